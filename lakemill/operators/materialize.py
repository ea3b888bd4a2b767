"""Keeping a frame between uses, and giving it back."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from lakemill.sources.names import table_name

MODES = ("auto", "persist", "table", "none")


def new_run_id() -> str:
    return f"r_{uuid.uuid4().hex}"


def is_connect(spark: SparkSession) -> bool:
    """Whether the session is remote (Spark Connect), without a SparkContext."""
    return not hasattr(spark, "_jsparkSession")


def resolve_mode(mode: str, remote: bool) -> str:
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}; known: {MODES}")
    return ("table" if remote else "persist") if mode == "auto" else mode


@dataclass
class Kept:
    """Frames and scratch tables of a run; ``release`` undoes them, last first."""

    spark: SparkSession
    mode: str = "auto"
    schema: str = "default"
    run_id: str = field(default_factory=new_run_id)
    warnings: list[str] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=dict)
    _undo: list[tuple[str, Callable[[], object]]] = field(default_factory=list)

    def keep(self, df: DataFrame, stage: str) -> DataFrame:
        """The frame, computed once: cached, or a scratch table in Parquet."""
        how = resolve_mode(self.mode, is_connect(self.spark))
        if how == "persist":
            df = df.persist()
            self._undo.append((stage, df.unpersist))
        elif how == "table":
            name = table_name(self.schema, f"_scratch_{stage}_{self.run_id}")
            self._undo.append((stage, lambda: self.spark.sql(f"DROP TABLE IF EXISTS {name}")))
            df.write.format("parquet").saveAsTable(name.replace("`", ""))
            df = self.spark.table(name)
        self.counts[stage] = df.count()
        return df

    def release(self) -> list[str]:
        """Undo everything; what fails becomes a warning."""
        while self._undo:
            stage, undo = self._undo.pop()
            try:
                undo()
            except Exception as e:  # noqa: BLE001  a failed clean-up must not hide the run's outcome
                self.warnings.append(f"{stage}: {e}")
        return self.warnings

    def __enter__(self) -> Kept:
        return self

    def __exit__(self, *_) -> None:
        self.release()


def configure_arrow(spark: SparkSession, batch: int) -> dict[str, bool]:
    """Set the Arrow options; one that the runtime does not know is reported False."""
    done = {}
    for key, value in (("spark.sql.execution.arrow.pyspark.enabled", "true"), ("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))):
        try:
            spark.conf.set(key, value)
            done[key] = True
        except Exception as e:
            if "CONFIG_NOT_AVAILABLE" not in str(e) and "CANNOT_MODIFY_CONFIG" not in str(e):
                raise
            done[key] = False
    return done
