"""Bronze datasets, their schemas, scans and the prepared inputs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemill.operators.silver import build_silver
from lakemill.sources.names import join_path


@dataclass(frozen=True)
class Dataset:
    """A raw table: file, output folder, key, schema, partitions to write."""

    name: str
    key: str
    ddl: str
    partitions: int
    unique: bool = True

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


# The five datasets, their columns and write partitions.
DATASETS = {
    d.name: d
    for d in (
        Dataset("review", "review_id", "review_id string, user_id string, business_id string, stars double, useful long, funny long, cool long, text string, date string", 192),
        Dataset(
            "business", "business_id",
            "business_id string, name string, address string, city string, state string, postal_code string, latitude double, longitude double, "
            "stars double, review_count long, is_open long, attributes map<string,string>, categories string, hours map<string,string>", 8,
        ),
        Dataset("checkin", "business_id", "business_id string, date string", 8, unique=False),
        Dataset("tip", "business_id", "user_id string, business_id string, text string, date string, compliment_count long", 16, unique=False),
        Dataset(
            "user", "user_id",
            "user_id string, name string, review_count long, yelping_since string, useful long, funny long, cool long, elite string, friends string, "
            "fans long, average_stars double, compliment_hot long, compliment_more long, compliment_profile long, compliment_cute long, compliment_list long, "
            "compliment_note long, compliment_plain long, compliment_cool long, compliment_funny long, compliment_writer long, compliment_photos long", 32,
        ),
    )
}


def read_json(spark: SparkSession, schema: StructType | str, path: str) -> DataFrame:
    """JSON lines with an explicit schema: unknown fields go, a bad line aborts."""
    return spark.read.schema(schema).option("mode", "FAILFAST").option("multiLine", False).json(path)


def with_lineage(df: DataFrame) -> DataFrame:
    return df.withColumns({"_source_file": F.col("_metadata.file_path"), "_ingested_at": F.current_timestamp()})


def read_bronze(spark: SparkSession, name: str, root: str) -> DataFrame:
    """A Bronze Parquet table with its explicit schema and lineage columns."""
    return with_lineage(spark.read.schema(DATASETS[name].schema).parquet(join_path(root, name)))


def read_prepared(spark: SparkSession, path: str, kind: str = "csv") -> DataFrame:
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind == "csv":
        return spark.read.options(header=True, inferSchema=True, multiLine=True, escape='"').csv(path)
    raise ValueError(f"unknown format: {kind}")


def read_joined(spark: SparkSession, reviews: str, places: str, users: str) -> DataFrame:
    """Silver straight from three Parquet paths."""
    return build_silver(*(spark.read.parquet(p) for p in (reviews, places, users)))


def find_one(spark: SparkSession, folder: str, filename: str) -> str:
    """Path of the only file of that name below a folder; ValueError otherwise."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", filename).option("recursiveFileLookup", True).load(folder).select("path").limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"{'no' if not found else 'more than one'} file named {filename} in {folder}")
    return found[0].path


def read_found_json(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """A raw dataset found by its file name anywhere below a folder."""
    return with_lineage(read_json(spark, DATASETS[name].schema, find_one(spark, folder, f"{name}.json")))


@contextmanager
def staged(spark: SparkSession, folder: str, filenames: list[str]) -> Iterator[dict[str, str]]:
    """Copies of small remote files on the driver, deleted at the end.

    For lexicons only: each file is one row of a binary scan, bounded to 64 MB.
    """
    with tempfile.TemporaryDirectory() as top:
        out = {}
        for name in filenames:
            path = find_one(spark, folder, name)
            row = spark.read.format("binaryFile").load(path).where(F.col("length") < 64 << 20).select("content").first()
            if row is None:
                raise ValueError(f"{name} is too large to stage")
            out[name] = os.path.join(top, name)
            with open(out[name], "wb") as f:
                f.write(row.content)
        yield out
