"""Scans of tables that come in too few splits."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakemill.operators.materialize import is_connect


def spread(scan: DataFrame) -> DataFrame:
    """A plain scan, dealt out anew if it has fewer splits than the cluster cores.

    A small file of one row group is one split and would keep one core busy;
    inputs of many splits pass unchanged, without a shuffle. Only for scans:
    the number of splits of other plans is not known before they run. A remote
    session does not tell it, and gets the scan as it is.
    """
    if is_connect(scan.sparkSession):
        return scan
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
