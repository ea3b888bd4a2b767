"""Support shared by the operators: input shape, layout, packed exchange.

Packed exchange: several operators compare very many 64-bit fingerprints of
all documents. One row per fingerprint would make Spark handle every one of
them as a record; here each document shard sends one row per bucket whose
payload is a sorted array of fingerprints, and buckets answer with arrays in
the same order. Keys are distinct within a shard, so a fingerprint that a
third of all documents share costs each shard one entry.
"""

from __future__ import annotations

import gc
import tempfile
import time

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: what operators return of an id through Arrow: null ids travel as 0 and a flag, since
#: pandas would turn a column of longs with a null into doubles
IDS = "doc_id long, no_id boolean"


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the unit for shards and buckets."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Where the session names
    none, a temporary one is made, on a local master only: executors do not
    share such a folder."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="checkpoints"))
    return sc._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Delete shuffles and checkpoints of finished steps now: Spark does so only
    after a collection of the driver's memory finds that nothing names them.
    Names that Python drops reach the JVM by a thread of Py4J that may sleep
    for a second first."""
    gc.collect()
    time.sleep(1.2)
    spark.sparkContext._jvm.System.gc()


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more) -> DataFrame:
    """The columns operators work on (and more): doc_id (0 where null), no_id
    and text; a null text counts as empty. :func:`own_ids` puts nulls back."""
    key = F.col(id_col).cast("long")
    return df.select(
        F.coalesce(key, F.lit(0)).alias("doc_id"),
        key.isNull().alias("no_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *more,
    )


def own_id() -> Column:
    """The id as it was given."""
    return F.when(~F.col("no_id"), F.col("doc_id"))


def own_ids(out: DataFrame) -> DataFrame:
    """Put null ids back into an operator's result."""
    return out.withColumn("doc_id", own_id()).drop("no_id")


def row_key(id_col: str, text_col: str) -> Column:
    """64 bits that name a row by its id and text; never null."""
    return F.xxhash64(F.col(id_col), F.col(id_col).isNull(), F.col(text_col), F.col(text_col).isNull())


def _range_column(docs: DataFrame, cuts: list[float], name: str) -> DataFrame:
    """Number of the range of doc_id between sorted cuts."""
    if not cuts:
        return docs.withColumn(name, F.lit(0))
    from pyspark.ml.feature import Bucketizer

    step = Bucketizer(splits=[-np.inf, *cuts, np.inf], inputCol="__k", outputCol="__s")
    return step.transform(docs.withColumn("__k", F.col("doc_id").cast("double"))).withColumn(name, F.col("__s").cast("int")).drop("__k", "__s")


def with_range_shard(docs: DataFrame, shards: int) -> tuple[DataFrame, list[int]]:
    """Add ``shard``: consecutive ranges of doc_id with about equally much text each.

    Shard order is document order: ids never fall from one shard to the next,
    rows without an id come last, and of equal ids the hash of the text
    (column ``place``, signed) never falls. Returns the rows and the class of
    each shard: shards of one class hold one id only (or none), so none of
    them is earlier than another; other shards are a class of their own. That
    is how an id that many rows share, and many rows without one, are spread.

    Eight times as many ranges of equally many rows are weighed by their
    characters and joined into shards; only their bounds and weights (at most
    ``16 * shards`` numbers) reach the driver.
    """
    docs = docs.withColumn("place", F.xxhash64("text"))
    if shards < 2:
        return docs.withColumn("shard", F.col("no_id").cast("int")), [0, 1]
    fine = 8 * shards
    found = docs.where("not no_id").select(F.col("doc_id").cast("double").alias("k")).approxQuantile("k", [i / fine for i in range(1, fine)], 1 / (4 * fine))
    often = {a for a, b in zip(found, found[1:]) if a == b}  # an id that fills a range is a range of its own
    cuts = sorted({*found, *(float(np.nextafter(k, np.inf)) for k in often)})
    ranged = _range_column(docs, cuts, "r").withColumn("r", F.when(F.col("no_id"), len(cuts) + 1).otherwise(F.col("r")))
    weigh = ranged.groupBy("r").agg(F.sum(F.length("text") + 64).alias("w"), (F.min("doc_id") == F.max("doc_id")).alias("one"))
    weights = {r.r: r for r in weigh.collect()}
    share = max(1, sum(r.w for r in weights.values()) / shards)
    kept, parts, seen = [], [1], 0.0  # cuts between the joined ranges, and shards of each of them
    for r in range(len(cuts) + 2):
        w, several = 0, 1
        if r in weights:
            w, several = weights[r].w, max(1, round(weights[r].w / share)) if weights[r].one else 1
        if r and (several > 1 or parts[-1] > 1 or seen >= share or r > len(cuts)):
            kept += cuts[r - 1 : r]  # rows without an id need no cut
            parts.append(1)
            seen = 0.0
        parts[-1] = several
        seen += w
    starts = np.concatenate([[0], np.cumsum(parts)]).tolist()
    classes = [a for a, n in zip(starts, parts) for _ in range(n)]
    joined = _range_column(docs, kept, "r").withColumn("r", F.when(F.col("no_id"), len(parts)).otherwise(F.col("r") + 1))
    many = F.element_at(F.lit(parts), F.col("r"))
    part = F.least(many - 1, F.floor((F.col("place") / F.lit(2.0**64) + 0.5) * many).cast("int"))
    return joined.withColumn("shard", (F.element_at(F.lit(starts), F.col("r")) + part).cast("int")).drop("r"), classes


class WordHash(dict):
    """Word (bytes) to XXH64, remembered; forgets all when it grows too large."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
S31, S29 = np.uint64(31), np.uint64(29)


def mix(a: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (multiply, shift, multiply)."""
    a = (a ^ (a >> S31)) * M1
    a ^= a >> S29
    return a * M2


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by sorting: np.unique hashes, which is slower for
    many distinct integers."""
    x = np.sort(x)
    if len(x) < 2:
        return x
    keep = np.ones(len(x), bool)
    keep[1:] = x[1:] != x[:-1]
    return x[keep]


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket from the upper 32 bits; ascending with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def cut_by_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bounds of each bucket in sorted keys (buckets + 1 positions)."""
    return np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1, dtype=np.uint64))


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted uint64 as byte planes of their differences, which compress well."""
    if not len(keys):
        return b""
    diff = keys.copy()
    diff[1:] -= keys[:-1]
    return diff.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    n = len(data) // 8
    planes = np.frombuffer(data, np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").reshape(n).astype(np.uint64), dtype=np.uint64)


def pack_planes(values: np.ndarray) -> bytes:
    """Fixed-width numbers as byte planes."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T.tobytes()


def unpack_planes(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, len(data) // width).T).view(dtype).reshape(-1)


def ascii_lower_words(text: str) -> list[bytes]:
    """Words of the text, A-Z lowered, as UTF-8 bytes."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 bytes: bytes.split() splits on just these."""
    return text.encode("utf-8", "surrogatepass").split()


def crc_mod(col, modulus: int):
    """crc32 of the decimal id, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % modulus
