"""What the operators of this subpackage share: the cluster's shared folder and A-Z lower-casing."""

from __future__ import annotations

import string
import tempfile
import zipfile
from collections.abc import Callable
from functools import reduce
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.sources import shared_folder

_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below the folder that the cluster names in spark.checkpoint.dir; without that setting, on
    a local master only, below a temporary one."""
    return shared_folder(spark)


#: Spark's setting for the bytes that go to a Python worker at once, and what it is set to where a session has no value of
#: its own. By default they are 64 MB, which a task then holds several times, in the JVM's buffers and in the worker.
BATCH_BYTES, AT_ONCE = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def ship(spark: SparkSession) -> None:
    """Makes this package known to the Python workers of all executors, once per application: they may neither
    share the driver's folders nor have it installed. Bounds the batches that they get (BATCH_BYTES)."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, AT_ONCE)
    sc, package = spark.sparkContext, Path(__file__).parents[1]
    if getattr(sc, "_tidewheel_shipped", False) or not package.is_dir():
        return
    target = f"{shared_dir(spark)}/tidewheel.zip"
    with tempfile.TemporaryDirectory() as folder:
        with zipfile.ZipFile(path := f"{folder}/tidewheel.zip", "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f"{package.name}/{f.relative_to(package)}")
        to = spark._jvm.org.apache.hadoop.fs.Path(target)
        to.getFileSystem(spark._jsc.hadoopConfiguration()).copyFromLocalFile(spark._jvm.org.apache.hadoop.fs.Path(f"file://{path}"), to)
    sc.addPyFile(target)  # executors fetch it from the shared folder
    sc._tidewheel_shipped = True


def broadcast(spark: SparkSession, value: Any) -> Broadcast:
    """A value that this package's functions use on executors."""
    ship(spark)
    return spark.sparkContext.broadcast(value)


#: Spark's setting by which a finished command deletes its shuffles' files; else they stay until the driver happens to
#: collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage, survives lost executors. The shuffles that made it are
    deleted with the command's end, as nothing reads them again."""
    path, conf = shared_dir(df.sparkSession), df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tidewheel_path = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder of the shared store, through Hadoop's file system API."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def forget(df: DataFrame) -> None:
    """Deletes the table behind a DataFrame that written() returned."""
    delete(df.sparkSession, df._tidewheel_path)


#: Rows that make a key common, and the common keys that there may be (that many rows are broadcast).
COMMON, KEYS = 1000, 1000


def looked_up(left: DataFrame, right: DataFrame, keys: list[str], counts: DataFrame | None = None) -> DataFrame:
    """left.join(right, keys, "left") for a right side with one row per key, without hot keys.

    Rows of left whose key is common (more than COMMON of them and a KEYSth of all) meet their row by a
    broadcast, and rows with a null in the key, which match nothing, aren't shuffled either.
    counts: keys and n, the rows of left for each key, where they are known already.
    """
    if counts is None:
        counts = left.groupBy(*keys).agg(F.count("*").alias("n"))
    whole = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.filter(F.col("n") > max(COMMON, whole // KEYS)).select(*keys)
    values = [c for c in right.columns if c not in keys]
    table = hot.join(right, keys, "left").withColumn("_common", F.lit(True))
    marked = left.join(F.broadcast(table), keys, "left")
    null = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    here = marked.filter(F.col("_common") | null).select(*left.columns, *values)
    away = marked.filter(F.col("_common").isNull() & ~null).select(*left.columns).join(right, keys, "left").select(*left.columns, *values)
    return here.unionByName(away)


#: Bits of a sieve: at most 8 MB.
SIEVE_BITS = 1 << 26


def sieve_places(wanted: DataFrame, key: str) -> tuple[Callable[[Column], Column], Broadcast]:
    """A bitmap of hashes of wanted's keys, and the places in it of a column of key's type; see held()."""
    bits = min(SIEVE_BITS, 1 << max(15, (16 * wanted.count()).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)) + 1
    # bitmap functions number positions from 1, in buckets of 32768
    rows = wanted.select(place(F.col(key)).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    table = np.zeros((bits >> 15, 4096), np.uint8)
    for r in rows:
        table[r.k - 1] = np.frombuffer(r.bits, np.uint8)
    return place, broadcast(wanted.sparkSession, table.ravel())


def held(bitmap: np.ndarray, places: pa.Array) -> np.ndarray:
    """Which places are set: false only where a value is no key."""
    p = places.to_numpy() - 1
    return (bitmap[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)


def sieve(wanted: DataFrame, key: str) -> Callable[[Column], Column]:
    """A function of a column (of key's type): false only where its value is no key of wanted. So few of the rows that a
    join with wanted would drop are shuffled for it."""
    place, shared = sieve_places(wanted, key)

    @F.arrow_udf("boolean")
    def maybe(places: pa.Array) -> pa.Array:
        return pa.array(held(shared.value, places))

    return lambda c: maybe(place(c))


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only; lower() would also change other scripts."""
    return F.translate(c, _UPPER, _LOWER)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
