"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import math
import tempfile
import uuid
from collections.abc import Iterable

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Null ids sort after every other id and come back as null.
NULL_ID = 2**63 - 1

_made: dict[str, SparkSession] = {}

#: Spark's setting by which shuffle files go as soon as the query that wrote them has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is ``spark.checkpoint.dir`` of the session.  Only where that is unset and everything runs in one process or machine
    (tests, a laptop) a temporary folder is taken and set; on a cluster that is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        where = spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="siltstone-")
        spark.sparkContext.setCheckpointDir(where)
    return where


def _drop(path: str, spark: SparkSession) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _drop_all() -> None:
    for path, spark in list(_made.items()):
        if spark.sparkContext._jsc is None:
            break  # the session is gone; the folder is then left to the cluster's own clean-up
        try:
            _drop(path, spark)
        except Py4JError:
            break  # its JVM is gone
    _made.clear()


def release(*tables: DataFrame) -> None:
    """Delete tables of `materialize` that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_siltstone_path", None)
        if path in _made:
            _drop(path, _made.pop(path))


def materialize(df: DataFrame, name: str, done: Iterable[DataFrame] = (), compression: str = "snappy") -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it again.

    It cuts lineage and lets several branches read the rows without computing them again.  The files
    survive lost executors.  Once `df` is written, its shuffle files and the tables in `done` are deleted; the rest goes when
    the driver process ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/siltstone-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    was = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.unset(CLEAN_UP) if was is None else spark.conf.set(CLEAN_UP, was)
    _made[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._siltstone_path = path
    release(*done)
    return out


def give_back() -> None:
    """Return free memory to the system: a Python worker lives on, beside others, and what it keeps counts against its executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def input_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of the bytes behind `df`, from file sizes; reads no data."""
    n = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return n if n < 2**60 else 0


def parts(df: DataFrame, bytes_each: int) -> int:
    """How many partitions or buckets of about `bytes_each` to deal `df` into."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(input_bytes(df) / bytes_each))


def doc_id(name: str = "doc_id") -> Column:
    return F.col(name).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores before it as it takes to differ from all columns of `df`."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def salt_of(key: Column, salts: int) -> Column:
    """A salt in 0 .. salts-1 that depends on the row's own id only, so that it survives recomputation."""
    return F.pmod(F.xxhash64(F.lit("salt"), key), F.lit(salts)).cast("int")


def salt_mask(salt: Column) -> Column:
    """One bit per salt; bit_or of these is a set of salts that stays a fixed-width aggregate."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), salt)


def salts_in(mask: Column, salts: int) -> Column:
    """The array of salts in a mask."""
    return F.filter(F.sequence(F.lit(0), F.lit(salts - 1)), lambda i: F.getbit(mask, i) == 1)
