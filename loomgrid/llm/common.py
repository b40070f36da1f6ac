"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of all contracts here: space, tab, line feed, vertical tab, form feed, carriage return.
#: ``bytes.split()`` without arguments splits at exactly these six.
SPACE_CLASS = r"[\x20\x09-\x0D]"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only where that is unset and all executors are
    this machine (tests). Elsewhere each executor would write to a disk of its own, so that is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="loomgrid-"))
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This cuts lineage and survives the loss of executors: the files are on shared storage, and the
    columns (row identifiers, partition numbers) are from then on fixed whatever Spark recomputes.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    for tables in _GATHERED:
        tables.append(out)
    return out


_GATHERED: list[list[DataFrame]] = []


@contextlib.contextmanager
def gathered() -> Iterator[list[DataFrame]]:
    """A list of the tables that are written within this: once its result is written too, a caller may release them."""
    tables: list[DataFrame] = []
    _GATHERED.append(tables)
    try:
        yield tables
    finally:
        _GATHERED[:] = [x for x in _GATHERED if x is not tables]


def release(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more, and the shuffle files of the plans that wrote them."""
    for table in tables:
        spark = table.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(table.written_path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    if tables:
        drop_shuffles(tables[0].sparkSession)


def drop_shuffles(spark: SparkSession) -> None:
    """Have the driver collect its garbage: only then does Spark delete the shuffle files of plans that nothing holds any more,
    which would fill executors' disks in a long job."""
    gc.collect()  # Python's objects hold the JVM's
    spark.sql("SELECT 1").collect()  # the listener bus holds the event, and so the plan, of the query that ended last: this one
    with contextlib.suppress(Py4JError):  # it is still busy
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    spark.sparkContext._jvm.System.gc()


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Within this, plans that are made and run send Arrow batches of at most so many rows: rows with whole texts are
    wide, and both the JVM and the Python worker hold a batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def trim_worker() -> None:
    """Give back what a Python worker has freed: workers stay for the next stages, whose memory is the same executor's."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def shrink_executors(spark: SparkSession) -> None:
    """Have the executors' JVMs collect their garbage and give back the heap that earlier stages left: Python workers, which stay
    for a minute, and the next stage need it."""
    tasks = max(2, spark.sparkContext.defaultParallelism)
    spark.range(0, tasks, 1, tasks).selectExpr("reflect('java.lang.System', 'gc') AS done").collect()


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hash_remainder(id_column: Column, modulus: int) -> Column:
    """``crc32(id as text) mod modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
