"""File inventories: listing, digests, comparison and archive planning."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_inventory(spark: SparkSession, root: str, digests: bool = True, block: int = 8 << 20) -> DataFrame:
    """``relative_path, size, sha256`` of all files below a folder, also those whose names begin with a dot or an underscore.

    The names and sizes are listed by the driver, as Spark's own readers do; the contents are digested on the executors, in
    blocks of ``block`` bytes, so a file may be of any size. Without ``digests`` no content is read. Symbolic links are refused.
    """
    system, base = FileSystem.from_uri(root if "://" in root else f"file://{os.path.abspath(root)}")
    if isinstance(system, LocalFileSystem) and (links := [os.path.join(d, x) for d, folders, names in os.walk(base) for x in folders + names if os.path.islink(os.path.join(d, x))]):
        raise ValueError(f"symbolic link: {links[0]}")
    found = [(f.path, f.path.removeprefix(base.rstrip("/") + "/"), f.size) for f in system.get_file_info(FileSelector(base, recursive=True)) if f.is_file]
    files = spark.createDataFrame(found, "path string, relative_path string, size bigint")
    if not digests:
        return files.drop("path")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for path in batch.column(0).to_pylist():
                total = hashlib.sha256()
                with system.open_input_stream(path) as file:
                    while part := file.read(block):
                        total.update(part)
                sums.append(total.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(sums, pa.string())], ["relative_path", "size", "sha256"])

    return files.repartition(max(1, min(len(found), 10_000))).mapInArrow(digest, "relative_path string, size bigint, sha256 string")


def inventory_difference(left: DataFrame, right: DataFrame, key: str, compared: list[str]) -> DataFrame:
    """``key, problem``: missing on the right or left, or different. Empty if the inventories are equal."""
    a = left.select(key, F.struct(*compared).alias("a"))
    b = right.select(key, F.struct(*compared).alias("b"))
    problem = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "unexpected").otherwise("different")
    return a.join(b, key, "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select(key, problem.alias("problem"))


def archive_plan(bags: DataFrame, archive: str) -> DataFrame:
    """``path, destination, problem`` for bags (``path, collection``): the archive folder, the collection's name and the
    bag's place in it; without a collection, the bag's name. Equal destinations are problems."""
    name = F.element_at(F.split("path", "/"), -1)
    inside = F.expr("CASE WHEN collection IS NULL THEN NULL WHEN path = collection THEN element_at(split(collection, '/'), -1) ELSE concat(element_at(split(collection, '/'), -1), '/', substring(path, length(collection) + 2)) END")
    planned = bags.select("path", F.concat(F.lit(archive.rstrip("/") + "/"), F.coalesce(inside, name)).alias("destination"))
    repeated = planned.groupBy("destination").agg(F.count(F.lit(1)).alias("n"))
    return planned.join(repeated, "destination").select("path", "destination", F.when(F.col("n") > 1, "duplicate destination").alias("problem"))


def required_bytes(inventory: DataFrame, archived: DataFrame, key: str) -> DataFrame:
    """Bytes of what isn't archived yet."""
    return inventory.join(archived.select(key).distinct(), key, "left_anti").agg(F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("required_bytes"), F.count(F.lit(1)).alias("n_files"))
