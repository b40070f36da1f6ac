"""Exact de-duplication by a tree merge of sorted digest runs.

Every input partition is a leaf of the tree, or one of several of a leaf where there are more than ``MOST_LEAVES``. It holds a run: its distinct digests in sorted order, each with
the smallest identifier and the number of rows. The leaves then exchange runs in rounds. In round k the leaves
whose numbers differ only in digit k (base ``fan_in``, a power of two: ``log2(fan_in)`` binomial rounds folded
into one multiway merge) trade runs, each keeping the digests that have its digit; so after the last round each
leaf owns one slice of the digest space and no task ever holds more than a slice. Spark's sort does the
merging of a round's runs (it spills), a sort aggregate folds equal neighbours and keeps the smallest
identifier. A digest counts as equal only if SHA-256, byte length and an independent 64-bit hash all agree.

The answer travels down by (leaf, digest): a group that makes up a third of the corpus is one row per leaf,
so no key of any join or aggregate has more rows than there are leaves, or than one leaf read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgrid.llm.common import materialize

KEY = ["sha", "n_bytes", "check"]
#: Leaves exchange with each other in every round, so their number stops here, at which a slice of 10^11 digests still fits a task.
MOST_LEAVES = 4096


def normalized(text: Column) -> Column:
    """Null counts as empty; every run of white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digest_table(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """One narrow row per document: row number, leaf, identifier and digest. The texts are read once."""
    text = normalized(F.col(text_column))
    return documents.select(
        F.monotonically_increasing_id().alias("rid"),
        F.spark_partition_id().alias("part"),
        F.col(id_column).alias("id"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
        F.octet_length(text).alias("n_bytes"),
        F.xxhash64(text).alias("check"),
    )


def merge_tree(runs: DataFrame, leaves: int, fan_in: int) -> DataFrame:
    """``runs`` (leaf, digest key, first, n) merged to one row per digest."""
    digest_number = F.conv(F.hex(F.substring("sha", 1, 4)), 16, 10).cast("long")
    runs, stride = runs.withColumn("owner", F.col("leaf").cast("long")), 1
    while stride < leaves:
        # digit k of the owner becomes digit k of the digest
        digit = lambda number: F.floor(number / F.lit(stride)) % F.lit(fan_in)
        owner = F.col("owner") + (digit(digest_number) - digit(F.col("owner"))) * F.lit(stride)
        runs = (
            runs.withColumn("owner", owner.cast("long"))
            .repartitionById(leaves, F.col("owner").cast("int"))
            .groupBy("owner", *KEY)
            .agg(F.min("first").alias("first"), F.sum("n").alias("n"))
        )
        stride *= fan_in
    return runs.select(*KEY, F.col("first.id").alias("keep_id"), F.col("first.rid").alias("keep_rid"), F.col("n").alias("group_size"))


def exact_dedup(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", fan_in: int = 8) -> DataFrame:
    """One row per document: ``<id>, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after each run of white space is replaced by one space; a null text is an
    empty one. Of equal texts the row with the smallest identifier is kept. A null identifier is larger than
    any other; of rows that repeat an identifier and a text exactly one is kept. Other columns are ignored,
    whatever their names; an empty table gives an empty result.
    """
    if fan_in < 2 or fan_in & (fan_in - 1):
        raise ValueError("fan_in must be a power of two")
    digests = materialize(digest_table(documents, id_column, text_column))
    parts = digests.agg(F.max("part")).first()[0]
    leaves = fan_in
    while leaves < min((parts or 0) + 1, MOST_LEAVES):
        leaves *= fan_in
    digests = digests.withColumn("leaf", F.col("part") % F.lit(leaves))
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "rid")
    runs = digests.groupBy("leaf", *KEY).agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
    groups = merge_tree(runs, leaves, fan_in)
    back = runs.select("leaf", *KEY).join(groups, KEY)
    return digests.join(back, ["leaf", *KEY]).select(
        F.col("id").alias(id_column),
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("rid") == F.col("keep_rid")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
