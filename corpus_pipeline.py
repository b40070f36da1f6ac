"""A corpus pipeline of five stages over the documents table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgrid.llm import language_id, line_dedup, packing, pii, simhash
from loomgrid.llm.common import gathered, hash_remainder, materialize, release, shrink_executors

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_text_of(docs: DataFrame) -> DataFrame:
    """The columns of documents, ``n_chars`` as the text now is."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those that no model accepts (or without a letter) go.

    Rows are whole texts here, and both the JVM and the Python workers hold a batch of them, so batches are kept small from
    this stage on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    models = language_id.fit_languages(docs.where(hash_remainder(F.col("doc_id"), 5) != 0))
    judged = language_id.identify_languages(docs.select(*COLUMNS), models, keep=COLUMNS)
    return judged.where("NOT rejected").select(*COLUMNS)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repetitions of passages are deleted; documents of which nothing is left go."""
    shrink_executors(spark)
    cleaned = line_dedup.dedup_passages(docs.select(*COLUMNS))
    return _with_text_of(cleaned.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8 or more) the document with the smallest identifier:
    one row, also of rows that repeat an identifier, or an identifier and a text."""
    groups = simhash.similar_groups(docs, seeds=3)
    # plain columns in place of a null-safe comparison: the texts are then dealt once for the join and the window
    place = [F.coalesce("doc_id", F.lit(0)).alias("place"), F.col("doc_id").isNull().alias("no_id")]
    kept = groups.where("kept").select(*place, "text_hash")
    rows = docs.select(*COLUMNS, *place, F.xxhash64("text").alias("text_hash")).join(kept, ["place", "no_id", "text_hash"], "left_semi")
    # rows with the same identifier and text are in one group, of which one row is kept
    same = Window.partitionBy("place", "no_id", "text_hash").orderBy("lang", "source")
    return rows.withColumn("copy", F.row_number().over(same)).where("copy = 1").select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return _with_text_of(pii.mask_personal_data(docs.select(*COLUMNS), pii.fit_field(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens."""
    # workers go from stage to stage with what they hold, so this one keeps fewer words
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), memo_words=100_000)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("simhash", remove_near_duplicates),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: The stages' models aren't expressible in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again. What a stage has read and written on the way is
    deleted as soon as its result is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for _, stage in STAGES[:-1]:
        with gathered() as tables:
            docs = materialize(stage(spark, docs, sf_dir))
        release(*before, *tables[:-1])
        before = tables[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
