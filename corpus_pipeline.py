"""A corpus from raw documents: stages over whole tables, each written and read again by the next.

quality: failing lines go, and documents that the rules reject. near_duplicates: of each group
of near copies the document of the smallest doc_id stays (nulls last, then by the text's digest). decontaminate: documents that hold a
benchmark item go. mix: every document is repeated as often as the mix takes it, or goes if it
does not. shard: every row gets its shard and its slot in it.

Defined results: null and empty texts fall to the quality rules; rows that are equal in doc_id and
text are near copies of which one stays; rows with a null or repeated doc_id are documents like
others, as decisions are applied by doc_id and digest of the text; extra
columns pass through, but for those named like the last stage's own (size, shard, slot,
text_crc32), which its own replace. No rows give no rows.

ORACLE_SQL is None: line cleaning, near-duplicate components and BM25 retrieval are no SQL;
``tests/llm`` holds every stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.decontaminate import find_leaks
from millrace.llm.mixing import fair_queue
from millrace.llm.near import near_duplicates
from millrace.llm.quality import clean_lines
from millrace.llm.ring import shard_rows
from millrace.llm.shared_files import stored
from millrace.session import scratch_path

ORACLE_SQL = None
BATCH_BYTES = str(16 << 20)


def _bounded(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes failing lines and the documents that the rules reject; n_chars follows the text."""
    _bounded(spark)
    out = clean_lines(docs).where("kept")
    fresh = {"text": F.col("clean_text"), "n_chars": F.char_length("clean_text").cast("long")}
    return out.select(*[fresh.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _row_key() -> Column:
    """What tells rows apart: doc_id alone may be null or repeated. Null ids come last in order."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.md5(F.col("text").cast("binary")).alias("digest"))


def _decided(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """``docs`` semi or anti joined with the keys (id, digest) of ``rows``."""
    digest = F.md5(F.col("text").cast("binary"))
    return docs.join(rows, F.col("doc_id").eqNullSafe(F.col("__id")) & digest.eqNullSafe(F.col("__digest")), how)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    _bounded(spark)
    keep = near_duplicates(docs.select(_row_key().alias("row"), "text"), key="row").where("kept")
    keep = keep.groupBy(F.col("row.id").alias("__id"), F.col("row.digest").alias("__digest")).agg(F.count("*").alias("__copies"))
    keep = stored(keep, "pipeline-kept")
    out = _decided(docs, keep, "left_semi")
    return out if keep.where("__copies > 1").isEmpty() else out.dropDuplicates(["doc_id", "text"])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    _bounded(spark)
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    leaks = find_leaks(docs.select(_row_key().alias("row"), "text"), benchmark, key="row")
    leaks = leaks.select(F.col("row.id").alias("__id"), F.col("row.digest").alias("__digest")).distinct()
    return _decided(docs, leaks, "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of the sources takes it."""
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    named = docs.withColumn("__digest", digest)
    turns = fair_queue(docs, carry=digest).select(F.col("doc_id").alias("__key"), F.col("carried").alias("__own"), F.col("turns").alias("__turns"))
    turns = stored(turns, "pipeline-turns")
    same = F.col("doc_id").eqNullSafe(F.col("__key")) & (F.col("__digest") == F.col("__own"))
    if not turns.groupBy("__key", "__own").count().where("count > 1").isEmpty():  # equal rows are told apart by number
        number = lambda a, b: F.row_number().over(Window.partitionBy(a, b).orderBy(F.lit(1)))
        named, turns = named.withColumn("__copy", number("doc_id", "__digest")), turns.withColumn("__nth", number("__key", "__own"))
        same &= F.col("__copy") == F.col("__nth")
    taken = named.join(turns.where("__turns > 0"), same)
    return taken.withColumn("__turn", F.explode(F.sequence(F.lit(1), F.col("__turns")))).select(*[F.col(f"`{c}`") for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents, and size, text_crc32, shard and slot of every row."""
    out = shard_rows(docs, shards=24, carry=docs.columns)
    own = ["size", "text_crc32", "shard", "slot"]
    return out.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in own], *own)


STAGES = [("quality", quality), ("near_duplicates", near), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
