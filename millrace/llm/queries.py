"""The queries of this package over the test tables, one per operator, and their SQL."""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.decontaminate import find_leaks
from millrace.llm.filter_audit import audit_filters, stream_documents
from millrace.llm.licenses import scan_licenses
from millrace.llm.mixing import fair_queue
from millrace.llm.near import near_duplicates
from millrace.llm.pieces import decode_pieces, encode_pieces
from millrace.llm.quality import clean_lines
from millrace.llm.ring import shard_rows
from millrace.llm.spelling import spelling_groups
from millrace.llm.suffix import remove_repeats
from millrace.llm.token_counts import count_tokens
from millrace.llm.token_files import sequence_round_trip
from millrace.llm.warc import archive_round_trip
from millrace.registry.base import Query
from millrace.session import apply_settings

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Arrow batches are bounded by bytes as well as rows, so long texts do not pile up.
BATCH_BYTES = str(16 << 20)


def query(sql: str | None = None):
    """Register a function under its own name; ``sql`` is DuckDB's version of it."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_settings(spark)
            spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query()
def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = clean_lines(docs)
    return out.select(
        F.col("row.doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines", "n_removed_lines", "lost_chars",
    )


@query()
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op5_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_rows(table(spark, sf_dir, "documents"), shards=24)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


MIX = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS point
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM d GROUP BY source),
w AS (SELECT *, ([3.0, 1.0, 2.0])[rank % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS most, sum(source_size) OVER () * 1.5::DOUBLE AS total FROM s),
f AS (SELECT *, row_number() OVER (ORDER BY most / weight, rank) AS place,
             coalesce(sum(most) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE) AS filled,
             sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM w),
l AS (SELECT *, (SELECT (total - filled) / open FROM f WHERE (total - filled) / open * weight <= most ORDER BY place LIMIT 1) AS level FROM f),
t AS (SELECT source, rank, source_size, least(most, coalesce(weight * level, most)) AS target FROM l),
q AS (SELECT d.*, t.rank, t.source_size, t.target,
             sum(size) OVER (PARTITION BY d.source ORDER BY point, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT doc_id, point, rank, size, (upto + source_size * n) / target AS finish FROM q, (VALUES (0), (1)) v(n) WHERE size > 0 AND target > 0),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, rank ROWS UNBOUNDED PRECEDING) AS run FROM e),
c AS (SELECT doc_id, point, count(*) AS turns FROM r WHERE run <= (SELECT sum(source_size) * 1.5 FROM s) GROUP BY ALL)
SELECT q.doc_id, q.size, q.source_size, q.target, (q.size * coalesce(c.turns, 0))::BIGINT AS taken
FROM q LEFT JOIN c ON q.doc_id IS NOT DISTINCT FROM c.doc_id AND q.point = c.point
"""


@query(MIX)
def op6_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fair_queue(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@query(
    """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
    d AS (SELECT page_id, octet_length(body) AS n, sha256(body) AS digest FROM p),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d)
    SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
    CASE WHEN n >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND first <> page_id THEN first END AS refers_to FROM f"""
)
def op4_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = archive_round_trip(table(spark, sf_dir, "pages"))
    return out.select(
        F.col("key").cast("long").alias("page_id"),
        F.coalesce("main.payload_bytes", "original.payload_bytes").alias("payload_bytes"),
        F.col("main.payload_digest"),
        F.col("main.kind").alias("record_type"),
        F.col("original.key").cast("long").alias("refers_to"),
    )


@query()
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sequence_round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


LINKS = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
p AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS shingle
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM p GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM p a JOIN p b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
k AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.size + y.size - shared)),
g AS (SELECT a, b FROM k UNION SELECT b, a FROM k),
r(id, other) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.id, g.b FROM r JOIN g ON g.a = r.other),
m AS (SELECT id, min(other) AS component_id FROM r GROUP BY id)
SELECT w.doc_id, coalesce(n.size, 0)::BIGINT AS n_shingles, m.component_id, w.doc_id = m.component_id AS kept
FROM w JOIN m ON m.id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
"""


@query(LINKS)
def op2_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


@query()
def op10_bm25_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan_licenses(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "paragraph_no", "family", "predicted", "probability", "similarity", F.md5("paragraph").alias("paragraph_md5"))


@query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"), least=400)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        (F.size("spans") > 0).alias("changed"), F.length("kept").cast("long").alias("n_kept"),
        # a run may end inside a character; the bytes left of it are U+FFFD here, the digest has them as they are
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


@query()
def op11_distinct_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    out = decode_pieces(encode_pieces(table(spark, sf_dir, "documents"), model), model)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


AUDIT = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT t.doc_id, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
      + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
      + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
      + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
      + CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask
      FROM t LEFT JOIN l ON t.doc_id = l.doc_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
b AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT [v.x, w.x, y.x, z.x, u.x] AS letters, [v.bit, w.bit, y.bit, z.bit, u.bit] AS bits FROM b v, b w, b y, b z, b u
      WHERE v.bit | w.bit | y.bit | z.bit | u.bit = 31),
s AS (SELECT array_to_string(letters, '') AS filter_order, i AS step, bits[i] AS bit, coalesce(list_sum(bits[1:i - 1]), 0)::INTEGER AS before
      FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS i)),
r AS (SELECT part, filter_order, step, bit,
        sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r
"""


@query(AUDIT)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = stream_documents(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    return audit_filters(docs, table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents").count())


@query()
def op13_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))
