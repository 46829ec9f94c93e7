"""The registered queries of the subpackage, one per operator, and the SQL of those SQL can state."""

from __future__ import annotations

import os
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm import bpe, ctw, mixing, pieces, pii, quality_rules, repair, sharding, simhash, spelling, suffix_dedup, topk, warc
from stockloom.llm.common import stored
from stockloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def vocabulary_path() -> str:
    """Where the vocabulary lies: TOKENIZER_FILE, else the file of the installed package."""
    if named := os.environ.get("TOKENIZER_FILE"):
        return named
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def surrogate_key() -> str:
    """SURROGATE_KEY, which every run on real data sets. Without it the registered runs use a public key for tests."""
    if key := os.environ.get("SURROGATE_KEY"):
        return key
    warnings.warn("SURROGATE_KEY is not set: surrogates are drawn with the public test key", stacklevel=2)
    return "public test key"


def piece_model_path() -> str:
    """The same for the piece model: PIECE_MODEL_FILE, else the file of the installed package."""
    if named := os.environ.get("PIECE_MODEL_FILE"):
        return named
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("op1_poisson_mix", f"""
WITH sizes AS (
  SELECT source, sum(coalesce(length(text), 0) + 1) AS size FROM documents GROUP BY source
), weights AS (
  SELECT source, pow(CAST(size AS DOUBLE), 0.5) AS weight FROM sizes
), rates AS (
  SELECT sizes.source, (SELECT sum(size) FROM sizes) * weight / (SELECT sum(weight) FROM weights) / size AS rate
  FROM sizes JOIN weights ON sizes.source IS NOT DISTINCT FROM weights.source
), parts AS (
  SELECT source, rate, greatest(ceil(rate / 16), 1) AS parts FROM rates
), inverse AS (
  SELECT source, rate, parts, list(upto ORDER BY k) AS inverse FROM (
    SELECT source, rate, parts, k, sum(exp(-rate / parts + k * ln(rate / parts) - lgamma(k + 1)))
      OVER (PARTITION BY source ORDER BY k) AS upto
    FROM (SELECT *, unnest(range(0, 1 + CAST(ceil(rate / parts + 10 * sqrt(rate / parts) + 20) AS BIGINT))) AS k FROM parts)
  ) GROUP BY source, rate, parts
), counted AS (
  SELECT d.*, rate, list_sum(list_transform(range(1, CAST(parts AS BIGINT) + 1), lambda i: len(list_filter(inverse, lambda c:
    c <= CAST(('0x' || substr(md5('{mixing.SEED}|count|' || i || '|' || coalesce(CAST(doc_id AS VARCHAR), '-' || md5(coalesce(text, '')))), 1, 13)) AS BIGINT)
      / 4503599627370496.0)))) AS n
  FROM documents d JOIN inverse ON d.source IS NOT DISTINCT FROM inverse.source
), copies AS (
  SELECT *, unnest(range(1, CAST(n AS BIGINT) + 1)) AS nth FROM counted
)
SELECT doc_id, text, lang, source, n_chars, CAST(nth AS INTEGER) AS "copy", round(rate, 6) AS rate,
       CAST(('0x' || substr(md5('{mixing.SEED}|place|' || nth || '|' || coalesce(CAST(doc_id AS VARCHAR), '-' || md5(coalesce(text, '')))), 1, 15)) AS BIGINT) AS mix_key
FROM copies""")
def op1_poisson_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Sources flattened by the square root of their sizes, one epoch in all."""
    return mixing.mix(table(spark, folder, "documents")).withColumn("rate", F.round("rate", 6))


@query("op2_warc", """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS h,
         min(page_id) OVER (PARTITION BY sha1(html), strlen(html)) AS first
  FROM p
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
         ((((strpos('0123456789abcdef', substr(h, 1 + (5 * i) // 4, 1)) - 1) * 16
            + strpos('0123456789abcdef', substr(h, 2 + (5 * i) // 4, 1)) - 1) >> (3 - (5 * i) % 4)) & 31), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, true AS intact
FROM d""")
def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    packages = warc.write_packages(table(spark, folder, "pages"), scratch_path(spark, "packages"))
    rows = warc.read_packages(spark, packages, payload=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


@query("op3_topk", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, p.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(p.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v p ON q.vec_id % 50 = 0 AND q.vec_id <> p.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5""")
def op3_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("id") % 50 == 0)


@query("op4_suffix_dedup", """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), s AS (
  SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 49, 0))) AS p FROM d
), w AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS win FROM s
), bad AS (
  SELECT w.doc_id, w.p FROM w JOIN (SELECT win, min(doc_id) AS first FROM w GROUP BY win) f ON w.win = f.win AND w.doc_id > f.first
), starts AS (
  SELECT doc_id, p, p > 50 + coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -100) AS fresh FROM bad
), islands AS (
  SELECT doc_id, p, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM starts
), spans AS (
  SELECT doc_id, k, min(p) AS b, max(p) + 50 AS e FROM islands GROUP BY doc_id, k
), pieces AS (
  SELECT doc_id, b, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS done, e FROM spans
), kept AS (
  SELECT d.doc_id, count(b) AS n_spans, coalesce(sum(e - b), 0) AS n_removed,
         coalesce(string_agg(substr(h, 2 * done + 1, 2 * (b - done)), '' ORDER BY b), '')
           || substr(any_value(h), 2 * coalesce(max(e), 0) + 1) AS left_hex, any_value(h) AS h
  FROM d LEFT JOIN pieces USING (doc_id) GROUP BY d.doc_id
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
       sha256(unhex(left_hex)) AS kept_sha256
FROM kept""")
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, folder, "documents"), with_kept=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op5_simhash")
def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@query("op6_context_tree")
def op6_context_tree(spark: SparkSession, folder: str) -> DataFrame:
    return ctw.score(table(spark, folder, "documents"))


@query("op7_pii_surrogates")
def op7_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pii.replace_entities(docs, surrogate_key())


@query("op8_two_pass_shuffle")
def op8_two_pass_shuffle(spark: SparkSession, folder: str) -> DataFrame:
    """Forty shards by the law that row counts differ by at most one."""
    rows = sharding.shard(table(spark, folder, "documents"))
    return rows.select(
        "doc_id", sharding.record_size(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op9_bpe")
def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, vocabulary_path(), carry=["doc_id"]).drop("n_bytes")


@query("op10_quality_rules", r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d
), windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
), repeated AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM repeated) GROUP BY doc_id
), lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM w JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), b AS (
  SELECT *, CAST(CASE WHEN n_words < 20 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
    + CASE WHEN n_symbols > 2 * n_words THEN 4 ELSE 0 END
    + CASE WHEN n_lines >= 10 AND 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 25 * n_words THEN 16 ELSE 0 END AS BIGINT) AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed,
       fail_bits & 31 = 0 AS kept, fail_bits
FROM b""")
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = quality_rules.ledger(docs, carry=["doc_id"])
    base, current = quality_rules.POLICIES[0], quality_rules.CURRENT
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(base)).alias("base_failed"),
        (quality_rules.passes(base) & quality_rules.passes(current)).alias("kept"),
        "fail_bits",
    )


_asked = ", ".join(
    f"('{p.version}', '{r.name}', {p.mask}, {1 << r.bit})" for p in quality_rules.POLICIES for r in quality_rules.RULES if r.name in p.rules)


@query("ledger_ablations", f"""
WITH ledger AS ({SQL['op10_quality_rules']}), asked(policy, rule, mask, bit) AS (VALUES {_asked})
SELECT policy, rule, count(*) FILTER (fail_bits & bit <> 0) AS n_failed, count(*) FILTER (fail_bits & mask <> 0) AS n_rejected,
       count(*) FILTER (fail_bits & mask = bit) AS n_only_this
FROM ledger, asked GROUP BY policy, rule""")
def ledger_ablations(spark: SparkSession, folder: str) -> DataFrame:
    """What each rule of each policy does, from the bits of all documents; the ledger is written once and read."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    bits = quality_rules.ledger(docs, carry=["doc_id"]).select("doc_id", "fail_bits")
    return quality_rules.ablations(stored(bits, "ledger"))


@query("op11_sentencepiece")
def op11_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pieces.round_trip(docs, piece_model_path(), carry=["doc_id"])


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair(table(spark, folder, "conversations"))


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents").select("doc_id", "text"))
