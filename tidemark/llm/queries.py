"""The registered queries of this package and the SQL they must equal, where SQL can tell."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tidemark.llm import best_fit, byte_bpe, column_bwt, host_rules, license_scan, line_dedup, multi_index, odd_sketch, packing, periodic_runs, secret_ledger, token_alignment, toxicity
from tidemark.llm.common import documents, words_of


def op1_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(documents(spark, sf_dir), width=2)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.scored(docs, model).select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.without_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return cut.select(
        "doc_id",
        "text",
        F.length("text").cast("long").alias("n_chars"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.concat_ws(",", F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))).alias("removed"),
    )


OP4_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
parted AS (
  SELECT doc_id, string_split(regexp_replace(text, '(\n+|[.!?][\x20\t]|[。！？])', '\1' || chr(57344), 'g'), chr(57344)) AS units FROM texts),
units AS (SELECT doc_id, unnest(units) AS unit, unnest(range(0, len(units))) AS i FROM parted),
normal AS (
  SELECT *, trim(lower(regexp_replace(unit, '[\x20\x09-\x0D]+', ' ', 'g')), ' ') AS plain,
         len(list_filter(regexp_split_to_array(unit, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words,
         coalesce(sum(length(unit)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
  FROM units),
judged AS (SELECT *, plain <> '' AND row_number() OVER (PARTITION BY plain ORDER BY doc_id, i) > 1 AS again FROM normal),
runs AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, again ORDER BY i) AS run FROM judged),
verdicts AS (
  SELECT *, again AND (sum(words) OVER w >= 5 OR sum(length(plain)) OVER w >= 30) AS gone FROM runs WINDOW w AS (PARTITION BY doc_id, again, run)),
spans AS (SELECT doc_id, min(s) AS s, max(s + length(unit)) AS e FROM verdicts WHERE gone GROUP BY doc_id, run),
removed AS (
  SELECT doc_id, sum(e - s) AS n, count(*) AS k, string_agg(CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s) AS spans
  FROM spans GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(CASE WHEN gone THEN '' ELSE unit END, '' ORDER BY i) AS text FROM verdicts GROUP BY doc_id)
SELECT k.doc_id, k.text, length(k.text) AS n_chars, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed, coalesce(r.k, 0) AS n_spans,
       coalesce(r.spans, '') AS removed
FROM kept k LEFT JOIN removed r ON k.doc_id = r.doc_id
"""


def op5_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return secret_ledger.with_findings(docs, secret_ledger.new_ledger(spark)).drop("text")


def op6_column_bwt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_bwt.without_repeats(documents(spark, sf_dir)).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(documents(spark, sf_dir))


OP7_SQL = r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}\n]+', ' ', 'g') AS t FROM documents),
units AS (
  SELECT doc_id, 'line' AS kind, unnest(string_split(t, chr(10))) AS unit,
         unnest(range(0, len(string_split(t, chr(10))))) AS number FROM normal
  UNION ALL
  SELECT doc_id, 'paragraph', unit, number FROM (
    SELECT doc_id, unnest(regexp_split_to_array(t, '\n(?:\x20?\n)+')) AS unit,
           unnest(range(0, len(regexp_split_to_array(t, '\n(?:\x20?\n)+')))) AS number FROM normal)
  WHERE contains(unit, chr(10))),
worded AS (
  SELECT doc_id, kind, number, list_filter(regexp_split_to_array(unit, '[\x20\n]+'), lambda x: x <> '') AS words FROM units),
bigrams AS (
  SELECT DISTINCT doc_id, kind, number, words[i] || ' ' || words[i + 1] AS bigram
  FROM (SELECT *, unnest(range(1, len(words))) AS i FROM worded)),
sized AS (SELECT *, count(*) OVER (PARTITION BY doc_id, kind, number) AS n_unit FROM bigrams),
matched AS (
  SELECT doc_id, kind, number, license, count(*) AS n_shared, n_unit, n_template
  FROM sized JOIN (VALUES @templates@) t(license, n_template, bigram) USING (bigram)
  GROUP BY doc_id, kind, number, license, n_unit, n_template)
SELECT doc_id, kind, CAST(number AS INTEGER) AS number, license, CAST(n_shared AS INTEGER) AS n_shared,
       CAST(n_unit AS INTEGER) AS n_unit, n_template, CAST(2.0 * n_shared / (n_unit + n_template) AS DOUBLE) AS dice
FROM matched WHERE 2.0 * n_shared / (n_unit + n_template) >= 0.8
""".replace("@templates@", license_scan.template_values())


def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.host_verdicts(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_rules"
    )


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return multi_index.top_k(vectors, vectors.filter("vec_id % 20 = 0"))


OP8_SQL = """
WITH signs AS (SELECT vec_id, [x > 0 for x in embedding] AS s FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id, len([i for i in range(1, 65) if a.s[i] <> b.s[i]]) AS distance
  FROM signs a, signs b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
SELECT * FROM (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank, neighbor_id, distance
  FROM pairs)
WHERE rank <= 10
"""


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


OP10_SQL = r"""
WITH parted AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM parted)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(0, 5)) AS k FROM again) GROUP BY doc_id),
figures AS (
  SELECT p.doc_id, source, CAST(len(words) AS BIGINT) AS n_words, len(lines) AS n_lines,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words
  FROM parted p LEFT JOIN covered c ON p.doc_id = c.doc_id),
long AS (
  SELECT doc_id, source, unnest([
    {'rule': 'few_words', 'failed': n_words < 20},
    {'rule': 'many_symbols', 'failed': 10 * n_symbols > n_words},
    {'rule': 'dup_lines', 'failed': 10 * n_dup_lines > 3 * n_lines},
    {'rule': 'word_length', 'failed': word_chars < 3 * n_words OR word_chars > 12 * n_words},
    {'rule': 'repeats', 'failed': 10 * n_repeat_words > n_words}], recursive := true)
  FROM figures),
hosts AS (SELECT source, rule, count(*) AS n, count_if(failed) AS f FROM long GROUP BY source, rule),
moments AS (
  SELECT rule, sum(f) / sum(n) AS m, sum(1.0 * f * f / n) / sum(n) - (sum(f) / sum(n)) ^ 2 AS v FROM hosts GROUP BY rule),
priors AS (
  SELECT rule, m, CASE WHEN v > 1e-12 THEN least(greatest(m * (1 - m) / v - 1, 1.0), 1000000.0) ELSE 1000000.0 END AS s
  FROM moments),
bad AS (
  SELECT h.source, h.rule FROM hosts h JOIN priors p ON h.rule = p.rule WHERE (f + m * s) / (n + s) > 0.3),
broken AS (
  SELECT doc_id, string_agg(rule, ',' ORDER BY list_position(['few_words', 'many_symbols', 'dup_lines', 'word_length', 'repeats'], rule)) AS rules
  FROM (SELECT l.doc_id, l.rule FROM long l JOIN bad b ON l.rule = b.rule AND l.source IS NOT DISTINCT FROM b.source WHERE l.failed)
  GROUP BY doc_id)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND rules IS NULL AS kept,
       coalesce(rules, '') AS host_rules
FROM figures f LEFT JOIN broken b ON f.doc_id = b.doc_id
"""

def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.when(h % 10 == 0, F.col("text"))
    docs = documents(spark, sf_dir).select("doc_id", "text", words_of(chosen).alias("words"), h.alias("h"))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    docs = docs.withColumns({"n": n, "a": F.when(n > 0, g % n), "g": g})
    # Every word from a on is one of the p words from a on: they are written again and again, and cut to length.
    tail = F.col("n") - F.col("a")
    p = F.expr("1 + (n - a) div (3 + g % 8)")
    again = F.flatten(F.array_repeat(F.slice("words", (F.col("a") + 1).cast("int"), p.cast("int")), F.ceil(tail / p).cast("int")))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), F.slice(again, F.lit(1), tail.cast("int")))
    texts = docs.select("doc_id", F.when(F.col("n") > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))
    runs = periodic_runs.periodic_runs(texts)
    # The greatest length to period, compared without division.
    first = F.array_sort(
        "runs",
        lambda x, y: F.when(x["length"] * y["period"] != y["length"] * x["period"], F.signum(y["length"] * x["period"] - x["length"] * y["period"]).cast("int"))
        .when(x["start"] != y["start"], F.signum(x["start"] - y["start"]).cast("int"))
        .otherwise(F.signum(x["period"] - y["period"]).cast("int")),
    )
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return runs.withColumn("best", F.get(first, F.lit(0))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.aligned(documents(spark, sf_dir), *paths).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps"
    )


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = packing.tokenised(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    # The checksum is taken before the pieces are numbered, so that no ids are shuffled.
    pieces = best_fit.pieces(tokens).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return best_fit.assigned(pieces)


QUERIES = {
    "op1_odd_sketch": op1_odd_sketch,
    "op2_toxicity": op2_toxicity,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_line_dedup": op4_line_dedup,
    "op5_secret_ledger": op5_secret_ledger,
    "op6_column_bwt": op6_column_bwt,
    "op7_license_scan": op7_license_scan,
    "op8_multi_index": op8_multi_index,
    "op9_packing": op9_packing,
    "op10_host_rules": op10_host_rules,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_alignment": op12_token_alignment,
    "op13_best_fit": op13_best_fit,
}
ORACLE = {
    "op4_line_dedup": OP4_SQL,
    "op7_license_scan": OP7_SQL,
    "op8_multi_index": OP8_SQL,
    "op10_host_rules": OP10_SQL,
}
