"""Queries of this subpackage over the test tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chat, classifier, html_text, language, mixing, near_copies, nearest, packing, quality_rules, secret_scan, tandem, url_filter
from .common import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def tokenizer_path() -> str:
    """The tokenizer file of the packing query; it lies at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_mix_entropy(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sizes(_read(spark, folder, "documents"), ["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


@query
def op2_pack_concat(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(_read(spark, folder, "documents"), tokenizer_path(), ["doc_id"], plain=False)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "padded")


@query
def op3_nearest_adaptive(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(_read(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op4_secrets_structural(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan_secrets(_read(spark, folder, "documents"), ["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query
def op5_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    langs, model = language.learn(docs.where(~held_out("doc_id")))
    found = docs.select("doc_id", held_out("doc_id").alias("held_out"), language.language_column(F.col("text"), langs, model).alias("l"))
    return found.select("doc_id", "held_out", F.col("l.lang").alias("lang_pred"), F.col("l.score").alias("score"))


@query
def op6_near_copies_forest(spark: SparkSession, folder: str) -> DataFrame:
    found = near_copies.near_copies(_read(spark, folder, "documents"), ["doc_id"])
    return found.select("doc_id", F.col("group.doc_id").alias("class_id"), "n_links")


@query
def op7_pages_suffix(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_text(_read(spark, folder, "pages"), ["page_id", "url"])


@query
def op8_quality_cascade(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    counted = quality_rules.base_counts(docs, ["doc_id"])
    sample = quality_rules.base_counts(quality_rules.some_rows(docs), ["doc_id"])
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    judged = quality_rules.cascade(counted, quality_rules.default_rules(), sample)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("failed_rule").isNull()).alias("kept"),
    )


_WORD = r"[^\x20\x09-\x0D]+"
ORACLES["op8_quality_cascade"] = rf"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents
), c AS (
    SELECT *, regexp_extract_all(t, '{_WORD}') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS l,
        length(regexp_replace(t, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) AS upper_chars, length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) AS letters
    FROM d
), g AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) AS n
    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM c WHERE len(w) > 2)
), p AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM g, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY r
), b AS (
    SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, len(l) AS n_lines, upper_chars, letters
    FROM c LEFT JOIN p USING (r)
), f AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT (n_symbols * 10 > n_words * 3) AND NOT (word_chars < n_words * 2 OR word_chars > n_words * 16)
        AND NOT (n_dup_lines >= 4 AND n_dup_lines * 10 > n_lines * 3) AND NOT (upper_chars * 2 > word_chars) AND NOT (letters * 2 < word_chars) AS kept
FROM f"""


@query
def op9_quality_network(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    model = classifier.learn(docs, _read(spark, folder, "labels"))
    scored = docs.select("doc_id", held_out("doc_id").alias("held_out"), classifier.score_column(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0).cast("int"))


@query
def op10_chat_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "conversations")
    model = chat.learn(rows.withColumnRenamed("conv_id", "conv"))
    return chat.recover_turns(rows, model, carried=["role"])


# The rules of the test pages.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


@query
def op11_url_trees(spark: SparkSession, folder: str) -> DataFrame:
    pages = _read(spark, folder, "pages")
    model = url_filter.learn(pages, URL_RULES)
    return url_filter.judge_urls(pages, URL_RULES, model, ["page_id"])


@query
def op12_centroids_heap(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster_vectors(_read(spark, folder, "embeddings"))


def _centroid_rounds(rounds: int) -> str:
    """Lloyd's rounds as a chain of tables: distances, nearest centroids and new centroids of each round."""
    chain = ""
    for i in range(rounds + 1):
        chain += f""", a{i} AS MATERIALIZED (
    SELECT r, c, d FROM (
        SELECT r, c, list_sum(list_transform(list_zip(k.v, e.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept k, c{i} e
    ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
)"""
        if i < rounds:
            chain += f""", c{i + 1} AS MATERIALIZED (
    SELECT c, coalesce(m.v, e.v) AS v FROM c{i} e LEFT JOIN (
        SELECT c, list(((s - (s % n + n) % n) // n)::BIGINT ORDER BY i) AS v
        FROM (SELECT c, i, sum(v[i]) AS s, count(*) AS n FROM a{i} JOIN kept USING (r), (SELECT unnest(range(1, 65)) AS i) GROUP BY c, i) GROUP BY c
    ) m USING (c)
)"""
    return chain


ORACLES["op12_centroids_heap"] = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id::VARCHAR) NULLS LAST, v) - 1 AS c, v FROM kept QUALIFY c < 40
){_centroid_rounds(5)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY c)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
    sha256(array_to_string(e.v, ',')) AS centroid_sha256
FROM a5 JOIN kept USING (r) JOIN c5 e USING (c)"""


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = _read(spark, folder, "documents")
    found = docs.select("doc_id", tandem.runs_column(F.col("text"), F.crc32(F.col("doc_id").cast("string"))).alias("r"))
    fields = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    return found.select("doc_id", *[F.col(f"r.{name}").alias(name) for name in fields])


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES["pipeline"] = pipeline
