"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.llm import (
    alignment, conversations, decontamination, jaccard, langid, licenses, mixing, oracles, pii, quality, rules, secrets, tokens, warc,
)
from skuflow.llm.common import table

KEEP_SCORE = 0.3


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    first = ["doc_id", "size", "source_size", "target", "taken"]
    return mixed.select(*first, *[c for c in mixed.columns if c not in first])


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(quality.remainder("doc_id", 5) == 0, F.lit(False))
    model = quality.fit(docs, table(spark, sf_dir, "labels"), holdout=held)
    out = quality.scored(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents")).drop("_k1", "_k2", "root")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(quality.remainder("doc_id", 4) == 2, F.lit(False))
    model = langid.fit(docs.where(~held))
    out = langid.identified(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_sure").alias("sure"))


def op8_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_pii_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_scan(table(spark, sf_dir, "documents"))


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.pair_digests(docs, _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations")
    return conversations.repaired(conversations.damaged(chats), chats.select("conv_id"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (op1_license_scan, op2_mix_sources, op3_secret_scan, op4_quality_classifier, op5_quality_rules,
           op6_ngram_jaccard_join, op7_language_id, op8_warc_round_trip, op9_benchmark_decontamination, op10_pii_scan,
           op11_cross_tokenizer_alignment, op12_conversation_repair, op13_token_counts)
    return {f.__name__: f for f in ops}


# The archives give back what was written, so the records follow from the pages alone.
WARC_SQL = f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    sized AS (SELECT page_id, octet_length(encode(html))::BIGINT AS bytes, sha1(html) AS digest FROM p),
    kept AS (SELECT *, CASE WHEN bytes >= {warc.LEAST_REVISIT} THEN max(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM sized)
    SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
           CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to, true AS intact
    FROM kept
"""


# Words, windows and lines by unnesting; the hosts' prior and verdict in closed form.
RULES_SQL = rf"""
    WITH m AS (
        SELECT row_number() OVER () AS r, doc_id, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
               string_split(coalesce(text, ''), chr(10)) AS lines, len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]')) AS n_symbols
        FROM documents),
    words AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM m),
    grams AS (SELECT r, i, x, lead(x) OVER p AS y, lead(x, 2) OVER p AS z FROM words WINDOW p AS (PARTITION BY r ORDER BY i)),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, x, y, z) AS c FROM grams WHERE z IS NOT NULL) WHERE c > 1),
    rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
    chars AS (SELECT r, sum(length(x)) AS n FROM words GROUP BY r),
    dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(lines) AS line FROM m)
             WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
    measured AS (
        SELECT m.doc_id, m.source, len(w)::BIGINT AS n_words, coalesce(chars.n, 0)::BIGINT AS word_chars, m.n_symbols::BIGINT AS n_symbols,
               coalesce(dups.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
        FROM m LEFT JOIN chars USING (r) LEFT JOIN dups USING (r) LEFT JOIN rep USING (r)),
    flagged AS (
        SELECT *, ({rules.BASE_RULE}) AS base_failed, ({" + ".join(f"({x})::INT" for x in rules.RULES.values())})::BIGINT AS n_rules FROM measured),
    hosts AS (SELECT source, count(*) AS n_docs, count(*) FILTER (WHERE base_failed OR n_rules > 0) AS n_failed FROM flagged GROUP BY source),
    corpus AS (SELECT *, f / n AS m FROM (SELECT count(*) AS k, sum(n_docs) AS n, sum(n_failed) AS f, sum(n_failed::DOUBLE * n_failed / n_docs) AS s,
               sum(n_docs::DOUBLE * n_docs) AS q FROM hosts)),
    spread AS (SELECT *, CASE WHEN m > 0 AND m < 1 AND n - q / n - (k - 1) > 1e-6
               THEN ((s - f * m) / (m * (1 - m)) - (k - 1)) / (n - q / n - (k - 1)) ELSE 0 END AS rho FROM corpus),
    prior AS (SELECT *, CASE WHEN rho > 0 THEN least({rules.MOST_STRENGTH}, greatest(1.0, 1 / rho - 1)) ELSE {rules.MOST_STRENGTH} END AS strength FROM spread),
    shrunk AS (SELECT hosts.*, strength, n, f, round((n_failed + m * strength) / (n_docs + strength), 6) AS host_rate FROM hosts, prior),
    sure AS (SELECT *, host_rate - 2 * sqrt(host_rate * (1 - host_rate) / (n_docs + strength + 1)) AS low FROM shrunk),
    verdict AS (SELECT *, n_docs < n AND low >= 0.25 AND low >= 2 * (f - n_failed) / nullif(n - n_docs, 0) AS bad FROM sure)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND n_rules < 2 AND NOT (n_rules > 0 AND coalesce(bad, false)) AS kept,
           n_rules, n_docs AS host_docs, host_rate, coalesce(bad, false) AS bad_host
    FROM flagged JOIN verdict ON flagged.source IS NOT DISTINCT FROM verdict.source
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": oracles.license_sql(), "op2_mix_sources": oracles.mix_sql(), "op5_quality_rules": RULES_SQL,
            "op6_ngram_jaccard_join": oracles.jaccard_sql(), "op8_warc_round_trip": WARC_SQL}
