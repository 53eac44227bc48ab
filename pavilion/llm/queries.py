"""The operators applied to the whole test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pavilion.llm import (
    byte_pairs, decontamination, hard_negatives, license_scan, near_dedup, packing, personal_data, quality_rules,
    repeated_passages, rule_ensemble, url_rules, warc, whitening,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of ``documents``."""
    return near_dedup.near_duplicates(_table(spark, folder, "documents"))


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licences in every document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    result, (ids, licenses, unmatched, kind, usable) = license_scan.scanned(docs)
    return result.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_sentences"),
        F.array_join(ids, ",").alias("sentence_ids"),
        F.array_join(licenses, ",").alias("licenses"),
        F.array_join(unmatched, ",").alias("unmatched"),
        F.col(kind).alias("license_class"),
        F.col(usable).alias("usable"),
    )


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rule statistics and verdict for every document."""
    judged = quality_rules.judged(_table(spark, folder, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", F.round("quality", 6).alias("quality_chance"))


def op4_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Passages of 50 bytes removed that an earlier document of ``documents`` has."""
    result = repeated_passages.without_repeated_passages(_table(spark, folder, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return result.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


# The rules of the query.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op5_url_range_join(spark: SparkSession, folder: str) -> DataFrame:
    """The rule that fits each URL of ``pages``, and its verdict."""
    named = [F.struct(*[F.lit(v).alias(n) for n, v in zip(("host", "path", "verdict"), r, strict=True)]) for r in URL_RULES]
    rules = spark.range(1).select(F.inline(F.array(*named)))
    pages = _table(spark, folder, "pages").select("page_id", "url")
    judged, names = url_rules.judged(pages, rules)
    return judged.select("page_id", *[F.col(n).alias(c) for n, c in zip(names, ("host", "path", "rule", "verdict"), strict=True)])


OP5_SQL = r"""
WITH urls AS (
    SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
        THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id,
        translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM urls
), rules(rule_host, rule_path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
    SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        arg_max(verdict, length(rule_host || rule_path)) AS verdict
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (page_id)
"""


def op6_rule_ensemble(spark: SparkSession, folder: str) -> DataFrame:
    """A quality score for every document, learnt from four fifths of ``labels``."""
    return rule_ensemble.scored(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def tokenizer_path() -> str:
    """The tokenizer file of the queries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_trie_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` encoded and decoded again."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    back, ids, text = byte_pairs.round_trip(docs, tokenizer_path())
    return back.select(
        "doc_id",
        byte_pairs.id_count(ids).alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(text, 256).alias("decoded_sha256"),
    )


def op8_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    found = personal_data.found(_table(spark, folder, "documents"))
    told = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in personal_data.BASE],
        F.sha2(told("base"), 256).alias("base_sha256"),
        told("spans").alias("spans"),
    )


def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Contamination of every document by ``benchmark``."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    result, (words, spans, items, _) = decontamination.measured(docs, _table(spark, folder, "benchmark"))
    return result.select(
        "doc_id",
        F.col(words).alias("n_words"),
        decontamination.n_hit(spans).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        decontamination.is_contaminated(words, spans).alias("contaminated"),
    )


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """``pages`` written as WARC records and read back."""
    path = warc.write_pages(_table(spark, folder, "pages"))
    pages = warc.read_pages(spark, path)
    return pages.select(
        F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


OP10_SQL = r"""
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), f AS (
    SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


def op11_curve_packing(spark: SparkSession, folder: str) -> DataFrame:
    """``documents`` packed into sequences of 1024 ids along a Hilbert curve."""
    return packing.packed(_table(spark, folder, "documents"), tokenizer_path(), with_ids=False)


def op12_refined_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """``embeddings`` on their 16 leading components, with unit variance along each."""
    rows = whitening.whitened(_table(spark, folder, "embeddings"))
    return rows.withColumn("deviation", F.col("deviation").cast("long"))


def op13_hyperplane_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth row of ``embeddings``; every seventh label is moved by one."""
    moved = F.when(F.pmod("vec_id", F.lit(7)) == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    anchors = F.pmod("vec_id", F.lit(100)) == 0
    return hard_negatives.hard_negatives(_table(spark, folder, "embeddings"), anchors, label=moved)


OP13_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS DOUBLE)) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
        CAST(list_inner_product(a.x, o.x) AS BIGINT) AS score
    FROM v a JOIN v o ON a.vec_id % 100 = 0 AND a.vec_id <> o.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
    s.other_id AS negative_id, positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_quality_rules": op3_quality_rules,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_url_range_join": op5_url_range_join,
    "op6_rule_ensemble": op6_rule_ensemble,
    "op7_trie_bpe": op7_trie_bpe,
    "op8_personal_data": op8_personal_data,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_warc": op10_warc,
    "op11_curve_packing": op11_curve_packing,
    "op12_refined_whitening": op12_refined_whitening,
    "op13_hyperplane_negatives": op13_hyperplane_negatives,
}

ORACLES: dict[str, str] = {"op5_url_range_join": OP5_SQL, "op10_warc": OP10_SQL, "op13_hyperplane_negatives": OP13_SQL}
