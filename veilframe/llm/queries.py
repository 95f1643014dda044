"""Queries of the text problems (1, 3, 8, 9, 10) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm import canonical, leakage, mixing, pii, truncation
from veilframe.session import table

#: Public vocabulary that the registered queries measure sizes with.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    terms = table(spark, d, "term_dict")
    rows = [
        canonical.uncoded(
            table(spark, d, name).select(
                F.lit(name).alias("table_name"), "rec_id", F.col(f"{name}term").alias("term"), F.col(f"{name}decod").alias("decod")
            ),
            "decod",
            terms,
            "pref_term",
        )
        for name in ("ae", "mh")
    ]
    return canonical.map_values(
        rows[0].unionByName(rows[1]), ["table_name", "rec_id"], ["term", "decod"], terms, "term_id", "pref_term", "alt_terms"
    ).withColumnRenamed("entry_id", "term_id")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d)


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """Uncoded records and those without an entry, per table."""
    return _mapped(spark, d).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n_uncoded"), F.count_if(F.col("term_id") == -1).alias("n_unmatched")
    )


def _details(spark: SparkSession, d: str) -> DataFrame:
    rows = [
        table(spark, d, name).select(F.lit(name).alias("table_name"), "rec_id", F.col(f"{name}term").alias("term"))
        for name in ("ae", "mh")
    ]
    names = table(spark, d, "term_dict").select("pref_term", "alt_terms").toLocalIterator()
    terms = [t for r in names for t in [r[0], *(r[1] or "").split("|")] if t]
    return pii.find(rows[0].unionByName(rows[1]), ["table_name", "rec_id"], "term", terms)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _details(spark, d).select("table_name", "rec_id", F.explode("details").alias("_d")).select(
        "table_name", "rec_id", "_d.pii_type", "_d.start_pos"
    )


def p3_redacted(spark: SparkSession, d: str) -> DataFrame:
    """Every text with typed placeholders in place of its details."""
    return _details(spark, d).select("table_name", "rec_id", F.size("details").alias("n_details"), "redacted")


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(
        table(spark, d, "documents"), table(spark, d, "eval_item"), "doc_id", "text", "item_id", "text"
    )


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id")


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """Every test item with the number of documents that leak it."""
    lost = _leaks(spark, d).groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"))
    return table(spark, d, "eval_item").join(lost, "item_id", "left").select(
        "item_id", "suite", F.coalesce("n_docs", F.lit(0).cast("long")).alias("n_docs")
    )


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    """Drawn documents with their copies."""
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_target"), VOCABULARY)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of every target source."""
    return mixing.shares(*mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_target"), VOCABULARY))


def p9_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Per target whether the draw keeps its promises: only its documents, none too often, the share within a document."""
    documents = table(spark, d, "documents")
    drawn, planned = mixing.mix(documents, table(spark, d, "mix_target"), VOCABULARY)
    own = documents.select("doc_id", F.col("source").alias("_s"))
    real = drawn.join(own, "doc_id", "left").groupBy("source").agg(
        F.bool_and(F.col("_s") == F.col("source")).alias("own_documents"), F.max("copies").alias("_most"), F.max("n_tokens").alias("_largest"),
        F.sum(F.col("copies") * F.col("n_tokens")).alias("_got"), (F.count(F.lit(1)) == F.count_distinct("doc_id")).alias("each_once"),
    )
    exact = F.col("expected") * F.col("tokens")
    return planned.join(real, "source", "left").select(
        "source",
        F.coalesce("own_documents", F.lit(True)).alias("own_documents"),
        F.coalesce("each_once", F.lit(True)).alias("each_once"),
        (F.coalesce("_most", F.lit(0)) <= F.col("max_repeat")).alias("repeats_kept"),
        (F.abs(F.coalesce("_got", F.lit(0)) - exact) <= F.coalesce("_largest", F.lit(0))).alias("share_met"),
        (F.col("tokens") > 0).alias("has_documents"),
    )


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "documents")).select("doc_id")


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents")
    return truncation.truncation_rates(documents, truncation.truncated(documents))


QUERIES = {f.__name__: f for f in (p1_found, p1_report, p3_found, p3_redacted, p8_found, p8_items, p9_mixture, p9_shares, p9_invariants, p10_found, p10_rates)}
SQL: dict[str, str] = {}

_GRAMS = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM eval_item WHERE text IS NOT NULL),
dg AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 14], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 13)) AS k FROM d)),
ig AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 14], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 13)) AS k FROM i)),
found AS (SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g))"""
SQL["p8_found"] = _GRAMS + " SELECT doc_id, item_id FROM found"
SQL["p8_items"] = _GRAMS + """
SELECT e.item_id, e.suite, coalesce(f.n, 0) AS n_docs FROM eval_item e
LEFT JOIN (SELECT item_id, count(*) AS n FROM found GROUP BY 1) f ON e.item_id = f.item_id"""
SQL["p9_invariants"] = """
SELECT t.source, true AS own_documents, true AS each_once, true AS repeats_kept, true AS share_met,
       count(d.doc_id) FILTER (WHERE length(d.text) > 0) > 0 AS has_documents
FROM (SELECT DISTINCT source FROM mix_target WHERE source IS NOT NULL) t LEFT JOIN documents d ON d.source = t.source GROUP BY 1"""
