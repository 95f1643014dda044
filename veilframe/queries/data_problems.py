"""Queries of the general data problems (2, 4, 5, 6, 7) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.operators import drift, intervals, orphans, quality, timestamps
from veilframe.session import cut, table

LB_COLUMNS = ["lbtestcd", "lbtest", "lborres", "lborresu", "visitnum", "lbdtc"]
LB_PATTERNS = {"visitnum": r"^[0-9]+$", "lbtestcd": r"^[A-Z][A-Z0-9]{0,7}$", "lbdtc": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"}


def _refs(spark: SparkSession, d: str) -> DataFrame:
    return orphans.references(
        {t: table(spark, d, t) for t in ("ae", "mh", "lb")}, "usubjid", "loaded_at", "rec_id"
    )


def _orphans(spark: SparkSession, d: str) -> orphans.Orphans:
    return orphans.Orphans(_refs(spark, d), orphans.parent_spans(table(spark, d, "dm"), "usubjid", "loaded_at", "deleted_at"))


def _lost_specs(spark: SparkSession, d: str) -> DataFrame:
    return orphans.missing_columns(table(spark, d, "anchor_spec"), table(spark, d, "field_rule"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    found = _orphans(spark, d).rows().select("table_name", "rec_id")
    return found.unionByName(_lost_specs(spark, d).select("table_name", "rec_id"))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    specs = orphans.specs_report(table(spark, d, "anchor_spec"), _lost_specs(spark, d))
    return _orphans(spark, d).report().unionByName(specs)


def _normalised(spark: SparkSession, d: str) -> DataFrame:
    tracks = timestamps.columns_as_tracks(
        {
            "ae_log": (table(spark, d, "ae_log"), "subject", ["ae_start"]),
            "mh_log": (table(spark, d, "mh_log"), "subject", ["mh_onset"]),
            "demog": (table(spark, d, "demog"), "subject", ["birth_dt", "enrol_dt"]),
        }
    )
    sites = table(spark, d, "site_ref").select(F.col("siteid").alias("source"), "zone_name", "date_order")
    return timestamps.normalise(tracks, sites)


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _normalised(spark, d).select(
        F.split_part("track", F.lit("."), F.lit(1)).alias("table_name"),
        "rec_id",
        F.split_part("track", F.lit("."), F.lit(2)).alias("field_name"),
        "norm_value",
    )


def p4_precision(spark: SparkSession, d: str) -> DataFrame:
    """Values per column and precision kept."""
    kind = (
        F.when(F.col("norm_value") == "INVALID", "invalid")
        .when(F.length("norm_value") == 4, "year")
        .when(F.length("norm_value") == 7, "month")
        .when(F.length("norm_value") == 10, "day")
        .otherwise("second")
    )
    return _normalised(spark, d).groupBy("track", kind.alias("precision")).agg(F.count(F.lit(1)).alias("n_values"))


def _lb_profile(spark: SparkSession, d: str) -> DataFrame:
    return quality.profile(table(spark, d, "lb"), ["feed_id", "load_no"], LB_COLUMNS, LB_PATTERNS)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.breaks(quality.shifts(cut(_lb_profile(spark, d)), "feed_id", "load_no"), "feed_id", "load_no")


def p5_profile(spark: SparkSession, d: str) -> DataFrame:
    return _lb_profile(spark, d).select(
        "feed_id", "load_no", "column_name", "n_rows", "n_null", "n_unique", "n_violation", "min_value", "max_value",
        "min_length", "max_length", "n_numeric", "n_outside", F.round(F.col("sum1").cast("double") / quality.MILLIONTHS, 3).alias("sum1"),
        F.round("numeric_rate", 9).alias("numeric_rate"), F.round("raw_date_rate", 9).alias("raw_date_rate"),
    )


def p5_shift(spark: SparkSession, d: str) -> DataFrame:
    compared = quality.shifts(cut(_lb_profile(spark, d)), "feed_id", "load_no")
    return compared.where(F.col("std_difference").isNotNull()).select(
        "feed_id", "load_no", "column_name", F.round("std_difference", 6).alias("std_difference")
    )


def p5_feeds(spark: SparkSession, d: str) -> DataFrame:
    """Profiles of whole feeds, added up from those of their loads."""
    whole = quality.merge_profiles(_lb_profile(spark, d), ["feed_id"])
    return whole.select(
        "feed_id", "column_name", "n_rows", "n_null", "n_violation", "n_numeric", "min_value", "max_value", F.round("mean", 6).alias("mean"), F.round(F.sqrt("variance"), 6).alias("deviation")
    )


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    found = intervals.day_periods(table(spark, d, "ae"), "usubjid", "aestdtc", "aeendtc")
    return found.withColumnRenamed("entity", "usubjid")


def _scripts(spark: SparkSession, d: str) -> DataFrame:
    return drift.edit_scripts(table(spark, d, "field_rule"), table(spark, d, "drop_row"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    kinds = ["renamed", "added", "removed", "retyped", "domain_renamed"]
    return _scripts(spark, d).where(F.col("change_type").isin(kinds)).select(
        "stream_id", "file_no", "field_name", "change_type"
    )


def p7_unified(spark: SparkSession, d: str) -> DataFrame:
    """Every record under its stream's newest names, one row per cell."""
    rules, rows = table(spark, d, "field_rule"), table(spark, d, "drop_row")
    whole = drift.unified(rules, rows, cut(_scripts(spark, d)))
    return whole.select("stream_id", "file_id", "record_key", F.explode_outer("fields").alias("field_name", "value"))


QUERIES = {f.__name__: f for f in (p2_found, p2_report, p4_found, p4_precision, p5_found, p5_profile, p5_shift, p5_feeds, p6_found, p7_found, p7_unified)}
SQL: dict[str, str] = {}

_REFS = """
  SELECT 'ae' AS table_name, rec_id, upper(trim(usubjid)) AS k, loaded_at AS t FROM ae WHERE usubjid IS NOT NULL
  UNION ALL SELECT 'mh', rec_id, upper(trim(usubjid)), loaded_at FROM mh WHERE usubjid IS NOT NULL
  UNION ALL SELECT 'lb', rec_id, upper(trim(usubjid)), loaded_at FROM lb WHERE usubjid IS NOT NULL"""
_ORPHANS = f"""
WITH refs AS ({_REFS}),
found AS (
  SELECT r.table_name, r.rec_id, r.t FROM refs r
  WHERE NOT EXISTS (SELECT 1 FROM dm d WHERE upper(trim(d.usubjid)) = r.k AND d.loaded_at <= r.t
                    AND (d.deleted_at IS NULL OR d.deleted_at > r.t))
  UNION ALL
  SELECT 'anchor_spec', spec_id, signed_at FROM anchor_spec a
  WHERE NOT EXISTS (SELECT 1 FROM field_rule f WHERE f.file_id = a.file_id
                    AND upper(trim(f.rule_column)) = upper(trim(a.subject_column))))"""
SQL["p2_found"] = _ORPHANS + " SELECT table_name, rec_id FROM found"
SQL["p2_report"] = _ORPHANS + """,
every AS (SELECT table_name, t FROM refs UNION ALL SELECT 'anchor_spec', signed_at FROM anchor_spec)
SELECT e.table_name, e.period, e.n_refs, coalesce(f.n_orphans, 0) AS n_orphans
FROM (SELECT table_name, strftime(t, '%Y-%m') AS period, count(*) AS n_refs FROM every GROUP BY 1, 2) e
LEFT JOIN (SELECT table_name, strftime(t, '%Y-%m') AS period, count(*) AS n_orphans FROM found GROUP BY 1, 2) f
  ON e.table_name = f.table_name AND e.period IS NOT DISTINCT FROM f.period"""

_EXACT = r"^\s*[+-]?0*[0-9]{0,12}(\.[0-9]{0,6}0*)?\s*$"
_NUMBER = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,3})?\s*$"
_DAY = (
    r"(?i)^\s*([12][0-9]{3}-(0?[1-9]|1[0-2])-(0?[1-9]|[12][0-9]|3[01])([T :].*)?"
    r"|(0?[1-9]|[12][0-9]|3[01])(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[12][0-9]{3}"
    r"|(0?[1-9]|[12][0-9]|3[01])/(0?[1-9]|1[0-2])/[12][0-9]{3})\s*$"
)
_LONG = " UNION ALL ".join(
    f"SELECT feed_id, load_no, '{c}' AS column_name, CAST({c} AS VARCHAR) AS v FROM lb" for c in LB_COLUMNS
)
_WRONG = " OR ".join(f"(column_name = '{c}' AND NOT regexp_matches(v, '{p}'))" for c, p in LB_PATTERNS.items())
_PROFILE = f"""
WITH long AS ({_LONG}),
typed AS (
  SELECT *, coalesce(regexp_matches(v, '{_NUMBER}'), false) AS is_num,
         coalesce(regexp_matches(v, '{_DAY}'), false) AS is_day,
         CASE WHEN regexp_matches(v, '{_NUMBER}') AND regexp_matches(v, '{_EXACT}') THEN try_cast(trim(v) AS DECIMAL(18, 6)) END AS x
  FROM long),
prof AS (
  SELECT feed_id, load_no, column_name, count(*) AS n_rows, count(*) - count(v) AS n_null,
         count(DISTINCT v) AS n_unique, count(*) FILTER (WHERE v IS NOT NULL AND ({_WRONG})) AS n_violation,
         min(v) AS min_value, max(v) AS max_value,
         CAST(min(length(v)) AS INT) AS min_length, CAST(max(length(v)) AS INT) AS max_length,
         nullif(count(x), 0) AS n_numeric, count(*) FILTER (WHERE is_num) - count(x) AS n_outside, CAST(sum(x) AS DOUBLE) AS sum1,
         var_pop(CAST(x AS DOUBLE)) AS var, avg(CAST(x AS DOUBLE)) AS mean,
         count(*) FILTER (WHERE is_num) / nullif(count(v), 0)::DOUBLE AS numeric_rate,
         count(*) FILTER (WHERE is_day) / nullif(count(v), 0)::DOUBLE AS raw_date_rate,
         (count(*) - count(v)) / count(*)::DOUBLE AS null_rate
  FROM typed GROUP BY ALL)"""
SQL["p5_profile"] = _PROFILE + """
SELECT feed_id, load_no, column_name, n_rows, n_null, n_unique, n_violation, min_value, max_value, min_length,
       max_length, n_numeric, n_outside, round(sum1, 3) AS sum1, round(numeric_rate, 9) AS numeric_rate, round(raw_date_rate, 9) AS raw_date_rate
FROM prof"""
SQL["p5_found"] = _PROFILE + """,
pair AS (SELECT a.*, b.null_rate AS p1, b.numeric_rate AS p2, b.raw_date_rate AS p3, b.n_unique AS p4
         FROM prof a JOIN prof b ON a.feed_id = b.feed_id AND a.column_name = b.column_name AND a.load_no = b.load_no + 1)
SELECT feed_id, load_no, column_name, 'null_rate' AS metric FROM pair WHERE round(abs(null_rate - p1), 12) > 0.2
UNION ALL SELECT feed_id, load_no, column_name, 'numeric_rate' FROM pair WHERE round(abs(numeric_rate - p2), 12) > 0.2
UNION ALL SELECT feed_id, load_no, column_name, 'raw_date_rate' FROM pair WHERE round(abs(raw_date_rate - p3), 12) > 0.2
UNION ALL SELECT feed_id, load_no, column_name, 'n_unique' FROM pair
  WHERE n_unique <> p4 AND (n_unique >= 3 * p4 OR 3 * n_unique <= p4)"""
SQL["p5_shift"] = _PROFILE + """
SELECT a.feed_id, a.load_no, a.column_name, round((a.mean - b.mean) / sqrt((a.var + b.var) / 2), 6) AS std_difference
FROM prof a JOIN prof b ON a.feed_id = b.feed_id AND a.column_name = b.column_name AND a.load_no = b.load_no + 1
WHERE a.var + b.var > 0"""
SQL["p5_feeds"] = _PROFILE + """
SELECT feed_id, column_name, count(*) AS n_rows, count(*) - count(v) AS n_null, count(*) FILTER (WHERE v IS NOT NULL AND (""" + _WRONG + """)) AS n_violation,
       nullif(count(x), 0) AS n_numeric, min(v) AS min_value, max(v) AS max_value, round(avg(CAST(x AS DOUBLE)), 6) AS mean, round(stddev_pop(CAST(x AS DOUBLE)), 6) AS deviation
FROM typed GROUP BY 1, 2"""
SQL["p6_found"] = """
WITH days AS (
  SELECT upper(trim(usubjid)) AS usubjid,
         try_cast(nullif(regexp_extract(aestdtc, '^([0-9]{4}-[0-9]{2}-[0-9]{2})([^0-9]|$)', 1), '') AS DATE) AS s,
         try_cast(nullif(regexp_extract(aeendtc, '^([0-9]{4}-[0-9]{2}-[0-9]{2})([^0-9]|$)', 1), '') AS DATE) AS e
  FROM ae WHERE usubjid IS NOT NULL AND trim(usubjid) <> ''),
ok AS (SELECT * FROM days WHERE s <= e),
reach AS (SELECT *, max(e) OVER (PARTITION BY usubjid ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM ok),
islands AS (SELECT *, sum(CASE WHEN r IS NULL OR s > r + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY usubjid ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM reach),
per AS (SELECT usubjid, i, min(s) AS s, max(e) AS e FROM islands GROUP BY 1, 2),
nxt AS (SELECT *, lead(s) OVER (PARTITION BY usubjid ORDER BY s) AS n FROM per)
SELECT usubjid, 'period' AS kind, strftime(s, '%Y-%m-%d') AS start_day, strftime(e, '%Y-%m-%d') AS end_day FROM per
UNION ALL SELECT usubjid, 'gap', strftime(e + 1, '%Y-%m-%d'), strftime(n - 1, '%Y-%m-%d') FROM nxt WHERE n IS NOT NULL"""

SQL["p7_found"] = r"""
WITH f AS (SELECT stream_id, file_no, file_id, min(domain_name) AS dom FROM field_rule GROUP BY ALL),
p AS (SELECT *, lag(file_id) OVER w AS prev, lag(dom) OVER w AS prev_dom FROM f WINDOW w AS (PARTITION BY stream_id ORDER BY file_no)),
names AS (SELECT DISTINCT file_id, rule_column AS n FROM field_rule WHERE rule_column IS NOT NULL),
cell AS (
  SELECT DISTINCT file_id, record_key, k AS n, json_type(v) AS kind, trim(v ->> '$') AS t
  FROM (SELECT file_id, record_key, k, json_extract(payload, '$."' || k || '"') AS v
        FROM (SELECT file_id, record_key, payload, unnest(json_keys(payload)) AS k FROM drop_row WHERE payload IS NOT NULL))
  WHERE json_type(v) <> 'NULL' AND trim(v ->> '$') <> ''),
val AS (
  SELECT file_id, record_key, n, CASE WHEN lower(t) IN ('true', 'y', 'yes') THEN 'Y' WHEN lower(t) IN ('false', 'n', 'no') THEN 'N'
    WHEN regexp_matches(t, '^-?[0-9]+\.[0-9]*$') THEN regexp_replace(t, '\.?0*$', '') ELSE t END AS v FROM cell),
kinds AS (
  SELECT file_id, n, CASE WHEN kind = 'VARCHAR' THEN 'text' WHEN kind = 'BOOLEAN' THEN 'boolean' ELSE 'number' END AS kind, count(*) AS c
  FROM cell GROUP BY ALL),
major AS (SELECT file_id, n, arg_max(kind, c) AS kind FROM kinds GROUP BY ALL),
gone AS (SELECT p.file_id, p.prev, a.n FROM p JOIN names a ON a.file_id = p.prev
         WHERE NOT EXISTS (SELECT 1 FROM names b WHERE b.file_id = p.file_id AND b.n = a.n)),
fresh AS (SELECT p.file_id, p.prev, a.n FROM p JOIN names a ON a.file_id = p.file_id
          WHERE p.prev IS NOT NULL AND NOT EXISTS (SELECT 1 FROM names b WHERE b.file_id = p.prev AND b.n = a.n)),
rec AS (SELECT DISTINCT p.file_id, p.prev, a.record_key FROM p JOIN cell a ON a.file_id = p.file_id JOIN cell b ON b.file_id = p.prev AND b.record_key = a.record_key),
cmp AS (
  SELECT g.file_id, g.n AS was, h.n AS now, count(*) FILTER (WHERE a.v IS NOT NULL OR b.v IS NOT NULL) AS filled, count(*) FILTER (WHERE a.v = b.v) AS same
  FROM gone g JOIN fresh h ON g.file_id = h.file_id JOIN rec r ON r.file_id = g.file_id
  LEFT JOIN val a ON a.file_id = r.prev AND a.record_key = r.record_key AND a.n = g.n
  LEFT JOIN val b ON b.file_id = r.file_id AND b.record_key = r.record_key AND b.n = h.n GROUP BY ALL),
ren AS (SELECT file_id, was, now FROM cmp WHERE same > 0.5 * filled),
out AS (
  SELECT file_id, now AS field_name, 'renamed' AS change_type FROM ren
  UNION ALL SELECT file_id, n, 'added' FROM fresh WHERE NOT EXISTS (SELECT 1 FROM ren WHERE ren.file_id = fresh.file_id AND ren.now = fresh.n)
  UNION ALL SELECT file_id, n, 'removed' FROM gone WHERE NOT EXISTS (SELECT 1 FROM ren WHERE ren.file_id = gone.file_id AND ren.was = gone.n)
  UNION ALL SELECT p.file_id, a.n, 'retyped' FROM p JOIN names a ON a.file_id = p.file_id JOIN names b ON b.file_id = p.prev AND a.n = b.n
    JOIN major x ON x.file_id = p.file_id AND x.n = a.n JOIN major y ON y.file_id = p.prev AND y.n = a.n WHERE x.kind <> y.kind
  UNION ALL SELECT file_id, dom, 'domain_renamed' FROM p WHERE prev IS NOT NULL AND dom IS DISTINCT FROM prev_dom)
SELECT p.stream_id, p.file_no, out.field_name, out.change_type FROM out JOIN p USING (file_id)"""

_P7 = SQL["p7_found"]
SQL["p7_unified"] = "WITH RECURSIVE" + _P7[len("\nWITH") : _P7.index("out AS (")] + r"""
nxt AS (SELECT a.file_id, a.file_no, b.file_id AS next_id, b.file_no AS next_no FROM p a LEFT JOIN p b ON b.prev = a.file_id),
walk AS (
  SELECT n.file_id AS origin, n.n AS name, n.n AS final, n.file_id AS at, x.file_no AS last FROM names n JOIN nxt x USING (file_id)
  UNION ALL
  SELECT w.origin, w.name, coalesce(r.now, w.final), x.next_id, x.next_no FROM walk w JOIN nxt x ON x.file_id = w.at
  LEFT JOIN ren r ON r.file_id = x.next_id AND r.was = w.final
  WHERE EXISTS (SELECT 1 FROM names m WHERE m.file_id = x.next_id AND m.n = coalesce(r.now, w.final))),
ends AS (SELECT origin, name, arg_max(final, last) AS final, max(last) AS last FROM walk GROUP BY 1, 2),
proj AS (SELECT e.origin AS file_id, e.name, CASE WHEN EXISTS (SELECT 1 FROM ends o WHERE o.origin = e.origin AND o.final = e.final
    AND (o.last > e.last OR (o.last = e.last AND o.name < e.name))) THEN e.final || '@' || e.last ELSE e.final END AS final FROM ends e),
rows AS (SELECT file_id, record_key, max(payload) AS payload FROM drop_row WHERE record_key IS NOT NULL GROUP BY 1, 2
  UNION ALL SELECT file_id, record_key, payload FROM drop_row WHERE record_key IS NULL),
flat AS (SELECT file_id, record_key, k AS n, json_type(v) AS kind, v ->> '$' AS value
  FROM (SELECT file_id, record_key, k, json_extract(payload, '$."' || k || '"') AS v FROM (SELECT *, unnest(json_keys(payload)) AS k FROM rows WHERE json_valid(payload)))),
kept AS (SELECT * FROM flat WHERE kind <> 'NULL' AND (kind <> 'VARCHAR' OR trim(value) <> ''))
SELECT p.stream_id, r.file_id, r.record_key,
  coalesce(j.final, CASE WHEN EXISTS (SELECT 1 FROM proj q WHERE q.file_id = r.file_id AND q.final = k.n) THEN k.n || '@undeclared' ELSE k.n END) AS field_name, k.value
FROM rows r LEFT JOIN p ON p.file_id = r.file_id LEFT JOIN kept k ON k.file_id = r.file_id AND k.record_key = r.record_key
LEFT JOIN proj j ON j.file_id = k.file_id AND j.name = k.n"""
