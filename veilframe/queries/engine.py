"""Queries of the de-identification operators and their SQL.

Operators that draw at random are checked through invariants that hold for any
draw; all queries run over whole tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.functions import dates, numbers, rawdates, text
from veilframe.operators import blinding, detect, profiler, protocol, reassign, risk, textcheck, treatments
from veilframe.operators.vault import Vault, dummy_column
from veilframe.session import table
from veilframe.sources import files
from veilframe.sources.files import workspace

QUERIES: dict = {}
SQL: dict[str, str] = {}
KEY = bytes(range(32))


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _vault(spark: SparkSession) -> Vault:
    return Vault(spark, workspace(spark, "vault"), KEY)


def _anchored(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Rows of a table with the reference date of their subject (last DM row wins)."""
    anchor = treatments.anchors(table(spark, d, "dm"), "usubjid", "rfstdtc", "rec_id")
    return treatments.with_anchor(table(spark, d, name), "usubjid", anchor)


_ANCHOR = "anchor AS (SELECT usubjid, arg_max(struct_pack(d := rfstdtc), rec_id).d AS anchor FROM dm WHERE usubjid IS NOT NULL GROUP BY 1)"
_ISO = r"^\s*([0-9]{4})(-([0-9]{2})(-([0-9]{2})([T ].*)?)?)?\s*$"


def _parts(c: str) -> str:
    """Year, month, day text and whole date of a partial ISO column."""
    return f"""nullif(regexp_extract({c}, '{_ISO}', 1), '') AS y_{c}, nullif(regexp_extract({c}, '{_ISO}', 3), '') AS m_{c},
      nullif(regexp_extract({c}, '{_ISO}', 5), '') AS d_{c},
      CASE WHEN regexp_extract({c}, '{_ISO}', 5) <> '' THEN try_cast(substr(trim({c}), 1, 10) AS DATE) END AS f_{c}"""


def _grain(c: str) -> str:
    return f"CASE WHEN d_{c} IS NOT NULL THEN 'day' WHEN m_{c} IS NOT NULL THEN 'month' WHEN y_{c} IS NOT NULL THEN 'year' ELSE 'none' END"


# --- dates --------------------------------------------------------------------


def _order_days(spark: SparkSession, d: str, day_zero: bool) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("dtc"))
    anchor = orders.groupBy(F.col("o_custkey").alias("subject")).agg(F.min("dtc").alias("anchor"))
    joined = treatments.with_anchor(orders, "o_custkey", anchor)
    return joined.select("o_orderkey", "o_custkey", dates.study_day(F.col("dtc"), F.col("anchor"), day_zero).alias("study_day"))


_ORDER_DAYS = """
SELECT o_orderkey, o_custkey, CAST(date_diff('day', CAST(a AS DATE), CAST(o_orderdate AS DATE)){plus} AS INT) AS study_day
FROM (SELECT *, min(o_orderdate) OVER (PARTITION BY o_custkey) AS a FROM orders)"""


@query(_ORDER_DAYS.format(plus=" + 1"))
def study_day_day1(spark, d):
    return _order_days(spark, d, False)


@query(_ORDER_DAYS.format(plus=""))
def study_day_day0(spark, d):
    return _order_days(spark, d, True)


@query(f"""
WITH {_ANCHOR}, j AS (SELECT rec_id, {_parts('aestdtc')}, {_parts('anchor')} FROM ae LEFT JOIN anchor USING (usubjid))
SELECT rec_id, CAST(CASE WHEN f_aestdtc >= f_anchor THEN date_diff('day', f_anchor, f_aestdtc) + 1
                         ELSE date_diff('day', f_anchor, f_aestdtc) END AS INT) AS aestdy,
       {_grain('aestdtc')} AS aestdy_gran FROM j""")
def study_day_partial(spark, d):
    rows = _anchored(spark, d, "ae")
    return rows.select(
        "rec_id",
        dates.study_day(F.col("aestdtc"), F.col("anchor")).alias("aestdy"),
        dates.granularity(F.col("aestdtc")).alias("aestdy_gran"),
    )


@query(f"""
WITH {_ANCHOR}, j AS (SELECT rec_id, {_parts('mhstdtc')}, {_parts('anchor')} FROM mh LEFT JOIN anchor USING (usubjid))
SELECT rec_id, CAST(y_mhstdtc AS INT) - CAST(y_anchor AS INT) AS mhstdtc_yr_rel, {_grain('mhstdtc')} AS gran FROM j""")
def year_offset(spark, d):
    rows = _anchored(spark, d, "mh")
    return rows.select(
        "rec_id",
        dates.year_offset(F.col("mhstdtc"), F.col("anchor")).alias("mhstdtc_yr_rel"),
        dates.granularity(F.col("mhstdtc")).alias("gran"),
    )


@query(f"""
WITH j AS (SELECT rec_id, {_parts('brthdtc')}, {_parts('rfstdtc')} FROM dm),
a AS (SELECT rec_id, CAST(y_rfstdtc AS INT) - CAST(y_brthdtc AS INT) - CASE
    WHEN f_brthdtc IS NOT NULL AND f_rfstdtc IS NOT NULL
      THEN CASE WHEN strftime(f_rfstdtc, '%m%d') < strftime(f_brthdtc, '%m%d') THEN 1 ELSE 0 END
    WHEN m_rfstdtc < m_brthdtc THEN 1 ELSE 0 END AS n FROM j)
SELECT rec_id, CASE WHEN n >= 90 THEN '90+' ELSE CAST(n AS VARCHAR) END AS age FROM a""")
def age_capped(spark, d):
    return table(spark, d, "dm").select("rec_id", dates.capped_age(F.col("brthdtc"), F.col("rfstdtc"), 90).alias("age"))


_SHIFT = """
WITH j AS (SELECT rec_id, CAST(180 + rec_id % 361 AS INT) AS n, {parts} FROM {t})
SELECT rec_id, CASE
  WHEN f_{c} IS NOT NULL THEN strftime(f_{c} + n, '%Y-%m-%d')
  WHEN m_{c} IS NOT NULL THEN strftime(try_cast(y_{c} || '-' || m_{c} || '-15' AS DATE) + n, '%Y-%m')
  WHEN y_{c} IS NOT NULL THEN strftime(try_cast(y_{c} || '-07-01' AS DATE) + n, '%Y') END AS shifted FROM j"""


@query(_SHIFT.format(parts=_parts("aestdtc"), t="ae", c="aestdtc"))
def date_shift_fixed(spark, d):
    days = (F.lit(180) + F.col("rec_id") % 361).cast("int")
    return table(spark, d, "ae").select("rec_id", dates.shift_iso(F.col("aestdtc"), days).alias("shifted"))


@query(_SHIFT.format(parts=_parts("mhstdtc"), t="mh", c="mhstdtc"))
def partial_shift(spark, d):
    days = (F.lit(180) + F.col("rec_id") % 361).cast("int")
    return table(spark, d, "mh").select("rec_id", dates.shift_iso(F.col("mhstdtc"), days).alias("shifted"))


# --- numbers, codes, text shapes ------------------------------------------------

_NUM = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


@query(f"""
WITH n AS (SELECT rec_id, CASE WHEN regexp_matches(lborres, '{_NUM}') THEN try_cast(trim(lborres) AS DOUBLE) END AS x FROM lb)
SELECT rec_id, CASE WHEN x >= 250 THEN '250+' ELSE printf('%g', x) END AS capped FROM n""")
def cap_numeric(spark, d):
    return table(spark, d, "lb").select("rec_id", numbers.cap_numeric(F.col("lborres"), 250).alias("capped"))


@query("""
SELECT rec_id, CASE WHEN age IS NULL THEN NULL WHEN age >= 90 THEN '90+' WHEN age < 18 THEN '<18' WHEN age < 40 THEN '18-39'
  WHEN age < 65 THEN '40-64' ELSE '65+' END AS age_band FROM dm""")
def generalize_numeric(spark, d):
    return table(spark, d, "dm").select("rec_id", numbers.bands(F.col("age"), [18, 40, 65], cap=90).alias("age_band"))


_AREAS = ", ".join(f"'{a}'" for a in text.SMALL_AREAS)


@query(f"""
WITH z AS (SELECT rec_id, regexp_replace(sitezip, '[^0-9]', '', 'g') AS q FROM dm)
SELECT rec_id, CASE WHEN length(q) < 3 THEN NULL WHEN substr(q, 1, 3) IN ({_AREAS}) THEN '000' ELSE substr(q, 1, 3) END AS zip3 FROM z""")
def zip3(spark, d):
    return table(spark, d, "dm").select("rec_id", text.zip3(F.col("sitezip")).alias("zip3"))


@query("""
SELECT rec_id, CASE WHEN country IS NULL THEN NULL WHEN n < 60 THEN 'OTHER' ELSE country END AS country
FROM (SELECT rec_id, country, count(country) OVER (PARTITION BY country) AS n FROM dm)""")
def pool_rare(spark, d):
    return treatments.pool_rare(table(spark, d, "dm"), "country", 60).select("rec_id", "country")


@query("SELECT siteid AS value, count(*) AS n FROM dm WHERE siteid IS NOT NULL GROUP BY 1 HAVING count(*) < 12")
def pool_rare_report(spark, d):
    return treatments.rare_values(table(spark, d, "dm"), "siteid", 12)


@query("SELECT rec_id, domain, aeterm AS ae_verbatim, aesev FROM ae")
def retain_rename_drop(spark, d):
    keep = {"rec_id": "rec_id", "domain": "domain", "aeterm": "ae_verbatim", "aesev": "aesev"}
    return table(spark, d, "ae").select(*[F.col(a).alias(b) for a, b in keep.items()])


@query("SELECT rec_id, 'ST-' || site || '/' || subject AS join_key FROM demog")
def join_key_template(spark, d):
    df = table(spark, d, "demog")
    return df.select("rec_id", treatments.template("ST-{site}/{subject}", {c: F.col(c) for c in df.columns}).alias("join_key"))


@query("""
SELECT rec_id, CASE WHEN age >= 90 THEN '90+' ELSE CAST(age AS VARCHAR) END || ' ' || ageu || ' (' || sex || ')' AS label FROM dm""")
def output_template(spark, d):
    published = table(spark, d, "dm").select("rec_id", numbers.cap_numeric(F.col("age"), 90).alias("age"), "ageu", "sex")
    return published.select("rec_id", treatments.template("{age} {ageu} ({sex})", {c: F.col(c) for c in published.columns}).alias("label"))


@query("""
WITH f AS (SELECT invnam, printf('PROVIDER-%06d', row_number() OVER (ORDER BY min(rec_id))) AS stand_in FROM dm WHERE invnam IS NOT NULL GROUP BY 1)
SELECT rec_id, stand_in AS invnam FROM dm LEFT JOIN f USING (invnam)""")
def faker_fallback(spark, d):
    return treatments.numbered_stand_ins(table(spark, d, "dm"), "invnam", "rec_id", "PROVIDER").select("rec_id", "invnam")


_SPELLED = "CASE rec_id % 40 " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(text.NA_CELLS)) + " ELSE lborresu END"
_NA = ", ".join(f"'{c}'" for c in text.NA_CELLS)


@query(f"""
SELECT rec_id, CASE WHEN unit NOT IN ({_NA}) THEN unit END AS unit, length(coalesce(lborres, '')) AS n FROM (SELECT rec_id, lborres, {_SPELLED} AS unit FROM lb)""")
def na_cells(spark, d):
    """Every spelling of a missing cell occurs, spread over all rows by their number."""
    n = F.length(F.coalesce("lborres", F.lit(""))).cast("bigint")
    return table(spark, d, "lb").select("rec_id", text.na_to_null(F.expr(_SPELLED)).alias("unit"), n.alias("n"))


@query("""
SELECT rec_id, trim(regexp_replace(lower(mhterm), '[^a-z0-9]+', ' ', 'g')) AS norm, lower(trim(regexp_replace(mhterm, '\\s+', ' ', 'g'))) AS term_key
FROM mh""")
def text_keys(spark, d):
    return table(spark, d, "mh").select("rec_id", text.normal(F.col("mhterm")).alias("norm"), text.term_key(F.col("mhterm")).alias("term_key"))


# --- risk -----------------------------------------------------------------------

QUASI = ["siteid", "sex", "race"]
_CLASSES = "c AS (SELECT siteid, sex, race, count(*) AS size FROM dm GROUP BY ALL)"


def _classes(spark, d):
    return risk.classes(table(spark, d, "dm"), QUASI)


@query(f"WITH {_CLASSES} SELECT siteid, sex, race, size FROM c")
def risk_classes(spark, d):
    return _classes(spark, d)


@query(f"""
WITH {_CLASSES} SELECT CAST(sum(size) AS BIGINT) AS n_records, min(size) AS k_min, count(*) AS n_classes,
  CAST(coalesce(sum(size) FILTER (WHERE size < 5), 0) AS BIGINT) AS records_below_k,
  round(coalesce(sum(size) FILTER (WHERE size < 5), 0) / sum(size), 4) AS fraction_below_k,
  round(1.0::DOUBLE / min(size), 4) AS prosecutor_risk, round(count(*) / sum(size), 4) AS marketer_risk FROM c""")
def risk_summary(spark, d):
    return risk.summary(_classes(spark, d), 5)


@query(f"WITH {_CLASSES} SELECT siteid, sex, race, size FROM (SELECT *, rank() OVER (ORDER BY size) AS r FROM c) WHERE r <= 10")
def risk_smallest_ties(spark, d):
    return risk.smallest(_classes(spark, d), 10)


@query("""
SELECT 'siteid' AS left_out, min(n) AS k_without FROM (SELECT count(*) AS n FROM dm GROUP BY sex, race)
UNION ALL SELECT 'sex', min(n) FROM (SELECT count(*) AS n FROM dm GROUP BY siteid, race)
UNION ALL SELECT 'race', min(n) FROM (SELECT count(*) AS n FROM dm GROUP BY siteid, sex)""")
def risk_blocking(spark, d):
    return risk.leave_one_out(_classes(spark, d), QUASI)


_LEFT_OUT = " UNION ALL ".join(
    f"SELECT {i} AS at, '{q}' AS gone, min(n) AS k FROM (SELECT count(*) AS n FROM dm GROUP BY {', '.join(x for x in QUASI if x != q)})" for i, q in enumerate(QUASI)
)
_TWO_OUT = " UNION ALL ".join(
    f"SELECT '{q}' AS first, {QUASI.index(r)} AS at, '{r}' AS gone, min(n) AS k FROM (SELECT count(*) AS n FROM dm GROUP BY {next(x for x in QUASI if x not in (q, r))})"
    for q in QUASI for r in QUASI if r != q
)


@query(f"""
WITH whole AS (SELECT min(n) AS k FROM (SELECT count(*) AS n FROM dm GROUP BY {", ".join(QUASI)})),
one AS (SELECT l.* FROM ({_LEFT_OUT}) l, whole WHERE whole.k < 5 ORDER BY l.k DESC, l.at LIMIT 1),
two AS (SELECT t.* FROM ({_TWO_OUT}) t JOIN one ON t.first = one.gone WHERE one.k < 5 ORDER BY t.k DESC, t.at LIMIT 1)
SELECT 1 AS step, gone AS dropped, k AS k_reached FROM one UNION ALL SELECT 2, gone, k FROM two""")
def risk_reduction_path(spark, d):
    path = risk.reduction_path(_classes(spark, d), QUASI, 5)
    return spark.createDataFrame([(i + 1, q, k) for i, (q, k) in enumerate(path)], "step int, dropped string, k_reached bigint")


@query("""
SELECT 'arm' AS sensitive, min(l) AS l_min FROM (SELECT count(DISTINCT arm) AS l FROM dm GROUP BY siteid, sex)
UNION ALL SELECT 'ethnic', min(l) FROM (SELECT count(DISTINCT ethnic) AS l FROM dm GROUP BY siteid, sex)""")
def risk_l_diversity(spark, d):
    return risk.l_diversity(table(spark, d, "dm"), ["siteid", "sex"], ["arm", "ethnic"])


@query(f"WITH {_CLASSES} SELECT size, count(*) AS n_classes FROM c GROUP BY 1")
def risk_histogram(spark, d):
    return risk.histogram(_classes(spark, d))


@query("SELECT CAST(l_returnflag AS VARCHAR) AS l_returnflag, CASE WHEN l_quantity > 25 THEN l_linestatus END AS status, count(*) AS size FROM lineitem GROUP BY ALL")
def risk_null_class(spark, d):
    items = table(spark, d, "lineitem").select("l_returnflag", F.when(F.col("l_quantity") > 25, F.col("l_linestatus")).alias("status"))
    return risk.classes(items, ["l_returnflag", "status"])


# --- vault (invariants) -----------------------------------------------------------


@query("""
SELECT c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def surrogate_join_integrity(spark, d):
    vault = _vault(spark)
    left = vault.replace(table(spark, d, "orders").withColumn("o_custkey", F.col("o_custkey").cast("string")), "o_custkey", "subject", "SUBJ")
    right = vault.replace(table(spark, d, "customer").withColumn("c_custkey", F.col("c_custkey").cast("string")), "c_custkey", "subject", "SUBJ")
    joined = left.join(right, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))


@query("SELECT count(DISTINCT usubjid) AS n, count(DISTINCT usubjid) AS n_distinct, 0::BIGINT AS n_kept FROM dm")
def surrogate_bijection(spark, d):
    subjects = table(spark, d, "dm").select("usubjid")
    pairs = _vault(spark).surrogates(subjects, "subject")
    kept = pairs.join(subjects.distinct(), F.col("surrogate") == F.col("usubjid"), "left_semi")
    counts = pairs.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("surrogate").alias("n_distinct"))
    return counts.withColumn("n_kept", F.lit(kept.count()).cast("bigint"))


@query("SELECT count(DISTINCT usubjid) AS n_subjects, 0::BIGINT AS n_in_clear FROM dm")
def vault_no_plaintext(spark, d):
    """Originals that any file under the vault's folder holds in clear, staging included."""
    subjects = table(spark, d, "dm").select("usubjid").where(F.col("usubjid").isNotNull()).distinct()
    vault = _vault(spark)
    vault.surrogates(subjects, "subject", "SUBJ")
    vault.offsets(subjects)
    vault.derangement(subjects, "all")
    vault.text_dummies(subjects)
    folders = [f"{vault.path}/{t}/{n}" for t, is_dir in files.listing(spark, vault.path) if is_dir for n, _ in files.listing(spark, f"{vault.path}/{t}")]
    cells = []
    for folder in folders:
        held = spark.read.parquet(folder)
        texts = [F.col(c).cast("binary") for c, t in held.dtypes if t in ("string", "binary")]
        if texts:
            cells.append(held.select(F.explode(F.array(*texts)).alias("cell")))
    clear = reduce(DataFrame.unionByName, cells).join(subjects, F.col("cell") == F.col("usubjid").cast("binary"), "left_semi")
    counted = subjects.agg(F.count(F.lit(1)).alias("n_subjects"))
    return counted.withColumn("n_in_clear", F.lit(clear.count()).cast("bigint"))


_SHAPE = "regexp_replace(regexp_replace(regexp_replace({c}, '[0-9]', '9', 'g'), '[A-Z]', 'A', 'g'), '[a-z]', 'a', 'g')"


@query(f"SELECT {_SHAPE.format(c='usubjid')} AS shape, count(*) AS n FROM (SELECT DISTINCT usubjid FROM dm WHERE usubjid IS NOT NULL) GROUP BY 1")
def surrogate_shape_preserved(spark, d):
    pairs = _vault(spark).surrogates(table(spark, d, "dm").select("usubjid"), "subject")
    return pairs.groupBy(text.shape_cased(F.col("surrogate")).alias("shape")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT count(DISTINCT (site, subject)) AS n, 0::BIGINT AS n_mismatch, count(DISTINCT site) AS n_sites FROM demog WHERE subject IS NOT NULL AND site IS NOT NULL""")
def surrogate_prefix_follows_site(spark, d):
    """Subjects are written behind their row's site, so that every value begins with its own."""
    rows = table(spark, d, "demog").where(F.col("subject").isNotNull() & F.col("site").isNotNull()).select(
        F.concat("site", F.lit("/"), "subject").alias("subject"), F.concat("site", F.lit("/")).alias("site")
    )
    vault = _vault(spark)
    pairs = vault.led(rows, "subject", "subject", "site", "site")
    sites = vault.surrogates(rows.select("site"), "site").select(F.col("value").alias("site"), F.col("surrogate").alias("site_new"))
    joined = rows.distinct().join(pairs, F.col("subject") == F.col("value")).join(sites, "site")
    return joined.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col("surrogate").startswith(F.col("site_new"))).alias("n_mismatch"),
        F.count_distinct("site_new").alias("n_sites"),
    )


@query("SELECT n, count(*) AS n_labels FROM (SELECT upper(trim(arm)) AS a, count(*) AS n FROM dm WHERE arm IS NOT NULL GROUP BY 1) GROUP BY 1")
def label_map_cardinality(spark, d):
    dm = table(spark, d, "dm")
    labels = _vault(spark).labels(dm.select("arm"), "treatment", "ARM")
    joined = dm.join(treatments.lookup(labels), F.upper(F.trim("arm")) == F.col("key"))
    return joined.groupBy("label").agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("n_labels"))


@query(f"""
WITH j AS (SELECT rec_id, usubjid, {_parts('aestdtc')}, {_parts('aeendtc')} FROM ae WHERE usubjid IS NOT NULL)
SELECT rec_id, CAST(date_diff('day', f_aestdtc, f_aeendtc) AS INT) AS days FROM j WHERE f_aestdtc IS NOT NULL AND f_aeendtc IS NOT NULL""")
def date_shift_intervals(spark, d):
    ae = table(spark, d, "ae").where(F.col("usubjid").isNotNull())
    offsets = _vault(spark).offsets(ae.select("usubjid"))
    moved = ae.join(treatments.lookup(offsets), F.col("usubjid") == F.col("value")).select(
        "rec_id", *[dates.shift_iso(F.col(c), F.col("days")).alias(c) for c in ("aestdtc", "aeendtc")]
    )
    start, end = dates.whole_date(F.col("aestdtc")), dates.whole_date(F.col("aeendtc"))
    return moved.where(start.isNotNull() & end.isNotNull()).select("rec_id", F.datediff(end, start).alias("days"))


@query("SELECT count(DISTINCT usubjid) AS n, count(DISTINCT usubjid) AS n_in_range, 0::BIGINT AS n_changed FROM dm")
def offset_range_check(spark, d):
    vault, keys = _vault(spark), table(spark, d, "dm").select("usubjid")
    first, again = vault.offsets(keys), vault.offsets(keys)
    changed = first.join(again.withColumnRenamed("days", "later"), "value").where(F.col("days") != F.col("later")).count()
    inside = F.abs("days").between(180, 540)
    return first.agg(F.count(F.lit(1)).alias("n"), F.count_if(inside).alias("n_in_range")).withColumn("n_changed", F.lit(changed).cast("bigint"))


@query(r"SELECT regexp_replace(regexp_replace(trim(aeterm), '[0-9]', '9', 'g'), '\p{L}', 'A', 'g') AS shape, count(*) AS n FROM ae GROUP BY 1")
def dummy_text_shape(spark, d):
    out = dummy_column(_vault(spark), table(spark, d, "ae").select("aeterm"), "aeterm")
    return out.groupBy(text.shape(F.trim("aeterm")).alias("shape")).agg(F.count(F.lit(1)).alias("n"))


# --- detection --------------------------------------------------------------------


class _Only:
    """Detector of one entity type."""

    def __init__(self, kind: str):
        self.kind, self.name = kind, kind.lower()
        self.whole = detect.PatternDetector()
        self.whole.patterns = [p for p in self.whole.patterns if p[0] == kind]

    def detect(self, text_: str):
        return self.whole.detect(text_)


def _only(kind: str):
    def factory():
        return _Only(kind)

    return factory


@query(r"SELECT rec_id FROM ae WHERE regexp_matches(aeterm, '[\w.+-]+@[\w-]+\.[\w.-]{2,}')")
def detect_email(spark, d):
    ae = table(spark, d, "ae")
    found = detect.findings_of(ae, "aeterm", _only("EMAIL_ADDRESS"))
    return ae.join(found, F.col("aeterm") == F.col("text"), "left_semi").select("rec_id")


@query(r"SELECT rec_id FROM ae WHERE regexp_matches(aeterm, '(^|[^0-9])[0-9]{3}-[0-9]{2}-[0-9]{4}([^0-9]|$)')")
def detect_ssn(spark, d):
    ae = table(spark, d, "ae")
    found = detect.findings_of(ae, "aeterm", _only("US_SSN"))
    return ae.join(found, F.col("aeterm") == F.col("text"), "left_semi").select("rec_id")


@query(r"SELECT rec_id FROM mh WHERE regexp_matches(mhterm, '(^|[^0-9])(\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}([^0-9]|$)')")
def detect_phone(spark, d):
    mh = table(spark, d, "mh")
    found = detect.findings_of(mh, "mhterm", _only("PHONE_NUMBER"))
    return mh.join(found, F.col("mhterm") == F.col("text"), "left_semi").select("rec_id")


TARGETS = [("ae", "aeterm"), ("mh", "mhterm")]


def _queue(spark, d):
    return detect.screen({t: table(spark, d, t) for t, _ in TARGETS}, TARGETS, "rec_id")


@query()
def screen_queue(spark, d):
    return _queue(spark, d)


@query()
def screen_policy_summary(spark, d):
    return detect.policy_summary(_queue(spark, d))


@query()
def screen_hit_rate(spark, d):
    return detect.hit_rates(_queue(spark, d), {t: table(spark, d, t) for t, _ in TARGETS}, TARGETS)


@query()
def screen_entity_counts(spark, d):
    return detect.entity_counts(_queue(spark, d))


#: Letters and digits of any script, as the detector reads them.
_MAIL = r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]{2,}"


@query(f"SELECT rec_id, regexp_replace(aeterm, '{_MAIL}', '<EMAIL_ADDRESS>', 'g') AS aeterm FROM ae")
def redact_email(spark, d):
    ae = table(spark, d, "ae")
    found = detect.findings_of(ae, "aeterm", _only("EMAIL_ADDRESS"))
    joined = ae.join(found, F.col("aeterm") == F.col("text"), "left")
    new = F.when(F.col("findings").isNotNull(), detect.redacted(F.col("aeterm"), F.col("findings"))).otherwise(F.col("aeterm"))
    return joined.select("rec_id", new.alias("aeterm"))


@query(r"""
SELECT rec_id, CASE WHEN regexp_matches(aeterm, '[\w.+-]+@[\w-]+\.[\w.-]{2,}') THEN '[REDACTED]' ELSE aeterm END AS aeterm FROM ae""")
def adjudicate_apply(spark, d):
    ae = table(spark, d, "ae")
    queue = detect.screen({"ae": ae}, [("ae", "aeterm")], "rec_id", _only("EMAIL_ADDRESS"))
    decided = queue.select("domain", "row_id", "column_name", F.lit("redact ").alias("verdict"), F.lit("").alias("replacement"))
    return detect.adjudicate(ae, "ae", "aeterm", "rec_id", decided).select("rec_id", "aeterm")


@query(r"""
SELECT rec_id, regexp_extract(aeterm, '[\w.+-]+@[\w-]+\.[\w.-]{2,}') AS text_found FROM ae
WHERE regexp_matches(aeterm, '[\w.+-]+@[\w-]+\.[\w.-]{2,}') ORDER BY rec_id LIMIT 20""")
def queue_top(spark, d):
    """The first page of a queue; its limit is the feature."""
    ae = table(spark, d, "ae")
    found = detect.findings_of(ae, "aeterm", _only("EMAIL_ADDRESS"))
    page = ae.join(found, F.col("aeterm") == F.col("text")).select("rec_id", F.col("findings")[0]["text"].alias("text_found"))
    return page.orderBy("rec_id").limit(20)


# --- dates in written form ----------------------------------------------------------

_SLASH = r"^\s*([0-9]{1,2})([/.-])([0-9]{1,2})([/.-])([0-9]{4})(\s.*)?$"
_ORDER_COLUMNS = ["birth_dt", "enrol_dt", "exit_dt"]
_ORDER = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, CASE WHEN count(a) = 0 THEN 'unambiguous' WHEN bool_or(a > 12) AND NOT bool_or(b > 12) THEN 'dmy'
        WHEN bool_or(b > 12) AND NOT bool_or(a > 12) THEN 'mdy' ELSE 'unknown' END AS day_order
        FROM (SELECT try_cast(nullif(regexp_extract({c}, '{_SLASH}', 1), '') AS INT) AS a,
                     try_cast(nullif(regexp_extract({c}, '{_SLASH}', 3), '') AS INT) AS b
              FROM demog WHERE regexp_extract({c}, '{_SLASH}', 2) = regexp_extract({c}, '{_SLASH}', 4))"""
    for c in _ORDER_COLUMNS
)


@query(_ORDER)
def raw_order_inference(spark, d):
    return rawdates.infer_order(table(spark, d, "demog"), _ORDER_COLUMNS)


_MOVED = "try_strptime(trim(exit_dt), '%d-%b-%Y')::DATE + CAST(200 + rec_id % 100 AS INT)"


@query(f"""
SELECT rec_id, CASE WHEN {_MOVED} IS NOT NULL THEN strftime({_MOVED}, '%d-%b-%Y') END AS value,
       CASE WHEN coalesce(trim(exit_dt), '') = '' THEN 'blank' WHEN {_MOVED} IS NULL THEN 'unparsed' ELSE 'shifted' END AS status FROM demog""")
def raw_shift_written(spark, d):
    moved = rawdates.shift_written(F.col("exit_dt"), (F.lit(200) + F.col("rec_id") % 100).cast("int"), "dmy")
    return table(spark, d, "demog").select("rec_id", moved.alias("_m")).select("rec_id", "_m.value", "_m.status")


@query("SELECT rec_id, strftime(o + CAST(200 + rec_id % 100 AS INT), '%d/%m/%Y') AS value FROM (SELECT o_orderkey AS rec_id, o_orderdate::DATE AS o FROM orders)")
def raw_shift_dmy(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("rec_id"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("v"))
    moved = rawdates.shift_written(F.col("v"), (F.lit(200) + F.col("rec_id") % 100).cast("int"), "dmy")
    return rows.select("rec_id", moved["value"].alias("value"))


@query("SELECT 0::BIGINT AS n_mismatch, count(*) AS n FROM orders")
def raw_vs_iso_pair(spark, d):
    rows = table(spark, d, "orders").select(
        F.date_format("o_orderdate", "ddMMMyyyy").alias("raw"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("iso"),
        (F.lit(-300) + F.col("o_custkey") % 50).cast("int").alias("n"),
    )
    moved = rows.select(
        rawdates.shift_written(F.upper("raw"), F.col("n"), None)["value"].alias("raw"), dates.shift_iso(F.col("iso"), F.col("n")).alias("iso")
    )
    back = F.upper(F.date_format(dates.whole_date(F.col("iso")), "ddMMMyyyy"))
    return moved.agg(F.count_if(~F.col("raw").eqNullSafe(back)).alias("n_mismatch"), F.count(F.lit(1)).alias("n"))


_DATES = [("mh_log", "mh_onset"), ("ae_log", "ae_start"), ("demog", "birth_dt"), ("demog", "enrol_dt"), ("demog", "exit_dt")]
_ALL_DATES = " UNION ALL ".join(f"SELECT '{c}' AS field_name, rec_id, {c} AS v FROM {t}" for t, c in _DATES)
_MON = "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_UNK = "(?:UNK|UN|UK|NK|XX|--|00)"
_AT = r"(?:[T\s]\s*\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:\s*[AP]\.?M\.?)?(?:\s*(?:Z|UTC|GMT|[+-]\d{2}:?\d{2}))?)?"
#: (pattern, groups of year, month, day; 'mon' where the month is a name), in reading order; days come first.
_GRAMMAR = [
    (r"(\d{4})-(\d{2})-(\d{2})" + _AT, 1, 2, 3),
    *[(rf"(\d{{1,2}}){sep}(\d{{1,2}}){sep}(\d{{4}})" + _AT, 3, 2, 1) for sep in ("/", r"\.", "-")],
    (r"(\d{4})-(\d{2})", 1, 2, None),
    (r"((?:19|20)\d{2})", 1, None, None),
    (r"((?:19|20)\d{2})(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])", 1, 2, 3),
    (r"(\d{4})/(\d{1,2})/(\d{1,2})" + _AT, 1, 2, 3),
    (rf"(\d{{1,2}})[-\s]?{_MON}[-\s,]?\s?(\d{{4}})(?::\s*\d{{1,2}}:\d{{2}}(?::\d{{2}}(?:\.\d+)?)?(?:\s*[AP]\.?M\.?)?)?", 3, "2", 1),
    (rf"(\d{{1,2}})[-\s]?{_MON}[-\s,]?\s?(\d{{4}})" + _AT, 3, "2", 1),
    (rf"{_MON}[-\s]?(\d{{4}})", 2, "1", None),
    (rf"{_UNK}[-/ .]?{_MON}[-/ .]?(\d{{4}})", 2, "1", None),
    *[(rf"{_UNK}{sep}{_UNK}{sep}(\d{{4}})", 1, None, None) for sep in ("-", "/", " ", r"\.", "")],
    (rf"(\d{{4}})[-/](\d{{2}})[-/]{_UNK}", 1, 2, None),
    (rf"(\d{{4}})[-/]{_UNK}(?:[-/]{_UNK})?", 1, None, None),
    *[(rf"{_UNK}{sep}(\d{{1,2}}){sep}(\d{{4}})", 2, 1, None) for sep in ("/", r"\.", "-")],
]


def _read(pattern: str, y: int, m: int | str | None, day: int | None) -> str:
    part = lambda g: f"CAST(regexp_extract(t, '(?i)^(?:{pattern})$', {g}) AS INT)"
    named = f"list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], lower(substr(regexp_extract(t, '(?i)^(?:{pattern})$', {m}), 1, 3)))"
    month = "NULL::INT" if m is None else named if isinstance(m, str) else part(m)
    whole = f"struct_pack(y := {part(y)}, m := CAST({month} AS INT), d := {'NULL::INT' if day is None else part(day)})"
    usable = " AND ".join([f"{part(y)} >= 1800", *([f"{part(m)} > 0"] if isinstance(m, int) else []), *([f"{part(day)} > 0"] if day else [])])
    return f"CASE WHEN regexp_matches(t, '(?i)^(?:{pattern})$') THEN CASE WHEN {usable} THEN {whole} END END"


@query(f"""
WITH v AS ({_ALL_DATES}), r AS (SELECT field_name, rec_id, coalesce({", ".join(_read(*g) for g in _GRAMMAR)}) AS p FROM (SELECT *, trim(v) AS t FROM v)),
ok AS (SELECT field_name, rec_id, CASE WHEN try_cast(printf('%04d-%02d-%02d', p.y, coalesce(p.m, 1), coalesce(p.d, 1)) AS DATE) IS NOT NULL THEN p END AS p FROM r)
SELECT field_name, rec_id, p.y AS year, p.m AS month, p.d AS day FROM ok""")
def raw_grammar(spark, d):
    """What every written date of every column reads as, day first."""
    parts = [table(spark, d, t).select(F.lit(c).alias("field_name"), "rec_id", F.col(c).alias("v")) for t, c in _DATES]
    every = reduce(DataFrame.unionByName, parts)
    return every.select("field_name", "rec_id", rawdates.parts_of(F.col("v"), "dmy").alias("p")).select("field_name", "rec_id", "p.year", "p.month", "p.day")


@query()
def raw_format_counts(spark, d):
    return rawdates.format_counts(table(spark, d, "mh_log"), "mh_onset")


@query()
def raw_date_rate(spark, d):
    return rawdates.date_rate(table(spark, d, "mh_log"), "mh_onset")


# --- blinding, text check -------------------------------------------------------------


def _arm_terms(spark, d):
    return blinding.revealing_terms(r[0] for r in table(spark, d, "dm").select("arm").distinct().collect())  # one row per arm


_TERMS = """t AS (
  SELECT DISTINCT unnest([lower(trim(arm)), lower(split_part(trim(arm), ' ', 1))]) AS term FROM dm
  WHERE arm IS NOT NULL AND lower(trim(arm)) <> 'placebo')"""


@query(f"WITH {_TERMS} SELECT term FROM t")
def blinding_terms(spark, d):
    return spark.createDataFrame([(t,) for t in _arm_terms(spark, d)], "term string")


@query(f"""
WITH {_TERMS} SELECT 'documents' AS domain, 'text' AS column_name, term, count(*) AS n_rows, min(doc_id) AS example_row
FROM t JOIN documents ON regexp_matches(text, '(?i)(^|[^A-Za-z0-9_])' || replace(term, ' ', '\\s+') || '([^A-Za-z0-9_]|$)') GROUP BY term""")
def blinding_audit(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text")
    return blinding.audit(documents, _arm_terms(spark, d), "documents", "doc_id")


@query(r"""
WITH p AS (SELECT aeterm AS t, trim(regexp_replace(lower(aeterm), '[^a-z0-9]+', ' ', 'g')) AS a,
                  trim(regexp_replace(lower(aedecod), '[^a-z0-9]+', ' ', 'g')) AS b, aedecod FROM ae WHERE aeterm IS NOT NULL)
SELECT count(*) AS n_values, count(DISTINCT t) AS n_distinct,
  round(avg(CASE WHEN trim(t) = '' THEN 0 ELSE len(regexp_split_to_array(trim(t, ' '), '\s+')) END), 6) AS mean_words,
  round(avg(CAST(regexp_matches(t, '[.;,]|[0-9]{2,}') AS INT)), 6) AS sentence_rate,
  round(avg(CASE WHEN aedecod IS NOT NULL THEN CAST(a = b AS INT) END), 6) AS match_rate,
  (SELECT round(avg(n), 6) FROM (SELECT count(DISTINCT t) AS n FROM p WHERE aedecod IS NOT NULL GROUP BY b)) AS terms_per_code
FROM p""")
def textcheck_signals(spark, d):
    found = textcheck.signals(table(spark, d, "ae"), "aeterm", "aedecod")
    rates = ["mean_words", "sentence_rate", "match_rate", "terms_per_code"]
    return found.select("n_values", "n_distinct", *[F.round(c, 6).alias(c) for c in rates])


@query("SELECT aeterm AS value, count(*) AS n FROM ae WHERE aeterm IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 60")
def value_counts_top60(spark, d):
    """The most frequent values of a column; its limit is the feature."""
    counts = table(spark, d, "ae").where(F.col("aeterm").isNotNull()).groupBy(F.col("aeterm").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "value").limit(60)


# --- reassignment -----------------------------------------------------------------------


def _spaced(spark, d):
    """Order rows as events of customers, with their reference dates."""
    orders = table(spark, d, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("subject"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("dtc")
    )
    return orders, orders.groupBy("subject").agg(F.min("dtc").alias("anchor"))


@query("""
SELECT study_day, count(*) AS n FROM (SELECT date_diff('day', min(o_orderdate) OVER (PARTITION BY o_custkey)::DATE, o_orderdate::DATE)::INT AS study_day FROM orders) GROUP BY 1""")
def reassign_study_day_invariant(spark, d):
    """Records carry a column of their subject; one that is not the recipient's after the move loses its day."""
    orders, anchor = _spaced(spark, d)
    anchor = anchor.withColumn("site", F.concat(F.lit("site "), F.col("subject")))
    orders = orders.withColumn("site", F.concat(F.lit("site "), F.col("subject")))
    rows = anchor.select("subject", F.col("site").alias("a_site"))
    moved = reassign.by_subject(orders, "subject", ["dtc"], anchor, _vault(spark), rows=rows)
    joined = moved.join(anchor.select(F.col("subject").alias("_s"), "anchor", F.col("site").alias("_site")), F.col("subject") == F.col("_s"))
    day = F.when(F.col("site") == F.col("_site"), dates.study_day(F.col("dtc"), F.col("anchor"), True))
    return joined.groupBy(day.alias("study_day")).agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT study_day, count(*) AS n FROM (SELECT date_diff('day', min(o_orderdate) OVER (PARTITION BY o_custkey)::DATE, o_orderdate::DATE)::INT AS study_day FROM orders) GROUP BY 1""")
def reassign_written_dates(spark, d):
    """Dates written as 05-Mar-2024 move in their own form and keep their study day."""
    orders, anchor = _spaced(spark, d)
    written = orders.withColumn("dtc", F.date_format(dates.whole_date(F.col("dtc")), "dd-MMM-yyyy"))
    moved = reassign.by_subject(written, "subject", ["dtc"], anchor, _vault(spark), orders={"dtc": "dmy"})
    joined = moved.join(anchor.withColumnRenamed("subject", "_s"), F.col("subject") == F.col("_s"))
    at = F.try_to_timestamp("dtc", F.lit("dd-MMM-yyyy")).cast("date")
    return joined.groupBy(F.datediff(at, dates.whole_date(F.col("anchor"))).alias("study_day")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT count(*) AS n_rows, 0::BIGINT AS n_donors_value FROM orders")
def reassign_mirrors(spark, d):
    """Columns that repeat their subject's row carry the new owner's values after the move."""
    people = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("subject"), F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("name"))
    orders, anchor = _spaced(spark, d)
    orders = orders.join(people, "subject")
    rows = people.select("subject", F.col("segment").alias("a_segment"), F.col("name").alias("a_name"))
    moved = reassign.by_subject(orders, "subject", ["dtc"], anchor, _vault(spark), rows=rows)
    own = people.select(F.col("subject").alias("_s"), F.col("segment").alias("_segment"), F.col("name").alias("_name"))
    joined = moved.join(own, F.col("subject") == F.col("_s"), "left")
    right = F.col("segment").eqNullSafe(F.col("_segment")) & F.col("name").eqNullSafe(F.col("_name"))
    return joined.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~right).alias("n_donors_value"))


@query("SELECT count(*) AS n_subjects, 0::BIGINT AS n_kept_own, count(*) AS n_recipients FROM (SELECT DISTINCT o_custkey FROM orders)")
def reassign_derangement(spark, d):
    pairs = _vault(spark).derangement(_spaced(spark, d)[0].select("subject"), "all")
    return pairs.agg(
        F.count(F.lit(1)).alias("n_subjects"),
        F.count_if(F.col("donor") == F.col("recipient")).alias("n_kept_own"),
        F.count_distinct("recipient").alias("n_recipients"),
    )


@query("SELECT count(*) AS n_rows, 0::BIGINT AS n_broken FROM ae WHERE usubjid IS NOT NULL")
def reassign_rows_renumber(spark, d):
    ae = table(spark, d, "ae").where(F.col("usubjid").isNotNull()).select("rec_id", "usubjid", "aeseq", "aeterm")
    moved = reassign.by_row(ae, "usubjid", "aeseq", "rec_id")
    per = moved.groupBy("usubjid").agg(F.count(F.lit(1)).alias("n"), F.min("aeseq").alias("lo"), F.max("aeseq").alias("hi"), F.count_distinct("aeseq").alias("u"))
    broken = (F.col("lo") != 1) | (F.col("hi") != F.col("n")) | (F.col("u") != F.col("n"))
    return per.agg(F.sum("n").alias("n_rows"), F.count_if(broken).alias("n_broken"))


@query("""
SELECT 'aesev' AS column_name, aesev AS value, count(*) AS n FROM ae GROUP BY 2
UNION ALL SELECT 'aeout', aeout, count(*) FROM ae GROUP BY 2""")
def shuffle_values_multiset(spark, d):
    ae = table(spark, d, "ae").select("rec_id", "aesev", "aeout")
    mixed = reassign.shuffle_values(ae, ["aesev", "aeout"], "rec_id")
    parts = [mixed.groupBy(F.lit(c).alias("column_name"), F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n")) for c in ("aesev", "aeout")]
    return reduce(DataFrame.unionByName, parts)


@query("""
SELECT 'l_linenumber' AS column_name, bool_and(ok) AND max(n) > 1 AS is_sequence FROM (
  SELECT count(*) AS n, min(l_linenumber) = 1 AND max(l_linenumber) = count(*) AND count(DISTINCT l_linenumber) = count(*) AS ok FROM lineitem GROUP BY l_orderkey)
UNION ALL SELECT 'l_suppkey', bool_and(ok) AND max(n) > 1 FROM (
  SELECT count(*) AS n, min(l_suppkey) = 1 AND max(l_suppkey) = count(*) AND count(DISTINCT l_suppkey) = count(*) AS ok FROM lineitem GROUP BY l_orderkey)""")
def sequence_column_detect(spark, d):
    return reassign.sequence_columns(table(spark, d, "lineitem"), "l_orderkey", ["l_linenumber", "l_suppkey"])


@query("""
WITH s AS (SELECT site, upper(trim(subject)) AS subject, country_cd, sex_cd, site_zip FROM demog),
p AS (SELECT subject, count(*) AS n,
  count(site) = 0 OR (min(site) = max(site) AND count(site) = count(*)) AS a,
  count(site_zip) = 0 OR (min(site_zip) = max(site_zip) AND count(site_zip) = count(*)) AS b FROM s GROUP BY 1)
SELECT 'site' AS column_name, bool_and(a) AND count(*) FILTER (WHERE n > 1) >= 2 AS is_constant FROM p
UNION ALL SELECT 'site_zip', bool_and(b) AND count(*) FILTER (WHERE n > 1) >= 2 FROM p""")
def subject_level_detect(spark, d):
    demog = table(spark, d, "demog").withColumn("subject", F.upper(F.trim("subject")))
    return reassign.subject_level_columns(demog, "subject", ["site", "site_zip"])


@query("""
SELECT 'l_check' AS column_name, 'o_custkey' AS anchor_name, true AS is_mirror UNION ALL SELECT 'l_suppkey', 'o_custkey', bool_and(l_suppkey = o_custkey)
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def mirror_column_detect(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    items = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    items = items.join(orders.withColumnRenamed("o_custkey", "l_check"), "l_orderkey")
    return reassign.mirror_columns(items, orders, "l_orderkey", [("l_check", "o_custkey"), ("l_suppkey", "o_custkey")])


# --- profile ------------------------------------------------------------------------------

PROFILED = ["usubjid", "siteid", "brthdtc", "age", "race", "sitezip", "arm", "rfstdtc", "subjphone"]
_PROFILE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS n, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_unique,
      round(coalesce(avg(length(CAST({c} AS VARCHAR))), 0), 6) AS mean_length, CAST(coalesce(max(length(CAST({c} AS VARCHAR))), 0) AS INT) AS max_length,
      round(avg(CAST(regexp_matches(CAST({c} AS VARCHAR), '{_NUM}') AS INT)), 6) AS numeric_rate,
      round(avg(CAST(contains(CAST({c} AS VARCHAR), ' ') AS INT)), 6) AS blank_rate FROM dm"""
    for c in PROFILED
)


@query(_PROFILE)
def profile_columns(spark, d):
    found = profiler.column_profiles(table(spark, d, "dm"), PROFILED)
    return found.select("column_name", "n", "n_null", "n_unique", "mean_length", "max_length", "numeric_rate", "blank_rate")


_WHOLE = r"^\s*[0-9]+\s*$"
_NUMERIC_SHAPE = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, bool_and(regexp_matches(v, '{_WHOLE}')) AS all_whole,
      CAST(max(length(trim(v))) FILTER (WHERE regexp_matches(v, '{_WHOLE}')) AS INT) AS max_digits,
      bool_or(regexp_matches(v, '^0[0-9]+$')) AS leading_zero FROM (SELECT CAST({c} AS VARCHAR) AS v FROM {t})"""
    for t, c in (("dm", "sitezip"), ("dm", "age"), ("dm", "siteid"))
)


@query(_NUMERIC_SHAPE)
def numeric_shape(spark, d):
    found = profiler.column_profiles(table(spark, d, "dm"), ["sitezip", "age", "siteid"])
    return found.select("column_name", "all_whole", "max_digits", "leading_zero")


@query("SELECT bool_and(starts_with(subjid, siteid) AND length(subjid) > length(siteid)) AS is_embedded, count(*) AS n FROM dm WHERE subjid IS NOT NULL")
def embedded_site_detect(spark, d):
    return profiler.embedded_prefix(table(spark, d, "dm"), "subjid", "siteid")


#: What the profiler should say of the columns of DM, from what they are.
_EXPECTED = {
    "studyid": "surrogate_id", "domain": "retain", "usubjid": "surrogate_id", "subjid": "drop", "siteid": "surrogate_id", "invnam": "drop", "brthdtc": "drop", "age": "cap_numeric",
    "ageu": "retain", "sex": "pool_rare", "race": "pool_rare", "ethnic": "pool_rare", "country": "pool_rare", "sitezip": "zip3", "arm": "label_map", "rfstdtc": "date_to_study_day",
    "rfendtc": "date_to_study_day", "subjphone": "drop",
}


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, '{t}' AS treatment" for c, t in _EXPECTED.items()))
def contract_treatments(spark, d):
    return contract_proposal(spark, d).select("column_name", "treatment")


@query()
def contract_proposal(spark, d):
    """Proposed treatment of every DM column."""
    dm = table(spark, d, "dm").drop("rec_id", "loaded_at", "deleted_at")
    rows = {r["column_name"]: r.asDict() for r in profiler.column_profiles(dm, dm.columns).collect()}  # one row per column
    found = profiler.propose(rows, blind=True)
    return spark.createDataFrame([(p.column, p.treatment, p.confidence, p.reason) for p in found], "column_name string, treatment string, confidence string, reason string")


# --- protocol -----------------------------------------------------------------------------

@query(f"""
WITH {_TERMS}, hits AS (
  SELECT term, len(regexp_extract_all(text, '(?i)(^|[^A-Za-z0-9_])' || term || '\\b')) AS n FROM t, documents WHERE NOT contains(term, ' '))
SELECT term, CAST(sum(n) AS BIGINT) AS n FROM hits GROUP BY 1 HAVING sum(n) > 0""")
def protocol_term_counts(spark, d):
    """Study drug names of one word, counted in all documents."""
    return protocol.term_counts(table(spark, d, "documents"), "text", [t for t in _arm_terms(spark, d) if " " not in t])


@query("SELECT 0::BIGINT AS n_residual, count(*) AS n_blocks, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM documents")
def protocol_mask_residual(spark, d):
    """Masks of equal length: nothing is left and nothing else moves."""
    terms = _arm_terms(spark, d)
    masked = protocol.mask(table(spark, d, "documents").select("doc_id", "text"), "text", {t: "X" * len(t) for t in terms})
    return masked.agg(
        F.count_if(F.col("text").rlike(text.word_pattern(terms))).alias("n_residual"),
        F.count(F.lit(1)).alias("n_blocks"),
        F.sum(F.length("text")).alias("n_chars"),
    )


@query()
def protocol_terms(spark, d):
    return protocol.propose(table(spark, d, "documents"), "doc_id", "text")


@query(f"""
SELECT CASE WHEN coalesce(trim(exit_dt), '') = '' THEN 'blank' WHEN {_MOVED} IS NULL THEN 'unparsed' ELSE 'shifted' END AS status, count(*) AS n FROM demog GROUP BY 1""")
def raw_shift_report(spark, d):
    """How many written dates were moved, and how many could not be read."""
    moved = rawdates.shift_written(F.col("exit_dt"), F.lit(200), "dmy")
    return table(spark, d, "demog").groupBy(moved["status"].alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT usubjid AS subject, arg_min(struct_pack(d := aestdtc), rec_id).d AS anchor FROM ae WHERE usubjid IS NOT NULL GROUP BY 1")
def reassign_self_anchor(spark, d):
    return reassign.self_anchor(table(spark, d, "ae"), "usubjid", "aestdtc", "rec_id")
