"""A made-up study for tests and demonstrations, built from ranges and hashes.

Every value is a function of the subject number and a seed, so the tables are
the same wherever and however often they are made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SITES = ["001", "002", "003", "004", "005", "017"]
WEIGHTS = [30, 28, 24, 20, 16, 2]
TERMS = ["Headache", "Nausea", "Fatigue", "Dizziness", "Rash", "Cough"]


def _pick(options: list[str], *key) -> Column:
    return F.element_at(F.array(*[F.lit(o) for o in options]), (F.pmod(F.xxhash64(*key), F.lit(len(options))) + 1).cast("int"))


def _number(low: int, high: int, *key) -> Column:
    return (F.pmod(F.xxhash64(*key), F.lit(high - low + 1)) + low).cast("int")


def _day(start: str, offset: Column) -> Column:
    return F.date_format(F.date_add(F.to_date(F.lit(start)), offset), "yyyy-MM-dd")


def study(spark: SparkSession, subjects: int = 120, seed: int = 1) -> dict[str, DataFrame]:
    """SDTM-like DM, AE, MH, LB; one site is deliberately tiny."""
    s, n = F.lit(seed), F.col("n")
    site = [w for w, k in zip(SITES, WEIGHTS) for _ in range(k)]
    base = spark.range(subjects).select(F.col("id").alias("n")).select(
        "n", F.element_at(F.array(*[F.lit(x) for x in site]), (F.pmod(n, F.lit(len(site))) + 1).cast("int")).alias("SITEID")
    ).withColumn("SUBJID", F.format_string("%s-%04d", "SITEID", n + 1)).withColumn("USUBJID", F.concat(F.lit("DEMO-2026-"), "SUBJID"))
    start = _number(0, 300, "n", s, F.lit("start"))
    dm = base.select(
        F.lit("DEMO-2026").alias("STUDYID"), F.lit("DM").alias("DOMAIN"), "USUBJID", "SUBJID", "SITEID",
        F.concat(F.lit("Dr. Demo "), "SITEID").alias("INVNAM"), _day("1930-01-01", _number(0, 25_000, "n", s, F.lit("b"))).alias("BRTHDTC"),
        _pick(["M", "F"], "n", s, F.lit("x")).alias("SEX"), _pick(["WHITE", "ASIAN", "BLACK"], "n", s, F.lit("r")).alias("RACE"),
        _pick(["Placebo", "Demodrug 40 mg"], "n", s, F.lit("a")).alias("ARM"), _day("2025-01-01", start).alias("RFSTDTC"),
    )
    events = base.withColumn("AESEQ", F.explode(F.sequence(F.lit(1), 1 + _number(0, 3, "n", s, F.lit("e")))))
    at = start + _number(1, 90, "n", "AESEQ", s)
    ae = events.select(
        F.lit("AE").alias("DOMAIN"), "USUBJID", "AESEQ", _pick(TERMS, "n", "AESEQ", s).alias("AETERM"),
        _day("2025-01-01", at).alias("AESTDTC"), _day("2025-01-01", at + _number(0, 20, "n", "AESEQ", s, F.lit("l"))).alias("AEENDTC"),
    )
    full = _day("2000-01-01", _number(0, 9000, "n", s, F.lit("mh")))
    kind = _number(0, 99, "n", s, F.lit("k"))
    mh = base.select(
        F.lit("MH").alias("DOMAIN"), "USUBJID", F.lit(1).alias("MHSEQ"), _pick(TERMS, "n", s, F.lit("m")).alias("MHTERM"),
        F.when(kind < 45, F.substring(full, 1, 4)).when(kind < 70, F.substring(full, 1, 7)).otherwise(full).alias("MHSTDTC"),
    )
    lb = base.withColumn("v", F.explode(F.sequence(F.lit(1), F.lit(4)))).withColumn("t", F.explode(F.array(*[F.lit(x) for x in ["ALT", "AST", "GLUC", "HGB", "PLAT"]])))
    lb = lb.select(
        F.lit("LB").alias("DOMAIN"), "USUBJID", F.col("t").alias("LBTESTCD"), _number(5, 400, "n", "v", "t", s).cast("string").alias("LBORRES"),
        F.col("v").alias("VISITNUM"), _day("2025-01-01", start + 14 * F.col("v")).alias("LBDTC"),
    )
    return {"DM": dm, "AE": ae, "MH": mh, "LB": lb}


def raw(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The same events as an export keyed by hand: other names and written dates."""

    def written(column: str, form: str) -> Column:
        return F.date_format(F.try_to_timestamp(column, F.lit("yyyy-MM-dd")), form)

    subject = F.substring_index("USUBJID", "DEMO-2026-", -1)
    return {
        "DEMOG": tables["DM"].select(subject.alias("SUBJECT"), F.col("SITEID").alias("SITE"), F.col("INVNAM").alias("INVESTIGATOR"), written("BRTHDTC", "dd-MMM-yyyy").alias("BIRTH_DT"), F.col("ARM").alias("TREATMENT"), written("RFSTDTC", "dd/MM/yyyy").alias("ENROL_DT")),
        "AE_LOG": tables["AE"].select(subject.alias("SUBJECT"), F.col("AESEQ").alias("AE_NO"), F.col("AETERM").alias("AE_TERM"), written("AESTDTC", "dd/MM/yyyy").alias("AE_START"), written("AEENDTC", "dd/MM/yyyy").alias("AE_STOP")),
        "LABS": tables["LB"].select(subject.alias("SUBJECT"), F.col("LBTESTCD").alias("TEST_CD"), F.col("LBORRES").alias("RESULT"), F.upper(written("LBDTC", "ddMMMyyyy")).alias("COLLECT_DT")),
    }
