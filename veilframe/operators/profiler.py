"""Column profiles in one distributed pass, and the proposal made from them.

The profile is one aggregation over distinct values (counts per value with
map-side combine, then a fold per column).  Proposals are plain driver code
over one row of metadata per column.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.functions.naming import name_tokens
from veilframe.functions.numbers import NUMBER
from veilframe.functions.text import shape_space
from veilframe.operators.detect import DRUG_ENDINGS
from veilframe.operators.quality import is_written_day


#: What values say of their column: a person's name, an answer, a medicine, a means of contact.
PERSON = r"^\s*(?:(?:Dr|Prof|Mr|Mrs|Ms)\.?\s+)?(?:\p{Lu}[\p{Ll}'’-]+(?:\s\p{Lu}\.)?\s\p{Lu}[\p{L}'’-]+|\p{Lu}\.\s?(?:\p{Lu}\.\s?)?\p{Lu}[\p{L}'’-]+|\p{Lu}[\p{L}'’-]+,\s?\p{Lu}[\p{L}.'’-]*|\p{Lu}{2,}\s\p{Lu}[\p{Ll}'’-]+)\s*$"
ANSWERS = ("y", "n", "yes", "no", "u", "unknown", "unk", "na", "n/a", "not applicable", "not done", "done", "true", "false", "none", "ongoing", "normal", "abnormal", "positive", "negative", "male", "female", "m", "f")
MEDICINE = r"(?i)\b[a-z]{2,}(?:" + "|".join(e for e in DRUG_ENDINGS if len(e) > 3 or e in ("mab", "nib")) + r")\b"
CONTACT = r"[\w.+-]+@[\w-]+\.[\w.-]{2,}|^\s*\+?\(?[0-9][0-9 ().-]{7,18}[0-9]\s*$"


def column_profiles(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: counts, lengths, shapes and rates of its values."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]))
    values = df.select(pairs.alias("_p")).select("_p.*").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    v, n = F.col("value"), F.col("n")
    filled = v.isNotNull()
    total = F.sum(F.when(filled, n))

    def rate(cond):
        return F.coalesce(F.sum(F.when(filled & cond, n)) / total, F.lit(0.0))

    number = F.when(v.rlike(NUMBER), F.trim(v).try_cast("double"))
    whole = v.rlike(r"^\s*[0-9]+\s*$")
    return values.groupBy("column_name").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(~filled, n)), F.lit(0).cast("bigint")).alias("n_null"),
        F.count("value").alias("n_unique"),
        F.round(F.coalesce(F.sum(F.when(filled, F.length(v) * n)) / total, F.lit(0.0)), 6).alias("mean_length"),
        F.coalesce(F.max(F.length(v)), F.lit(0)).alias("max_length"),
        F.round(rate(number.isNotNull()), 6).alias("numeric_rate"),
        F.round(rate(v.rlike(r"^\s*[0-9]{4}(-[0-9]{2}(-[0-9]{2}([T ].*)?)?)?\s*$")), 6).alias("iso_rate"),
        F.round(rate(is_written_day(v)), 6).alias("raw_date_rate"),
        F.round(rate(v.contains(" ")), 6).alias("blank_rate"),
        F.round(rate(v.rlike(r"^\s*[0-2]?[0-9]:[0-5][0-9](:[0-5][0-9])?\s*$")), 6).alias("time_rate"),
        F.coalesce(F.bool_and(F.when(filled, whole)), F.lit(False)).alias("all_whole"),
        F.max(F.when(whole, F.length(F.trim(v)))).alias("max_digits"),
        F.coalesce(F.bool_and(F.when(filled, whole & number.between(1900, 2100))), F.lit(False)).alias("all_years"),
        F.coalesce(F.bool_or(v.rlike("^0[0-9]+$")), F.lit(False)).alias("leading_zero"),
        F.min(F.when(filled, shape_space(v))).alias("shape_space"),
        F.round(rate(v.rlike(PERSON)), 6).alias("person_rate"),
        F.round(rate(F.lower(F.trim(v)).isin(*ANSWERS)), 6).alias("answer_rate"),
        F.round(rate(v.rlike(MEDICINE)), 6).alias("medicine_rate"),
        F.round(rate(v.rlike(CONTACT)), 6).alias("contact_rate"),
    )


def embedded_prefix(df: DataFrame, whole: str, head: str) -> DataFrame:
    """One row: does every value of ``whole`` begin with, and exceed, its row's ``head``?"""
    rows = df.where(F.col(whole).isNotNull())
    good = F.col(whole).startswith(F.col(head)) & (F.length(whole) > F.length(head))
    return rows.agg(F.coalesce(F.bool_and(F.coalesce(good, F.lit(False))), F.lit(False)).alias("is_embedded"), F.count(F.lit(1)).alias("n"))


# Column names with a settled meaning in study tables.
DIRECT = frozenset(
    """INVNAM SUBJINIT INITIALS SUBJPHONE PHONE CONTACT_PHONE EMAIL ADDRESS STREET SSN MRN NAME FIRSTNAME LASTNAME INVESTIGATOR
    PATIENTNAME PT_NAME FAX""".split()
)
QUASI = frozenset("SEX SEX_CD RACE RACE_TXT ETHNIC ETHNIC_TXT COUNTRY COUNTRY_CD AGEGR AGEGR1".split())
ROLES = frozenset("INVESTIGATOR PI MONITOR NURSE PHYSICIAN DOCTOR COORDINATOR ASSESSOR REVIEWER 研究者 医生 护士".split())
EDC_USER = frozenset("USERID USER_ID CREATEDBY MODIFIEDBY ENTEREDBY LASTUSER USERNAME".split())
STRUCTURE = frozenset("PROJECTID PAGEREPEATNUMBER RECORDPOSITION INSTANCEREPEATNUMBER DATAPAGEID FOLDERSEQ RECORDID INSTANCENAME DATAPAGENAME FOLDER FOLDERNAME".split())
AUDIT = re.compile(r"(CREATED|MODIFIED|UPDATED|SAVETS|ENTRY|MINCREATED|MAXUPDATED|LASTMOD)(_?(DT|DATE|TS|AT|TIME|DTC))?$")
DESIGN = frozenset("VISITNUM VISIT VISITDY EPOCH VISIT_NO CYCLE_NO".split())


@dataclass
class Proposal:
    column: str
    treatment: str
    confidence: str
    reason: str
    entity: str | None = None
    params: dict | None = None


def propose(columns: dict[str, dict], tier: str = "deidentified", raw: bool = False, blind: bool = False) -> list[Proposal]:
    """One proposal per column, lowest confidence first.  ``columns``: name -> profile row."""
    names = {c.upper() for c in columns}

    def one(name: str, p: dict) -> Proposal:
        up = name.upper()
        squeezed = re.sub(r"_(RAW|INT|STD|DEC|FUL)$", "", up) if raw else up
        say = lambda t, c, why, e=None, **kw: Proposal(name, t, c, why, e, kw or None)
        words = set(name_tokens(name))
        if up == "DOMAIN":
            return say("retain", "high", "table code")
        if squeezed.endswith(("FREQ", "FRQ", "INDC")):
            return say("retain", "high", "regimen or indication")
        if raw and squeezed.startswith("DRUG") and p["numeric_rate"] < 0.5 and p["raw_date_rate"] < 0.5:
            return say("label_map", "medium", "study product", "treatment_product", prefix="DRUG")
        if squeezed in ("STUDYID", "STUDY", "PROTOCOL", "PROJECT"):
            return say("surrogate_id", "high", "study number", "studyid")
        if squeezed in ("USUBJID", "SUBJECT", "SUBJECT_NUMBER", "SUBJECT_KEY", "PATNO", "PT"):
            return say("surrogate_id", "high", "subject key", "subject")
        if squeezed == "SUBJID":
            return say("drop", "high", "beside the subject key") if "USUBJID" in names else say("surrogate_id", "high", "subject key", "subject")
        if squeezed in ("SITEID", "SITE", "SITENUMBER", "SITE_NO"):
            return say("surrogate_id", "high", "site", "site")
        if words & {"SITE", "CENTRE", "CENTER"} and words & {"NAME", "NM"}:
            code_beside = any("SITE" in n and "NAME" not in n for n in names)
            return say("drop", "high", "site code is present") if code_beside else say("surrogate_id", "medium", "site name", "site")
        if squeezed in EDC_USER:
            return say("drop", "high", "who keyed the record")
        if words & ROLES and words & {"NAME", "SIGNATURE", "SIGN", "INITIALS"}:
            return say("drop", "high", "staff name")
        if AUDIT.search(squeezed):
            return say("drop", "high", "audit time")
        if raw and up.endswith("_INT") and p["numeric_rate"] > 0.9 and any(n != up and n.startswith(up[:-4]) for n in names):
            return say("drop", "high", "number behind a date")
        if re.search(r"(YY|MM|DD|MO|D|Y|YYYY)$", squeezed) and any(n != squeezed and n == re.sub(r"(YYYY|YY|MM|DD|MO|D|Y)$", "DAT", squeezed) for n in names):
            return say("drop", "medium", "piece of a date that is present")
        if squeezed in DIRECT:
            return say("drop", "high", "direct identifier")
        if re.search(r"ZIP|POSTCODE", squeezed):
            return say("zip3", "high", "postcode")
        if squeezed in ("BRTHDTC", "BIRTH_DT", "BRTHDAT", "DOB"):
            return say("drop", "high", "age is present") if "AGE" in names else say("dob_to_age", "medium", "birth date", cap=90)
        if squeezed == "AGE":
            return say("cap_numeric", "high", "age", cap=90)
        if blind and re.search(r"^(ARM|ARMCD|ACTARM|TREATMENT|EXTRT|STUDY_DRUG)$", squeezed):
            return say("label_map", "high", "treatment under blinding", "treatment", prefix="ARM")
        if blind and re.search(r"^EX(DOSE|DOSTOT|DOSU|DOSFRM|DOSFRQ|DOSRGM)$", squeezed):
            return say("retain", "low", "dose may tell the arm")
        if squeezed.endswith(("TM", "TIM", "TIME")) or p["time_rate"] >= 0.8:
            return say("retain", "medium", "time of day")
        if squeezed in STRUCTURE:
            return say("retain", "high", "form structure")
        if squeezed in QUASI:
            return say("pool_rare", "medium", "demographic", min_count=5)
        if squeezed.endswith("DY") or squeezed in DESIGN:
            return say("retain", "high", "relative time or design")
        if squeezed.endswith("DTC") or p["iso_rate"] >= 0.8 and not p["all_whole"]:
            if tier == "lds":
                return say("retain", "medium", "dates stay in a limited set")
            partial = p["iso_rate"] - p["raw_date_rate"] >= 0.2
            return say("partial_date_to_year_offset" if partial else "date_to_study_day", "medium", "date")
        if p["raw_date_rate"] >= 0.8 or raw and re.search(r"(_DT|DAT|_DATE|START|STOP|ONSET)$", squeezed):
            return say("date_shift_raw", "medium", "date in written form", "subject")
        if squeezed.endswith(("SEQ", "_NO")) and p["all_whole"]:
            return say("retain", "high", "sequence")
        if squeezed.endswith(("DECOD", "BODSYS", "SOC", "CD", "TESTCD", "TEST", "ORRESU")):
            return say("retain", "high", "coded value")
        # The values themselves, where the name says nothing.
        if p.get("contact_rate", 0) >= 0.3 and p["iso_rate"] + p["raw_date_rate"] < 0.3 and not p["all_whole"]:
            return say("drop", "medium", "values are means of contact")
        if p.get("answer_rate", 0) >= 0.9:
            return say("retain", "medium", "answers")
        if p.get("medicine_rate", 0) >= 0.5 and squeezed not in ("CMTRT",):
            return say("retain", "medium", "medicines") if not raw else say("label_map", "low", "medicines, maybe the study's own", "treatment_product", prefix="DRUG")
        if p.get("person_rate", 0) >= 0.6 and p["n_unique"] > 1:
            return say("drop", "low" if p["medicine_rate"] else "medium", "values read as names of persons")
        text = p["blank_rate"] > 0.3 and p["mean_length"] >= 12 and p["n_unique"] >= 0.3 * max(p["n"] - p["n_null"], 1)
        if squeezed.endswith(("TERM", "TRT", "COMMENT", "NARR", "VERBATIM")) or text:
            return say("screen_freetext", "medium", "free text")
        if p["n_null"] == p["n"]:
            return say("drop", "high", "empty")
        if p["all_years"]:
            return say("drop", "low", "numbers that read as years")
        if p["numeric_rate"] >= 0.95:
            wide = p["all_whole"] and (p["max_digits"] or 0) >= 7
            return say("drop", "low", "long number") if wide or p["leading_zero"] else say("retain", "medium", "measurement")
        if (p["n_unique"] <= 30 or p["n_unique"] <= 0.05 * p["n"]) and p["mean_length"] <= 40:
            return say("retain", "medium", "few values")
        if p["n_unique"] >= 0.9 * (p["n"] - p["n_null"]):
            return say("drop", "low", "nearly unique")
        return say("retain", "low", "not recognised")

    rank = {"low": 0, "medium": 1, "high": 2}
    return sorted((one(c, p) for c, p in columns.items()), key=lambda s: (rank[s.confidence], s.column))
