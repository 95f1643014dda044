"""Blinding audit: terms that give a treatment away, and where they appear."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.functions.text import word_pattern

# Words of treatment names that say nothing about the arm.
GENERIC = frozenset(
    """placebo control vehicle sham comparator standard care arm group cohort dose doses dosing tablet tablets capsule capsules
    injection infusion solution suspension syrup patch vial oral orally intravenous iv subcutaneous sc im topical inhaled nasal daily
    weekly monthly once twice thrice morning evening night bid tid qid qd prn high low mid medium and the with plus open label
    blinded double single active titration mg mcg ug kg ml unit units iu study studies drug drugs medication medicinal product
    treatment treatments trial investigational imp regimen therapy administration administered not available site unknown other none
    randomised randomized assignment assigned sequence period""".split()
)


def revealing_terms(values: Iterable[str], keep: Iterable[str] = ()) -> list[str]:
    """Full names and distinctive words of treatment values, longest first."""
    spared = {k.strip().upper() for k in keep}
    terms: set[str] = set()
    for value in values:
        text = (value or "").strip().lower()
        words = re.findall(r"[a-z][a-z0-9-]{2,}", text)
        if not text or text.upper() in spared or text in GENERIC or words and all(w in GENERIC for w in words):
            continue
        terms.add(text)
        for word in words:
            mixed = len(word) >= 3 and re.search(r"\d", word)
            if word not in GENERIC and (len(word) >= 5 or mixed):
                terms.add(word)
    return sorted(terms, key=lambda t: (-len(t), t))


def audit(df: DataFrame, terms: list[str], domain: str, row_id: str, skip: Iterable[str] = ()) -> DataFrame:
    """(domain, column_name, term, n_rows, example_row) of every leak.

    One scan: text columns are stacked, filtered by one alternation of all
    terms, and only matching cells are tested term by term.
    """
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in set(skip)]
    empty = "domain string, column_name string, term string, n_rows bigint, example_row bigint"
    if not text or not terms:
        return df.sparkSession.createDataFrame([], empty)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("cell")) for c in text]))
    hit = df.select(F.col(row_id).alias("_row"), cells.alias("_c")).select("_row", "_c.*").where(F.col("cell").rlike(word_pattern(terms)))
    tests = F.array(*[F.when(F.col("cell").rlike(word_pattern([t])), F.lit(t)) for t in terms])
    found = hit.select("_row", "column_name", F.explode(F.array_compact(tests)).alias("term"))
    return found.groupBy(F.lit(domain).alias("domain"), "column_name", "term").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("_row").cast("bigint").alias("example_row")
    )
