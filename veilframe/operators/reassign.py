"""Record reassignment: records change their owner, tables keep their shape."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilframe.functions import rawdates
from veilframe.functions.dates import shift_iso, whole_date
from veilframe.operators.ordering import dense_index, shuffled
from veilframe.operators.treatments import lookup
from veilframe.operators.vault import Vault
from veilframe.session import cut


# Columns that belong to a subject where no subject has the records to show it.
SUBJECT_LEVEL_NAMES = re.compile(
    r"(STUDYID|STUDY|PROJECT|USUBJID|SUBJID|SUBJECT|SUBJECTID|SUBJNUM|PATID|SITEID|SITE|SITENUM|SITENUMBER|SITENO|STUDYSITEID|INVID|COUNTRY)"
)


class ReassignError(RuntimeError):
    """Records that cannot be moved."""


def sequence_columns(df: DataFrame, subject: str, columns: list[str]) -> DataFrame:
    """(column_name, is_sequence): values of every subject are exactly 1..n, some n > 1."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).try_cast("bigint").alias("v")) for c in columns]))
    flat = df.select(F.col(subject).alias("_s"), pairs.alias("_p")).select("_s", "_p.*")
    per = flat.groupBy("column_name", "_s").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count_distinct("v").alias("d"), F.count(F.lit(1)).alias("n")
    )
    good = (F.col("lo") == 1) & (F.col("hi") == F.col("n")) & (F.col("d") == F.col("n"))
    return per.groupBy("column_name").agg(
        (F.bool_and(F.coalesce(good, F.lit(False))) & (F.max("n") > 1)).alias("is_sequence")
    )


def subject_level_columns(df: DataFrame, subject: str, columns: list[str]) -> DataFrame:
    """(column_name, is_constant): one value per subject, where at least two have several rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns]))
    flat = df.select(F.col(subject).alias("_s"), pairs.alias("_p")).select("_s", "_p.*")
    per = flat.groupBy("column_name", "_s").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("filled"), F.count(F.lit(1)).alias("n")
    )
    same = ((F.col("lo") == F.col("hi")) & (F.col("filled") == F.col("n"))) | (F.col("filled") == 0)
    return per.groupBy("column_name").agg(
        (F.bool_and(same) & (F.count_if(F.col("n") > 1) >= 2)).alias("is_constant")
    )


def mirror_columns(df: DataFrame, anchor: DataFrame, subject: str, pairs: list[tuple[str, str]]) -> DataFrame:
    """(column_name, anchor_name, is_mirror): columns equal to the subject's anchor value on every row."""
    joined = df.alias("r").join(lookup(anchor).alias("a"), F.col(f"r.{subject}") == F.col(f"a.{subject}"))
    same = [
        F.bool_and(F.trim(F.col(f"r.{c}").cast("string")).eqNullSafe(F.trim(F.col(f"a.{a}").cast("string")))).alias(f"_{i}")
        for i, (c, a) in enumerate(pairs)
    ]
    row = joined.agg(*same)
    rows = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(a).alias("anchor_name"), F.col(f"_{i}").alias("is_mirror")) for i, (c, a) in enumerate(pairs)])
    )
    return row.select(rows.alias("_m")).select("_m.*")


def self_anchor(df: DataFrame, subject: str, date: str, row_id: str) -> DataFrame:
    """(subject, anchor) from a table that is its own reference: the first row of a subject."""
    return df.where(F.col(subject).isNotNull()).groupBy(F.col(subject).cast("string").alias("subject")).agg(
        F.min_by(F.struct(F.col(date).alias("d")), F.col(row_id))["d"].alias("anchor")
    )


def report(before: DataFrame, after: DataFrame, subject: str, references: DataFrame) -> DataFrame:
    """Counts only: rows, subjects before and after, subjects without a reference date."""
    anchored = references.where(F.col("anchor").isNotNull()).select(F.col("subject").alias(subject))
    lost = before.select(F.col(subject).cast("string").alias(subject)).distinct().join(anchored, subject, "left_anti")
    counts = before.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(subject).alias("n_donors"))
    return counts.withColumns({"n_recipients": F.lit(after.select(subject).distinct().count()), "n_unanchored": F.lit(lost.count())})


def subject_rows(df: DataFrame, key: Column, row_id: str) -> DataFrame:
    """One row per subject of the anchor table (the last one, as for its date), keyed by ``subject``."""
    kept = [c for c in df.columns if c != row_id]
    rows = df.where(key.isNotNull()).groupBy(key.cast("string").alias("subject")).agg(F.max_by(F.struct(*kept), F.col(row_id)).alias("_r"))
    return rows.select("subject", *[F.col("_r")[c].alias(f"a_{c}") for c in kept])


def self_rows(df: DataFrame, key: Column, subject: str | None, row_id: str) -> DataFrame:
    """Subject rows of a table that is its own anchor: only the columns that never vary within a subject.

    Where under two subjects have several records there is no such evidence and the usual names count.
    """
    columns = [c for c in df.columns if c not in (row_id, subject)]
    keyed = df.withColumn("_key", key.cast("string")).where(F.col("_key").isNotNull())
    many = keyed.groupBy("_key").count().where("count > 1").limit(2).count() > 1
    if many and columns:
        constant = {r["column_name"] for r in subject_level_columns(keyed, "_key", columns).where("is_constant").collect()}  # one row per column
    else:
        constant = {c for c in columns if SUBJECT_LEVEL_NAMES.fullmatch(re.sub(r"[ _.-]", "", c.upper()))}
    kept = [c for c in df.columns if c in constant or c == subject]
    return subject_rows(df.select(*kept, row_id, key.alias("_key")), F.col("_key"), row_id).drop("a__key")


def mirrors_of(df: DataFrame, key: Column, rows: DataFrame, skip: list[str], subject: str | None = None, anchor_subject: str | None = None) -> dict[str, str]:
    """Columns that repeat the value of their subject's row on every record, and where they stand there."""
    pairs = [(c, f"a_{c}") for c in df.columns if c not in skip and f"a_{c}" in rows.columns]
    if subject and anchor_subject and subject != anchor_subject and f"a_{anchor_subject}" in rows.columns:
        pairs.append((subject, f"a_{anchor_subject}"))
    if not pairs:
        return {}
    keyed = df.withColumn("_key", key.cast("string"))
    found = mirror_columns(keyed, rows.withColumnRenamed("subject", "_key"), "_key", pairs).where("is_mirror").collect()  # one row per column
    return {r["column_name"]: r["anchor_name"] for r in reversed(found)}


def rewritten(df: DataFrame, owner: str, rows: DataFrame, mirrors: dict[str, str]) -> DataFrame:
    """Mirror columns with the values of the owner's row; every owner needs one."""
    if not mirrors:
        return df
    values = rows.select(F.col("subject").alias("_own"), F.lit(True).alias("_there"), *[F.col(a).alias(f"_new_{c}") for c, a in mirrors.items()])
    joined = df.join(lookup(values), F.col(owner) == F.col("_own"), "left")
    if not joined.where(F.col(owner).isNotNull() & F.col("_there").isNull()).isEmpty():
        raise ReassignError("records of subjects without a row in the anchor table")
    types = {f.name: f.dataType for f in df.schema.fields}
    new = {c: F.when(F.col(owner).isNotNull(), F.col(f"_new_{c}").cast(types[c])).otherwise(F.col(c)) for c in mirrors}
    return joined.withColumns(new).drop("_own", "_there", *[f"_new_{c}" for c in mirrors])


def moved_date(df: DataFrame, column: str, days: Column, order: str | None = None) -> Column:
    """A date moved in its own written form; what cannot be read stays as it is.

    Plain ISO dates move in the JVM; only other forms go through the reader.
    """
    if order is None:
        order = rawdates.infer_order(df, [column]).first()["day_order"]  # one row
    text = F.col(column).cast("string")
    iso = text.rlike(r"^[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?$") & shift_iso(text, days).isNotNull()
    written = rawdates.shift_written(F.when(~iso, text), days, order if order in ("dmy", "mdy") else None)
    other = F.when(written["status"].isin("shifted", "partial_shifted"), written["value"]).otherwise(text)
    new = F.when(iso, shift_iso(text, days)).otherwise(other)
    return F.when(text.isNotNull() & (days != 0), new).otherwise(text)


def by_subject(
    df: DataFrame, subject: str | None, dates: list[str], references: DataFrame, vault: Vault, group: str = "all",
    rows: DataFrame | None = None, key: Column | None = None, mirrors: dict[str, str] | None = None,
    orders: dict[str, str | None] | None = None,
) -> DataFrame:
    """All records of a donor go to one recipient; dates move with the references.

    ``references`` is (subject, anchor).  Study days stay what they were.  Dates
    move in their own written form (``orders`` names the day order of a column,
    else it is inferred); one that cannot be read stays as written.  A donor or
    recipient without a reference date keeps the written dates; the vault pins
    that, and every other move, for later runs.  ``rows`` (see ``subject_rows``) is the
    anchor table: columns that mirror it get the recipient's values.
    ``mirrors`` may be given where they are known.  ``key`` names the subject
    where one column alone does not.
    """
    key = (F.col(subject) if key is None else key).cast("string")
    if rows is not None and mirrors is None:
        mirrors = mirrors_of(df, key, rows, dates, subject)
    universe = references.select(F.col("subject")).unionByName(df.select(key.alias("subject")))
    pairs = vault.derangement(universe, group)
    ref = references.select("subject", whole_date(F.col("anchor")).alias("_at"))
    moves = cut(
        pairs.join(lookup(ref.select(F.col("subject").alias("donor"), F.col("_at").alias("_from"))), "donor", "left")
        .join(lookup(ref.select(F.col("subject").alias("recipient"), F.col("_at").alias("_to"))), "recipient", "left")
        .select("donor", "recipient", F.datediff("_to", "_from").alias("_delta"))
    )
    if dates:
        donors = df.select(key.alias("donor")).where(F.col("donor").isNotNull()).distinct()
        there = moves.select(F.col("donor").alias("subject"), F.col("_delta").cast("string").alias("anchor"))
        vault.settle_unanchored(group, donors, there)
        pinned = vault.is_unanchored(group, donors).withColumn("_pinned", F.lit(True))
        moves = moves.join(pinned, "donor", "left").withColumn("_delta", F.when(F.col("_pinned").isNull(), F.col("_delta"))).drop("_pinned")
        deltas = vault.pinned_deltas(group, moves.select("donor", F.col("_delta").alias("delta")))
        moves = cut(moves.drop("_delta").join(deltas.withColumnRenamed("delta", "_delta"), "donor", "left"))
    moved = df.withColumn("_donor", key).join(lookup(moves), F.col("_donor") == F.col("donor"), "left")
    lost = moved.where(F.col("_donor").isNotNull() & F.col("recipient").isNull())
    if not lost.isEmpty():
        raise ReassignError("records without a recipient")
    delta = F.coalesce("_delta", F.lit(0))
    for column in dates:
        moved = moved.withColumn(column, moved_date(df, column, delta, (orders or {}).get(column)))
    if rows is not None:
        moved = rewritten(moved, "recipient", rows, mirrors)
    if subject and subject not in (mirrors or {}):
        moved = moved.withColumn(subject, F.col("recipient").cast(df.schema[subject].dataType))
    if mirrors and not moved.where(F.col("recipient").isNotNull() & ~key.eqNullSafe(F.col("recipient"))).isEmpty():
        raise ReassignError("moved records still resolve to their old subject")
    return moved.select(*df.columns)


def by_row(df: DataFrame, subject: str, sequence: str | list[str] | None, row_id: str) -> DataFrame:
    """Every record goes to a random subject; sequences are numbered anew."""
    pool = shuffled(df.where(F.col(subject).isNotNull()).select(F.col(subject).alias("_owner")).distinct())
    n = pool.count()
    dealt = cut(df.withColumn("_i", F.floor(F.rand() * n)))
    moved = dealt.join(pool, "_i").withColumn(subject, F.col("_owner")).drop("_i", "_owner")
    order = W.partitionBy(subject).orderBy(row_id)
    for column in [sequence] if isinstance(sequence, str) else sequence or []:
        moved = moved.withColumn(column, F.row_number().over(order).cast(df.schema[column].dataType))
    return shuffled(cut(moved), "_order").drop("_order")


def shuffle_values(df: DataFrame, columns: list[str], row_id: str) -> DataFrame:
    """Each column permuted on its own over the whole table."""
    out = dense_index(df, row_id)
    for column in columns:
        mixed = shuffled(df.select(F.col(column).alias("_v")))
        out = out.drop(column).join(mixed.withColumnRenamed("_v", column), "_i")
    return out.drop("_i").select(*df.columns)
