"""References to records that do not exist (problem 2).

A *reference* is a row of some table that names a key of a parent table at a
point in time; it is an orphan when no parent row is alive at that time.  One
pooled subject may own a third of all references, so rows never meet on a key:

1. references are pre-aggregated per (table, key, period) with map-side combine
   into *cells* (rows, first and last time);
2. a key with more than its fair share of rows (``1 / (SHARES * tasks)`` of all,
   so there are at most ``SHARES * tasks`` of them, however large the data) is
   *heavy*.  Cells of heavy keys are checked against their parent spans by
   broadcast when the measured number of spans allows it, else by spans dealt
   over ``SALT`` parts; all other cells go through one shuffle join;
3. a cell is alive (one span covers it), dead (none meets it) or mixed.  Both
   sides are united; the report adds up their counts;
4. only rows of dead and mixed cells are read again, and only those of mixed
   cells are compared one by one.

Nulls: a null key is no reference and never comes out.  A null reference time
can match no parent, so it is an orphan, of period null.  A blank key is a key
like any other.  An empty parent makes every reference an orphan; empty
references give an empty result.  Repeated rows come out once per row id.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.session import cut

#: A key is heavy from this part of a task's fair share on.
SHARES = 4
#: Spans or cells that may be broadcast once counted (about 60 bytes each).
BROADCAST_ROWS = 100_000
#: Parts into which the spans of heavy keys are dealt when they are not broadcast.
SALT = 64
CELL = ["table_name", "_key", "period"]


def key_of(column: str) -> Column:
    """Identifier compared without letter case and outer blanks."""
    return F.upper(F.trim(F.col(column)))


def references(tables: dict[str, DataFrame], key: str, time: str, row_id: str) -> DataFrame:
    """(table_name, rec_id, _key, _at) for all rows with a non-null key."""
    parts = [
        df.where(F.col(key).isNotNull()).select(
            F.lit(name).alias("table_name"),
            F.col(row_id).cast("long").alias("rec_id"),
            key_of(key).alias("_key"),
            F.col(time).alias("_at"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def parent_spans(parent: DataFrame, key: str, born: str, died: str) -> DataFrame:
    """(key, born, died) of parents; of those that end alike only the earliest counts."""
    return (
        parent.where(F.col(key).isNotNull() & F.col(born).isNotNull())
        .select(key_of(key).alias("_key"), F.col(born).alias("born"), F.col(died).alias("died"))
        .groupBy("_key", "died")
        .agg(F.min("born").alias("born"))
    )


def with_period(refs: DataFrame) -> DataFrame:
    """Month of the reference time, blank where there is none."""
    return refs.withColumn("period", F.coalesce(F.date_format("_at", "yyyy-MM"), F.lit("")))


def reference_cells(refs: DataFrame) -> DataFrame:
    """(table_name, _key, period, n, lo, hi): references counted per key and month."""
    return with_period(refs).groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("lo"), F.max("_at").alias("hi"))


def heavy_keys(cells: DataFrame, heavy_rows: int | None = None) -> DataFrame:
    """Keys with more than their fair share of all references."""
    if heavy_rows is None:
        tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        heavy_rows = (cells.agg(F.sum("n")).first()[0] or 0) // (SHARES * tasks)  # one row
    return cells.groupBy("_key").agg(F.sum("n").alias("_n")).where(F.col("_n") > heavy_rows).select("_key")


def judged(cells: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """Cells that are not alive, with ``mixed`` where some span meets them."""
    died, open_end = F.col("died"), F.col("died").isNull() & F.col("born").isNotNull()
    covers = (F.col("born") <= F.col("lo")) & (open_end | (died > F.col("hi")))
    meets = (F.col("born") <= F.col("hi")) & (open_end | (died > F.col("lo")))
    never = F.lit(False)
    return (
        cells.join(spans, keys, "left")
        .groupBy(*CELL, "n")
        .agg(F.bool_or(F.coalesce(covers, never)).alias("alive"), F.bool_or(F.coalesce(meets, never)).alias("mixed"))
        .where(~F.col("alive"))
        .drop("alive")
    )


def _unmatched(refs: DataFrame, spans: DataFrame) -> DataFrame:
    """References without a living parent span."""
    at, born, died = F.col("r._at"), F.col("s.born"), F.col("s.died")
    alive = (born <= at) & (died.isNull() | (died > at))
    return refs.alias("r").join(spans.alias("s"), (F.col("r._key") == F.col("s._key")) & alive, "left_anti")


class Orphans:
    """Orphan cells and, from them, orphan rows and counts."""

    def __init__(self, refs: DataFrame, spans: DataFrame, heavy_rows: int | None = None, broadcast_rows: int = BROADCAST_ROWS):
        self.refs, self.spans, self.most = refs, spans, broadcast_rows
        self.cells = cut(reference_cells(refs))
        # At most SHARES keys for each task.
        heavy = F.broadcast(cut(heavy_keys(self.cells, heavy_rows)))
        light = judged(self.cells.join(heavy, "_key", "left_anti"), spans, ["_key"])
        hot_cells, hot_spans = self.cells.join(heavy, "_key", "left_semi"), spans.join(heavy, "_key", "left_semi")
        if self._small(hot_spans):
            hot = judged(hot_cells, F.broadcast(hot_spans), ["_key"])
        else:
            dealt = hot_spans.withColumn("_salt", F.pmod(F.xxhash64("born", "died"), F.lit(SALT)).cast("int"))
            copies = hot_cells.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
            hot = judged(copies, dealt, ["_key", "_salt"])
        self.bad = cut(light.withColumn("hot", F.lit(False)).unionByName(hot.withColumn("hot", F.lit(True))))

    def _small(self, df: DataFrame) -> bool:
        return df.limit(self.most + 1).count() <= self.most

    def rows(self) -> DataFrame:
        """(table_name, rec_id, _at, period) of every orphan reference."""
        out = ["table_name", "rec_id", "_at", "period"]
        refs, bad = with_period(self.refs), self.bad.drop("n")
        if self._small(bad):
            met = refs.join(F.broadcast(bad), CELL)
        else:
            # Rows of heavy keys stay where they are; their cells are few.
            hot = bad.where("hot")
            hot = F.broadcast(hot) if self._small(hot) else hot
            met = refs.join(bad.where("NOT hot"), CELL).unionByName(refs.join(hot, CELL))
        return met.where("NOT mixed").select(*out).unionByName(self._mixed(met.where("mixed")).select(*out))

    def _mixed(self, rows: DataFrame) -> DataFrame:
        """Rows of cells that are partly alive, one by one."""
        spans = self.spans.join(self.bad.where("mixed").select("_key").distinct(), "_key", "left_semi")
        if self._small(spans):
            return _unmatched(rows, F.broadcast(spans))
        # Many spans: rows are spread over parts by their own id, spans copied to each.
        salted = rows.withColumn("_key", F.concat_ws("|", F.pmod(F.xxhash64("rec_id"), F.lit(SALT)), "_key"))
        copies = spans.withColumn("_key", F.explode(F.transform(F.sequence(F.lit(0), F.lit(SALT - 1)), lambda k: F.concat_ws("|", k, "_key"))))
        return _unmatched(salted, copies)

    def report(self) -> DataFrame:
        """(table_name, period, n_refs, n_orphans): counts of both sides united."""
        met = with_period(self.refs).join(self.bad.where("mixed").select(*CELL, "mixed"), CELL)
        parts = [
            self.cells.select("table_name", "period", "n", F.lit(0).cast("long").alias("lost")),
            self.bad.where("NOT mixed").select("table_name", "period", F.lit(0).cast("long").alias("n"), F.col("n").alias("lost")),
            self._mixed(met).select("table_name", "period", F.lit(0).cast("long").alias("n"), F.lit(1).cast("long").alias("lost")),
        ]
        return counted(reduce(DataFrame.unionByName, parts))


def counted(parts: DataFrame) -> DataFrame:
    return parts.groupBy("table_name", F.nullif("period", F.lit("")).alias("period")).agg(F.sum("n").alias("n_refs"), F.sum("lost").alias("n_orphans"))


def orphans(refs: DataFrame, spans: DataFrame, heavy_rows: int | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Orphan references: (table_name, rec_id, _at)."""
    return Orphans(refs, spans, heavy_rows, broadcast_rows).rows().drop("period")


def missing_columns(specs: DataFrame, declared: DataFrame) -> DataFrame:
    """Specs whose subject_column is not declared by their file (null: none)."""
    return (
        specs.select(
            F.lit("anchor_spec").alias("table_name"),
            F.col("spec_id").cast("long").alias("rec_id"),
            F.col("signed_at").alias("_at"),
            "file_id",
            key_of("subject_column").alias("_key"),
        )
        .join(
            declared.select("file_id", key_of("rule_column").alias("_key")).distinct(),
            ["file_id", "_key"],
            "left_anti",
        )
        .select("table_name", "rec_id", "_at")
    )


def specs_report(specs: DataFrame, found: DataFrame) -> DataFrame:
    """Specs and those without their column, per month of signing."""
    month = F.coalesce(F.date_format("_at", "yyyy-MM"), F.lit("")).alias("period")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    every = specs.select(F.lit("anchor_spec").alias("table_name"), F.col("signed_at").alias("_at"))
    parts = every.select("table_name", month, one.alias("n"), zero.alias("lost"))
    return counted(parts.unionByName(found.select("table_name", month, zero.alias("n"), one.alias("lost"))))
