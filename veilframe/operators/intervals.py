"""Overlapping and gapped integer intervals (problem 6).

Closed intervals of days are cut into canonical dyadic blocks (level, index):
at most two per level, so about 2 log2(length) rows each.  Blocks are made
distinct per (entity, block) with map-side combine, which spreads a hot entity
over its blocks; only then do the blocks of an entity meet, and their number is
bounded by the calendar, however many rows the entity has.  Each partition then streams its
entities in order and, vectorised over whole batches, drops blocks covered by
an ancestor, merges sibling pairs upward, coalesces adjacent blocks into
periods and lists the gaps between them.

Rows with a null or blank entity, a missing or impossible day, or an end before
the start take no part.  Repeated rows and ties change nothing.  Empty input
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions.patterns import ISO_DAY_PREFIX

#: 0001-01-01 is day 0; 9999-12-31 is below 2**22.
EPOCH_SHIFT = 719162
LEVELS = 22


def iso_day(column: str) -> Column:
    """Day number of the whole existing date a value starts with, else null."""
    text = F.regexp_extract(F.col(column), ISO_DAY_PREFIX, 1)
    date = F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit("yyyy-MM-dd")).cast("date")
    return F.datediff(date, F.lit("1970-01-01").cast("date")) + EPOCH_SHIFT


def dyadic_blocks(start: str, end: str) -> Column:
    """array<struct<level,idx>> of the canonical cover of [start, end]."""
    return F.expr(
        f"""filter(flatten(transform(sequence(0, {LEVELS}), k -> array(
              if(shiftright({start} + shiftleft(1, k) - 1, k) < shiftright({end} + 1, k)
                 AND shiftright({start} + shiftleft(1, k) - 1, k) % 2 = 1,
                 named_struct('level', k, 'idx', shiftright({start} + shiftleft(1, k) - 1, k)), null),
              if(shiftright({start} + shiftleft(1, k) - 1, k) < shiftright({end} + 1, k)
                 AND shiftright({end} + 1, k) % 2 = 1,
                 named_struct('level', k, 'idx', shiftright({end} + 1, k) - 1), null)))),
            b -> b IS NOT NULL)"""
    )


def merge_blocks(ent: np.ndarray, level: np.ndarray, idx: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimal disjoint blocks of each entity number: ancestors win, siblings merge."""
    level, idx = level.astype(np.int64), idx.astype(np.int64)
    start = idx << level
    order = np.lexsort((-level, start, ent))
    ent, level, idx, start = ent[order], level[order], idx[order], start[order]
    # Blocks are laminar, so in this order a block is covered exactly when an
    # earlier block of its entity reaches beyond its end.
    end = start + (np.int64(1) << level)
    base = ent.astype(np.int64) << (LEVELS + 2)
    reach = np.maximum.accumulate(np.concatenate([[np.int64(-1)], (base + end)[:-1]]))
    keep = reach < base + end
    ent, level, idx = ent[keep], level[keep], idx[keep]
    for k in range(LEVELS):
        at = np.flatnonzero(level == k)
        if not len(at):
            continue
        parent = (ent[at].astype(np.int64) << (LEVELS + 2)) + (idx[at] >> 1)
        order = np.argsort(parent, kind="stable")
        at, parent = at[order], parent[order]
        pair = np.flatnonzero(parent[1:] == parent[:-1])
        if len(pair):
            level[at[pair]] = k + 1
            idx[at[pair]] >>= 1
            gone = np.ones(len(level), bool)
            gone[at[pair + 1]] = False
            ent, level, idx = ent[gone], level[gone], idx[gone]
    order = np.lexsort((idx << level, ent))
    return ent[order], level[order], idx[order]


def periods_and_gaps(ent: np.ndarray, level: np.ndarray, idx: np.ndarray) -> pd.DataFrame:
    """Coalesce adjacent blocks; rows (ent, kind, lo, hi) with inclusive days."""
    ent, level, idx = merge_blocks(ent, level, idx)
    lo, hi = idx << level, ((idx + 1) << level) - 1
    new = np.ones(len(ent), bool)
    new[1:] = (ent[1:] != ent[:-1]) | (lo[1:] != hi[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(ent)) - 1
    e, s, t = ent[first], lo[first], hi[last]
    gap = np.flatnonzero(e[1:] == e[:-1])
    return pd.DataFrame(
        {
            "ent": np.concatenate([e, e[gap]]),
            "kind": np.array(["period"] * len(e) + ["gap"] * len(gap), dtype=object),
            "lo": np.concatenate([s, t[gap] + 1]),
            "hi": np.concatenate([t, s[gap + 1] - 1]),
        }
    )


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []

    def close(frame: pd.DataFrame) -> pd.DataFrame:
        codes, names = pd.factorize(frame["entity"], sort=False)
        out = periods_and_gaps(codes, frame["level"].to_numpy(), frame["idx"].to_numpy())
        out.insert(0, "entity", names.to_numpy()[out.pop("ent")] if len(out) else [])
        return out

    for batch in batches:
        if not len(batch):
            continue
        open_entity = batch["entity"].iloc[-1]
        done = (batch["entity"] != open_entity).to_numpy()
        if held and not done.any() and held[-1]["entity"].iloc[-1] == open_entity:
            held.append(batch)
            continue
        frame = pd.concat([*held, batch[done]])
        if len(frame):
            yield close(frame)
        held = [batch[~done]]
    if held:
        yield close(pd.concat(held))


def merge_intervals(df: DataFrame, entity: str, start: str, end: str) -> DataFrame:
    """(entity, kind, lo, hi): periods and gaps of integer intervals per entity.

    Ends must lie in 0 .. 2**LEVELS - 2; any other stops the run with a message.
    """
    lo, hi = F.col(start).cast("long"), F.col(end).cast("long")
    inside = (lo >= 0) & (hi < (1 << LEVELS) - 1)
    checked = F.when(inside, lo).otherwise(F.raise_error(F.lit(f"an interval lies outside 0 .. 2**{LEVELS} - 2")))
    blocks = (
        df.where(F.col(entity).isNotNull() & (lo <= hi))
        .select(F.col(entity).cast("string").alias("entity"), checked.alias("_from"), hi.alias("_to"))
        .select("entity", F.explode(dyadic_blocks("_from", "_to")).alias("_b"))
        .select("entity", "_b.level", "_b.idx")
        .groupBy("entity", "level", "idx")
        .agg(F.lit(1).alias("_one"))
        .drop("_one")
    )
    ordered = blocks.repartition("entity").sortWithinPartitions("entity")
    return ordered.mapInPandas(_stream, "entity string, kind string, lo long, hi long")


def day_periods(df: DataFrame, entity: str, start: str, end: str) -> DataFrame:
    """Periods and gaps from text days: (entity, kind, start_day, end_day)."""
    key = F.upper(F.trim(F.col(entity)))
    days = df.select(key.alias("_entity"), iso_day(start).alias("_lo"), iso_day(end).alias("_hi")).where(
        (F.col("_entity") != "") & F.col("_lo").isNotNull() & F.col("_hi").isNotNull()
    )

    def text(c: str) -> Column:
        return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), (F.col(c) - EPOCH_SHIFT).cast("int")), "yyyy-MM-dd")

    return merge_intervals(days, "_entity", "_lo", "_hi").select(
        "entity", "kind", text("lo").alias("start_day"), text("hi").alias("end_day")
    )
