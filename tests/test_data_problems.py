"""Operators of the general data problems against brute force and edge cases."""

import json
import random
from collections import Counter
from datetime import date, datetime, timedelta
from fractions import Fraction

import numpy as np
import pytest

from veilframe.operators import drift, intervals, orphans, quality, timestamps

T0 = datetime(2024, 1, 1)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- orphans -----------------------------------------------------------------


def _parents(spark, data):
    return spark.createDataFrame(data, "usubjid string, loaded_at timestamp_ntz, deleted_at timestamp_ntz, _key string, rec_id int")


def _refs(spark, data):
    df = spark.createDataFrame(data, "rec_id long, usubjid string, loaded_at timestamp_ntz, died string, table_name int")
    return orphans.references({"ae": df}, "usubjid", "loaded_at", "rec_id")


@pytest.mark.parametrize(("heavy", "broadcast"), [(10**6, 10**6), (3, 10**6), (3, 1), (10**6, 0), (0, 0), (None, 10**6)])
def test_orphans_match_brute_force_on_every_path(spark, heavy, broadcast):
    r = random.Random(5)
    keys = ["A", " a", "B", "b ", "C", "HOT", "hot"]
    parents = [(r.choice(keys[:6]), T0 + timedelta(days=r.randrange(20)), r.choice([None, T0 + timedelta(days=r.randrange(40))]), "x", 1) for _ in range(25)]
    refs = [(i, r.choice([*keys, "HOT", "HOT", "D", None]), T0 + timedelta(days=r.randrange(40)), None, 7) for i in range(120)]

    def alive(key, at):
        return any(p[0].strip().upper() == key and p[1] <= at and (p[2] is None or p[2] > at) for p in parents)

    want = sorted(i for i, k, at, *_ in refs if k is not None and not alive(k.strip().upper(), at))
    spans = orphans.parent_spans(_parents(spark, parents), "usubjid", "loaded_at", "deleted_at")
    found = orphans.Orphans(_refs(spark, refs), spans, heavy, broadcast)
    assert sorted(r.rec_id for r in found.rows().collect()) == want
    month = {i: f"{at:%Y-%m}" for i, _, at, *_ in refs}
    every = Counter(month[i] for i, k, *_ in refs if k is not None)
    lost = Counter(month[i] for i in want)
    assert {(r.period, r.n_refs, r.n_orphans) for r in found.report().collect()} == {(m, n, lost[m]) for m, n in every.items()}


def test_orphans_empty_tables_and_nulls(spark):
    spans = orphans.parent_spans(_parents(spark, []), "usubjid", "loaded_at", "deleted_at")
    refs = _refs(spark, [(1, "A", T0, None, 0), (2, None, T0, None, 0), (3, "A", None, None, 0)])
    assert sorted(r.rec_id for r in orphans.orphans(refs, spans).collect()) == [1, 3]
    assert {(r.period, r.n_refs, r.n_orphans) for r in orphans.Orphans(refs, spans).report().collect()} == {("2024-01", 1, 1), (None, 1, 1)}
    assert orphans.orphans(_refs(spark, []), spans).count() == 0


def test_missing_columns(spark):
    specs = spark.createDataFrame([(1, 10, " subject", T0), (2, 10, "PT", T0), (3, 11, "SUBJECT", T0), (4, 10, None, T0)], "spec_id long, file_id long, subject_column string, signed_at timestamp_ntz")
    declared = spark.createDataFrame([(10, "SUBJECT"), (11, None)], "file_id long, rule_column string")
    assert sorted(r.rec_id for r in orphans.missing_columns(specs, declared).collect()) == [2, 3, 4]


# --- quality -------------------------------------------------------------------


def test_profile_and_breaks(spark):
    data = [(1, 1, "5", "a")] * 6 + [(1, 1, "7.5", None)] * 4 + [(1, 2, "5", "a")] * 5 + [(1, 2, "<5", None)] * 5 + [(1, 3, None, None)] * 3
    df = spark.createDataFrame(data, "feed_id int, load_no int, x string, value string")
    prof = {(r.load_no, r.column_name): r for r in quality.profile(df, ["feed_id", "load_no"], ["x", "value"]).collect()}
    assert prof[1, "x"].n_rows == 10 and prof[1, "x"].n_unique == 2 and prof[1, "x"].numeric_rate == 1
    assert abs(prof[1, "x"].mean - 6.0) < 1e-9 and prof[1, "x"].sum2 == int((6 * 25 + 4 * 56.25) * 10**12)
    assert prof[3, "x"].numeric_rate is None and prof[3, "x"].null_rate == 1
    shifts = quality.shifts(quality.profile(df, ["feed_id", "load_no"], ["x", "value"]), "feed_id", "load_no")
    got = rows(quality.breaks(shifts, "feed_id", "load_no"))
    assert got == [
        (1, 2, "x", "numeric_rate"),
        (1, 3, "value", "n_unique"),
        (1, 3, "value", "null_rate"),
        (1, 3, "x", "n_unique"),
        (1, 3, "x", "null_rate"),
    ]


def test_profile_is_mergeable_and_survives_odd_values(spark):
    df = spark.createDataFrame([(1, 1, "1" * 30), (1, 1, ""), (1, 1, "x" * 100_000), (1, 1, "999999999999"), (1, 1, None)], "feed_id int, load_no int, x string")
    p = quality.profile(df, ["feed_id", "load_no"], ["x"])
    assert p.first().n_unique == 4 and (p.first().n_numeric, p.first().n_outside) == (1, 1)
    both = quality.merge_profiles(p.unionByName(p), ["feed_id"]).first()
    assert both.n_numeric == 2 and both.n_rows == 2 * p.first().n_rows and abs(both.mean - 999999999999) < 1
    assert quality.profile(df.limit(0), ["feed_id", "load_no"], ["x"]).count() == 0


def test_power_sums_round_nothing(spark):
    values = ["0.0004", "0.000001", "12.5", "-3", "1e2", "0.1234567", "0.50000000"]
    df = spark.createDataFrame([(1, 1, v) for v in values], "feed_id int, load_no int, x string")
    p = quality.profile(df, ["feed_id", "load_no"], ["x"]).first()
    kept = [Fraction(v) for v in values if v not in ("1e2", "0.1234567")]
    assert (p.n_numeric, p.n_outside) == (5, 2)
    assert p.sum1 == sum(kept) * 10**6 and p.sum2 == sum(x * x for x in kept) * 10**12
    assert p.max_number == 100.0 and p.variance > 0


@pytest.mark.parametrize(
    ("value", "day"),
    [("2025-01-15", True), ("03MAR2025", True), ("29/11/2024", True), ("12/29/2024", True), ("week 1", False), ("1745066760", False), ("2024-13-45", False), ("7.5", False)],
)
def test_written_day(spark, value, day):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(quality.is_written_day(df.v)).first()[0] is day


# --- intervals --------------------------------------------------------------------


def _brute(spans):
    days = sorted({d for a, b in spans for d in range(a, b + 1)})
    periods, start = [], None
    for i, d in enumerate(days):
        if start is None:
            start = d
        if i + 1 == len(days) or days[i + 1] != d + 1:
            periods.append((start, d))
            start = None
    gaps = [(a[1] + 1, b[0] - 1) for a, b in zip(periods, periods[1:])]
    return periods, gaps


def test_intervals_match_brute_force(spark):
    r = random.Random(3)
    data, want = [], []
    for e in range(40):
        spans = [(a := r.randrange(0, 300), a + r.randrange(0, 25)) for _ in range(r.randrange(1, 12))]
        spans += spans[:2]
        data += [(f"E{e:02d}", a, b, "x", 1) for a, b in spans]
        periods, gaps = _brute(spans)
        want += [(f"E{e:02d}", "period", a, b) for a, b in periods] + [(f"E{e:02d}", "gap", a, b) for a, b in gaps]
    df = spark.createDataFrame(data, "k string, lo long, hi long, level string, idx int")
    assert rows(intervals.merge_intervals(df, "k", "lo", "hi")) == sorted(want)


@pytest.mark.parametrize("span", [(-1, 3), (5, 2**22 - 1), (0, 2**40)])
def test_intervals_outside_the_range_stop_the_run(spark, span):
    df = spark.createDataFrame([("a", *span)], "k string, lo long, hi long")
    with pytest.raises(Exception, match="outside"):
        intervals.merge_intervals(df, "k", "lo", "hi").collect()


def test_dyadic_blocks_are_minimal_and_cover():
    r = random.Random(8)
    for _ in range(200):
        spans = [(a := r.randrange(0, 500), a + r.randrange(0, 60)) for _ in range(r.randrange(1, 6))]
        level, idx = [], []
        for a, b in spans:
            k, lo, hi = 0, a, b + 1
            while lo < hi:
                if lo & 1:
                    level.append(k)
                    idx.append(lo)
                    lo += 1
                if hi & 1:
                    hi -= 1
                    level.append(k)
                    idx.append(hi)
                lo, hi, k = lo >> 1, hi >> 1, k + 1
        ent, lv, ix = intervals.merge_blocks(np.zeros(len(level), int), np.array(level), np.array(idx))
        covered = [d for k, i in zip(lv, ix) for d in range(i << k, (i + 1) << k)]
        assert len(covered) == len(set(covered)) and set(covered) == {d for a, b in spans for d in range(a, b + 1)}
        pairs = set(zip(lv.tolist(), ix.tolist()))
        assert all((k, i ^ 1) not in pairs for k, i in pairs)


def test_day_periods_edges(spark):
    data = [
        (" s1", "2024-01-01", "2024-01-03T10:00"), ("S1 ", "2024-01-04", "2024-01-04"), ("s1", "2024-02-30", "2024-03-01"),
        ("S1", "2024-01", "2024-05-01"), ("S1", "2024-06-02", "2024-06-01"), (None, "2024-01-01", "2024-01-02"), ("", "2024-01-01", "2024-01-02"),
        ("S1", "2024-01-10", "2024-01-10"), ("S1", None, "2024-01-10"), ("S1", "0001-01-01", "0001-01-01"), ("S1", "9999-12-31", "9999-12-31"),
    ]
    df = spark.createDataFrame(data, "usubjid string, a string, b string")
    got = rows(intervals.day_periods(df, "usubjid", "a", "b"))
    assert [g for g in got if g[1] == "period"] == [
        ("S1", "period", "0001-01-01", "0001-01-01"), ("S1", "period", "2024-01-01", "2024-01-04"),
        ("S1", "period", "2024-01-10", "2024-01-10"), ("S1", "period", "9999-12-31", "9999-12-31"),
    ]
    assert ("S1", "gap", "2024-01-05", "2024-01-09") in got
    assert intervals.day_periods(df.limit(0), "usubjid", "a", "b").count() == 0


# --- drift --------------------------------------------------------------------------


def _files(spark):
    rules = []
    for file_id, no, domain, names in (
        (1, 1, "AE", ["SUBJECT", "TERM", "ZIP", "OLD"]),
        (2, 3, "AE", ["TERM", "SUBJECT", "POSTCODE", "NEW"]),
        (3, 4, "ADVERSE", ["TERM", "SUBJECT", "POSTCODE", "NEW"]),
    ):
        rules += [(file_id, 9, no, domain, i, n, "x") for i, n in enumerate(names)]
    data = []
    for k in range(10):
        data.append((1, k, k, json.dumps({"SUBJECT": f"S{k}", "TERM": "t", "ZIP": f"{100 + k}", "OLD": "z" if k else None})))
        data.append((2, k, k, json.dumps({"SUBJECT": f"S{k}", "TERM": "t", "POSTCODE": 100 + k, "NEW": k})))
        data.append((3, k, k, json.dumps({"SUBJECT": f"S{k}", "TERM": True, "POSTCODE": f"{100 + k}", "NEW": k})))
    data += [(1, 99, 0, data[0][3]), (2, 98, 77, None), (2, 97, 78, "not json"), (2, 96, 79, "[1]")]
    rule = "file_id long, stream_id long, file_no int, domain_name string, rule_no int, rule_column string, name string"
    return spark.createDataFrame(rules, rule), spark.createDataFrame(data, "file_id long, row_no int, record_key long, payload string")


def test_drift_scripts_and_one_table(spark):
    rules, data = _files(spark)
    script = drift.edit_scripts(rules, data)
    got = rows(script.select("file_no", "change_type", "field_name", "old_name"))
    assert got == [
        (3, "added", "NEW", None), (3, "removed", "OLD", "OLD"), (3, "renamed", "POSTCODE", "ZIP"),
        (4, "domain_renamed", "ADVERSE", "AE"), (4, "retyped", "POSTCODE", "POSTCODE"), (4, "retyped", "TERM", "TERM"),
    ]
    whole = drift.unified(rules, data, script)
    first = whole.where("file_id = 1 AND record_key = 3").first().fields
    assert first["POSTCODE"] == "103" and "ZIP" not in first and first["OLD"] == "z"
    assert drift.edit_scripts(rules.limit(0), data).count() == 0
    assert rows(drift.edit_scripts(rules, data.limit(0)).where("change_type = 'renamed'")) == []


def test_columns_that_would_share_a_name_stay_apart(spark):
    rules = [(1, 5, 1, "AE", n) for n in ("x", "y")] + [(2, 5, 2, "AE", "x")] + [(3, 5, 3, "AE", "y")] + [(4, 5, 4, "AE", "z")]
    data = []
    for k in range(8):
        data += [(1, k, f'{{"x": "v{k}", "y": "old", "extra": 1}}'), (2, k, f'{{"x": "v{k}"}}'), (3, k, f'{{"y": "v{k}", "y": "v{k}"}}'), (4, k, f'{{"z": "v{k}", "y": "?"}}')]
    data += [(1, 50, '{"x": " "}'), (1, None, '{"x": "a"}'), (1, None, '{"x": "a"}'), (1, 51, "no json"), (9, 1, '{"q": 1}')]
    rules = spark.createDataFrame(rules, "file_id long, stream_id long, file_no int, domain_name string, rule_column string")
    data = spark.createDataFrame(data, "file_id long, record_key long, payload string")
    script = drift.edit_scripts(rules, data)
    renamed = rows(script.where("change_type = 'renamed'").select("file_no", "field_name", "old_name"))
    assert renamed == [(3, "y", "x"), (4, "z", "y")]
    whole = {(r.file_id, r.record_key): r for r in drift.unified(rules, data, script).collect() if r.record_key is not None}
    assert whole[1, 3].fields == {"z": "v3", "y": "old", "extra": "1"}
    assert whole[2, 3].fields == {"z": "v3"} and whole[3, 3].fields == {"z": "v3"}
    assert whole[4, 3].fields == {"z": "v3", "y": "?"}
    assert whole[1, 50].fields == {} and whole[1, 51].fields == {} and whole[9, 1].stream_id is None
    assert drift.unified(rules, data, script).count() == len(whole) + 2
    rival = spark.createDataFrame([(1, 6, 1, "A", "a"), (1, 6, 1, "A", "b"), (2, 6, 2, "A", "b")], rules.schema)
    told = spark.createDataFrame([(f, k, p) for k in range(5) for f, p in ((1, f'{{"a": "v{k}", "b": "w"}}'), (2, f'{{"b": "w", "a": "?"}}'))], data.schema)
    names = {r.file_id: dict(map(tuple, r.names)) for r in drift.projections(rival, drift.edit_scripts(rival, told)).collect()}
    assert names == {1: {"a": "a", "b": "b"}, 2: {"b": "b"}}
    swapped = spark.createDataFrame([(1, 7, 1, "A", "a"), (1, 7, 1, "A", "b"), (2, 7, 2, "A", "c"), (3, 7, 3, "A", "b")], rules.schema)
    moved = spark.createDataFrame([(f, k, p) for k in range(5) for f, p in ((1, f'{{"a": "v{k}", "b": "w"}}'), (2, f'{{"c": "v{k}"}}'), (3, f'{{"b": "v{k}"}}'))], data.schema)
    names = {r.file_id: dict(map(tuple, r.names)) for r in drift.projections(swapped, drift.edit_scripts(swapped, moved)).collect()}
    assert names == {1: {"a": "b", "b": "b@1"}, 2: {"c": "b"}, 3: {"b": "b"}}


def test_a_nested_node_that_changes_parents_has_moved():
    old = {"a": "OBJECT<x: BIGINT, y: STRING>", "b": "OBJECT<z: STRING>"}
    new = {"a": "OBJECT<x: BIGINT>", "b": "OBJECT<y: STRING, z: STRING>"}
    assert drift.tree_script(old, new, {}) == (1.0, [("moved", "b.y", "a.y")])


def test_assignment_is_optimal():
    r = np.random.default_rng(1)
    from itertools import permutations

    for n in (1, 2, 3, 5):
        cost = r.random((n, n))
        best = min(sum(cost[i, p[i]] for i in range(n)) for p in permutations(range(n)))
        assert abs(sum(cost[i, j] for i, j in drift.assign(cost)) - best) < 1e-9


def test_nested_schemas_are_compared_below():
    old = {"a": "OBJECT<x: BIGINT, y: STRING>", "b": "STRING"}
    new = {"a": "OBJECT<x: STRING, z: STRING>", "b": "STRING"}
    cost, script = drift.edit_script(old, new, {("a.y", "a.z"): 0.9})
    assert sorted(script) == [("renamed", "a.z", "a.y"), ("retyped", "a.x", "a.x")]


# --- timestamps -----------------------------------------------------------------------


def test_only_ruled_out_interpretations_are_dropped_and_one_path_costs_the_same():
    import pandas as pd

    r = random.Random(12)
    both = timestamps.readings("05/06/2024", None)
    assert [x[0] for x in timestamps.possible(both, "dmy")] == ["dmy"] and len(timestamps.possible(both, None)) == 2
    assert timestamps.possible((), "dmy") == [] and len(timestamps.possible(timestamps.readings("13/06/2024", None), "mdy")) == 1
    for _ in range(40):
        options = [r.choice(timestamps.possible(timestamps.readings(f"{r.randrange(1, 29)}/{r.randrange(1, 13)}/2024", None), None)) for _ in range(r.randrange(1, 9))]
        declared = [r.choice(["dmy", "mdy", None]) for _ in options]
        frame = pd.DataFrame({"ord": [o[0] for o in options], "at": [o[1] for o in options], "norm": [o[2] for o in options], "more": None, "date_order": declared})
        costs, _, _ = timestamps.block_costs([((o,), d) for o, d in zip(options, declared)])
        assert costs == [[timestamps.one_path_cost(frame)]]


CASES = [
    ("25-Sep-2023", "dmy", None, "2023-09-25"), ("1 déc. 2024", "dmy", None, "2024-12-01"), ("18. März 2025", "dmy", None, "2025-03-18"),
    ("19JUL23", "dmy", None, "2023-07-19"), ("UNAUG2023", "dmy", None, "2023-08"), ("UN/UN/2012", "mdy", None, "2012"), (" 2024", "mdy", None, "2024"),
    ("03/04/2024", "dmy", None, "2024-04-03"), ("03/04/2024", "mdy", None, "2024-03-04"), ("16/04/2024", "mdy", None, "2024-04-16"),
    ("20241345", "dmy", None, "INVALID"), ("31/02/2024", "dmy", None, "INVALID"), ("12/2O23/1", "dmy", None, "INVALID"), ("see note", "dmy", None, "INVALID"),
    ("1731534638", "dmy", None, "2024-11-13T21:50:38Z"), ("1722471168993", "dmy", None, "2024-08-01T00:12:48Z"),
    ("2023-07-01T00:30", "dmy", "Europe/Berlin", "2023-06-30T22:30:00Z"), ("2024-03-31 02:30:00", "dmy", "Europe/Berlin", "2024-03-31T01:30:00Z"),
    ("2023-10-29 02:19:35", "dmy", "Europe/Berlin", "2023-10-29T00:19:35Z"), ("2023-10-29T02:19:35.9+01:00", "dmy", "Asia/Tokyo", "2023-10-29T01:19:35Z"),
    ("09-Apr-2024 17:08:21 IST", "dmy", "Europe/Madrid", "2024-04-09T11:38:21Z"), ("04/05/2024 12:36AM", "mdy", "America/New_York", "2024-04-05T04:36:00Z"),
    ("07JUL2023:14:54", "dmy", "America/Halifax", "2023-07-07T17:54:00Z"), ("2024-05-01 25:00", "dmy", None, "INVALID"), ("Dec 2024", "dmy", None, "2024-12"),
    ("2023-06-UN", "dmy", None, "2023-06"), ("Mar 16, 1967", "dmy", None, "1967-03-16"), ("x" * 50_000, "dmy", None, "INVALID"),
]


def test_timestamp_forms(spark):
    data = [(i, f"S{i}-1", v) for i, (v, *_) in enumerate(CASES)] + [(900 + i, "S0-1", v) for i, v in enumerate([None, "", "  ", "na", "UNK", "."])]
    sites = spark.createDataFrame([(f"S{i}", z, o) for i, (_, o, z, _) in enumerate(CASES)], "source string, zone_name string, date_order string")
    df = spark.createDataFrame(data, "rec_id long, subject string, v string")
    tracks = timestamps.columns_as_tracks({"t": (df, "subject", ["v"])})
    got = {r.rec_id: r.norm_value for r in timestamps.normalise(tracks, sites).collect()}
    assert got == {i: w for i, (*_, w) in enumerate(CASES)}
    assert timestamps.normalise(tracks.limit(0), sites).count() == 0


def _whole_path(options):
    score = [timestamps.emission(r, None) for r in options[0]]
    for before, now in zip(options, options[1:]):
        score = [min(score[k] + timestamps.transition(before[k], r) for k in range(len(before))) for r in now]
    return min(score)


def test_blocks_give_the_cost_of_the_whole_viterbi_path(spark):
    r = random.Random(2)
    values = [f"{r.randrange(1, 13):02d}/{r.randrange(1, 13):02d}/2024" if r.random() < 0.7 else f"{r.randrange(13, 28)}/{r.randrange(1, 13):02d}/2024" for _ in range(60)]
    df = spark.createDataFrame([(i, "Q-1", v) for i, v in enumerate(values)], "rec_id long, subject string, v string")
    sites = spark.createDataFrame([], "source string, zone_name string, date_order string")
    got = {x.rec_id: x.norm_value for x in timestamps.normalise(timestamps.columns_as_tracks({"t": (df, "subject", ["v"])}), sites, block=7).collect()}
    options = [timestamps.readings(v, None) for v in values]
    chosen = [next(o for o in opts if o[2] == got[i]) for i, opts in enumerate(options)]
    cost = sum(timestamps.transition(a, b) for a, b in zip(chosen, chosen[1:]))
    assert abs(cost - _whole_path(options)) < 1e-9


def test_readings_are_valid_dates():
    assert {x[2] for x in timestamps.readings("05/06/2024", None)} == {"2024-06-05", "2024-05-06"}
    assert date.fromisoformat(timestamps.readings("5. Mai 2005", None)[0][2]) == date(2005, 5, 5)
