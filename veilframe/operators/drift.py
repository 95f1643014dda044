"""Schemas that drift between files (problem 7).

Each file is a tree: the domain name at the root, one node per declared column,
nested objects below.  Successive files of a stream are compared by a
constrained tree edit distance (children are matched by minimum-cost
assignment, so reordered columns cost nothing).  Deleting and adding a node
cost 1 each; relabelling a column costs ``2 * (1 - overlap)`` and is allowed
only when most of the records in both files carry the same values under the
two names; a nested node that leaves one parent and appears under another has
moved, which costs 1.  The cheapest script is the report.

The scripts are compiled into one projection per file, a map from its names to
those of the stream's newest file: the maps of neighbouring files are composed
by doubling, so a stream of n files takes log2(n) joins and no task ever holds
a whole stream.  A projection is applied to a record's parsed object in place.
Two columns of a file that would end under one name stay apart: the one that
was dropped earlier is named with the number of its last file (``y@2``).  A cell
no rule declares keeps its name (``y@undeclared`` where that name is taken).

JSON is read by the JVM's variant parser, without a shuffle; only per-file
metadata (bounded by the columns of a file) reaches Python.  Records meet on
(pair of files, record), so a hot stream is spread over its records.

Nulls: blank cells are null or absent and carry no evidence; a column without
any value has no type and is never retyped.  Payloads that are no JSON object
have no cells, but their records stay in the unified table, as do those with
blank cells only and those without a key.  Repeated records count once.  A
stream's first file has no changes; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilframe.session import cut

#: Share of records in both files that must agree for a rename.
RENAME_OVERLAP = 0.5
SCRIPT = "array<struct<change_type:string,field_name:string,old_name:string>>"


def assign(cost: np.ndarray) -> list[tuple[int, int]]:
    """Minimum-cost perfect matching of a square matrix (shortest augmenting paths)."""
    n = len(cost)
    u, v, match, way = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1, int), np.zeros(n + 1, int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, used = np.full(n + 1, np.inf), np.zeros(n + 1, bool)
        while True:
            used[j0] = True
            free = np.flatnonzero(~used[1:]) + 1
            slack = cost[match[j0] - 1, free - 1] - u[match[j0]] - v[free]
            better = slack < least[free]
            least[free[better]], way[free[better]] = slack[better], j0
            j1 = free[np.argmin(least[free])]
            delta = least[j1]
            u[match[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if match[j0] == 0:
                break
        while j0:
            match[j0], j0 = match[way[j0]], way[j0]
    return [(match[j] - 1, j - 1) for j in range(1, n + 1)]


def object_children(kind: str | None) -> dict[str, str]:
    """Fields of an ``OBJECT<a: T, b: OBJECT<...>>`` type text, else nothing."""
    if not kind or not kind.startswith("OBJECT<"):
        return {}
    fields, depth, start, body = {}, 0, 0, kind[7:-1]
    for at, char in enumerate(body + ","):
        depth += (char == "<") - (char == ">")
        if char == "," and depth == 0 or at == len(body):
            name, _, sub = body[start:at].strip().partition(": ")
            if name:
                fields[name.strip("`")] = sub
            start = at + 1
    return fields


def family(kind: str | None) -> str | None:
    """JSON type of a variant type text."""
    if not kind or kind == "VOID":
        return None
    if kind.startswith("OBJECT"):
        return "object"
    if kind.startswith("ARRAY"):
        return "array"
    if kind == "STRING":
        return "text"
    return "boolean" if kind == "BOOLEAN" else "number"


def size(kind: str | None) -> int:
    return 1 + sum(size(k) for k in object_children(kind).values())


def edit_script(
    old: dict[str, str | None], new: dict[str, str | None], overlap: dict[tuple[str, str], float], path: str = ""
) -> tuple[float, list[tuple[str, str, str | None]]]:
    """(cost, [(change_type, new path, old path)]) turning one level into another."""
    gone, fresh = sorted(set(old) - set(new)), sorted(set(new) - set(old))
    cost, script = 0.0, []
    for name in sorted(set(old) & set(new)):
        if family(old[name]) and family(new[name]) and family(old[name]) != family(new[name]):
            cost += 0.5
            script.append(("retyped", path + name, path + name))
        elif family(new[name]) == "object":
            below = edit_script(object_children(old[name]), object_children(new[name]), overlap, f"{path}{name}.")
            cost += below[0]
            script += below[1]
    n = len(gone) + len(fresh)
    matrix = np.zeros((n, n))
    for i in range(n):
        for j in range(n):
            if i < len(gone) and j < len(fresh):
                share = overlap.get((path + gone[i], path + fresh[j]), 0.0)
                matrix[i, j] = 2 * (1 - share) if share > RENAME_OVERLAP else 1e6
            elif i < len(gone):
                matrix[i, j] = size(old[gone[i]])
            elif j < len(fresh):
                matrix[i, j] = size(new[fresh[j]])
    for i, j in assign(matrix) if n else []:
        cost += matrix[i, j]
        if i < len(gone) and j < len(fresh):
            script.append(("renamed", path + fresh[j], path + gone[i]))
        elif i < len(gone):
            script.append(("removed", path + gone[i], path + gone[i]))
        elif j < len(fresh):
            script.append(("added", path + fresh[j], None))
    return cost, script


def tree_script(
    old: dict[str, str | None], new: dict[str, str | None], overlap: dict[tuple[str, str], float]
) -> tuple[float, list[tuple[str, str, str | None]]]:
    """Edit script of whole trees: as by level, and nested nodes that changed parents have moved."""
    cost, script = edit_script(old, new, overlap)
    lost: dict[str, list[str]] = {}
    for kind, path, _ in script:
        if kind == "removed":
            lost.setdefault(path.rpartition(".")[2], []).append(path)
    out, moved = [], set()
    for kind, path, was in sorted(script, key=str):
        above, _, tail = path.rpartition(".")
        from_path = next((x for x in lost.get(tail, ()) if x not in moved and x.rpartition(".")[0] != above), None)
        if kind == "added" and from_path is not None:
            out.append(("moved", path, from_path))
            moved.add(from_path)
            cost -= 1  # one step instead of a removal and an addition
        else:
            out.append((kind, path, was))
    return cost, [x for x in out if not (x[0] == "removed" and x[1] in moved)]


def _scripts(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for olds, news, shares in batches:
        out = []
        for old, new, share in zip(olds, news, shares):
            a, b = ({r["name"]: r["kind"] for r in x} if x is not None else {} for x in (old, new))
            o = {(r["was"], r["now"]): r["share"] for r in share} if share is not None else {}
            script = tree_script(a, b, o)[1]
            out.append([{"change_type": k, "field_name": p, "old_name": w} for k, p, w in sorted(script, key=str)])
        yield pd.Series(out)


CELLS = """filter(transform(map_entries(from_json(payload, 'map<string,variant>')),
    e -> named_struct('name', e.key, 'kind', schema_of_variant(e.value), 'value', cast(e.value AS string))),
  c -> c.kind <> 'VOID' AND (c.kind <> 'STRING' OR trim(c.value) <> ''))"""


def records(rows: DataFrame) -> DataFrame:
    """(file_id, record_key, cells): non-blank cells of each record; null where it is no JSON object.

    Repeated records count once; records without a key cannot be told apart and all stay.
    """
    keyed = rows.where(F.col("record_key").isNotNull()).groupBy("file_id", "record_key").agg(F.max("payload").alias("payload"))
    every = keyed.unionByName(rows.where(F.col("record_key").isNull()).select("file_id", "record_key", "payload"))
    return every.select("file_id", "record_key", F.expr(CELLS).alias("cells"))


def _canonical(value: Column) -> Column:
    """Value text compared across JSON types: 14 = "14" = 14.0, true = "Y"."""
    v = F.trim(value)
    return (
        F.when(F.lower(v).isin("true", "y", "yes"), F.lit("Y"))
        .when(F.lower(v).isin("false", "n", "no"), F.lit("N"))
        .when(v.rlike(r"^-?[0-9]+\.[0-9]*$"), F.regexp_replace(v, r"\.?0*$", ""))
        .otherwise(v)
    )


def column_kinds(record: DataFrame) -> DataFrame:
    """(file_id, name, kind): the most frequent JSON type of a column; all numbers are one type."""
    cell = record.select("file_id", F.explode("cells").alias("_c")).select("file_id", "_c.name", "_c.kind")
    kinds = {"STRING": "STRING%", "BOOLEAN": "BOOLEAN%", "ARRAY": "ARRAY%", "OBJECT": "OBJECT%"}
    counts = [F.count_if(F.col("kind").like(pattern)).alias(name) for name, pattern in kinds.items()]
    seen = cell.groupBy("file_id", "name").agg(*counts, F.count(F.lit(1)).alias("_n"), F.max(F.when(F.col("kind").like("OBJECT%"), F.col("kind"))).alias("_object"))
    number = F.col("_n") - sum((F.col(k) for k in kinds), F.lit(0))
    best = F.greatest(*[F.struct(n.alias("n"), F.lit(k).alias("kind")) for k, n in [("DOUBLE", number), *[(k, F.col(k)) for k in kinds]]])
    return seen.select("file_id", "name", F.when(best["kind"] == "OBJECT", F.col("_object")).otherwise(best["kind"]).alias("kind"))


def files(rules: DataFrame, kinds: DataFrame) -> DataFrame:
    """Each file of a stream with its typed columns and the file before it (next lower file_no)."""
    declared = rules.groupBy("file_id", F.col("rule_column").alias("name")).agg(
        F.min("stream_id").alias("stream_id"), F.min("file_no").alias("file_no"), F.min("domain_name").alias("domain_name")
    )
    column = F.when(F.col("name").isNotNull(), F.struct("name", "kind"))  # collect_list leaves nulls out
    own = declared.join(kinds, ["file_id", "name"], "left").groupBy("file_id").agg(
        F.min("stream_id").alias("stream_id"), F.min("file_no").alias("file_no"), F.min("domain_name").alias("domain_name"),
        F.sort_array(F.collect_list(column)).alias("columns"),
    )
    order = W.partitionBy("stream_id").orderBy("file_no", "file_id")
    return own.select(
        "*",
        F.lag("file_id").over(order).alias("prev_id"),
        F.lag("columns").over(order).alias("prev_columns"),
        F.lag("domain_name").over(order).alias("prev_domain"),
    )


def _names(columns: str) -> Column:
    return F.transform(columns, lambda c: c["name"])


def overlaps(pairs: DataFrame, record: DataFrame) -> DataFrame:
    """(file_id, shares): agreement of gone and new names over the records both files of a pair hold."""
    named = pairs.where(F.col("prev_id").isNotNull()).select(
        "file_id", "prev_id",
        F.array_except(_names("prev_columns"), _names("columns")).alias("gone"),
        F.array_except(_names("columns"), _names("prev_columns")).alias("fresh"),
    )
    # Only pairs that have both a gone and a new name can hold a rename.
    both = named.where((F.size("gone") > 0) & (F.size("fresh") > 0))
    roles = both.select(F.col("prev_id").alias("file_id"), F.col("file_id").alias("pair"), F.lit(True).alias("old"), F.col("gone").alias("asked")).unionByName(
        both.select("file_id", F.col("file_id").alias("pair"), F.lit(False).alias("old"), F.col("fresh").alias("asked"))
    )
    filled = record.where(F.col("record_key").isNotNull() & (F.size("cells") > 0))
    told = F.transform(
        "asked",
        lambda n: F.struct(n.alias("name"), _canonical(F.try_element_at(F.filter("cells", lambda c: c["name"] == n), F.lit(-1))["value"]).alias("v")),
    )
    side = filled.join(roles, "file_id").select("pair", "record_key", "old", told.alias("told"))
    met = side.groupBy("pair", "record_key").agg(
        F.first(F.when(F.col("old"), F.col("told")), True).alias("was"), F.first(F.when(~F.col("old"), F.col("told")), True).alias("now")
    ).where(F.col("was").isNotNull() & F.col("now").isNotNull())
    compared = F.flatten(
        F.transform("was", lambda a: F.transform("now", lambda b: F.struct(
            a["name"].alias("was"), b["name"].alias("now"),
            (a["v"].isNotNull() | b["v"].isNotNull()).alias("filled"), F.coalesce(a["v"] == b["v"], F.lit(False)).alias("same"))))
    )
    return (
        met.select("pair", F.explode(compared).alias("_c"))
        .groupBy("pair", "_c.was", "_c.now")
        .agg(F.count_if("_c.filled").alias("n"), F.count_if("_c.same").alias("same"))
        .where(F.col("same") > RENAME_OVERLAP * F.col("n"))
        .groupBy(F.col("pair").alias("file_id"))
        .agg(F.collect_list(F.struct("was", "now", (F.col("same") / F.col("n")).alias("share"))).alias("shares"))
    )


def edit_scripts(rules: DataFrame, rows: DataFrame) -> DataFrame:
    """(stream_id, file_no, file_id, prev_id, change_type, field_name, old_name)."""
    record = cut(records(rows))  # parsed once
    pairs = cut(files(rules, column_kinds(record)))  # one row per file
    compared = (
        pairs.where(F.col("prev_id").isNotNull())
        .join(overlaps(pairs, record), "file_id", "left")
        .withColumn("script", F.pandas_udf(_scripts, SCRIPT)("prev_columns", "columns", "shares"))
    )
    domain = F.when(
        ~F.col("domain_name").eqNullSafe(F.col("prev_domain")),
        F.array(
            F.struct(
                F.lit("domain_renamed").alias("change_type"),
                F.col("domain_name").alias("field_name"),
                F.col("prev_domain").alias("old_name"),
            )
        ),
    )
    every = F.concat("script", F.coalesce(domain, F.slice("script", 1, 0)))
    return compared.select("stream_id", "file_no", "file_id", "prev_id", F.explode(every).alias("_c")).select(
        "stream_id", "file_no", "file_id", "prev_id", "_c.change_type", "_c.field_name", "_c.old_name"
    )


def projections(rules: DataFrame, script: DataFrame) -> DataFrame:
    """(file_id, stream_id, names): the final name of every declared column of a file."""
    own = rules.groupBy("file_id").agg(
        F.min("stream_id").alias("stream_id"), F.min("file_no").alias("file_no"), F.sort_array(F.collect_set("rule_column")).alias("columns")
    )
    order = W.partitionBy("stream_id").orderBy("file_no", "file_id")
    nexts = own.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in ("file_id", "file_no", "columns")])
    renames = script.where("change_type = 'renamed'").groupBy(F.col("prev_id").alias("file_id")).agg(
        F.map_from_entries(F.collect_list(F.struct("old_name", "field_name"))).alias("renames")
    )
    # A step: name -> (name in the next file, number of the last file that has the column).
    after = lambda n: F.coalesce(F.try_element_at("renames", n), n)
    lives = lambda n: F.coalesce(F.array_contains("next_columns", after(n)), F.lit(False))
    one = F.transform("columns", lambda n: F.struct(n.alias("name"), F.when(lives(n), after(n)).otherwise(n).alias("final"), F.when(lives(n), F.col("next_file_no")).otherwise(F.col("file_no")).alias("last")))
    steps = cut(
        nexts.join(renames, "file_id", "left").select(
            "file_id", "stream_id", F.col("next_file_id").alias("to_id"), F.col("next_file_no").alias("to_no"), one.alias("steps")
        )
    )
    # Doubling: each round joins a file with the file its steps lead to.
    while not steps.where(F.col("to_id").isNotNull()).isEmpty():
        way = F.map_from_entries(F.transform("steps", lambda x: F.struct(x["name"].alias("key"), F.struct(x["final"].alias("final"), x["last"].alias("last")).alias("value"))))
        ahead = steps.select(F.col("file_id").alias("to_id"), F.col("to_id").alias("_id"), F.col("to_no").alias("_no"), way.alias("_way"))

        def onward(s: Column) -> Column:
            # Where the column lives on in the file ahead, that file knows its name.
            found = F.when(s["last"] == F.col("to_no"), F.try_element_at("_way", s["final"]))
            return F.struct(s["name"].alias("name"), F.coalesce(found["final"], s["final"]).alias("final"), F.coalesce(found["last"], s["last"]).alias("last"))

        # Two selects: within one, to_no would mean the alias to_no.
        joined = steps.join(ahead, "to_id", "left").withColumn("steps", F.transform("steps", onward))
        steps = cut(joined.select("file_id", "stream_id", F.col("_id").alias("to_id"), F.col("_no").alias("to_no"), "steps"))

    def apart(s: Column) -> Column:
        """The final name, unless a column of the file that lived longer holds it."""
        rival = F.exists("steps", lambda x: (x["final"] == s["final"]) & ((x["last"] > s["last"]) | ((x["last"] == s["last"]) & (x["name"] < s["name"]))))
        return F.struct(s["name"].alias("name"), F.when(rival, F.concat_ws("@", s["final"], s["last"])).otherwise(s["final"]).alias("final"))

    return steps.select("file_id", "stream_id", F.transform("steps", apart).alias("names"))


def unified(rules: DataFrame, rows: DataFrame, script: DataFrame) -> DataFrame:
    """All records in one table: (stream_id, file_id, record_key, fields map)."""

    def named(c: Column) -> Column:
        found = F.try_element_at(F.filter("names", lambda n: n["name"] == c["name"]), F.lit(1))["final"]
        taken = F.exists("names", lambda n: n["final"] == c["name"])
        return F.coalesce(found, F.when(taken, F.concat(c["name"], F.lit("@undeclared"))).otherwise(c["name"]))

    placed = records(rows).join(projections(rules, script), "file_id", "left").withColumn("names", F.coalesce("names", F.expr("array()").cast("array<struct<name:string,final:string>>")))
    cells = F.coalesce("cells", F.expr("array()").cast("array<struct<name:string,kind:string,value:string>>"))
    # A key written twice in one object: the last value counts.
    last = F.filter(cells, lambda c, i: ~F.exists(F.slice(cells, i + 2, F.size(cells)), lambda d: d["name"] == c["name"]))
    fields = F.map_from_entries(F.transform(last, lambda c: F.struct(named(c).alias("key"), c["value"].alias("value"))))
    return placed.select("stream_id", "file_id", "record_key", fields.alias("fields"))
