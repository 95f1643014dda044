"""Re-identification risk from one aggregation.

The table is grouped once by all quasi-identifiers; every measure (summary,
smallest classes, leave-one-out, reduction path, histogram) works on these
classes, never again on the rows, so each further pass is over the number of
classes.  Nulls form one group of their own; values are compared as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def classes(df: DataFrame, quasi: list[str]) -> DataFrame:
    """(quasi..., size): equivalence classes, nulls grouped together."""
    return df.groupBy(*[F.col(q).cast("string").alias(q) for q in quasi]).agg(F.count(F.lit(1)).alias("size"))


def summary(groups: DataFrame, k_target: int = 5) -> DataFrame:
    """One row: k, classes, records below the target and the two risks."""
    n = F.sum("size")
    below = F.coalesce(F.sum(F.when(F.col("size") < k_target, F.col("size"))), F.lit(0).cast("bigint"))
    return groups.agg(
        n.alias("n_records"),
        F.min("size").alias("k_min"),
        F.count(F.lit(1)).alias("n_classes"),
        below.alias("records_below_k"),
        F.round(below / n, 4).alias("fraction_below_k"),
        F.round(F.lit(1.0) / F.min("size"), 4).alias("prosecutor_risk"),
        F.round(F.count(F.lit(1)) / n, 4).alias("marketer_risk"),
    )


def smallest(groups: DataFrame, n: int = 10) -> DataFrame:
    """The n smallest classes with all ties."""
    # Only sizes small enough can rank: the n-th smallest size is found first.
    sizes = groups.groupBy("size").agg(F.count(F.lit(1)).alias("_c"))
    ranked = sizes.withColumn("_before", F.coalesce(F.sum("_c").over(W.orderBy("size").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    cut_at = ranked.where(F.col("_before") < n).agg(F.max("size")).first()[0]
    return groups.where(F.col("size") <= (0 if cut_at is None else cut_at))


def leave_one_out(groups: DataFrame, quasi: list[str]) -> DataFrame:
    """k reached when one quasi-identifier is left out, for each of them.

    One exploded pass over the classes: each class is regrouped once per
    quasi-identifier with that column blanked.
    """
    kept = F.array(
        *[
            F.struct(
                F.lit(q).alias("left_out"),
                F.array(*[F.lit(None).cast("string") if o == q else F.col(o) for o in quasi]).alias("key"),
            )
            for q in quasi
        ]
    )
    wide = groups.select(F.explode(kept).alias("_k"), "size").select("_k.*", "size")
    regrouped = wide.groupBy("left_out", "key").agg(F.sum("size").alias("size"))
    return regrouped.groupBy("left_out").agg(F.min("size").alias("k_without"))


def reduction_path(groups: DataFrame, quasi: list[str], k_target: int = 5) -> list[tuple[str, int]]:
    """Greedy order in which to give up quasi-identifiers: [(dropped, k reached)].

    At most one job per quasi-identifier over ever fewer classes; ties keep the
    declared order.  The last identifier is never given up: without any the
    table would say nothing of the risk.
    """
    left, path = list(quasi), []
    groups = groups.select(*quasi, "size")
    k = groups.agg(F.min("size")).first()[0]
    while len(left) > 1 and k is not None and k < k_target:
        found = {r["left_out"]: r["k_without"] for r in leave_one_out(groups, left).collect()}  # one row each
        gone = max(left, key=lambda q: (found[q], -left.index(q)))
        left.remove(gone)
        groups = groups.groupBy(*left).agg(F.sum("size").alias("size"))
        k = found[gone]
        path.append((gone, k))
    return path


def l_diversity(df: DataFrame, quasi: list[str], sensitive: list[str]) -> DataFrame:
    """Fewest distinct sensitive values in any class, per sensitive column.

    Distinct pairs are formed before the class is gathered, so a class with
    many rows costs no more than its distinct values.
    """
    keys = [F.col(q).cast("string").alias(f"_q{i}") for i, q in enumerate(quasi)]
    pairs = F.explode(F.array(*[F.struct(F.lit(s).alias("sensitive"), F.col(s).cast("string").alias("value")) for s in sensitive]))
    flat = df.select(*keys, pairs.alias("_p")).select(*[f"_q{i}" for i in range(len(quasi))], "_p.sensitive", "_p.value").distinct()
    per_class = flat.groupBy(*[f"_q{i}" for i in range(len(quasi))], "sensitive").agg(F.count("value").alias("l"))
    return per_class.groupBy("sensitive").agg(F.min("l").alias("l_min"))


def histogram(groups: DataFrame) -> DataFrame:
    return groups.groupBy("size").agg(F.count(F.lit(1)).alias("n_classes"))
