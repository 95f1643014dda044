"""Mixing sources to target weights (problem 9).

Every document of a source has the same expected number of copies,
``share * total / tokens of the source``.  Its whole part is certain; the
fractional parts are settled by pivotal dependent rounding: two documents with
open fractions meet, and token mass moves from one to the other, in a random
direction that keeps both expectations, until one fraction is 0 or 1.  Token
mass is kept exactly at each meeting, so a source ends within one document of
its target.

The tree: sizes (no texts) are dealt to groups by a hash of the document id,
their number following from the number of documents alone; each group streams
its documents in the order of their ids and keeps one open document per source;
the leftovers (groups x sources) meet again in groups of ``FAN_IN`` until every
source has one at most, which a last draw settles.  Draws are hashes of document
id, level and seed.  So neither the files' layout nor a task that runs again
changes the mixture; each level is cut to the shared checkpoint folder.

``total`` is the largest mixture that all present sources can fill without any
document being used more than ``max_repeat`` times, unless a smaller one is
asked for.  A target without documents can hold no share: the other shares are
scaled up, and the report shows 0 for it.  Sources without a target, null
sources and texts without tokens (null, empty) are never drawn.  A repeated
target row counts once with its shares added and the least cap.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilframe.session import cut

#: Largest vocabulary file that is shipped to the executors.
VOCABULARY_BYTES = 32_000_000
#: Published split pattern of that byte-level vocabulary.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Documents of one group of the first level, and least number of groups.
GROUP_DOCS, GROUPS = 250_000, 16
#: Open documents that meet in one task of the upper levels.
FAN_IN = 4096
EDGE = 1e-9


def encoder(vocabulary: bytes):
    """Encoder of a public tokenizer from the content of its vocabulary file (tiktoken ranks)."""
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("mixing", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, doc_id: str, text: str, source: str, vocabulary: str) -> DataFrame:
    """(doc_id, source, n_tokens): sizes of whole texts, one scan.

    ``vocabulary`` is a file on the driver; its content is sent to the executors.
    """
    with open(vocabulary, "rb") as file:
        content = file.read(VOCABULARY_BYTES + 1)
    if len(content) > VOCABULARY_BYTES:
        raise ValueError("the vocabulary file is too large to be shipped")
    shared = documents.sparkSession.sparkContext.broadcast(content)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(shared.value).encode_ordinary
        for batch in batches:
            sizes = [len(encode(t)) if t else 0 for t in batch["_text"]]
            yield batch[["doc_id", "source"]].assign(n_tokens=sizes)

    narrow = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("_text"))
    return narrow.mapInPandas(count, "doc_id long, source string, n_tokens long")


def uniform(doc_id: int, level: int, seed: int) -> float:
    """Reproducible draw in [0, 1)."""
    digest = hashlib.blake2b(f"{seed}|{level}|{doc_id}".encode(), digest_size=8).digest()
    return int.from_bytes(digest, "big") / 2**64


class Pivot:
    """Streams documents of one source; at most one stays open."""

    def __init__(self, level: int, seed: int):
        self.level, self.seed = level, seed
        self.open: list | None = None  # [doc_id, tokens, fraction]

    def meet(self, doc_id: int, tokens: int, fraction: float) -> list[tuple[int, int, int]]:
        """Documents settled by this arrival: (doc_id, extra copy, tokens)."""
        if fraction <= EDGE or fraction >= 1 - EDGE:
            return [(doc_id, int(fraction > 0.5), tokens)]
        if self.open is None:
            self.open = [doc_id, tokens, fraction]
            return []
        a_id, a, p = self.open
        b_id, b, q = doc_id, tokens, fraction
        # Token mass that can go from b to a, and from a to b.
        up, down = min((1 - p) * a, q * b), min(p * a, (1 - q) * b)
        moved = up if uniform(b_id, self.level, self.seed) < down / (up + down) else -down
        p, q = p + moved / a, q - moved / b
        done = []
        self.open = None
        for other, size, f in ((a_id, a, p), (b_id, b, q)):
            if f <= EDGE or f >= 1 - EDGE:
                done.append((other, int(f > 0.5), size))
            else:
                self.open = [other, size, f]
        return done


def _rounds(level: int, seed: int):
    """Streaming rounding of (source, doc_id, n_tokens, fraction)."""

    def rounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots: dict[str, Pivot] = {}
        for batch in batches:
            rows = []
            for source, doc_id, tokens, fraction in zip(batch["source"], batch["doc_id"], batch["n_tokens"], batch["fraction"]):
                pivot = pivots.setdefault(source, Pivot(level, seed))
                rows += [(source, d, extra, n, None) for d, extra, n in pivot.meet(doc_id, tokens, fraction)]
            yield pd.DataFrame(rows, columns=["source", "doc_id", "extra", "n_tokens", "fraction"])
        left = [(s, p.open[0], None, p.open[1], p.open[2]) for s, p in pivots.items() if p.open]
        yield pd.DataFrame(left, columns=["source", "doc_id", "extra", "n_tokens", "fraction"])

    return rounds


ROUNDED = "source string, doc_id long, extra int, n_tokens long, fraction double"


def open_docs(left: DataFrame):
    """Most open documents of one source, and all of them (0 where there are none)."""
    per_source = left.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return per_source.agg(F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.coalesce(F.sum("n"), F.lit(0)).alias("every")).first()


def plan(counts: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """(source, target_share, share, max_repeat, tokens, expected copies); one row per target."""
    wanted = targets.where(F.col("source").isNotNull()).groupBy("source").agg(
        F.sum("target_share").alias("target_share"), F.min("max_repeat").alias("max_repeat")
    )
    have = counts.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    joined = wanted.join(have, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0).cast("long")))
    live = joined.where((F.col("tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeat") > 0))
    # One row over the targets, a list written by hand.
    scale = live.agg(
        F.sum("target_share").alias("shares"),
        F.min(F.col("max_repeat") * F.col("tokens") / F.col("target_share")).alias("room"),
    ).first()
    shares_of, room = scale["shares"] or 1.0, (scale["room"] or 0.0) * (scale["shares"] or 0.0)
    size = room if total is None else min(room, float(total))
    usable = (F.col("tokens") > 0) & (F.col("target_share") > 0) & (F.col("max_repeat") > 0)
    share = F.when(usable, F.col("target_share") / shares_of).otherwise(0.0)
    expected = F.when(usable, F.least(share * size / F.col("tokens"), F.col("max_repeat").cast("double"))).otherwise(0.0)
    return joined.select("source", "target_share", share.alias("share"), "max_repeat", "tokens", expected.alias("expected"))


def mix(documents: DataFrame, targets: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        total: float | None = None, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(drawn, planned): (source, doc_id, n_tokens, copies) and one row per target."""
    counts = cut(token_counts(documents, doc_id, text, source, vocabulary))
    planned = cut(plan(counts, targets, total))
    rates = planned.select("source", "expected")
    # One row per target, a list written by hand; a long one is joined by a shuffle.
    rates = F.broadcast(rates) if planned.count() <= 10_000 else rates
    wanted = counts.where(F.col("n_tokens") > 0).join(rates, "source").where(F.col("expected") > 0)
    whole = F.floor("expected").cast("int")
    sized = wanted.select("source", "doc_id", "n_tokens", (F.col("expected") - whole).alias("fraction"))
    def meet(docs: DataFrame, n: int, level: int) -> DataFrame:
        groups = F.pmod(F.xxhash64("doc_id", F.lit(level)), F.lit(n))
        dealt = docs.select("source", "doc_id", "n_tokens", "fraction").repartition(n, groups)
        return cut(dealt.sortWithinPartitions("source", "doc_id", "n_tokens").mapInPandas(_rounds(level, seed), ROUNDED))

    rounded = meet(sized, max(GROUPS, -(-counts.count() // GROUP_DOCS)), 0)
    settled, level = [rounded.where(F.col("extra").isNotNull())], 1
    left = rounded.where(F.col("extra").isNull())
    # Until no source has two open documents that could still meet.
    while (n_open := open_docs(left))["most"] > 1:
        met = meet(left, -(-n_open["every"] // FAN_IN), level)
        settled.append(met.where(F.col("extra").isNotNull()))
        left, level = met.where(F.col("extra").isNull()), level + 1

    def last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["extra"] = [int(uniform(d, 99, seed) < f) for d, f in zip(batch["doc_id"], batch["fraction"])]
            yield batch

    extras = left.mapInPandas(last, ROUNDED)
    for part in settled:
        extras = extras.unionByName(part)
    # The whole part is the same for all documents of a source.
    drawn = (
        extras.join(rates, "source")
        .select("source", "doc_id", "n_tokens", (whole + F.col("extra")).alias("copies"))
        .where(F.col("copies") > 0)
    )
    return drawn, planned


def shares(drawn: DataFrame, planned: DataFrame) -> DataFrame:
    """Target and actual shares of every target source."""
    got = drawn.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("copies").alias("n_copies"),
        F.max("copies").alias("most_copies"),
        F.sum(F.col("copies") * F.col("n_tokens")).alias("n_tokens"),
    )
    every = W.partitionBy()  # one row per target
    zero = F.lit(0).cast("long")
    return planned.join(got, "source", "left").select(
        "source",
        "target_share",
        F.col("share").alias("attainable_share"),
        F.coalesce("n_docs", zero).alias("n_docs"),
        F.coalesce("n_copies", zero).alias("n_copies"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
        "max_repeat",
        F.coalesce("n_tokens", zero).alias("n_tokens"),
        (F.coalesce("n_tokens", zero) / F.sum("n_tokens").over(every)).alias("actual_share"),
    )
