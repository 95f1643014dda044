"""Evaluation texts leaking into training text (problem 8).

The evaluation items are the indexed side.  Every training document is cut
into overlapping passages and each passage is a query against a BM25 inverted
index of the items, walked with block-max WAND: the cursors of the passage's
words stand on their posting lists in item order; the pivot is the first item
their upper bounds could carry over the least threshold, the bounds of the
posting blocks around it are tried against the item's own threshold, and only
then is the item scored; all cursors before it skip ahead.

The threshold is not tuned but *admissible*: for each item it is the smallest
BM25 score that any ``RUN`` consecutive words of the item can give.  A passage
holding such a run therefore always reaches it.  A run holds only words of the
index, so passages are stretches of such words; long ones overlap by ``RUN - 1``
words, so that every run lies wholly in one passage.  Retrieved pairs are
verified exactly: they must share ``RUN`` or more consecutive words.

The scan is one pass over the documents without a shuffle, once per distinct
text of a batch.  The index of one block of items (``BLOCK_BYTES`` of text,
measured) is broadcast, and larger item sets take further passes; a posting
takes 8 bytes and a word of an item 4, so an index is about three times its text.

Words are runs of letters or digits in lower case.  Null or empty texts and
items shorter than ``RUN`` words leak nothing; texts of any length are read
whole; exact copies come out under each document id.
"""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Consecutive words that make a leak.
RUN = 15
#: Words of a passage; consecutive passages overlap by RUN - 1 words.
PASSAGE = 64
#: BM25 parameters.
K1, B = 1.2, 0.75
#: Postings under one upper bound, and bytes of item text broadcast at once.
POSTING_BLOCK, BLOCK_BYTES = 32, 32_000_000

WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class Bm25Index:
    """Inverted index of items: per word a posting list in item order with block maxima."""

    def __init__(self, items: list[tuple[int, str]]):
        tokens = [(item, words(text)) for item, text in items]
        tokens = [(item, t) for item, t in tokens if len(t) >= RUN]
        self.ids = array("q", [item for item, _ in tokens])
        df = Counter(w for _, t in tokens for w in set(t))
        self.vocab = {w: k for k, w in enumerate(sorted(df))}
        n = len(tokens)
        idf = {w: math.log(1 + (n - c + 0.5) / (c + 0.5)) for w, c in df.items()}
        mean = sum(len(t) for _, t in tokens) / max(n, 1)
        self.posts = [array("i") for _ in self.vocab]
        self.scores = [array("f") for _ in self.vocab]
        self.texts: list[array] = []
        self.threshold = array("d")
        for k, (_, t) in enumerate(tokens):
            norm = K1 * (1 - B + B * len(t) / mean)
            own = {w: idf[w] * tf * (K1 + 1) / (tf + norm) for w, tf in Counter(t).items()}
            for w, score in own.items():
                self.posts[self.vocab[w]].append(k)
                self.scores[self.vocab[w]].append(score)
            self.texts.append(array("i", [self.vocab[w] for w in t]))
            # Scores are kept in single precision; the margin is wider than their rounding.
            self.threshold.append(min(sum(own[w] for w in set(t[i : i + RUN])) for i in range(len(t) - RUN + 1)) - 1e-3)
        self.block_max = [array("f", [max(s[i : i + POSTING_BLOCK]) for i in range(0, len(s), POSTING_BLOCK)]) for s in self.scores]
        self.most = array("f", [max(s) for s in self.scores])
        self.floor = min(self.threshold, default=math.inf)
        self._runs: dict[int, set[tuple[int, ...]]] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_runs": {}}

    def runs(self, k: int) -> set[tuple[int, ...]]:
        """All runs of an item; kept for the items met, made again when they are many."""
        found = self._runs.get(k)
        if found is None:
            if len(self._runs) > 5_000:
                self._runs.clear()
            text = self.texts[k].tolist()
            found = self._runs[k] = {tuple(text[i : i + RUN]) for i in range(len(text) - RUN + 1)}
        return found

    def retrieve(self, terms: set[int]) -> list[int]:
        """Items whose BM25 score for the distinct ``terms`` reaches their threshold (block-max WAND)."""
        posts, scores, most, floor = self.posts, self.scores, self.most, self.floor
        cursors = [[posts[w][0], 0, w] for w in terms]  # item, position, word
        hits = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for at, cursor in enumerate(cursors):
                bound += most[cursor[2]]
                if bound >= floor:
                    pivot = at
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            # Bounds of the blocks in which the cursors would meet the pivot item.
            bound, until = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else len(self.texts)
            for _, position, w in cursors[: pivot + 1]:
                list_of = posts[w]
                block = bisect_left(list_of, item, position) // POSTING_BLOCK
                if block < len(self.block_max[w]):
                    bound += self.block_max[w][block]
                    until = min(until, list_of[min((block + 1) * POSTING_BLOCK, len(list_of)) - 1] + 1)
            # The blocks hold for every item up to their ends, but thresholds are each item's own.
            least = self.threshold[item]
            if bound < floor and until > item:
                goal = until
            elif bound < least:
                goal = item + 1
            elif cursors[0][0] == item:
                score = 0.0
                for cursor in cursors[: pivot + 1]:
                    score += scores[cursor[2]][cursor[1]]
                if score >= least:
                    hits.append(item)
                goal = item + 1
            else:
                goal = item
            for cursor in cursors[: pivot + 1]:
                if cursor[0] < goal:
                    list_of = posts[cursor[2]]
                    cursor[1] = bisect_left(list_of, goal, cursor[1])
                    cursor[0] = list_of[cursor[1]] if cursor[1] < len(list_of) else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return hits

    def passages(self, ids: list[int]) -> Iterator[list[int]]:
        """Stretches of known words, cut into overlapping windows."""
        start = 0
        for end in [k for k, w in enumerate(ids) if w < 0] + [len(ids)]:
            for at in range(start, end - RUN + 1, PASSAGE - RUN + 1):
                yield ids[at : min(at + PASSAGE, end)]
            start = end + 1

    def leaks(self, text: str | None) -> list[tuple[int, int]]:
        """(item_id, shared runs of RUN words) for one document."""
        if not text or not self.texts:
            return []
        get = self.vocab.get
        found: dict[int, set[tuple[int, ...]]] = {}
        for passage in self.passages([get(w, -1) for w in words(text)]):
            hits = self.retrieve(set(passage))
            if hits:
                grams = {tuple(passage[i : i + RUN]) for i in range(len(passage) - RUN + 1)}
                for k in hits:
                    if shared := grams & self.runs(k):
                        found.setdefault(k, set()).update(shared)
        return [(self.ids[k], len(s)) for k, s in found.items()]


def leaks(documents: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str) -> DataFrame:
    """(doc_id, item_id, n_runs): documents sharing RUN consecutive words with an item."""
    spark = documents.sparkSession
    rows = items.where(F.col(item_text).isNotNull()).select(F.col(item_id).cast("long"), item_text).distinct()
    source = documents.where(F.length(text) > 0).select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"))

    def against(block: list[tuple[int, str]]) -> DataFrame:
        index = spark.sparkContext.broadcast(Bm25Index(block))

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                codes, texts = pd.factorize(batch["t"])
                found = [index.value.leaks(t) for t in texts]
                out = [(d, i, n) for d, c in zip(batch["d"], codes) for i, n in found[c]]
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "n_runs"])

        return source.mapInPandas(scan, "doc_id long, item_id long, n_runs long")

    # One block of items is on the driver at a time.
    parts: list[DataFrame] = []
    block: list[tuple[int, str]] = []
    size = 0
    for item, content in rows.toLocalIterator():
        if block and size + len(content) > BLOCK_BYTES:
            parts.append(against(block))
            block, size = [], 0
        block.append((item, content))
        size += len(content)
    parts.append(against(block))
    return reduce(DataFrame.unionByName, parts)
