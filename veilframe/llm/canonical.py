"""Mapping free-entered values to a canonical list (problem 1).

The reference entries, with their other names and inverted readings ("blister
of ankle") as alias paths, form a trie: letters inside a word, words inside an
entry.  A value is walked through it by a Levenshtein automaton (optimal string
alignment, so a swapped pair is one edit) whose budget depends on the length of
each word; a written abbreviation ("shou. lace.") follows the trie to the words
below its node.  Every entry reachable from any word of the value is returned
with its cost; the best one covers most letters at least cost, and a value
whose best entries tie is reported as unmatched rather than guessed.

Accents, case and punctuation are folded on both sides; entries with ae or oe
have an alias path with e.  Automaton results are memoised per distinct word, so the work is
one trie walk per new word, and a repeated value is walked once per task.

A list of more than ``BLOCK_ENTRIES`` entries is walked block by block.  Which
words a written word may mean is settled by the words of the whole list, which
every block holds; blocks hold the entries.  Each block returns its two best
entries per distinct value, and ties and the fallback are settled over all
blocks, so the blocks change no result.

Null, blank and wordless values match nothing (-1).  Values of any length are
read whole; repeated rows each get their own result.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries whose trie is broadcast at once (about 2 kB each).
BLOCK_ENTRIES = 20_000
#: Letters an abbreviation must have, and what it costs in edits.
SHORT_WORD, SHORT_COST = 3, 0.75
#: Letters an abbreviation needs to stand for a whole one-word entry.
SHORT_ALONE = 5
#: Letters that one edit takes off the letters covered.
EDIT_WEIGHT = 3
#: Cost of a word that only sounds alike, and of a stray short word inside an entry.
SOUND_COST, STRAY_COST = 1.5, 0.5
#: Largest distance of a word that sounds alike (one less for short words and uneven lengths).
SOUND_EDITS = 4
#: Queries that walk a trie together.
QUERIES = 1024
#: Score under which an entry is only taken if none fits written without blanks,
#: and under which it is not taken at all.
WEAK, LEAST = 6, -2
#: Letters a one-word entry needs to be read from words cut apart.
ALONE = 7
#: Digits read as letters they resemble.
LOOKS_LIKE = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s"}
#: Words without meaning of their own inside an entry.
STOP = frozenset({"of", "the", "in", "on", "and", "a", "an", "at", "to"})
# Words on the course of a condition; never read as something else.
QUALIFIERS = frozenset(
    """limiting limited ongoing resolved resolving mild moderate severe slight worse worsening evening morning night overnight resting
    home visit grade treated dosing probable possible intermittent recurrent reports subject patient after before since while left
    right onset history dose post day days again present daughter caregiver informant phone letter""".split()
)
WORD = re.compile(r"[a-z0-9]+")
VOWELS = re.compile(r"[aeiouyw]+")
#: Spellings that sound alike (English), applied in this order before vowels go.
SOUNDS = [
    ("^pn", "n"), ("^ps", "s"), ("sth", "s"), ("th", "t"), ("ph", "f"), ("gue$", "g"), ("gh", "f"), ("rh", "r"),
    ("ch", "k"), ("ck", "k"), ("c(?=[eiy])", "s"), ("c", "k"), ("q", "k"), ("x", "ks"), ("z", "s"), ("(.)\\1", "\\1"),
]

_SOUNDS = [(re.compile(spelling), said) for spelling, said in SOUNDS]


def budget(length: int) -> int:
    """Edits allowed in a word of this many letters (under 4: only inside longer entries)."""
    return 0 if length < 2 else 1 if length < 6 else 2 if length < 10 else 3


def joined_budget(length: int) -> int:
    """Edits allowed between values and entries written without blanks."""
    return 1 if length < 8 else 2 if length < 18 else 3 if length < 24 else 4


def sound(word: str, reference: bool = False) -> set[tuple[str, int]]:
    """Consonant skeleton and vowel groups; a reference word may end silently."""
    for spelling, said in _SOUNDS:
        word = spelling.sub(said, word)
    head = "a" if word[:1] in "aeiouy" else ""
    skeleton = head + VOWELS.sub("", word)
    groups = len(VOWELS.findall(word))
    silent = len(VOWELS.findall(re.sub(r"e$" if not reference else r"[aeiouy]+$", "", word)))
    return {(skeleton, groups), (skeleton, silent)} if reference else {(skeleton, silent)}


def fold(text: str) -> list[str]:
    """Folded words of a value."""
    text = text.lower().replace("'", "")
    if not text.isascii():
        text = text.replace("ß", "ss").replace("’", "").replace("æ", "ae").replace("œ", "oe")
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return [w for w in WORD.findall(text) if w not in STOP]


def spellings(words: list[str]) -> list[list[str]]:
    """The words as listed and with ae and oe written e."""
    plain = [w.replace("ae", "e").replace("oe", "e") for w in words]
    return [words] if plain == words else [words, plain]


class Trie:
    """Letter trie of words: node = [children, word number or -1, longest below]."""

    def __init__(self) -> None:
        self.root: list = [{}, -1]
        self.words: list[str] = []
        self.letters: set[str] = set()
        self.longest = 0

    def add(self, word: str) -> int:
        node = self.root
        self.letters.update(word)
        self.longest = max(self.longest, len(word))
        for c in word:
            node = node[0].setdefault(c, [{}, -1])
        if node[1] < 0:
            node[1] = len(self.words)
            self.words.append(word)
        return node[1]

    def within(self, query: str, most: int) -> dict[int, float]:
        """Words whose alignment distance to ``query`` is at most ``most``."""
        return self.within_many([query], [most])[0]

    def within_many(self, queries: list[str], most: list[int]) -> list[dict[int, float]]:
        """Words within each query's own distance.

        One walk of the trie serves all queries: the automaton's state is one
        row per query (edits by letters read), a step along a letter moves all
        rows at once, and a branch is left by the queries it can no longer serve.
        """
        found: list[dict[int, float]] = [{} for _ in queries]
        # Queries of like length walk together: their rows are as short as they can be.
        fits = sorted((k for k, q in enumerate(queries) if len(q) <= self.longest + most[k]), key=lambda k: len(queries[k]))
        for at in range(0, len(fits), QUERIES):
            self._walk(queries, most, fits[at : at + QUERIES], found)
        return found

    def _walk(self, queries: list[str], most: list[int], chosen: list[int], found: list[dict[int, float]]) -> None:
        n = max((len(queries[k]) for k in chosen), default=0)
        letters = np.zeros((len(chosen), n), np.int32)
        for row, k in enumerate(chosen):
            letters[row, : len(queries[k])] = [ord(c) for c in queries[k]]
        length = np.array([len(queries[k]) for k in chosen])
        bound = np.array([most[k] for k in chosen], np.int16)
        # Which letters of each query are, or look like, a letter of the trie.
        same = {c: letters == ord(c) for c in self.letters}
        like = {c: np.logical_or.reduce([same[c], *[letters == ord(d) for d, options in LOOKS_LIKE.items() if c in options]]) for c in self.letters}
        steps = np.arange(n + 1, dtype=np.int16)
        first = np.broadcast_to(steps, (len(chosen), n + 1))
        every = np.arange(len(chosen))
        zero = np.zeros(len(chosen), np.int16)
        stack = [(child, c, "", every, first, first, zero, 1) for c, child in self.root[0].items()]
        while stack:
            node, c, before, who, row, above, row_least, depth = stack.pop()
            new = np.empty_like(row)
            new[:, 0] = depth
            np.minimum(row[:, :-1] + ~like[c][who], row[:, 1:] + 1, out=new[:, 1:])
            if depth > 1 and n > 1:
                swapped = same[before][who, 1:] & same[c][who, :-1]
                np.minimum(new[:, 2:], above[:, :-2] + 1, out=new[:, 2:], where=swapped)
            new = np.minimum.accumulate(new - steps, 1) + steps
            if node[1] >= 0:
                last = new[np.arange(len(who)), length[who]]
                for k in np.flatnonzero(last <= bound[who]):
                    found[chosen[who[k]]][node[1]] = float(last[k])
            if not node[0]:
                continue
            # The row above still counts for one step, through a swapped pair.
            least, own = new.min(1), bound[who]
            alive = (least <= own) | (row_least < own)
            n_alive = int(np.count_nonzero(alive))
            if not n_alive:
                continue
            if n_alive < len(who):
                who, new, row, least = who[alive], new[alive], row[alive], least[alive]
            stack += [(child, d, c, who, new, row, least, depth + 1) for d, child in node[0].items()]

    def find(self, word: str) -> int:
        """Number of a word of the trie, -1 if it is none."""
        node = self.root
        for c in word:
            if c not in node[0]:
                return -1
            node = node[0][c]
        return node[1]

    def below(self, prefix: str) -> list[int]:
        """Words properly below the node of ``prefix``."""
        node = self.root
        for c in prefix:
            if c not in node[0]:
                return []
            node = node[0][c]
        out, stack = [], list(node[0].values())
        while stack:
            node = stack.pop()
            if node[1] >= 0:
                out.append(node[1])
            stack += node[0].values()
        return out


Entry = tuple[int, str, str | None]


def aliases(entries: list[Entry]) -> Iterator[tuple[int, str, str, list[str]]]:
    """(entry, name, alias, folded words) of every spelling of every entry."""
    for entry, name, others in entries:
        for alias in [name, *(others or "").split("|")]:
            for words in spellings(fold(alias)):
                if words:
                    yield entry, name, alias, words


class Words:
    """The words of the whole list: what a written word may mean."""

    def __init__(self, entries: list[Entry]):
        self.letters = Trie()
        self.memo: dict[str, list[tuple[int, float, int]]] = {}
        acronyms: set[str] = set()
        for _, _, alias, words in aliases(entries):
            for w in words:
                self.letters.add(w)
            acronyms |= {w for w in words if alias.isupper()}
        #: Acronyms are read as written or not at all.
        self.exact = {k for k, w in enumerate(self.letters.words) if w in acronyms}
        self.sounds: dict[tuple[str, int], list[int]] = {}
        for number, word in enumerate(self.letters.words):
            for key in sound(word, reference=True) if len(word) > 3 else ():
                self.sounds.setdefault(key, []).append(number)

    def learn(self, words: set[str]) -> None:
        """Settles what new written words may mean, in one walk."""
        new = sorted(w for w in words if w not in self.memo)
        if len(self.memo) > 500_000:
            self.memo.clear()
            new = sorted(words)
        walked = [w for w in new if w not in QUALIFIERS]
        most = [max(budget(len(w) + 3) + (len(w) > 4), SOUND_EDITS if len(w) > 3 else 0) for w in walked]
        near = dict(zip(walked, self.letters.within_many(walked, most)))
        for word in new:
            if word in QUALIFIERS:
                exact = self.letters.find(word)
                self.memo[word] = [(exact, 0.0, 0)] if exact >= 0 else []
            else:
                self.memo[word] = self._readings(word, near[word])

    def readings(self, word: str) -> list[tuple[int, float, int]]:
        """Reference words a written word may mean: (word, cost, edits over budget).

        One edit over the budget is allowed once in an entry of several words.
        """
        if word not in self.memo:
            self.learn({word})
        return self.memo[word]

    def _readings(self, word: str, near: dict[int, float]) -> list[tuple[int, float, int]]:
        options: dict[int, tuple[float, int]] = {}
        names = self.letters.words
        alike = {w for key in sound(word) if len(key[0]) > 1 for w in self.sounds.get(key, ())} if len(word) > 3 else set()
        for w, edits in near.items():
            over = edits - budget(len(names[w]))
            if w in self.exact and edits:
                continue
            if over <= 0:
                options[w] = (edits, 0)
            elif w in alike and edits <= SOUND_EDITS - (len(word) < 6 or abs(len(word) - len(names[w])) > 1):
                options[w] = (SOUND_COST, 0)
            elif over == 1 and len(word) > 4 and len(names[w]) > 4:
                options[w] = (edits, 1)
        if len(word) >= SHORT_WORD:
            for w in self.letters.below(word):
                if w not in options or options[w][0] > SHORT_COST:
                    options[w] = (SHORT_COST, 0)
        if any(c == 0 for c, _ in options.values()):
            # A word of the list means itself, not a neighbour.
            options = {w: (c, o) for w, (c, o) in options.items() if c == 0}
        return sorted(((w, c, o) for w, (c, o) in options.items()), key=lambda x: (x[1], x[0]))


class Canonical:
    """Trie of entries: words of a value lead from node to node."""

    def __init__(self, entries: list[Entry], words: Words | None = None):
        self.words = words or Words(entries)
        self.joined = Trie()
        self.root: dict = {}
        self.whole: dict[int, set[int]] = {}
        self.single: set[int] = set()
        self.near: dict[str, dict[int, float]] = {}
        for entry, name, alias, listed in aliases(entries):
            self._add(listed, entry)
            if len(listed) > 1 or len(listed[0]) >= ALONE:
                number = self.joined.add("".join(listed))
                self.whole.setdefault(number, set()).add(entry)
                if len(listed) == 1:
                    self.single.add(number)
            if len(listed) > 1 and alias == name:
                self._add([listed[-1], *listed[:-1]], entry)
        #: No longer text can be within distance of an entry.
        self.longest = max(map(len, self.joined.words), default=0) + joined_budget(1 << 30)

    def _add(self, words: list[str], entry: int) -> None:
        node = self.root
        for w in words:
            node = node.setdefault(self.words.letters.find(w), {})
        node.setdefault(-1, set()).add(entry)

    def walked(self, words: Sequence[str]) -> dict[int, float]:
        """Every entry reachable word by word with its best score (letters covered less edits)."""
        best: dict[int, float] = {}
        names = self.words.letters.words
        for start in range(len(words)):
            stack = [(self.root, start, 0.0, 0, 0, 0)]
            while stack:
                node, at, cost, letters, depth, over = stack.pop()
                for entry in node.get(-1, ()):
                    if depth == 1 and cost:
                        word = words[start]
                        if over or len(word) < 4 or cost == SHORT_COST and len(word) < SHORT_ALONE:
                            continue
                    score = letters - EDIT_WEIGHT * cost
                    if score > best.get(entry, -1e9):
                        best[entry] = score
                if at < len(words):
                    for w, c, o in self.words.readings(words[at]):
                        if w in node and over + o < 2:
                            covered = min(len(names[w]), len(words[at]))
                            stack.append((node[w], at + 1, cost + c, letters + covered, depth + 1, over + o))
                    if depth and len(words[at]) < 4 and cost < 1:
                        stack.append((node, at + 1, cost + STRAY_COST, letters, depth, over))
        return best

    def _windows(self, words: Sequence[str]) -> Iterator[tuple[int, int, str]]:
        """(start, end, text) of consecutive words written in one."""
        for start in range(len(words)):
            text = ""
            for end in range(start + 1, len(words) + 1):
                text += words[end - 1]
                if len(text) > self.longest:
                    break
                if len(text) > 5:
                    yield start, end, text

    def learn(self, values: Sequence[Sequence[str]]) -> None:
        """Settles all windows of new values in one walk."""
        if len(self.near) > 200_000:
            self.near.clear()
        new = sorted({t for words in values for _, _, t in self._windows(words) if t not in self.near})
        self.near.update(zip(new, self.joined.within_many(new, [joined_budget(len(t)) for t in new])))

    def without_blanks(self, words: Sequence[str]) -> dict[int, float]:
        """Entries written in one, or cut into other words than theirs."""
        best: dict[int, float] = {}
        for start, end, text in self._windows(words):
            if text not in self.near:
                self.learn([words])
            plain = end == start + 1 or not QUALIFIERS.isdisjoint(words[start:end])
            for number, cost in self.near[text].items():
                if plain and number in self.single:
                    continue
                for entry in self.whole[number]:
                    score = len(text) - EDIT_WEIGHT * cost
                    best[entry] = max(best.get(entry, -1e9), score)
        return best

    def candidates_of(self, values: list[str | None]) -> list[dict[int, float]]:
        """Per value every entry within distance of it with its score."""
        written = [tuple(fold(v)) if v else () for v in values]
        # Values that differ in case, accents or marks only are one value.
        folded = list(dict.fromkeys(written))
        self.words.learn({w for words in folded for w in words})
        walked = [self.walked(words) for words in folded]
        weak = [k for k, best in enumerate(walked) if not best or max(best.values()) < WEAK]
        self.learn([folded[k] for k in weak])
        for k in weak:
            for entry, score in self.without_blanks(folded[k]).items():
                walked[k][entry] = max(walked[k].get(entry, -1e9), score)
        of_value = {words: {e: s for e, s in best.items() if s >= LEAST} for words, best in zip(folded, walked)}
        return [of_value[words] for words in written]

    def candidates(self, value: str | None) -> dict[int, float]:
        return self.candidates_of([value])[0]

    def meant(self, values: list[str | None]) -> list[int]:
        """The one entry each value means, or -1."""
        out = []
        for found in map(leaders, self.candidates_of(values)):
            out.append(found[0][0] if found and (len(found) == 1 or found[0][1] > found[1][1]) else -1)
        return out

    def best(self, *values: str | None) -> int:
        """The entry of the first value that means exactly one, or -1."""
        return next((e for e in self.meant(list(values)) if e >= 0), -1)


def leaders(found: dict[int, float]) -> list[tuple[int, float]]:
    """The two best entries."""
    return sorted(found.items(), key=lambda x: (-x[1], x[0]))[:2]


def settle(blocks: list[tuple[list[tuple[int, float]], list[tuple[int, float]]]]) -> int:
    """The entry a value means, from each block's leaders (walked, without blanks), or -1."""
    walked: dict[int, float] = {}
    joined: dict[int, float] = {}
    for first, second in blocks:
        for into, part in ((walked, first), (joined, second)):
            for entry, score in part:
                into[entry] = max(score, into.get(entry, -1e9))
    if not walked or max(walked.values()) < WEAK:
        walked = {e: max(walked.get(e, -1e9), joined.get(e, -1e9)) for e in {*walked, *joined}}
    found = leaders({e: s for e, s in walked.items() if s >= LEAST})
    return found[0][0] if found and (len(found) == 1 or found[0][1] > found[1][1]) else -1


def uncoded(rows: DataFrame, code: str, reference: DataFrame, name: str) -> DataFrame:
    """Rows whose code is null or not exactly some entry name."""
    names = reference.select(F.col(name).alias(code)).where(F.col(code).isNotNull()).distinct()
    small = names.limit(BLOCK_ENTRIES + 1).count() <= BLOCK_ENTRIES
    return rows.join(F.broadcast(names) if small else names, code, "left_anti")


def map_values(rows: DataFrame, keys: list[str], values: list[str], reference: DataFrame, entry: str, name: str, others: str) -> DataFrame:
    """(keys, entry_id): the entry the first telling of ``values`` means, or -1."""
    spark = rows.sparkSession
    # The reference list is read whole; one entry stays in one block.
    entries = [tuple(r) for r in reference.where(F.col(name).isNotNull()).select(entry, name, others).toLocalIterator()]
    entries.sort(key=lambda e: (e[0], e[1], e[2] or ""))
    narrow = rows.select(*keys, *[F.col(v).cast("string").alias(f"_v{i}") for i, v in enumerate(values)])
    columns = [f"_v{i}" for i in range(len(values))]
    if len(entries) > BLOCK_ENTRIES:
        return _map_in_blocks(narrow, keys, columns, entries)
    shared = spark.sparkContext.broadcast(entries)
    schema = ", ".join(f"{c} {narrow.schema[c].dataType.simpleString()}" for c in keys)

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        canonical = Canonical(shared.value)
        for batch in batches:
            found = np.full(len(batch), -1, np.int64)
            for c in columns:  # the next column decides where the one before says nothing
                codes, told = pd.factorize(batch[c])
                asked = np.unique(codes[(found < 0) & (codes >= 0)])
                means = np.full(len(told) + 1, -1, np.int64)  # the last one: null
                means[asked] = canonical.meant([told[k] for k in asked])
                found = np.where(found < 0, means[codes], found)
            yield batch[keys].assign(entry_id=found)

    return narrow.mapInPandas(match, f"{schema}, entry_id long")


def _map_in_blocks(narrow: DataFrame, keys: list[str], columns: list[str], entries: list[Entry]) -> DataFrame:
    """Distinct values against every block, settled over the blocks, joined back to the rows."""
    spark = narrow.sparkSession
    told = reduce(DataFrame.unionByName, [narrow.select(F.col(c).alias("_value")) for c in columns]).where(F.col("_value").isNotNull()).distinct()
    words = spark.sparkContext.broadcast(Words(entries))
    lead = "array<struct<e:long,s:double>>"
    parts = []
    for at in range(0, len(entries), BLOCK_ENTRIES):
        stop = at + BLOCK_ENTRIES
        # Rows of one entry must not be parted.
        low = next((k for k in range(at, len(entries)) if not k or entries[k][0] != entries[k - 1][0]), len(entries))
        high = next((k for k in range(stop, len(entries)) if entries[k][0] != entries[k - 1][0]), len(entries))
        shared = spark.sparkContext.broadcast(entries[low:high])

        def lead_in(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            canonical = Canonical(shared.value, words.value)
            for batch in batches:
                folded = [fold(v) for v in batch["_value"]]
                words.value.learn({w for f in folded for w in f})
                canonical.learn(folded)
                found = [(leaders(canonical.walked(w)), leaders(canonical.without_blanks(w))) for w in folded]
                for k, side in enumerate(("walked", "joined")):
                    batch[side] = [[{"e": e, "s": s} for e, s in f[k]] for f in found]
                yield batch

        parts.append(told.mapInPandas(lead_in, f"_value string, walked {lead}, joined {lead}"))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["entry_id"] = [
                settle([([(r["e"], r["s"]) for r in b["walked"]], [(r["e"], r["s"]) for r in b["joined"]]) for b in blocks]) for blocks in batch["blocks"]
            ]
            yield batch[["_value", "entry_id"]]

    # At most four entries a block for each value.
    gathered = reduce(DataFrame.unionByName, parts).groupBy("_value").agg(F.collect_list(F.struct("walked", "joined")).alias("blocks"))
    meant = gathered.mapInPandas(decide, "_value string, entry_id long")
    out = narrow
    for c in columns:
        out = out.join(meant.select(F.col("_value").alias(c), F.col("entry_id").alias(f"{c}_e")), c, "left")
    pick = F.coalesce(*[F.when(F.col(f"{c}_e") >= 0, F.col(f"{c}_e")) for c in columns], F.lit(-1).cast("long"))
    return out.select(*keys, pick.alias("entry_id"))
