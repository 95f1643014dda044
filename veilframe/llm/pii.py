"""Personal information inside free text (problem 3).

A skip-chain conditional random field labels every token as name, e-mail,
phone, identity number, address or other.

* Node potentials read the token, its shape, its neighbours (three before, two
  after), the words before and after it whatever stands between, the digit
  groups of the number it is part of, and whether a common written form of a
  detail (``FORMS``) runs through it.
* Chain edges join neighbouring tokens; skip edges join distant tokens of one
  document that are the same or alike (a name and the local part of a mail
  address), and favour one label for both.
* Documents without skip edges are decoded by Viterbi, vectorised over all
  documents of one length; the others by loopy max-product message passing,
  each until its own messages settle (``settled`` tells whether they did).

A detail is a run of equal labels.  A written form is evidence for the field
and, inside a labelled run, tells two neighbouring details apart; a run without
any known form is a detail all the same.

There are no labelled rows, so the field is trained on the driver, by
pseudo-likelihood, on ``TRAINING_TEXTS`` sentences of ``pii_corpus``, a grammar
of invented names, numbers and cues around the reference terms of the caller.
That bound is a parameter and does not depend on the data; the weights (about
2 MB) are broadcast and kept for the next call.  Prediction is one scan of all
rows without a shuffle, once per distinct text of a batch.

Null and empty texts have no details.  Texts are read whole, whatever their
length.  Repeated rows come out under each row id.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm import pii_corpus

LABELS = ["other", "name", "email", "phone", "id_number", "address"]
TRAINING_TEXTS = 30000
BUCKETS, EPOCHS, BATCH = 1 << 17, 6, 1536
#: Times evidence must be met in training.
LEAST_SEEN = 3
RATE, DECAY = 0.4, 1e-6
#: A missed detail weighs more than a word hidden for nothing.
DETAIL_WEIGHT = 2.5
PLAIN_PART = 0.3
HIDDEN = 0.6
#: Neighbours by distance (role 1..5) and by words before and after (role 6..9).
LAGS = ((1, -1), (2, 1), (3, -2), (4, 2), (5, -3))
WORD_LAGS = ((6, -1), (7, -2), (8, 1), (9, -3))
ROLES = 10
#: Messages have settled when none changes by more; a text gets this many rounds
#: and one more per token, which is above the length of any path through it.
SETTLED, ROUNDS = 1e-4, 400

TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+|[^\w\s]|_")
#: A number with everything that may part its groups.
NUMBER = re.compile(r"[+(]?[A-Za-z]{0,3}\d[\d() ./-]*(?:[A-Za-z]\b)?")

_LOCAL = r"[\w.+'’-]*[^\W_]"
_DOT = r"(?:\.|\s?[\[(]dot[\])]\s?|\sdot\s)"
#: Common written forms: evidence for the field, never a condition.
FORMS: dict[str, re.Pattern[str]] = {
    "email": re.compile(
        rf"{_LOCAL}(?:\s?@\s?|\s?[\[(]at[\])]\s?|\sat\s(?=[\w-]+{_DOT}))[\w-]+(?:{_DOT}[\w-]+)*{_DOT}[a-z]{{2,}}\b", re.I
    ),
    "id_number": re.compile(
        r"(?<![\w.-])(?:\d{3}([- ])\d{2}\1\d{4}|[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Z]|\d{3}-\d{5}|[A-Z]{1,2}\d{6,9}|\d{9})(?![\w-])", re.I
    ),
    "phone": re.compile(
        r"(?<![\w.-])(?:\+\d{1,3}[ .-]?(?:\(\d{1,5}\)|\d{1,5})(?:[ .-]?\d{2,6}){1,4}|\(\d{3,5}\) ?\d{3}[-. ]?\d{3,4}"
        r"|\d{3}([-. ])\d{3}\1\d{4}|0\d{3,4}[ -]?\d{3}[ -]?\d{3,4}|\d{10})(?:,? ?(?:ext|x)\.? ?\d{1,5})?(?![\w-])",
        re.I,
    ),
}


def hash_of(text: str) -> int:
    """Stable number of a text."""
    return zlib.crc32(text.encode())


def bucket(base: np.ndarray, kind: int, extra: np.ndarray | int = 0) -> np.ndarray:
    """Stable bucket of a feature: a kind of evidence, its hash and a small number."""
    mixed = base.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (np.atleast_1d(np.asarray(extra, np.uint64)) * np.uint64(97) + np.uint64(kind)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) >> np.uint64(40)).astype(np.int64) % BUCKETS


def shape(token: str) -> str:
    if token.isdigit():
        return f"9{min(len(token), 11)}"
    if not token[0].isalpha():
        return token
    return "A" if len(token) == 1 else "X" if token.isupper() else "x" if token.islower() else "Xx" if token[1:].islower() else "xX"


KNOWN = "ku-"


def known(token: str, lexicon: frozenset[str]) -> int:
    """0 a word of the lexicon, 1 another word, 2 no word."""
    return 2 if not token[0].isalpha() else 0 if token.lower() in lexicon else 1


def bases(token: str) -> list[int]:
    """Hashes of what a token shows: word, shape, ends, length, and its length class."""
    low = shape(token) if token.isdigit() else token.lower()
    return [hash_of(low), hash_of(shape(token)), hash_of("<" + low[:3]), hash_of(low[-3:] + ">"), hash_of(low[-2:] + ">>"), min(len(low), 12)]


def role_buckets(base: np.ndarray, kind: np.ndarray, role: int, own: np.ndarray | int) -> np.ndarray:
    """(tokens, features): buckets of tokens of class ``kind`` seen from a token of class ``own``."""
    w, s, head, tail, end, size = (base[:, c] for c in range(6))
    at = role * 16
    if role > 5:
        return np.stack([bucket(w, at), bucket(w, at + 1, own + 1)], 1)
    out = [bucket(w, at), bucket(s, at + 3, kind + 1)]
    if role > 2:
        return np.stack(out, 1)
    out += [bucket(s, at + 1), bucket(kind, at + 2)]
    if role:
        out += [bucket(w, at + 4, own + 1), bucket(s, at + 5, own + 1 + 4 * (kind + 1))]
    else:
        out += [bucket(head, at + 6), bucket(tail, at + 7), bucket(end, at + 8), bucket(size, at + 9), bucket(np.minimum(size, 6), at + 10, kind + 1)]
    return np.stack(out, 1)


def group_buckets(number: str) -> np.ndarray:
    """Buckets of a whole number, written as its groups (``3-3-4``)."""
    sizes = number.split("-")
    total = sum(int(re.sub(r"\D", "", s) or 0) for s in sizes)
    texts = (number, f"n{len(sizes)}", f"d{min(total, 16)}", f"f{sizes[0]}", f"e{sizes[-1]}")
    return bucket(np.array([hash_of(x) for x in texts]), 250)


@lru_cache(maxsize=200_000)
def groups_of(number: str) -> str:
    """Digit groups of a number, with its letters and opening mark."""
    number = number.rstrip(" ./-(")
    head = "+" if number[0] == "+" else "(" if number[0] == "(" else "a" if number[0].isalpha() else ""
    zero = "0" if number.lstrip("+(").startswith("0") else ""
    tail = "a" if number[-1].isalpha() else ""
    return f"{head}{zero}" + "-".join(str(len(g)) for g in re.findall(r"\d+", number)) + tail


Span = tuple[str, int, int]


def spans_of(text: str) -> list[Span]:
    """Written forms: (label, start, end); forms inside e-mail addresses give way."""
    found: list[Span] = []
    for label in ("email", "phone", "id_number"):
        for m in FORMS[label].finditer(text):
            if all(m.end() <= s or m.start() >= e for _, s, e in found):
                found.append((label, m.start(), m.end()))
    return found


class Text:
    """Tokens of a text with their evidence."""

    __slots__ = ("tokens", "starts", "ends", "form", "first", "number", "joined", "spans")

    def __init__(self, text: str):
        found = [(m[0], m.start(), m.end()) for m in TOKEN.finditer(text)]
        self.tokens = [t for t, _, _ in found]
        self.starts = [s for _, s, _ in found]
        self.ends = [e for _, _, e in found]
        n = len(found)
        self.form, self.first, self.number = [0] * n, [0] * n, [""] * n
        #: Does the token continue the number of the token before it?
        self.joined = [0] * n
        self.spans = []
        if not any(c.isdigit() or c == "@" for c in text) and not re.search(r"\bat\b", text, re.I):
            return
        self.spans = spans_of(text)
        at = 0
        for label, start, end in sorted(self.spans, key=lambda x: x[1]):
            while at < n and self.starts[at] < start:
                at += 1
            k = at
            while k < n and self.starts[k] < end:
                self.form[k] = LABELS.index(label) - 1
                self.first[k] = self.form[k] if k == at else 0
                k += 1
        at = 0
        for m in NUMBER.finditer(text):
            while at < n and self.starts[at] < m.start():
                at += 1
            k, groups = at, groups_of(m[0])
            while k < n and self.starts[k] < m.end():
                self.number[k] = groups
                self.joined[k] = int(k > at)
                k += 1


def skip_edges(tokens: list[str]) -> list[tuple[int, int]]:
    """Distant tokens of a document that are the same or alike.

    Each token is joined to its next likeness only, so a long repetitive text
    has at most one skip edge per token.
    """
    edges, last = [], {}
    for i, token in enumerate(tokens):
        if len(token) < 3 or not token[0].isalpha():
            continue
        key = token.lower()[:5]
        if key in last and i - last[key] > 1:
            edges.append((last[key], i))
        last[key] = i
    return edges


def neighbours(is_word: np.ndarray, text: np.ndarray) -> np.ndarray:
    """(tokens, ROLES): which token plays each role for a token of the same text, -1 for none."""
    n = len(text)
    at, words = np.arange(n), np.flatnonzero(is_word)
    out = np.full((n, ROLES), -1)
    out[:, 0] = at
    before, after = np.searchsorted(words, at, "left"), np.searchsorted(words, at, "right")
    for role, lag in LAGS:
        k = at + lag
        ok = (k >= 0) & (k < n)
        out[ok, role] = k[ok]
    for role, lag in WORD_LAGS:
        k = before + lag if lag < 0 else after + lag - 1
        ok = (k >= 0) & (k < len(words))
        out[ok, role] = words[k[ok]]
    out[text[out] != text[:, None]] = -1
    return out


class Field:
    """Weights of the skip-chain field."""

    def __init__(self, lexicon: frozenset[str]):
        n = len(LABELS)
        self.lexicon = lexicon
        self.node = np.zeros((BUCKETS, n), np.float32)
        self.form = np.zeros((4, n))  # which form runs through the token (0: none)
        self.first = np.zeros((4, n))  # ... and starts at it
        self.chain = np.zeros((n, n))
        self.inside = np.zeros((n, n))  # added to the chain within one number
        self.skip = np.zeros((n, n))
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.table = np.zeros((0, len(KNOWN), ROLES, len(LABELS)))
        self.kinds = np.zeros(0, np.int64)
        self.numbers: dict[str, np.ndarray] = {}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("index", "table", "kinds", "numbers")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def _learn(self, tokens: list[str]) -> None:
        """What new tokens give to themselves and to neighbours: rows (class, role, label) of ``table``."""
        base = np.array([bases(t) for t in tokens])
        kind = np.array([known(t, self.lexicon) for t in tokens])
        own = range(len(KNOWN))
        rows = np.stack([np.stack([self.node[role_buckets(base, kind, role, np.full(len(kind), o))].sum(1) for role in range(ROLES)], 1) for o in own], 1)
        self.index.update((t, len(self.table) + k) for k, t in enumerate(tokens))
        self.table, self.kinds = np.concatenate([self.table, rows]), np.concatenate([self.kinds, kind])

    def number(self, groups: str) -> np.ndarray:
        found = self.numbers.get(groups)
        if found is None:
            found = self.numbers[groups] = self.node[group_buckets(groups)].sum(0)
        return found

    def unary(self, texts: list[Text]) -> np.ndarray:
        """Node potentials of all tokens of many texts, one below the other."""
        if len(self.index) > 200_000 or len(self.numbers) > 100_000:
            self._forget()
        if new := {t for x in texts for t in x.tokens if t not in self.index}:
            self._learn(sorted(new))
        rows = np.array([self.index[t] for x in texts for t in x.tokens])
        own = self.kinds[rows]
        out = self.form[[f for x in texts for f in x.form]] + self.first[[f for x in texts for f in x.first]]
        numbers = [(k, g) for k, g in enumerate(g for x in texts for g in x.number) if g]
        if numbers:
            out[[k for k, _ in numbers]] += np.stack([self.number(g) for _, g in numbers])
        near = neighbours(own < 2, np.repeat(np.arange(len(texts)), [len(x.tokens) for x in texts]))
        for role in range(ROLES):
            ok = np.flatnonzero(near[:, role] >= 0)
            out[ok] += self.table[rows[near[ok, role]], own[ok], role]
        return out


def viterbi(unary: np.ndarray, joined: np.ndarray, field: Field) -> np.ndarray:
    """Best labels of many documents of one length: (docs, length, labels)."""
    n, length, k = unary.shape
    back = np.zeros((n, length, k), np.int8)
    score = unary[:, 0]
    for t in range(1, length):
        step = score[:, :, None] + field.chain + joined[:, t, None, None] * field.inside
        back[:, t] = step.argmax(1)
        score = step.max(1) + unary[:, t]
    labels = np.zeros((n, length), np.int8)
    labels[:, -1] = score.argmax(1)
    for t in range(length - 1, 0, -1):
        labels[:, t - 1] = back[np.arange(n), t, labels[:, t]]
    return labels


def message_passing(unary: np.ndarray, joined: np.ndarray, lengths: list[int], edges: list[list[tuple[int, int]]], field: Field) -> tuple[np.ndarray, np.ndarray]:
    """Loopy max-product over chain and skip edges of many documents: (labels, settled).

    Each document stops when its own messages settle, whatever the others do.
    """
    k, n_docs = unary.shape[1], len(lengths)
    base = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    # Directed edges: (source, target, document, is it a skip edge, backwards).
    ca = np.concatenate([b + np.arange(n - 1) for b, n in zip(base, lengths)] or [np.zeros(0, int)]).astype(np.int64)
    cd = np.repeat(np.arange(n_docs), [max(n - 1, 0) for n in lengths])
    sa = np.array([b + x for b, e in zip(base, edges) for x, _ in e], dtype=np.int64)
    sb = np.array([b + y for b, e in zip(base, edges) for _, y in e], dtype=np.int64)
    sd = np.repeat(np.arange(n_docs), [len(e) for e in edges])
    source, target = np.concatenate([ca, ca + 1, sa, sb]), np.concatenate([ca + 1, ca, sb, sa])
    doc = np.concatenate([cd, cd, sd, sd])
    c, s = len(ca), len(sa)
    forward = field.chain + joined[ca + 1, None, None] * field.inside
    pair = np.concatenate([forward, forward.transpose(0, 2, 1), np.broadcast_to(field.skip, (2 * s, k, k))])
    reverse = np.concatenate([np.arange(c, 2 * c), np.arange(c), np.arange(2 * c + s, 2 * c + 2 * s), np.arange(2 * c, 2 * c + s)])
    sent = np.zeros((len(source), k))
    belief = unary.copy()
    open_docs = np.ones(n_docs, bool)
    most = ROUNDS + np.array(lengths)
    live = np.arange(len(source))
    for turn in range(int(most.max(initial=0))):
        into = belief[source[live]] - sent[reverse[live]]
        new = (into[:, :, None] + pair[live]).max(1)
        new -= new.max(1, keepdims=True)
        change = np.zeros(n_docs)
        np.maximum.at(change, doc[live], np.abs(new - sent[live]).max(1))
        # Damped, so that loops settle; damping grows for those that keep turning.
        share = 0.7 if turn < 60 else 0.3
        step = share * (new - sent[live])
        sent[live] += step
        np.add.at(belief, target[live], step)
        open_docs &= (change >= SETTLED) & (turn + 1 < most)
        if turn + 1 >= most.min() and not open_docs.any() or not open_docs.any():
            break
        live = live[open_docs[doc[live]]]
    final = np.zeros(n_docs)
    into = belief[source] - sent[reverse]
    new = (into[:, :, None] + pair).max(1)
    new -= new.max(1, keepdims=True)
    np.maximum.at(final, doc, np.abs(new - sent).max(1))
    return belief.argmax(1), final < 10 * SETTLED


# --- training -----------------------------------------------------------------


def lexicon_of(terms: list[str]) -> frozenset[str]:
    """Words that are no names: reference terms and the generator's own cues."""
    return frozenset({w.lower() for t in terms for w in TOKEN.findall(t) if w[0].isalpha()} | pii_corpus.cue_words())


def train(terms: list[str], texts: int = TRAINING_TEXTS, seed: int = 11, families: set[str] | None = None) -> Field:
    """Pseudo-likelihood training: each label given its true neighbours (Adagrad)."""
    r = random.Random(seed)
    terms = sorted({t for t in terms if t}) or ["nausea", "headache"]
    everything = sorted(lexicon_of(terms))
    # Words are left out of the lexicon in turn while training, as a stand-in
    # for the clinical and common words that no list holds.
    lexicons = [frozenset(w for k, w in enumerate(everything) if k % 7 != part) for part in range(7)]
    index: dict[str, int] = {}
    groups: dict[str, int] = {"": 0}
    rows, kinds, numbers, joined, forms, firsts, gold, left, right, skips, text_of = ([] for _ in range(11))
    for number in range(texts):
        text, spans = pii_corpus.sentence(r, terms, families)
        x = Text(text)
        base, n = len(rows), len(x.tokens)
        rows += [index.setdefault(t, len(index)) for t in x.tokens]
        kinds += [known(t, lexicons[number % 7]) for t in x.tokens]
        numbers += [groups.setdefault(g, len(groups)) for g in x.number]
        joined += x.joined
        text_of += [number] * n
        left += [base + i - 1 if i else -1 for i in range(n)]
        right += [base + i + 1 if i + 1 < n else -1 for i in range(n)]
        other = [-1] * n
        for a, b in skip_edges(x.tokens):
            other[a], other[b] = base + b, base + a
        skips += other
        forms += x.form
        firsts += x.first
        gold += [next((LABELS.index(k) for k, s, e in spans if s <= o < e), 0) for o in x.starts]
    n, k = len(rows), len(LABELS)
    rows, kinds = np.array(rows), np.array(kinds)
    base = np.array([bases(t) for t in index])
    near = neighbours(kinds < 2, np.array(text_of))
    columns = []
    for role in range(ROLES):
        at = near[:, role]
        found = role_buckets(base[rows[at]], kinds[at], role, kinds)
        found[at < 0] = BUCKETS
        columns.append(found)
    by_group = np.stack([group_buckets(g) if g else np.full(5, BUCKETS) for g in groups])
    ids = np.concatenate([*columns, by_group[numbers]], 1).astype(np.int32)
    forms, firsts, gold, left, right, skips = (np.array(x) for x in (forms, firsts, gold, left, right, skips))
    joined = np.array([*joined, 0], np.float64)[:, None]  # position n: behind the last token
    # Evidence met only a few times (invented words) says nothing: it gets no weight.
    used = np.flatnonzero(np.bincount(ids.ravel(), minlength=BUCKETS + 1)[:BUCKETS] >= LEAST_SEEN)
    place = np.full(BUCKETS + 1, len(used), np.int32)
    place[used] = np.arange(len(used))
    ids = place[ids]
    around = np.append(gold, k)  # label k: no such neighbour
    field = Field(lexicon_of(terms))
    node = np.zeros((len(used) + 1, k), np.float32)  # the last row stays 0
    form_w, first_w = field.form, field.first
    chain, inside, skip = (np.zeros((k + 1, k + 1)) for _ in range(3))
    weights = (node, form_w, first_w, chain, inside, skip)
    seen = [np.full(w.shape, 1e-3, w.dtype) for w in weights]
    order = np.random.default_rng(seed)
    near_detail = (gold > 0) | (around[left] % k > 0) | (around[right] % k > 0)
    weight = np.where(gold > 0, DETAIL_WEIGHT, np.where(near_detail, 1.0, 1 / PLAIN_PART)) / BATCH
    for _ in range(EPOCHS):
        # Plain words far outnumber details: each turn takes another part of them, with more weight.
        taken = np.flatnonzero(near_detail | (order.random(n) < PLAIN_PART))
        order.shuffle(taken)
        for batch in np.array_split(taken, max(1, len(taken) // BATCH)):
            b, f, s, y = ids[batch], forms[batch], firsts[batch], gold[batch]
            l, rr, o = around[left[batch]], around[right[batch]], around[skips[batch]]
            # Neighbours are hidden half of the time, or their labels alone would explain a token.
            hidden = order.random(len(batch)) < HIDDEN
            l, rr, o = (np.where(hidden, k, x) for x in (l, rr, o))
            jl, jr = joined[batch], joined[batch + 1]
            score = node[b].sum(1) + form_w[f] + first_w[s] + chain[l, :k] + chain[:k, rr].T + skip[o, :k]
            score += jl * inside[l, :k] + jr * inside[:k, rr].T
            p = np.exp(score - score.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p *= weight[batch, None]
            grads = [np.zeros_like(w) for w in weights]
            flat = b.ravel()
            for c in range(k):
                grads[0][:, c] = np.bincount(flat, np.repeat(p[:, c], b.shape[1]), len(used) + 1)
            np.add.at(grads[1], f, p)
            np.add.at(grads[2], s, p)
            np.add.at(grads[3][:, :k], l, p)
            np.add.at(grads[3].T[:, :k], rr, p)
            np.add.at(grads[4][:, :k], l, p * jl)
            np.add.at(grads[4].T[:, :k], rr, p * jr)
            np.add.at(grads[5][:, :k], o, p)
            for w, g, h in zip(weights, grads, seen):
                g = g + DECAY * w
                h += g * g
                w -= RATE * g / np.sqrt(h)
            node[-1] = 0
            for w in (chain, inside, skip):
                w[k], w[:, k] = 0, 0
    field.node[used] = node[:-1]
    field.chain, field.inside, field.skip = chain[:k, :k], inside[:k, :k], (skip + skip.T)[:k, :k] / 2
    return field


@lru_cache(maxsize=4)
def trained(terms: tuple[str, ...], texts: int = TRAINING_TEXTS, seed: int = 11) -> Field:
    """The field of these terms, trained once in a process."""
    return train(list(terms), texts, seed)


# --- prediction ---------------------------------------------------------------

TITLES = frozenset("dr mr mrs ms miss prof nurse gp sr md rn herr frau".split())


def _piece(label: str, x: Text, a: int, b: int) -> Span | None:
    """Tokens a..b as one detail, without marks and titles around it; None if nothing is left."""
    opening = "+(" if label == "phone" else ""
    tokens = x.tokens
    while a < b and not (tokens[a][0].isalnum() or tokens[a] in opening) or a < b and label == "name" and (not tokens[a][0].isalpha() or tokens[a].lower() in TITLES):
        a += 1
    while b > a and not tokens[b - 1][0].isalnum():
        b -= 1
    if a >= b:
        return None
    n_digits = sum(len(t) for t in tokens[a:b] if t.isdigit())
    letters = any(t[0].isalpha() and len(t) > 1 for t in tokens[a:b])
    # What any detail of the kind must hold, however it is written.
    whole = {"name": letters, "email": b - a > 2, "phone": n_digits > 4, "id_number": n_digits > 3, "address": n_digits > 0 and letters}
    return (label, x.starts[a], x.ends[b - 1]) if whole[label] else None


def details(x: Text, labels: np.ndarray) -> list[Span]:
    """Labelled runs as details; a written form inside a run bounds its own detail."""
    out: list[Span] = []
    i, n = 0, len(x.tokens)
    while i < n:
        j = i
        while j < n and labels[j] == labels[i]:
            j += 1
        if labels[i]:
            label, at = LABELS[labels[i]], i
            for k, s, e in sorted(x.spans, key=lambda f: f[1]) if x.spans else ():
                if k != label or s >= x.ends[j - 1] or e <= x.starts[i]:
                    continue
                a = next(t for t in range(n) if x.starts[t] >= s)
                b = next((t for t in range(a, n) if x.starts[t] >= e), n)
                # A form counts when the field agrees on most of its tokens.
                if 2 * sum(labels[t] == labels[i] for t in range(a, b)) < b - a:
                    continue
                if at < a and (piece := _piece(label, x, at, min(a, j))):
                    out.append(piece)
                out.append((label, s, e))
                at = max(at, b)
            if at < j and (piece := _piece(label, x, at, j)):
                out.append(piece)
        i = j
    return sorted(set(out), key=lambda f: f[1])


def predict(field: Field, texts: list[str | None]) -> list[tuple[list[Span], bool]]:
    """Per text its details (label, start, end) and whether its messages settled."""
    out: list[tuple[list[Span], bool]] = [([], True)] * len(texts)
    parsed = [(i, x) for i, x in ((i, Text(t)) for i, t in enumerate(texts) if t) if x.tokens]
    if not parsed:
        return out
    unary = field.unary([x for _, x in parsed])
    stops = np.cumsum([len(x.tokens) for _, x in parsed])
    by_length: dict[int, list[tuple[int, Text, np.ndarray]]] = {}
    looped: list[tuple[int, Text, np.ndarray, list[tuple[int, int]]]] = []
    for (i, x), stop in zip(parsed, stops):
        own = unary[stop - len(x.tokens) : stop]
        if edges := skip_edges(x.tokens):
            looped.append((i, x, own, edges))
        else:
            by_length.setdefault(len(x.tokens), []).append((i, x, own))
    for group in by_length.values():
        for (i, x, _), labels in zip(group, viterbi(np.stack([u for _, _, u in group]), np.array([x.joined for _, x, _ in group]), field)):
            if labels.any():
                out[i] = (details(x, labels), True)
    if looped:
        lengths = [len(x.tokens) for _, x, _, _ in looped]
        joined = np.array([j for _, x, _, _ in looped for j in x.joined])
        labels, settled = message_passing(np.concatenate([u for _, _, u, _ in looped]), joined, lengths, [e for _, _, _, e in looped], field)
        for (i, x, _, _), stop, ok in zip(looped, np.cumsum(lengths), settled):
            out[i] = (details(x, labels[stop - len(x.tokens) : stop]), bool(ok))
    return out


def redact(text: str | None, found: list[Span]) -> str | None:
    """Typed placeholders in place of the details."""
    for label, start, end in reversed(found):
        text = f"{text[:start]}<{label.upper()}>{text[end:]}"
    return text


def find(rows: DataFrame, keys: list[str], text: str, terms: list[str]) -> DataFrame:
    """(keys, details array, redacted, settled): details of every row's text."""
    spark = rows.sparkSession
    field = spark.sparkContext.broadcast(trained(tuple(sorted(set(terms)))))
    narrow = rows.select(*keys, F.col(text).cast("string").alias("_text"))
    schema = ", ".join(f"{c} {narrow.schema[c].dataType.simpleString()}" for c in keys)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes, texts = pd.factorize(batch["_text"], use_na_sentinel=False)
            texts = [t if isinstance(t, str) else None for t in texts]
            found = predict(field.value, texts)
            spans = [[{"pii_type": k, "start_pos": s, "end_pos": e} for k, s, e in f] for f, _ in found]
            clean = [redact(t, f) for t, (f, _) in zip(texts, found)]
            part = batch[keys].copy()
            part["details"] = [spans[c] for c in codes]
            part["redacted"] = [clean[c] for c in codes]
            part["settled"] = [found[c][1] for c in codes]
            yield part

    return narrow.mapInPandas(
        scan, f"{schema}, details array<struct<pii_type:string,start_pos:int,end_pos:int>>, redacted string, settled boolean"
    )
