"""Operators of the text problems against brute force, round trips and edge cases."""

import pickle
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilframe.llm import canonical, leakage, mixing, pii, pii_corpus, truncation
from veilframe.llm.queries import VOCABULARY

# --- canonical list --------------------------------------------------------------

TERMS = [
    (1, "Ankle blister", None), (2, "Hypertension", "HTN|high blood pressure"), (3, "Hypotension", "low blood pressure"),
    (4, "Gastrooesophageal reflux disease", "GERD"), (5, "Asthma", None), (6, "Shoulder laceration", None), (7, "Pulmonary embolism", "PE"),
    (8, "Influenza", "flu"), (9, "Wrist haematoma", None), (10, "Restless legs syndrome", "RLS"), (11, "Dry eye", None), (12, "Vomiting", None),
]
VALUES = [
    ("ankle blistr", 1), ("blister of ANKLE", 1), ("Ankle_blister", 1), ("ankleblister", 1), ("hypertnsion", 2), ("hypotenson", 3),
    ("high  blood oressure", 2), ("azma", 5), ("shou. lace.", 6), ("PE in am", 7), ("wrist hematoma", 9), ("Reestlses kegs syndome", 10),
    ("St1ff knee", -1), ("knee blister", -1), ("calf laceration.76", -1), ("Grade 1 sunburn", -1), ("unknown 31", -1), ("", -1), (None, -1),
    ("drry eye", 11), ("h/o flu", 8), ("x " * 20_000 + "asthma", 5), ("asthma asthma", 5), ("asthma, dry eye", -1), ("hypertension hypotension", 2),
]


@pytest.mark.parametrize(("value", "entry"), VALUES)
def test_value_means_entry(value, entry):
    assert canonical.Canonical(TERMS).best(value) == entry


def _distance(a, b):
    d = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_returns_exactly_the_words_within_distance():
    r = random.Random(4)
    words = sorted({"".join(r.choice("abcd") for _ in range(r.randrange(2, 8))) for _ in range(80)})
    trie = canonical.Trie()
    for w in words:
        trie.add(w)
    for _ in range(80):
        q = "".join(r.choice("abcd") for _ in range(r.randrange(1, 8)))
        want = {w: _distance(q, w) for w in words if _distance(q, w) <= 2}
        assert {trie.words[k]: int(d) for k, d in trie.within(q, 2).items()} == want
    many = ["".join(r.choice("abcd") for _ in range(r.randrange(0, 9))) for _ in range(50)]
    for q, found in zip(many, trie.within_many(many, [k % 4 for k in range(50)])):
        assert found == trie.within(q, many.index(q) % 4) or many.count(q) > 1


def test_mapping_over_rows_and_blocks(spark, monkeypatch):
    ref = spark.createDataFrame(TERMS, "term_id long, pref_term string, alt_terms string")
    data = [(i, v, None, "x") for i, (v, _) in enumerate(VALUES)] + [(99, None, "HTN", "x"), (98, "zzz", "Asthma ", "x")]
    df = spark.createDataFrame(data, "rec_id long, term string, decod string, score string")
    left = canonical.uncoded(df, "decod", ref, "pref_term")
    want = {i: e for i, (_, e) in enumerate(VALUES)} | {99: 2, 98: 5}
    args = (["rec_id"], ["term", "decod"], ref, "term_id", "pref_term", "alt_terms")
    assert {r.rec_id: r.entry_id for r in canonical.map_values(left, *args).collect()} == want
    for size in (7, 1, 3):
        monkeypatch.setattr(canonical, "BLOCK_ENTRIES", size)
        assert {r.rec_id: r.entry_id for r in canonical.map_values(left, *args).collect()} == want
    twice = left.where("rec_id = 99").unionByName(left.where("rec_id = 99"))
    assert [r.entry_id for r in canonical.map_values(twice, *args).collect()] == [2, 2]
    assert canonical.map_values(left.limit(0), *args).count() == 0
    exact = spark.createDataFrame([(1, "a", "Asthma", "x"), (2, "a", "asthma", "x")], df.schema)
    assert [r.rec_id for r in canonical.uncoded(exact, "decod", ref, "pref_term").collect()] == [2]


# --- personal information -----------------------------------------------------------


PII_TERMS = [t for _, name, alts in TERMS for t in [name, *(alts or "").split("|")] if t]
HELD_OUT = {"name:told", "name:caller", "said:present", "phone:call", "email:from", "address:event", "address:sent", "id:verb"}


@pytest.fixture(scope="module")
def field():
    """A field that never saw the cues of HELD_OUT."""
    return pii.train(PII_TERMS, texts=16000, families=set(pii_corpus.FAMILIES) - HELD_OUT)


def test_held_out_families(field):
    r = random.Random(77)
    right, wrong, missed = Counter(), Counter(), Counter()
    cases = [pii_corpus.sentence(r, ["asthma", "ankle blister", "influenza"], HELD_OUT) for _ in range(2500)]
    for (_, gold), (found, _) in zip(cases, pii.predict(field, [t for t, _ in cases])):
        gold, found = {(k, s) for k, s, _ in gold}, {(k, s) for k, s, _ in found}
        right.update(k for k, _ in gold & found)
        wrong.update(k for k, _ in found - gold)
        missed.update(k for k, _ in gold - found)
    for kind in pii.LABELS[1:]:
        precision, recall = right[kind] / (right[kind] + wrong[kind]), right[kind] / (right[kind] + missed[kind])
        print(f"held out {kind}: precision {precision:.3f}, recall {recall:.3f}")
        assert recall >= 0.85 and precision >= 0.85, (kind, precision, recall)
    assert sum(right.values()) / (sum(right.values()) + sum(missed.values())) >= 0.9


def test_generator_holds_no_written_numbers():
    source = open(pii_corpus.__file__, encoding="utf-8").read()
    assert [n for n in re.findall(r"(?<![\d_])\d{5,}", source) if set(n) != {"9"} and n != "0123456789"] == []
    assert not re.search(r"\d{3}-\d{2}-\d{4}", source.replace("999-99-9999", ""))


@pytest.mark.parametrize(
    ("text", "kind", "start"),
    [
        ("Asthma; kit no. 512-46-7730", None, 0), ("Asthma (SSN 512-46-7730)", "id_number", 12), ("patient called from (731) 555-0142 re asthma", "phone", 20),
        ("asthma (write to a.b at inbox dot test)", "email", 17), ("asthma; visited at Flat 3, 12 Ostwick Road", "address", 19), ("lives at 12 Ostwick Crescent, asthma", "address", 9),
        ("Dry eye, seen by Dr. Brenko Talvi", "name", 21), ("asthma", None, 0), ("", None, 0), (None, None, 0), ("   ", None, 0), ("...", None, 0),
    ],
)
def test_details(field, text, kind, start):
    ((found, settled),) = pii.predict(field, [text])
    assert [(k, s) for k, s, _ in found] == ([(kind, start)] if kind else []) and settled


def test_a_detail_needs_no_written_form(field):
    text = "asthma, passport no X41Y77Z02"
    assert pii.spans_of(text) == []
    assert [(k, s) for k, s, _ in pii.predict(field, [text])[0][0]] == [("id_number", 20)]


def test_redaction_keeps_the_rest(field):
    text = "asthma, phone 801-555-0161 or 453-555-0168"
    ((found, _),) = pii.predict(field, [text])
    assert pii.redact(text, found) == "asthma, phone <PHONE> or <PHONE>"


def test_message_passing_equals_viterbi_on_chains(field):
    r = np.random.default_rng(0)
    lengths, unary, joined = [2, 5, 9, 1, 40], [], []
    for n in lengths:
        unary.append(r.normal(size=(n, len(pii.LABELS))) * 3)
        joined.append(np.array([0, *r.integers(0, 2, n - 1)]))
    labels, settled = pii.message_passing(np.concatenate(unary), np.concatenate(joined), lengths, [[]] * 5, field)
    assert settled.all()
    assert (labels == np.concatenate([pii.viterbi(u[None], j[None], field)[0] for u, j in zip(unary, joined)])).all()


def test_message_passing_of_a_document_does_not_depend_on_others(field):
    texts = ["seen by Brenko Talvi, asthma, told by Talvi again", "asthma asthma asthma asthma", "Talvi, asthma; " * 50 + "Talvi"]
    alone = [pii.predict(field, [t])[0] for t in texts]
    assert pii.predict(field, texts) == alone


def test_find_over_rows(spark, field, monkeypatch):
    monkeypatch.setattr(pii, "trained", lambda terms: field)
    long = "asthma " * 3000 + "(write to a.b@inbox.test)"
    df = spark.createDataFrame([(1, "asthma (write to a.b@inbox.test)", 5), (1, "asthma (write to a.b@inbox.test)", 5), (2, None, 5), (3, long, 5)], "rec_id long, term string, details int")
    got = sorted((r.rec_id, len(r.details), r.settled) for r in pii.find(df, ["rec_id"], "term", ["asthma"]).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 0, True), (3, 1, True)]
    assert pii.find(df.limit(0), ["rec_id"], "term", ["asthma"]).count() == 0


# --- leakage -------------------------------------------------------------------------


def _shared(a, b):
    a, b = leakage.words(a), leakage.words(b)
    grams = {tuple(b[i : i + leakage.RUN]) for i in range(len(b) - leakage.RUN + 1)}
    return any(tuple(a[i : i + leakage.RUN]) in grams for i in range(len(a) - leakage.RUN + 1))


def test_leaks_match_brute_force(spark):
    r = random.Random(6)
    vocabulary = [f"w{i}" for i in range(25)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([10, 30, 60])))) for i in range(50)]
    documents = []
    for d in range(120):
        body = [r.choice(vocabulary) for _ in range(r.randrange(0, 150))]
        if d % 3 == 0:
            words = r.choice(items)[1].split()
            n = r.choice([14, 15, 16, 30])
            at, to = r.randrange(max(1, len(words) - n)), r.randrange(len(body) + 1)
            body[to:to] = [w.upper() if d % 2 else w + "," for w in words[at : at + n]]
        documents.append((d, " ".join(body), 1))
    documents += [(500, None, 1), (501, "", 1), (502, documents[3][1], 1), (503, "q " * 30_000 + items[1][1] + " q" * 30_000, 1)]
    df = spark.createDataFrame(documents, "doc_id long, text string, d int")
    index = spark.createDataFrame(items + [(900, None)], "item_id long, text string")
    want = sorted((d, i) for d, t, _ in documents if t for i, x in items if _shared(t, x))
    got = sorted((r.doc_id, r.item_id) for r in leakage.leaks(df, index, "doc_id", "text", "item_id", "text").collect())
    assert got == want and any(d == 503 for d, _ in got)
    assert leakage.leaks(df.limit(0), index, "doc_id", "text", "item_id", "text").count() == 0
    assert leakage.leaks(df, index.limit(0), "doc_id", "text", "item_id", "text").count() == 0


def test_wand_retrieves_every_item_over_its_threshold():
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (k + 1) for k in range(60)]
    index = leakage.Bm25Index([(i, " ".join(r.choices(vocabulary, weights, k=r.choice([15, 20, 40, 90])))) for i in range(300)])
    for _ in range(60):
        terms = {index.vocab[w] for w in r.choices(vocabulary, weights, k=r.choice([5, 20, 60])) if w in index.vocab}
        score = [0.0] * 300
        for w in terms:
            for k, s in zip(index.posts[w], index.scores[w]):
                score[k] += s
        want = [k for k in range(300) if score[k] >= index.threshold[k]]
        got = index.retrieve(terms)
        near = {k for k in range(300) if abs(score[k] - index.threshold[k]) < 1e-9}
        assert set(got) - near == set(want) - near and len(got) == len(set(got))


def test_index_stays_small():
    r = random.Random(3)
    items = [(i, " ".join(f"word{r.randrange(5000)}" for _ in range(100))) for i in range(1500)]
    assert len(pickle.dumps(leakage.Bm25Index(items))) < 3 * sum(len(t) for _, t in items)


def test_leaks_in_item_blocks(spark, monkeypatch):
    text = " ".join(f"t{i}" for i in range(40))
    index = spark.createDataFrame([(i, text + f" end{i}") for i in range(5)], "item_id long, text string")
    monkeypatch.setattr(leakage, "BLOCK_BYTES", 300)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert leakage.leaks(df, index, "doc_id", "text", "item_id", "text").count() == 5


# --- mixing ----------------------------------------------------------------------------


def _mix(spark, sizes, targets, parts=5, **options):
    documents = spark.createDataFrame([(i, s, "word " * n, 1) for i, (s, n) in enumerate(sizes)], "doc_id long, source string, text string, whole int").repartition(parts)
    wanted = spark.createDataFrame(targets, "source string, target_share double, max_repeat int")
    drawn, planned = mixing.mix(documents, wanted, VOCABULARY, **options)
    return {r.source: r for r in mixing.shares(drawn, planned).collect()}, drawn.collect()


def test_shares_are_met_within_a_document(spark):
    r = random.Random(1)
    sizes = [("a", r.randrange(5, 60)) for _ in range(400)] + [("b", r.randrange(5, 60)) for _ in range(80)] + [(None, 10)] * 5 + [("x", 10)] * 5
    sizes += [("b", 0)]
    shares, drawn = _mix(spark, sizes, [("a", 0.5, 1), ("b", 0.3, 3), ("none", 0.2, 4)])
    total = sum(x.n_tokens for x in shares.values())
    for s, want in (("a", 0.625), ("b", 0.375)):
        assert abs(shares[s].n_tokens - want * total) < 150
        assert shares[s].most_copies <= shares[s].max_repeat
    assert shares["none"].n_tokens == 0 and {d.source for d in drawn} == {"a", "b"}
    assert len({d.doc_id for d in drawn}) == len(drawn)
    again, _ = _mix(spark, sizes, [("a", 0.5, 1), ("b", 0.3, 3), ("none", 0.2, 4)], total=500.0)
    assert abs(sum(x.n_tokens for x in again.values()) - 500) < 150


def test_mixture_does_not_depend_on_the_layout_of_files(spark):
    r = random.Random(2)
    sizes = [(s, r.randrange(5, 90)) for s in "abc" * 60]
    targets = [(s, 1 / 8, 2) for s in "abc"] + [(f"none{i}", 1 / 8, 2) for i in range(5)]
    first, drawn = _mix(spark, sizes, targets, parts=2, total=6000.0)
    assert sorted(map(tuple, drawn)) == sorted(map(tuple, _mix(spark, sizes, targets, parts=9, total=6000.0)[1]))
    # More targets than open documents: every source still ends within a document of its share.
    assert all(abs(first[s].n_tokens - 2000) <= 90 for s in "abc")


def test_pivot_keeps_mass_and_expectation():
    hits = [0, 0, 0]
    for seed in range(4000):
        pivot, copies = mixing.Pivot(0, seed), {}
        for doc, (tokens, p) in enumerate([(10, 0.5), (20, 0.25), (10, 0.5)]):
            copies |= {d: extra for d, extra, _ in pivot.meet(doc, tokens, p)}
        if pivot.open:
            copies[pivot.open[0]] = int(mixing.uniform(pivot.open[0], 99, seed) < pivot.open[2])
        for k in range(3):
            hits[k] += copies[k]
    assert all(abs(h / 4000 - p) < 0.03 for h, p in zip(hits, (0.5, 0.25, 0.5)))


def test_mixing_empty(spark):
    shares, drawn = _mix(spark, [("z", 3)], [("a", 1.0, 2)])
    assert drawn == [] and shares["a"].n_docs == 0


# --- truncation --------------------------------------------------------------------------


def _corpus():
    r = random.Random(9)
    names = ["haemoglobin", "creatinine", "glucose", "platelets", "albumin"]
    out = []
    for i in range(300):
        body = " ".join(f"The {r.choice(names)} value of {r.randrange(10, 99)} looks out of line with visit {r.randrange(1, 9)}." for _ in range(r.randrange(3, 8)))
        out.append([i, "note" if i % 2 else "lab", body])
    return out


def test_cut_and_whole_texts(spark):
    docs = _corpus()
    for i in range(0, 40, 2):
        docs[i][2] = docs[i][2][:150]  # a field limit of the lab source
    want = {i for i in range(0, 40, 2) if not docs[i][2].rstrip().endswith(".")}
    docs[41][2] = docs[41][2][: docs[41][2].rindex("looks") + 3]
    docs[43][2] = docs[43][2][: docs[43][2].rindex("out of")] + "out �"
    docs[45][2] += "\nSigned, monitor 7"
    docs[47][2] += "\nSigned, monitor 9"
    docs[49][2] += "\nSigned, monitor 12"
    docs[51][2] = docs[51][2][: docs[51][2].rindex("value")]
    docs[53][2] += "<p"
    want |= {41, 43, 51, 53}
    docs += [[900, None, docs[41][2]], [901, "note", None], [902, "note", "   "], [903, "note", docs[41][2]]]
    want |= {900, 903}
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, source string, text string, hash int, n int")
    assert {r.doc_id for r in truncation.truncated(df).collect()} == want
    rates = {r.source: (r.n_docs, r.n_cut) for r in truncation.truncation_rates(df, truncation.truncated(df)).collect()}
    assert rates[None] == (1, 1)


def test_truncation_of_empty_and_long(spark):
    df = spark.createDataFrame([(1, "a", "x" * 200_000)], "doc_id long, source string, text string")
    assert truncation.truncated(df).count() == 0
    assert truncation.truncated(df.limit(0)).count() == 0


def test_long_blanks_and_tokens_before_the_end_change_nothing(spark):
    docs = _corpus()
    docs[41][2] = docs[41][2][: docs[41][2].rindex("looks") + 3] + " " * 500
    docs[43][2] += " " + "y" * 900 + " The glucose val"
    df = spark.createDataFrame([tuple(d) for d in docs], "doc_id long, source string, text string")
    assert {r.doc_id for r in truncation.truncated(df).collect()} == {41, 43}


def test_trie_nodes_are_the_proper_prefixes(spark):
    words = spark.createDataFrame([("abc", 2), ("abd", 3), ("a", 5), ("b" * 70, 1)], "fragment string, n long")
    got = {r.fragment: r.n_below for r in truncation.trie(words, []).collect()}
    assert got == {"a": 5, "ab": 5}
    assert truncation.trie(words.withColumn("k", F.lit(1)), ["k"]).count() == 2
