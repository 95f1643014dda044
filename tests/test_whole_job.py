"""Queries and operators over all rows, where SQL can only check a slice."""

import re
from collections import Counter

import pytest

from veilframe.functions.text import NA_CELLS
from veilframe.operators import protocol
from veilframe.operators.vault import Vault
from veilframe.plans.contract import Anchor, Contract, Domain, Risk, Rule
from veilframe.plans.pipeline import ContractMismatch, Pipeline
from veilframe.queries import engine

EMAIL = re.compile(r"\b[\w.+-]+@[\w-]+\.[\w.-]{2,}\b")


def test_no_row_is_left_out(spark, tmp_path):
    terms = [
        "MYALGIA; Ilsebet Águaett <brackmont34@mail.sitebox.example>", "vomiting; T. Sørkaven <nymova77@inbox.test>",
        "näusea müller@klinik.example!", "Flu", "--", "???", "RLS", "PE", "患者头痛恶心呕吐", "Straße 12", None, "", "plain headache",
    ]
    rows = list(enumerate(terms))
    for name, column in (("ae", "aeterm"), ("mh", "mhterm")):
        spark.createDataFrame(rows, f"rec_id long, {column} string").write.parquet(f"{tmp_path}/{name}.parquet")
    units = [(i, u, "1") for i, u in enumerate([*NA_CELLS, None, "g/L", " NA"])]
    spark.createDataFrame(units, "rec_id long, lborresu string, lborres string").write.parquet(f"{tmp_path}/lb.parquet")
    d = str(tmp_path)

    got = {r.rec_id: r.aeterm for r in engine.QUERIES["redact_email"](spark, d).collect()}
    assert got == {i: t if t is None else EMAIL.sub("<EMAIL_ADDRESS>", t) for i, t in rows}

    got = {r.rec_id: (r.norm, r.term_key) for r in engine.QUERIES["text_keys"](spark, d).collect()}
    keys = lambda t: (re.sub("[^a-z0-9]+", " ", t.lower()).strip(" "), re.sub(r"\s+", " ", t).strip(" ").lower())
    assert got == {i: (None, None) if t is None else keys(t) for i, t in rows}

    shape = lambda t: t if t is None else "".join("9" if c.isdigit() else "A" if c.isalpha() else c for c in t.strip(" "))
    got = {r["shape"]: r.n for r in engine.QUERIES["dummy_text_shape"](spark, d).collect()}
    assert got == Counter(shape(t) for t in terms)

    got = {r.rec_id: r.unit for r in engine.QUERIES["na_cells"](spark, d).collect()}
    assert got == {i: None if u in NA_CELLS else u for i, u, _ in units}


@pytest.mark.parametrize("mode", ["subjects", "rows", "values"])
def test_moved_records_carry_the_values_of_their_new_subject(spark, tmp_path, mode):
    dm = [(f"S{i}", f"0{i}", f"X{i % 3}", f"2024-01-{10 + i:02d}" if i != 4 else None, "DM") for i in range(6)]
    ae = [(f"S{i % 6}", f"0{i % 6}", f"X{i % 6 % 3}", 1 + i // 6, f"t{i}", f"2024-02-{1 + i:02d}", "AE") for i in range(18)]
    study = {
        "DM": spark.createDataFrame(dm, "USUBJID string, SITEID string, COUNTRY string, RFSTDTC string, DOMAIN string"),
        "AE": spark.createDataFrame(ae, "USUBJID string, SITEID string, COUNTRY string, AE_NO int, AETERM string, AESTDTC string, DOMAIN string"),
    }
    domains = [Domain(n, [Rule(c, "retain") for c in df.columns], "USUBJID", reassign=n == "AE", reassign_mode=mode) for n, df in study.items()]
    contract = Contract("1", "demo", "lds", Anchor("DM", "USUBJID", "RFSTDTC"), Risk("DM"), domains)
    out = Pipeline(contract, Vault(spark, str(tmp_path / "v"), bytes(range(32)))).run(study, unreviewed=True)
    got = out.tables["AE"].collect()
    rows = {r[0]: r for r in dm}
    assert len(got) == 18 and all((r.SITEID, r.COUNTRY, r.DOMAIN) == (*rows[r.USUBJID][1:3], "AE") for r in got)
    report = out.manifest["reassignment"]["AE"]
    assert report["mirrors"] == ["COUNTRY", "SITEID"] and report["n_rows"] == 18 and report["n_unanchored"] == 1
    if mode == "subjects":
        was = {r[4]: r for r in ae}
        assert all(was[r.AETERM][0] != r.USUBJID for r in got) and report["n_kept_dates"] == 2
        kept = {was[r.AETERM][0] for r in got if was[r.AETERM][5] == r.AESTDTC}
        assert len(kept) == 2 and "S4" in kept
    else:
        for s in {r.USUBJID for r in got}:
            assert sorted(r.AE_NO for r in got if r.USUBJID == s) == list(range(1, sum(r.USUBJID == s for r in got) + 1))


def test_proposals_reach_labels_aliases_and_lists(spark):
    blocks = [
        ("a", 0, "Protocol Number:"), ("a", 1, "QX77/2024"), ("a", 2, "Sponsor\n\nNorthwind Labs"),
        ("a", 3, "zentolimab (ZTM) and other (XYZ)"), ("a", 4, "such as ketoconazole, fluconazole, nefazodone or verapine"),
        ("b", 0, "Investigator: John Smith, Mary Jones and Wei Zhang"), ("b", 1, "apples, pears, plums"),
    ]
    df = spark.createDataFrame(blocks, "path string, block_no int, text string")
    got = {(r.category, r.term_key) for r in protocol.propose(df, "path", "text", "block_no").collect()}
    assert {("study_id", "qx77/2024"), ("sponsor", "northwind labs"), ("drug", "ztm"), ("drug", "nefazodone"), ("person", "mary jones"), ("person", "wei zhang")} <= got
    assert not {("drug", "xyz"), ("drug", "apples"), ("drug", "plums")} & got


def test_blinding_sees_every_treatment_or_stops(spark, tmp_path):
    contract = Contract("1", "demo", "lds", Anchor("DM", "U", "D"), Risk("DM"), [Domain("DM", [Rule("ARM", "label_map", entity="treatment")])])
    pipeline = Pipeline(contract, Vault(spark, str(tmp_path / "v"), bytes(range(32))))
    arms = [(" " * i + "Placebo",) for i in range(900)] + [("Drugamab",), (None,)]
    assert pipeline._blind_terms({"DM": spark.createDataFrame(arms, "ARM string")}) == ["drugamab"]
    with pytest.raises(ContractMismatch):
        pipeline._blind_terms({"DM": spark.createDataFrame([(f"drug{i}",) for i in range(703)], "ARM string")})
