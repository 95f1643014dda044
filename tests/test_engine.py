"""Operators with state, contracts and whole runs."""

import json
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from veilframe.operators import blinding, detect, protocol, reassign, risk, textcheck, treatments
from veilframe.operators.vault import DESTROY, Vault, VaultError, dummy_column
from veilframe.plans import review
from veilframe.plans.contract import Anchor, Contract, ContractError, Domain, Risk, Rule
from veilframe.plans.pipeline import ContractMismatch, Pipeline, RiskTargetMissed, selfcheck
from veilframe.sources import keys, study_io, workbook
from veilframe.streaming import drops

KEY = bytes(range(32))


@pytest.fixture
def vault(spark, tmp_path):
    return Vault(spark, str(tmp_path / "vault"), KEY)


def _ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id string")


# --- vault -----------------------------------------------------------------------


def test_surrogates_are_stable_unique_and_not_originals(spark, vault, tmp_path):
    ids = [f"S-{i:04d}" for i in range(60)]
    first = dict(vault.surrogates(_ids(spark, [*ids, None, ids[0]]), "subject").collect())
    assert len(first) == 60 == len(set(first.values())) and not set(first.values()) & set(ids)
    assert all(s[:2].isalpha() is False and s[1] == "-" and s[2:].isdigit() for s in first.values())
    again = Vault(spark, str(tmp_path / "vault"), KEY)
    more = dict(again.surrogates(_ids(spark, [*ids, "S-9999"]), "subject").collect())
    assert {k: more[k] for k in first} == first and more["S-9999"] not in first.values()
    other = dict(again.surrogates(_ids(spark, ids), "site").collect())
    assert other != first


def test_wrong_key_and_small_shapes(spark, vault, tmp_path):
    with pytest.raises(VaultError):
        Vault(spark, str(tmp_path / "vault"), bytes(32))
    with pytest.raises(VaultError, match="too few"):
        vault.surrogates(_ids(spark, ["7"]), "site")
    got = vault.surrogates(_ids(spark, ["7"]), "site", "SITE").first().surrogate
    assert got.startswith("SITE-") and len(got) == 13


def test_reverse_is_logged(spark, vault):
    s = vault.surrogates(_ids(spark, ["S-0001"]), "subject").first().surrogate
    with pytest.raises(VaultError):
        vault.reverse([s], "subject", "me", " ")
    assert vault.reverse([s, "nobody"], "subject", "me", "safety query").where("original IS NOT NULL").first().original == "S-0001"
    log = vault.access_log().collect()
    assert Counter(r.found for r in log) == {True: 1, False: 1}
    assert {r.kind: r.n for r in vault.stats().collect()}["access_log"] == 2


def test_offsets_labels_and_destroy(spark, vault):
    a = dict(vault.offsets(_ids(spark, ["x", "y", None])).collect())
    assert dict(vault.offsets(_ids(spark, ["x", "y", "z"])).collect()) | a == dict(vault.offsets(_ids(spark, ["x", "y", "z"])).collect())
    assert all(180 <= abs(d) <= 540 for d in a.values())
    labels = dict(vault.labels(_ids(spark, ["Drug", " drug ", "Placebo", "keep"]), "treatment", "ARM", ("KEEP",)).collect())
    assert sorted(labels.values()) == ["ARM A", "ARM B"] and set(labels) == {"DRUG", "PLACEBO"}
    with pytest.raises(VaultError):
        vault.destroy("yes")
    assert vault.destroy(DESTROY)["destroyed"]


def test_led_surrogates_check_their_heads(spark, vault):
    df = spark.createDataFrame([("101-0001", "101-"), ("102-0001", "102-"), ("101-0002", "101-")], "s string, h string")
    got = {r.value: r.surrogate for r in vault.led(df, "s", "subject", "h", "site").collect()}
    assert got["101-0001"][:4] == got["101-0002"][:4] != got["102-0001"][:4]
    with pytest.raises(VaultError):
        vault.led(spark.createDataFrame([("x-1", "101-")], "s string, h string"), "s", "subject2", "h", "site")


def test_dummy_text_keeps_shape_and_equality(spark, vault):
    df = spark.createDataFrame([(1, " Heart Attack 12! "), (2, "heart attack 12!"), (3, "患者头痛恶心呕吐"), (4, None), (5, "  ")], "i int, t string")
    got = {r.i: r.t for r in dummy_column(vault, df, "t").collect()}
    assert got[1].strip().lower() == got[2].lower() != "heart attack 12!" and got[1][0] == " " and got[1][-2:] == "! "
    assert [c.isupper() for c in got[1]] == [c.isupper() for c in " Heart Attack 12! "]
    assert len(got[3]) == 8 and all("一" <= c <= "龥" for c in got[3]) and got[4] is None and got[5] == "  "


# --- risk ---------------------------------------------------------------------------


def test_risk_on_nulls_and_reduction(spark):
    df = spark.createDataFrame([("x", None)] * 4, "a string, b string")
    groups = risk.classes(df, ["a", "b"])
    assert risk.summary(groups).first().k_min == 4
    data = [(f"s{i % 3}", "M" if i % 2 else "F", i) for i in range(24)]
    groups = risk.classes(spark.createDataFrame(data, "site string, sex string, age int"), ["site", "sex", "age"])
    assert risk.reduction_path(groups, ["site", "sex", "age"], 4) == [("age", 4)]
    path = risk.reduction_path(groups, ["site", "sex", "age"], 10)
    assert path[0][0] == "age" and path[-1][1] >= 10
    assert len(risk.reduction_path(groups, ["site", "sex", "age"], 10**6)) == 2  # the last one stays
    assert risk.reduction_path(groups.limit(0), ["site", "sex", "age"]) == []
    assert risk.smallest(groups, 3).count() == 24  # all tie
    assert risk.l_diversity(spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), ("b", None)], "q string, s string"), ["q"], ["s"]).first().l_min == 1


# --- detection -----------------------------------------------------------------------


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("call 555-123-4567 or a@b.org", ["PHONE_NUMBER", "EMAIL_ADDRESS"]), ("seen by Dr. Smith", ["PERSON"]), ("seen by Dr. Crohn", []),
        ("Patient Adalimumab given", []), ("MRN: 12345", ["MEDICAL_RECORD_NUMBER"]), ("at Mercy Hospital on 3/4/2024", ["FACILITY", "DATE_IN_TEXT"]),
        ("92 years old", ["AGE_OVER_89"]), ("123-45-6789", ["US_SSN"]), ("nothing", []), ("", []),
    ],
)
def test_pattern_detector(text, kinds):
    assert [f[0] for f in detect.PatternDetector().detect(text)] == kinds


def test_reclassified_not_deleted():
    assert [f[0] for f in detect.PatternDetector(reclassify=True).detect("seen by Dr. Crohn")] == ["CLINICAL_TERM"]


def test_queue_policy_redaction_and_adjudication(spark):
    df = spark.createDataFrame([(1, "mail a@b.org now"), (2, "seen by Dr. Smith, a@b.org"), (3, "fine"), (4, None), (5, "mail a@b.org now")], "_row_id long, t string")
    queue = detect.screen({"AE": df}, [("AE", "t")], "_row_id")
    got = {r.row_id: r for r in queue.collect()}
    assert set(got) == {1, 2, 5} and got[1].verdict == "REDACT" and got[2].verdict == "" and got[1].decided_by == "policy"
    assert got[1].replacement == "mail <EMAIL_ADDRESS> now" and got[2].replacement == "seen by Dr. <PERSON>, <EMAIL_ADDRESS>"
    assert got[2].marked == "seen by Dr. [[PERSON:Smith]], [[EMAIL_ADDRESS:a@b.org]]" and queue.first().row_id == 2
    assert detect.policy_summary(queue).first().asDict() == {"needs_human": 1, "auto_redact": 2, "auto_pass": 0}
    decided = queue.withColumn("verdict", F.when(F.col("row_id") == 2, "PASS").otherwise(F.col("verdict")))
    out = {r._row_id: r.t for r in detect.adjudicate(df, "AE", "t", "_row_id", decided).collect()}
    assert out == {1: "mail <EMAIL_ADDRESS> now", 2: "seen by Dr. Smith, a@b.org", 3: "fine", 4: None, 5: "mail <EMAIL_ADDRESS> now"}
    counts = detect.adjudication_counts(decided, {"AE": ["t"]}).first()
    assert (counts.redacted, counts.passed, counts.pending) == (2, 1, 0)
    with pytest.raises(ValueError):
        detect.policy_of({"PERSON": "shrug"})
    assert detect.screen({"AE": df.limit(0)}, [("AE", "t")], "_row_id").count() == 0


def test_blinding_terms_and_audit(spark):
    terms = blinding.revealing_terms(["Pembrolizumab 200 mg Q3W", "Placebo", "BLINDED STUDY TREATMENT", None])
    assert terms == ["pembrolizumab 200 mg q3w", "pembrolizumab", "q3w"]
    df = spark.createDataFrame([(1, "on PEMBROLIZUMAB", 5), (2, "pembrolizumabs", 5), (3, None, 5)], "_row_id long, note string, n int")
    (leak,) = blinding.audit(df, terms, "AE", "_row_id").collect()
    assert (leak.column_name, leak.term, leak.n_rows, leak.example_row) == ("note", "pembrolizumab", 1, 1)
    assert blinding.audit(df, [], "AE", "_row_id").count() == 0


def test_textcheck_verdicts(spark):
    coded = spark.createDataFrame([("Nausea", "NAUSEA")] * 5, "t string, c string")
    assert textcheck.characterise(coded, "t", "c")["verdict"] == "controlled"
    free = spark.createDataFrame([("Nausea, since 12 days; worse", "NAUSEA"), ("felt sick", "NAUSEA")], "t string, c string")
    assert textcheck.characterise(free, "t", "c")["verdict"] == "verbatim"
    assert textcheck.characterise(coded.limit(0), "t", "c")["verdict"] == "unknown"


# --- contracts ---------------------------------------------------------------------------


def _contract(**options):
    dm = [
        Rule("USUBJID", "surrogate_id", entity="subject", prefix="SUBJ"), Rule("SITEID", "pool_rare", min_count=2, quasi_identifier=True),
        Rule("BRTHDTC", "dob_to_age", cap=90), Rule("RFSTDTC", "date_to_study_day"), Rule("ARM", "label_map", entity="treatment", prefix="ARM"), Rule("PHONE", "drop"),
    ]
    ae = [
        Rule("USUBJID", "surrogate_id", entity="subject", prefix="SUBJ"), Rule("AESEQ", "retain"), Rule("AETERM", "redact_freetext"),
        Rule("AESTDTC", "date_to_study_day"), Rule("RAWDT", "date_shift_raw", date_order="dmy", on_unparsed="redact"), Rule("NOTE", "screen_freetext"),
    ]
    return Contract("1", "demo", "deidentified", Anchor("DM", "USUBJID", "RFSTDTC"), Risk("DM", k_target=2, **options), [Domain("DM", dm, "USUBJID"), Domain("AE", ae, "USUBJID")])


def _study(spark):
    dm = [(f"S{i}", "01" if i < 4 else "09", f"19{30 + i}-05-05", f"2024-01-{10 + i:02d}", "Drugamab 5 mg" if i % 2 else "Placebo", "555-123-4567") for i in range(5)]
    ae = [(f"S{i % 5}", i, "headache, call 555-123-4567" if i == 3 else "headache", f"2024-02-{1 + i:02d}", f"{13 + i:02d}/02/2024" if i else "junk", "took drugamab" if i == 1 else "ok") for i in range(8)]
    return {
        "DM": spark.createDataFrame(dm, "USUBJID string, SITEID string, BRTHDTC string, RFSTDTC string, ARM string, PHONE string"),
        "AE": spark.createDataFrame(ae, "USUBJID string, AESEQ int, AETERM string, AESTDTC string, RAWDT string, NOTE string"),
    }


def test_whole_run(spark, vault, tmp_path):
    study, contract = _study(spark), _contract()
    with pytest.raises(ContractError, match="draft"):
        Pipeline(contract, vault).run(study)
    sheet = review.build_sheet(contract, {})
    for row in review.read_sheet(review.write_sheet(sheet)):
        assert row["decision"] == ""
    for row in sheet:
        row["decision"] = "OK"
    signed = review.apply_sheet(sheet, contract, "steward")
    out = Pipeline(Contract.from_yaml(signed.to_yaml()), vault).run(study)
    dm, ae = out.tables["DM"], out.tables["AE"]
    assert "PHONE" not in dm.columns and set(ae.columns) >= {"AESTDY", "AESTDY_GRAN", "RAWDT"}
    assert [r.AESTDY for r in ae.orderBy("AESEQ").collect()][:2] == [23, 23]
    assert {r.SITEID for r in dm.collect()} == {"01", "OTHER"} and {r.ARM for r in dm.collect()} == {"ARM A", "ARM B"}
    assert ae.join(dm, "USUBJID", "left_anti").count() == 0 and not {r[0] for r in dm.select("USUBJID").collect()} & {f"S{i}" for i in range(5)}
    assert [r.AETERM for r in ae.where("AESEQ = 3").collect()] == ["headache, call <PHONE_NUMBER>"]
    assert ae.where("AESEQ = 0").first().RAWDT is None and out.risk["k_min"] == 1
    assert [x["term"] for x in out.leaks] == ["drugamab"] and out.queue.first().entities == "STUDY_DRUG"
    assert selfcheck(out.tables, study, signed) == []
    folder = str(tmp_path / "tier")
    study_io.write_release(spark, out, folder)
    assert json.loads((tmp_path / "tier" / "manifest.json").read_text())["contract"]["approved_by"] == "steward"
    again = Pipeline(signed, vault).run(study)
    assert sorted(again.tables["DM"].drop("_row_id").collect()) == sorted(dm.drop("_row_id").collect())


def test_run_fails_closed(spark, vault):
    study = _study(spark)
    for change in (lambda s: s | {"XX": s["DM"]}, lambda s: {"DM": s["DM"]}, lambda s: s | {"DM": s["DM"].withColumn("NEW", F.lit(1))}, lambda s: s | {"AE": s["AE"].drop("NOTE")}):
        with pytest.raises(ContractMismatch):
            Pipeline(_contract(), vault).run(change(study), unreviewed=True)
    with pytest.raises(RiskTargetMissed):
        Pipeline(_contract(fail_on_target_miss=True), vault).run(study, unreviewed=True)
    with pytest.raises(ContractError, match="vault"):
        Pipeline(_contract())


def test_contract_checks_and_digest():
    base = _contract()
    assert base.digest() == _contract().digest()
    changed = _contract()
    changed.domains[0].rules[1].min_count = 3
    assert changed.digest() != base.digest()
    noted = _contract()
    noted.domains[0].rules[1].note = "because"
    noted.contract_version = "9"
    assert noted.digest() == base.digest()
    for rules in ([Rule("A", "nope")], [Rule("A", "surrogate_id")], [Rule("A", "retain"), Rule("A", "drop")], [Rule("A", "retain"), Rule("B", "retain", output="A")], [Rule("XDTC", "retain")], [Rule("A", "retain", keep_values=["x"])], [Rule("A", "drop", redundant_with="B")]):
        with pytest.raises(ContractError):
            Contract("1", "s", "deidentified", Anchor("D", "A", "A"), Risk("D"), [Domain("D", rules, "A")])


def test_sheet_decisions():
    contract = _contract()
    sheet = review.build_sheet(contract, {})
    with pytest.raises(ContractError, match="without a decision"):
        review.apply_sheet(sheet, contract, "x")
    for row in sheet:
        row["decision"] = "OK"
    sheet[0] |= {"decision": "CHANGE", "decision_treatment": "drop"}
    signed = review.apply_sheet(sheet, contract, "x")
    assert signed.approval.changed == 1 and signed.approval.accepted == len(sheet) - 1
    signed.domains[1].rules[5].treatment = "drop"
    with pytest.raises(ContractError, match="edited"):
        signed.check()
    fresh = review.build_sheet(contract, {})
    signed = review.apply_sheet(sheet, contract, "x")
    assert review.carry_forward(fresh, signed) == len(fresh)
    with pytest.raises(ContractError):
        review.apply_sheet(sheet[1:], contract, "x")
    assert review.decode_params("cap=90; bins=1,2; preserve_format=true") == {"cap": 90.0, "bins": [1.0, 2.0], "preserve_format": True}


# --- reassignment, treatments, streams, sources ------------------------------------------------


def test_reassignment_modes(spark, vault):
    data = [(f"s{i % 6}", 1 + i // 6, f"2024-01-{1 + i:02d}", str(i), i) for i in range(18)]
    df = spark.createDataFrame(data, "subj string, seq int, dtc string, v string, _row_id long")
    ref = df.groupBy(F.col("subj").alias("subject")).agg(F.min("dtc").alias("anchor"))
    moved = reassign.by_subject(df, "subj", ["dtc"], ref, vault)
    was, now = {r.v: r.subj for r in df.collect()}, {r.v: r.subj for r in moved.collect()}
    assert all(was[v] != now[v] for v in was) and len(set(now.values())) == 6
    dealt = reassign.by_row(df, "subj", "seq", "_row_id")
    for subj, n in Counter(r.subj for r in dealt.collect()).items():
        assert sorted(r.seq for r in dealt.where(F.col("subj") == subj).collect()) == list(range(1, n + 1))
    lone = vault.derangement(_ids(spark, ["only"]), "lonely").first()
    assert lone.donor == lone.recipient == "only"
    # A later drop adds one subject: the earlier pairs stay.
    before = dict(vault.derangement(_ids(spark, ["a", "b", "c"]), "grows").collect())
    after = dict(vault.derangement(_ids(spark, ["a", "b", "c", "d"]), "grows").collect())
    assert after == before | {"d": "d"}


def test_reassignment_moves_written_dates_and_pins_the_days(spark, vault):
    forms = ["12-Mar-2024", "2024-03-12T08:30", "12/03/2024", "2024-03", "UN-MAR-2024", "soon", None, "2024-03-12", "31/12/2023"]
    data = [(f"s{i % 2}", f, i) for i, f in enumerate(forms)]
    df = spark.createDataFrame(data, "subj string, d string, _row_id long")
    ref = spark.createDataFrame([("s0", "2024-01-01"), ("s1", "2024-01-11")], "subject string, anchor string")
    moved = {r._row_id: r.d for r in reassign.by_subject(df, "subj", ["d"], ref, vault, "written").collect()}
    assert moved == {
        0: "22-Mar-2024", 1: "2024-03-02T08:30", 2: "22/03/2024", 3: "2024-03", 4: "UN-MAR-2024", 5: "soon", 6: None, 7: "2024-03-02", 8: "10/01/2024",
    }
    # A reference date corrected later changes no day that is already out.
    late = spark.createDataFrame([("s0", "2020-05-05"), ("s1", "2024-01-11")], "subject string, anchor string")
    again = {r._row_id: r.d for r in reassign.by_subject(df, "subj", ["d"], late, vault, "written").collect()}
    assert again == moved


def test_no_original_rests_in_clear(spark, tmp_path):
    path = str(tmp_path / "sealed")
    vault = Vault(spark, path, bytes(range(32)))
    secrets_of = ["SECRET-0001", "SECRET-0002", "SECRET-0003"]
    own = vault.surrogates(_ids(spark, secrets_of), "subject", "SUBJ")
    days = vault.offsets(_ids(spark, secrets_of))
    pairs = vault.derangement(_ids(spark, secrets_of), "all")
    texts = vault.text_dummies(_ids(spark, secrets_of))
    assert own.count() == days.count() == pairs.count() == texts.count() == 3
    for folder, _, names in os.walk(path):
        for name in names:
            content = open(os.path.join(folder, name), "rb").read()
            assert not any(s.encode() in content for s in secrets_of), (folder, name)
            if name.endswith(".parquet"):
                rows = spark.read.parquet(os.path.join(folder, name)).collect()
                assert not any(str(v) in secrets_of for r in rows for v in r)
    assert vault.sweep() > 0 and vault.sweep() == 0
    assert vault.surrogates(_ids(spark, secrets_of), "subject", "SUBJ").count() == 3


def test_templates_and_anchors(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", "2024-01-01"), (3, "a", None), (4, None, "x")], "_row_id long, s string, d string")
    assert [tuple(r) for r in treatments.anchors(df, "s", "d", "_row_id").collect()] == [("a", None)]
    got = df.select(treatments.template("<{s}|{d}>", {"s": F.col("s"), "d": F.col("d")})).collect()
    assert [r[0] for r in got] == [None, "<a|2024-01-01>", None, None]
    with pytest.raises(KeyError):
        treatments.template("{nope}", {})


def test_streams(spark, vault, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    study = _study(spark)
    study["AE"].coalesce(1).write.parquet(source)
    drops.stateless(spark, source, {"seq": F.col("AESEQ"), "term": F.upper("AETERM")}, out, str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(out).count() == 8
    pipeline = Pipeline(_contract(), vault)
    anchor = treatments.anchors(study["DM"].withColumn("_row_id", F.monotonically_increasing_id()), "USUBJID", "RFSTDTC", "_row_id")
    tier = str(tmp_path / "tier")
    for _ in range(2):
        drops.contracted(spark, source, "AE", pipeline, anchor, lambda df, n: df.write.mode("overwrite").parquet(f"{tier}/batch={n}"), str(tmp_path / "cp2")).awaitTermination()
        study["AE"].coalesce(1).write.mode("append").parquet(source)
    got = spark.read.parquet(tier)
    assert got.count() == 16 and got.select("USUBJID").distinct().count() == 5


def test_sources_round_trip(spark, tmp_path):
    (tmp_path / "ae.csv").write_text('A,B\n"x, ""y""",NA\n007,\n')
    (tmp_path / "notes.md").write_text("no table")
    df = spark.createDataFrame([("2024-01-01 00:00:00", "1"), (None, "a<b")], "D string, V string")
    workbook.write({"one": df, "a/b": df}, str(tmp_path / "book.xlsx"))
    found = study_io.discover(spark, str(tmp_path))
    assert set(found) == {"AE", "ONE", "A_B"}
    study = study_io.load_study(spark, str(tmp_path))
    assert [tuple(r) for r in study["AE"].orderBy("_row_id").drop("_row_id").collect()] == [('x, "y"', None), ("007", None)]
    assert [tuple(r) for r in study["ONE"].orderBy("_row_id").drop("_row_id").collect()] == [("2024-01-01", "1"), (None, "a<b")]
    assert study_io.checksums(spark, str(tmp_path / "ae.csv")).count() == 1
    assert study_io.is_remote("s3://b/x") and not study_io.is_remote("/tmp/x")
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        study_io.load_study(spark, str(tmp_path / "none"))


def test_keys(tmp_path, monkeypatch):
    keys.FileKey.generate(str(tmp_path / "k"))
    assert len(keys.resolve(f"file:{tmp_path / 'k'}").key()) == 32
    (tmp_path / "k").chmod(0o644)
    with pytest.raises(PermissionError):
        keys.resolve(f"file:{tmp_path / 'k'}").key()
    monkeypatch.setenv("K", "00ff")
    assert keys.resolve("env:K").key() == b"\x00\xff"
    with pytest.raises(PermissionError):
        keys.resolve("env:K", require_managed=True)


def test_protocol_documents(spark, tmp_path):
    (tmp_path / "p.txt").write_text("Protocol no: ABC-123-X\nPembrolizumab and Q-Drug 12 at Grand Clinic\n")
    blocks = protocol.documents(spark, str(tmp_path))
    found = {(r.category, r.term_key) for r in protocol.propose(blocks, "path", "text").collect()}
    assert ("study_id", "abc-123-x") in found and ("drug", "pembrolizumab") in found and ("site", "grand clinic") in found
    masked = protocol.mask(blocks, "text", {"pembrolizumab": "DRUG A", "Q-Drug 12": "DRUG B"})
    assert protocol.residual(masked, "text", ["pembrolizumab", "q-drug 12"]) == 0
    assert any("DRUG A and DRUG B at" in r.text for r in masked.collect())
    assert {r.term: r.n for r in protocol.term_counts(blocks, "text", ["pembrolizumab", "clinic", "grand clinic"]).collect()} == {"pembrolizumab": 1, "grand clinic": 1}


def test_term_readers():
    from veilframe.operators.termforms import label_of, terms_of

    cases = {
        "NCT01234567 and 2020-001234-12": {("study_id", "NCT01234567"), ("study_id", "2020-001234-12")},
        "IND No. 123,456 given": {("study_id", "123,456")},
        "Dr. Jane Roe (jane.roe@x.org), tel: (212) 555-0188": {("person", "Jane Roe"), ("contact", "jane.roe@x.org"), ("contact", "(212) 555-0188")},
        "ABC-123 and XYZ 12345 with Keytruda® under ICH-GCP E6, CTCAE 5": {("drug", "ABC-123"), ("drug", "XYZ 12345"), ("drug", "Keytruda")},
        "run by Northwind Labs, Inc. at the University of Leeds": {("sponsor", "Northwind Labs, Inc"), ("site", "University of Leeds")},
        "Principal Investigator: J. Smith": {("person", "J. Smith")},
        "申办方：海正药业股份有限公司": {("sponsor", "海正药业股份有限公司")},
        "北京协和医院张伟教授": {("site", "北京协和医院")},
        "Call +44 20 7946 0958": {("contact", "+44 20 7946 0958")},
        "nothing to see on day 5, 12 mg": set(),
    }
    for line, want in cases.items():
        got = {(c, t) for c, t, _ in terms_of(line)}
        assert want <= got and len(got - want) <= 1, (line, got)
    assert label_of("Sponsor") == "sponsor" and label_of("方案编号：") == "study_id" and label_of("Sponsor of things") is None


def test_proposed_terms_are_ordered_and_get_stand_ins(spark, vault):
    lines = ["Sponsor:", "Northwind Labs", "NCT01234567", "- ketoconazole", "- fluconazole", "- nefazodone"]
    blocks = spark.createDataFrame([("a", "\n".join(lines)), ("b", None), ("c", "")], "path string, text string")
    found = protocol.propose(blocks, "path", "text")
    order = [(r.category, r.term_key, r.confidence) for r in protocol.ordered(found).collect()]
    assert [o[2] for o in order] == sorted((o[2] for o in order), reverse=True) and ("drug", "nefazodone", 1) in order
    named = {r.term_key: r.replacement for r in protocol.with_stand_ins(found, vault).collect()}
    assert named["nct01234567"].startswith("STUDY-") and named["northwind labs"].startswith("SPONSOR-") and len(set(named.values())) == len(order)
    assert named == {r.term_key: r.replacement for r in protocol.with_stand_ins(found, vault).collect()}


@pytest.mark.parametrize(
    ("values", "treatment"),
    [
        (["Jane Roe", "John Q. Smith", "A. Muller", "Garcia, Ana"] * 5, "drop"), (["yes", "No", "unknown", "Y"] * 5, "retain"),
        (["a.b@c.org", "(212) 555-0188", "+44 20 7946 0958", "x@y.example"] * 5, "drop"), (["Metformin", "aspirin", "Atorvastatin", "Omeprazole"] * 5, "retain"),
        ([None] * 20, "drop"), (["1.5", "2", "3.25", "4"] * 5, "retain"),
    ],
)
def test_values_decide_where_the_name_says_nothing(spark, values, treatment):
    from veilframe.operators import profiler

    df = spark.createDataFrame([(v,) for v in values], "XQ7 string")
    rows = {r["column_name"]: r.asDict() for r in profiler.column_profiles(df, ["XQ7"]).collect()}
    assert profiler.propose(rows)[0].treatment == treatment


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    from veilframe import cli

    monkeypatch.setattr(cli, "build_session", lambda *a: spark)
    drop = tmp_path / "drop"
    drop.mkdir()
    for name, df in _study(spark).items():
        df.replace("junk", "09/02/2024").toPandas().to_csv(drop / f"{name.lower()}.csv", index=False)
    contract, sheet, signed, key = (str(tmp_path / n) for n in ("c.yaml", "s.csv", "a.yaml", "key"))
    assert cli.main(["keygen", key]) == 0 and cli.main(["treatments"]) == 0
    assert cli.main(["profile", str(drop), contract, sheet, "--blind"]) == 0
    rows = review.read_sheet(open(sheet).read())
    for r in rows:
        r["decision"] = "OK"
    open(sheet, "w").write(review.write_sheet(rows))
    assert cli.main(["profile", str(drop), contract, sheet]) == 2
    assert cli.main(["approve", sheet, contract, signed, "--by", "me"]) == 0
    tier = str(tmp_path / "tier")
    code = ["--vault", str(tmp_path / "v"), "--key", f"file:{key}"]
    assert cli.main(["run", str(drop), signed, tier, *code]) == 0
    assert cli.main(["risk", f"{tier}/dm.parquet", "--quasi", "SITEID"]) == 0
    assert cli.main(["adjudicate", tier, f"{tier}_review/review_queue.parquet", str(tmp_path / "final"), "--allow-pending"]) == 0
    assert cli.main(["vault", *code]) == 0
    assert cli.main(["textcheck", str(drop / "ae.csv"), "AETERM"]) == 0
