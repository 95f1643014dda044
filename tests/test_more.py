"""Names, fixtures, raw and SDTM pairs, vault extras and protocol files."""

import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from veilframe.functions import dates, rawdates
from veilframe.functions.naming import domain_code, move_group, name_tokens
from veilframe.operators import profiler, protocol, reassign
from veilframe.operators.vault import Vault, VaultError
from veilframe.sources import fixtures, study_io


@pytest.mark.parametrize(("name", "code"), [("ae", "AE"), ("EDC_MH_RAWDATA_US", "MH"), ("AE_MH_both", None), ("Demog", "DM"), ("labs", None)])
def test_domain_codes(name, code):
    assert domain_code(name) == code


def test_groups_and_tokens():
    assert move_group("SUPPAE") == "AE" and move_group("dm") is None and move_group("x_lb_1") == "LB"
    assert name_tokens("AEOutcome_RAW") == ["AEOUTCOME"] and name_tokens("aeOutcome-2") == ["AE", "OUTCOME"]


def test_raw_and_sdtm_pair_agree_under_one_shift(spark, tmp_path):
    sdtm = fixtures.study(spark, 30)
    raw = fixtures.raw(sdtm)
    vault = Vault(spark, str(tmp_path / "v"), bytes(range(32)))
    offsets = vault.offsets(sdtm["DM"].select("USUBJID"))
    a = sdtm["AE"].join(offsets, F.col("USUBJID") == F.col("value")).select("USUBJID", "AESEQ", dates.shift_iso(F.col("AESTDTC"), F.col("days")).alias("iso"))
    key = F.concat(F.lit("DEMO-2026-"), "SUBJECT")
    b = raw["AE_LOG"].withColumn("USUBJID", key).join(offsets, F.col("USUBJID") == F.col("value"))
    b = b.select("USUBJID", F.col("AE_NO").alias("AESEQ"), rawdates.shift_written(F.col("AE_START"), F.col("days"), "dmy")["value"].alias("raw"))
    pair = a.join(b, ["USUBJID", "AESEQ"])
    assert pair.count() == sdtm["AE"].count() > 30
    assert pair.where(F.date_format(dates.whole_date(F.col("iso")), "dd/MM/yyyy") != F.col("raw")).count() == 0


def test_self_anchor_unanchored_and_labels(spark, tmp_path):
    vault = Vault(spark, str(tmp_path / "v"), bytes(range(32)))
    df = spark.createDataFrame([(1, "a", None), (2, "a", "2024-01-02"), (3, "b", "2024-01-05")], "_row_id long, s string, d string")
    ref = reassign.self_anchor(df, "s", "d", "_row_id")
    assert dict(ref.collect()) == {"a": None, "b": "2024-01-05"}
    assert vault.settle_unanchored("all", df.select("s"), ref) == 1 and vault.settle_unanchored("all", df.select("s"), ref) == 0
    assert [r.donor for r in vault.is_unanchored("all", df.select("s")).collect()] == ["a"]
    vault.labels(spark.createDataFrame([("Drug",)], "v string"), "treatment", "ARM")
    assert [tuple(r) for r in vault.labelled("treatment").collect()] == [("DRUG", "ARM A")]
    with pytest.raises(VaultError):
        vault.labelled("subject")
    moved = reassign.by_subject(df, "s", ["d"], ref, vault)
    counts = reassign.report(df, moved, "s", ref).first()
    assert (counts.n_rows, counts.n_donors, counts.n_recipients, counts.n_unanchored) == (3, 2, 2, 1)


def test_proposals_on_a_raw_study(spark):
    demog = fixtures.raw(fixtures.study(spark, 40))["DEMOG"].withColumn("CREATED_DT", F.lit("2024-01-01")).withColumn("SITE_NAME", F.lit("x"))
    rows = {r["column_name"]: r.asDict() for r in profiler.column_profiles(demog, demog.columns).collect()}
    got = {p.column: p.treatment for p in profiler.propose(rows, raw=True, blind=True)}
    assert got == {
        "SUBJECT": "surrogate_id", "SITE": "surrogate_id", "INVESTIGATOR": "drop", "BIRTH_DT": "dob_to_age", "TREATMENT": "label_map",
        "ENROL_DT": "date_shift_raw", "CREATED_DT": "drop", "SITE_NAME": "drop",
    }


def _docx(lines: list[str]) -> bytes:
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    body = "".join("<w:p>" + "".join(f"<w:r><w:t>{part}</w:t></w:r>" for part in line.split("|")) + "</w:p>" for line in lines)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        book.writestr("word/document.xml", f'<w:document xmlns:w="{w}"><w:body>{body}</w:body></w:document>')
        book.writestr("word/media/logo.png", b"picture")
        book.writestr("docProps/core.xml", '<a xmlns="x"><creator>Jane Roe</creator></a>')
    return out.getvalue()


def test_protocol_files_are_masked(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "plan.docx").write_bytes(_docx(["Drug Zento|limab (ZTM) daily", "nothing"]))
    (tmp_path / "in" / "zentolimab.txt").write_text("Protocol number:\nABC-2024-77\nzentolimab at 021\n")
    blocks = protocol.documents(spark, str(tmp_path / "in"))
    assert [tuple(r)[1:] for r in protocol.labelled_terms(blocks, "path", "block_no", "text").collect()] == [("study_id", "ABC-2024-77")]
    mapping = {"zentolimab": "DRUG A", "ZTM": "DA", "ABC-2024-77": "STUDY 1"}
    for wrong in ({"zentolimab": ""}, mapping):
        with pytest.raises(ValueError):
            protocol.apply_terms(spark, str(tmp_path / "in"), wrong, "" if wrong is mapping else "me", str(tmp_path / "no"))
    done = protocol.apply_terms(spark, str(tmp_path / "in"), mapping, "me", str(tmp_path / "out"))
    assert done["documents"] == 2 and done["residual"] == 0
    assert "DRUG A at 021" in (tmp_path / "out" / "DRUG A.txt").read_text()
    content = (tmp_path / "out" / "plan.docx").read_bytes()
    assert protocol.docx_text(content) == ["Drug DRUG A (DA) daily", "nothing"] and b"Jane Roe" not in content
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        assert book.read("word/media/logo.png") == b""


def _ibm(value: float | None) -> bytes:
    if value is None:
        return b"." + b"\0" * 7
    if value == 0:
        return b"\0" * 8
    sign, value, e = (0x80 if value < 0 else 0), abs(value), 64
    while value >= 1:
        value, e = value / 16, e + 1
    while value < 1 / 16:
        value, e = value * 16, e - 1
    return bytes([sign | e]) + int(value * 2**56).to_bytes(7, "big")


def _xport(names, rows) -> bytes:
    def head(kind: str, tail: str) -> bytes:
        return f"HEADER RECORD*******{kind:8}HEADER RECORD!!!!!!!{tail}".ljust(80).encode()

    out = head("LIBRARY", "0" * 30) + b" " * 160 + head("MEMBER", "0" * 17 + "1600000000140") + head("DSCRPTR", "0" * 30)
    out += (b"SAS     " + b"AE      ").ljust(80) + b" " * 80 + head("NAMESTR", f"000000{len(names):04d}" + "0" * 20)
    body, at = b"", 0
    for name, is_number, length in names:
        body += (struct.pack(">hhhh", 1 if is_number else 2, 0, length, 1) + name.ljust(8).encode()).ljust(84) + struct.pack(">l", at) + b"\0" * 52
        at += length
    out += body.ljust(-(-len(body) // 80) * 80) + head("OBS", "0" * 30)
    data = b"".join(b"".join(_ibm(v) if n[1] else (v or "").ljust(n[2]).encode() for n, v in zip(names, row)) for row in rows)
    return out + data.ljust(-(-len(data) // 80) * 80)


def test_transport_files(spark, tmp_path):
    rows = [("S1", 1.0, "Headache"), ("S2", -118.625, None), ("S3", None, "x"), ("S4", 0.1, "y"), ("S5", 0.0, "z")]
    (tmp_path / "ae.xpt").write_bytes(_xport([("SUBJ", False, 6), ("N", True, 8), ("TERM", False, 10)], rows))
    study = study_io.load_study(spark, str(tmp_path))
    got = [tuple(r) for r in study["AE"].orderBy("_row_id").drop("_row_id").collect()]
    assert [(a, round(b, 12) if b is not None else None, c) for a, b, c in got] == rows
