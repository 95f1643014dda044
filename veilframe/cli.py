"""Command line: keygen, profile, treatments, approve, run, adjudicate, risk, textcheck, vault, reverse, donor, protocol."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import functions as F

from veilframe.functions import rawdates
from veilframe.functions.naming import move_group
from veilframe.operators import detect, profiler, protocol, risk, textcheck
from veilframe.operators.vault import Vault
from veilframe.plans import review
from veilframe.plans.contract import TREATMENTS, Anchor, Contract, Domain, Risk, Rule
from veilframe.plans.pipeline import Pipeline, selfcheck
from veilframe.session import build_session
from veilframe.sources import files, keys, study_io


def draft(spark, folder: str, source: str, tier: str, raw: bool, blind: bool) -> tuple[Contract, dict]:
    """A proposed contract from one profile job per table, and its confidences."""
    study = study_io.load_study(spark, folder)
    domains, sure = [], {}
    for name, df in study.items():
        columns = [c for c in df.columns if c != study_io.ROW]
        rows = {r["column_name"]: r.asDict() for r in profiler.column_profiles(df, columns).collect()}  # one row per column
        found = {p.column: p for p in profiler.propose(rows, tier, raw, blind)}
        rules = [Rule(c, found[c].treatment, entity=found[c].entity, note=found[c].reason, **(found[c].params or {})) for c in columns]
        key = next((r.column for r in rules if r.entity == "subject" and r.treatment == "surrogate_id"), None)
        domains.append(Domain(name, rules, subject_key=key))
        sure |= {(name, c): (found[c].confidence, found[c].reason) for c in columns}
    _settle_orders(study, domains)
    first = next((d for d in domains if d.name == "DM"), domains[0])
    names = [r.column for r in first.rules]
    date = next((n for n in ("RFXSTDTC", "RFSTDTC", "TRTSDTC", "RANDDTC") if n in names), names[0])
    return Contract("1", source, tier, Anchor(first.name, first.subject_key or names[0], date), Risk(first.name), domains), sure


def _settle_orders(study: dict, domains: list[Domain]) -> None:
    """Day and month order of written dates; columns that cannot tell borrow what all others agree on."""
    orders: dict[tuple[str, str], str] = {}
    for d in domains:
        columns = [r.column for r in d.rules if r.treatment == "date_shift_raw"]
        if columns:
            found = rawdates.infer_order(study[d.name], columns).collect()  # one row per column
            orders |= {(d.name, r["column_name"]): r["day_order"] for r in found}
    votes = {o for o in orders.values() if o in ("dmy", "mdy")}
    for d in domains:
        for r in d.rules:
            order = orders.get((d.name, r.column))
            if order in ("dmy", "mdy"):
                r.date_order = order
            elif order == "unknown" and len(votes) == 1:
                (r.date_order,) = votes


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="veilframe")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *arguments: str, **options):
        c = sub.add_parser(name)
        for a in arguments:
            c.add_argument(a)
        for k, v in options.items():
            c.add_argument(f"--{k.replace('_', '-')}", **v)
        return c

    flag, vault = {"action": "store_true"}, {"vault": {}, "key": {"default": "env:VEIL_VAULT_KEY"}, "require_managed": {"action": "store_true"}}
    command("keygen", "path")
    command("treatments")
    command("profile", "folder", "contract", "sheet", tier={"default": "deidentified"}, source={"default": "study"}, raw=flag, blind=flag, carry_forward={})
    command("approve", "sheet", "contract", "approved", by={"required": True})
    command("run", "folder", "contract", "out", unreviewed=flag, allow_missing=flag, format={"default": "parquet"}, **vault)
    command("adjudicate", "tier", "queue", "out", allow_pending=flag)
    command("risk", "table", quasi={"required": True}, k={"type": int, "default": 5})
    command("textcheck", "table", "column", coded={})
    command("vault", **vault)
    command("reverse", "surrogate", entity={"required": True}, justification={"required": True}, by={"required": True}, **vault)
    command("donor", "recipient", "folder", "domain", "column", justification={"required": True}, by={"required": True}, **vault)
    command("protocol", "folder", "terms", apply={"help": "folder for masked documents"}, by={"default": ""}, **vault)
    a = p.parse_args(argv)

    if a.command == "keygen":
        keys.FileKey.generate(a.path)
        return 0
    if a.command == "treatments":
        print("\n".join(TREATMENTS))
        return 0
    if a.command == "approve":
        signed = review.apply_sheet(review.read_sheet(Path(a.sheet).read_text()), Contract.from_yaml(Path(a.contract).read_text()), a.by)
        Path(a.approved).write_text(signed.to_yaml())
        return 0
    spark = build_session("veilframe")

    def opened() -> Vault | None:
        return Vault(spark, a.vault, keys.resolve(a.key, a.require_managed).key()) if a.vault else None

    if a.command == "profile":
        if Path(a.sheet).exists() and any(r["decision"] for r in review.read_sheet(Path(a.sheet).read_text())):
            print(f"{a.sheet} holds decisions; it is not overwritten", file=sys.stderr)
            return 2
        contract, sure = draft(spark, a.folder, a.source, a.tier, a.raw, a.blind)
        sheet = review.build_sheet(contract, sure)
        if a.carry_forward:
            print(f"{review.carry_forward(sheet, Contract.from_yaml(Path(a.carry_forward).read_text()))} decisions carried forward")
        Path(a.contract).write_text(contract.to_yaml())
        Path(a.sheet).write_text(review.write_sheet(sheet))
    elif a.command == "run":
        contract = Contract.from_yaml(Path(a.contract).read_text())
        crosswalk = opened()
        study = study_io.load_study(spark, a.folder)
        published = Pipeline(contract, crosswalk).run(study, a.allow_missing, a.unreviewed)
        # What went in, for whoever repeats the run; the checks read what was written.
        published.manifest["inputs"] = {r["path"].rsplit("/", 1)[-1]: r["sha256"] for r in study_io.checksums(spark, a.folder).collect()}
        paths = study_io.write_release(spark, published, a.out, a.format)
        failed = selfcheck({n: study_io.read_table(spark, p) for n, p in paths.items()}, study, contract) if a.format == "parquet" else []
        files.write_text(spark, f"{a.out.rstrip('/')}_review/selfcheck.json", json.dumps(failed, indent=1))
        if crosswalk:
            crosswalk.sweep()
        print(json.dumps(published.manifest["risk"], default=str))
        if failed:
            print("\n".join(failed), file=sys.stderr)
            return 3
    elif a.command == "adjudicate":
        queue = study_io.read_table(spark, a.queue)
        pending = queue.where(F.upper(F.trim(F.coalesce("verdict", F.lit("")))).isin(*detect.UNREVIEWED)).count()
        if pending and not a.allow_pending:
            print(f"{pending} rows are not decided", file=sys.stderr)
            return 2
        for name, path in study_io.discover(spark, f"{a.tier.rstrip('/')}_review/rows").items():
            df = study_io.read_table(spark, path)
            targets = [r[0] for r in queue.where(F.col("domain") == name).select("column_name").distinct().collect()]  # few columns
            for column in [t for t in targets if t in df.columns]:
                df = detect.adjudicate(df, name, column, study_io.ROW, queue)
            study_io.write_table(df, f"{a.out}/{name.lower()}.parquet")
    elif a.command == "risk":
        groups = risk.classes(study_io.read_table(spark, a.table), a.quasi.split(","))
        print(json.dumps(risk.summary(groups, a.k).first().asDict()))
    elif a.command == "textcheck":
        print(json.dumps(textcheck.characterise(study_io.read_table(spark, a.table), a.column, a.coded)))
    elif a.command == "vault":
        opened().stats().show(truncate=False)
    elif a.command == "reverse":
        opened().reverse([a.surrogate], a.entity, a.by, a.justification).show(truncate=False)
    elif a.command == "donor":
        subjects = study_io.load_study(spark, a.folder)[a.domain].select(F.col(a.column).cast("string"))
        opened().donor_of(a.recipient, move_group(a.domain) or a.domain, a.by, a.justification, subjects).show(truncate=False)
    elif a.command == "protocol":
        blocks = protocol.documents(spark, a.folder)
        if not a.apply:
            proposed = protocol.propose(blocks, "path", "text", "block_no")
            # Without a vault the reviewer writes the stand-ins.
            proposed = protocol.with_stand_ins(proposed, opened()) if a.vault else proposed.withColumn("replacement", F.lit(None).cast("string"))
            protocol.ordered(proposed).coalesce(1).write.mode("overwrite").csv(a.terms, header=True)
        else:
            decided = {r["term"]: r["replacement"] for r in spark.read.csv(a.terms, header=True).collect()}  # reviewed by hand
            done = protocol.apply_terms(spark, a.folder, decided, a.by, a.apply)
            files.write_text(spark, f"{a.apply}_manifest.json", json.dumps(done))
            return int(done["residual"] > 0)
    return 0


if __name__ == "__main__":
    sys.exit(main())
