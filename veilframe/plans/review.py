"""The decision sheet: proposals out, a steward's decisions back, an approval."""

from __future__ import annotations

import csv
import io
from copy import deepcopy
from dataclasses import fields
from datetime import UTC, datetime

from veilframe.plans.contract import Approval, Contract, ContractError, Rule

# The sheet's columns and the words of a decision.
PROPOSED = ["domain", "column", "proposed_treatment", "proposed_params", "confidence", "quasi_identifier"]
DECISION = ["decision", "decision_treatment", "decision_params", "steward_note"]
CONTEXT = ["why", "detail"]
ACCEPT, CHANGE = {"OK", "ACCEPT", "Y", "YES"}, {"CHANGE", "C", "OVERRIDE"}
_SETTABLE = {f.name: f for f in fields(Rule) if f.name not in ("column", "treatment", "note")}


def encode_params(rule: Rule) -> str:
    out = []
    for name, f in _SETTABLE.items():
        value = getattr(rule, name)
        if value != f.default and value not in (None, []):
            if isinstance(value, dict):
                value = ",".join(f"{k}:{v}" for k, v in value.items())
            out.append(f"{name}={','.join(map(str, value)) if isinstance(value, list) else value}")
    return "; ".join(out)


def decode_params(text: str) -> dict[str, object]:
    out: dict[str, object] = {}
    for part in filter(None, (p.strip() for p in (text or "").split(";"))):
        name, mark, value = part.partition("=")
        name, value = name.strip(), value.strip()
        if not mark or name not in _SETTABLE:
            raise ContractError(f"parameter {part!r} is not understood")
        kind = str(_SETTABLE[name].type)
        if "bool" in kind:
            if value.lower() not in ("true", "false", "yes", "no"):
                raise ContractError(f"{name} must be true or false")
            out[name] = value.lower() in ("true", "yes")
        elif "list[float]" in kind:
            out[name] = [float(v) for v in value.split(",")]
        elif "list" in kind:
            out[name] = [v.strip() for v in value.split(",")]
        elif "dict" in kind:
            out[name] = dict(v.split(":", 1) for v in value.split(","))
        elif "int" in kind:
            out[name] = int(value)
        elif "float" in kind:
            out[name] = float(value)
        else:
            out[name] = value
    return out


def build_sheet(contract: Contract, confidence: dict[tuple[str, str], tuple[str, str]]) -> list[dict[str, str]]:
    """Rows to fill in, least certain first."""
    rank = {"low": 0, "medium": 1, "high": 2}
    rows = []
    for domain in contract.domains:
        for rule in domain.rules:
            sure, why = confidence.get((domain.name, rule.column), ("low", ""))
            rows.append(
                dict.fromkeys(PROPOSED + DECISION + CONTEXT, "")
                | {
                    "domain": domain.name, "column": rule.column, "proposed_treatment": rule.treatment,
                    "proposed_params": encode_params(rule), "confidence": sure,
                    "quasi_identifier": "yes" if rule.quasi_identifier else "", "why": why, "detail": rule.note or "",
                }
            )
    return sorted(rows, key=lambda r: (rank[r["confidence"]], r["domain"], r["column"]))


def carry_forward(sheet: list[dict[str, str]], approved: Contract) -> int:
    """Earlier decisions repeated where the column still exists; returns how many."""
    earlier = {(d.name, r.column): r for d in approved.domains for r in d.rules}
    n = 0
    for row in sheet:
        rule = earlier.get((row["domain"], row["column"]))
        if rule is None or row["decision"]:
            continue
        n += 1
        same = rule.treatment == row["proposed_treatment"] and encode_params(rule) == row["proposed_params"]
        row["decision"] = "OK" if same else "CHANGE"
        if not same:
            row["decision_treatment"], row["decision_params"] = rule.treatment, encode_params(rule)
        row["steward_note"] = "carried forward"
    return n


def write_sheet(sheet: list[dict[str, str]]) -> str:
    out = io.StringIO()
    writer = csv.DictWriter(out, PROPOSED + DECISION + CONTEXT)
    writer.writeheader()
    writer.writerows(sheet)
    return out.getvalue()


def read_sheet(text: str) -> list[dict[str, str]]:
    rows = [{k: (v or "").strip() for k, v in r.items() if k} for r in csv.DictReader(io.StringIO(text.lstrip("﻿")))]
    missing = [c for c in PROPOSED + DECISION if rows and c not in rows[0]]
    if missing:
        raise ContractError(f"the sheet lacks {', '.join(missing)}")
    return rows


def apply_sheet(sheet: list[dict[str, str]], draft: Contract, approved_by: str, note: str | None = None) -> Contract:
    """An approved contract from a filled sheet; anything undecided stops it."""
    keys = [(r["domain"], r["column"]) for r in sheet]
    wanted = {(d.name, r.column) for d in draft.domains for r in d.rules}
    if len(set(keys)) != len(keys):
        raise ContractError("a row of the sheet appears twice")
    if set(keys) != wanted:
        raise ContractError(f"sheet and contract differ: missing {sorted(wanted - set(keys))}, extra {sorted(set(keys) - wanted)}")
    blank = [k for k, r in zip(keys, sheet) if not r["decision"]]
    if blank:
        raise ContractError(f"{len(blank)} rows without a decision, first {blank[0]}")
    by_key, result, counts = dict(zip(keys, sheet)), deepcopy(draft), {"accepted": 0, "changed": 0}
    result.approval = None
    for domain in result.domains:
        renamed = {}
        for i, rule in enumerate(domain.rules):
            row = by_key[domain.name, rule.column]
            verdict = row["decision"].upper()
            if verdict in ACCEPT:
                if row["decision_treatment"] or row["decision_params"]:
                    raise ContractError(f"{domain.name}.{rule.column}: accepted and changed at once")
                counts["accepted"] += 1
            elif verdict in CHANGE:
                treatment = row["decision_treatment"].lower()
                if not treatment:
                    raise ContractError(f"{domain.name}.{rule.column}: changed to what?")
                # A change starts from a clean rule; no parameter of the proposal survives.
                domain.rules[i] = Rule(rule.column, treatment, note=row["steward_note"] or None, **decode_params(row["decision_params"]))
                counts["changed"] += 1
            else:
                raise ContractError(f"{domain.name}.{rule.column}: decision {row['decision']!r} is not understood")
            renamed[domain.rules[i].column] = domain.rules[i]
        key = renamed.get(domain.subject_key or "")
        if key is not None and key.treatment == "drop":
            subject = next((r.column for r in domain.rules if r.entity == "subject" and r.treatment != "drop"), None)
            domain.subject_key = subject
    result.check()
    result.approval = Approval(approved_by, datetime.now(UTC).isoformat(timespec="seconds"), result.digest(), note=note, **counts)
    return result
