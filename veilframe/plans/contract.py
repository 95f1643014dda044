"""The contract: what happens to every column, who signed it, and its checks.

A contract is the logical plan of a run.  It is plain driver data; compiling it
into DataFrame plans is the pipeline's work.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field, fields

# The treatments and what each one needs.
TREATMENTS = (
    "retain", "drop", "surrogate_id", "faker", "date_to_study_day", "partial_date_to_year_offset", "dob_to_age", "date_shift",
    "date_shift_raw", "cap_numeric", "generalize_numeric", "zip3", "pool_rare", "label_map", "screen_freetext", "redact_freetext",
    "dummy_text",
)
NON_MUTATING = frozenset({"retain", "screen_freetext"})
NEEDS_ANCHOR = frozenset({"date_to_study_day", "partial_date_to_year_offset", "dob_to_age"})
NEEDS_VAULT = frozenset({"surrogate_id", "date_shift", "date_shift_raw", "label_map", "dummy_text"})
KEEPS_CALENDAR_DATE = frozenset({"retain", "date_shift", "date_shift_raw"})
DIGEST_SCHEME = 2
_REQUIRED = {
    "surrogate_id": ("entity",), "label_map": ("entity",), "date_shift": ("entity",), "faker": ("provider",),
    "pool_rare": ("min_count",), "generalize_numeric": ("bins",), "cap_numeric": ("cap",),
}
_ONLY = {"redundant_with": ("drop",), "keep_values": ("label_map",), "date_order": ("date_shift_raw",)}


class ContractError(ValueError):
    """A contract that cannot be signed or run."""


@dataclass
class Rule:
    column: str
    treatment: str
    output: str | None = None
    entity: str | None = None
    prefix: str | None = None
    preserve_format: bool = False
    shape_prefix_from: str | None = None
    provider: str | None = None
    min_count: int | None = None
    pooled_value: str = "OTHER"
    bins: list[float] | None = None
    cap: float | None = None
    keep_values: list[str] | None = None
    date_order: str | None = None
    on_unparsed: str = "fail"
    screen_policy: dict[str, str] | None = None
    output_template: str | None = None
    redundant_with: str | None = None
    quasi_identifier: bool = False
    is_date: bool = False
    day_zero: bool = False
    note: str | None = None

    def check(self) -> None:
        at = f"column {self.column}"
        if self.treatment not in TREATMENTS:
            raise ContractError(f"{at}: unknown treatment {self.treatment!r}")
        for name in _REQUIRED.get(self.treatment, ()):
            if getattr(self, name) in (None, []):
                raise ContractError(f"{at}: {self.treatment} needs {name}")
        for name, allowed in _ONLY.items():
            if getattr(self, name) is not None and self.treatment not in allowed:
                raise ContractError(f"{at}: {name} belongs to {', '.join(allowed)}")
        if self.on_unparsed not in ("fail", "redact", "pass"):
            raise ContractError(f"{at}: on_unparsed {self.on_unparsed!r}")

    @property
    def published(self) -> str:
        """Name of the output column."""
        if self.output:
            return self.output
        name = self.column
        if self.treatment == "date_to_study_day":
            return name[:-3] + "DY" if name.upper().endswith("DTC") else f"{name}_STUDY_DAY"
        if self.treatment == "partial_date_to_year_offset":
            return f"{name}_YR_REL"
        return "AGE" if self.treatment == "dob_to_age" else name


@dataclass
class Domain:
    name: str
    rules: list[Rule]
    subject_key: str | None = None
    join_key_template: str | None = None
    retained_in_full: bool = False
    reassign: bool = False
    reassign_mode: str = "subjects"

    def check(self) -> None:
        names = [r.column for r in self.rules]
        if len(set(names)) != len(names):
            raise ContractError(f"{self.name}: a column has two rules")
        live = [r for r in self.rules if r.treatment != "drop"]
        out = [r.published for r in live] + [f"{r.published}_GRAN" for r in live if r.treatment in ("date_to_study_day", "partial_date_to_year_offset")]
        if len(set(out)) != len(out):
            raise ContractError(f"{self.name}: two rules publish one column")
        for rule in self.rules:
            rule.check()
            if rule.redundant_with and rule.redundant_with not in {r.column for r in live}:
                raise ContractError(f"{self.name}.{rule.column}: redundant with a column that does not survive")
            if rule.treatment in ("date_shift", "date_shift_raw") and not (self.subject_key or self.join_key_template):
                raise ContractError(f"{self.name}.{rule.column}: shifting needs a subject key")
        if self.retained_in_full:
            changed = [r.column for r in self.rules if r.treatment in ("cap_numeric", "generalize_numeric", "pool_rare", "redact_freetext", "dummy_text", "zip3")]
            if changed:
                raise ContractError(f"{self.name} is retained in full but changes {', '.join(changed)}")


@dataclass
class Anchor:
    domain: str
    subject_column: str
    date_column: str
    day_zero: bool = False


@dataclass
class Risk:
    domain: str
    k_target: int = 5
    sensitive: list[str] = field(default_factory=list)
    fail_on_target_miss: bool = False


@dataclass
class Approval:
    approved_by: str
    approved_at: str
    rules_fingerprint: str
    digest_scheme: int = DIGEST_SCHEME
    accepted: int = 0
    changed: int = 0
    note: str | None = None


@dataclass
class Contract:
    contract_version: str
    source: str
    tier: str
    anchor: Anchor
    risk: Risk
    domains: list[Domain]
    approval: Approval | None = None

    def __post_init__(self) -> None:
        self.check()

    def check(self) -> None:
        if self.tier not in ("lds", "deidentified"):
            raise ContractError(f"unknown tier {self.tier!r}")
        names = [d.name for d in self.domains]
        if len(set(names)) != len(names):
            raise ContractError("a domain appears twice")
        for what, name in (("anchor", self.anchor.domain), ("risk", self.risk.domain)):
            if name not in names:
                raise ContractError(f"{what} domain {name!r} is not in the contract")
        for domain in self.domains:
            domain.check()
            for rule in domain.rules:
                dated = rule.is_date or rule.column.upper().endswith("DTC")
                if self.tier == "deidentified" and dated and rule.treatment == "retain":
                    raise ContractError(f"{domain.name}.{rule.column}: a deidentified tier keeps no dates")
        if self.approval:
            if self.approval.digest_scheme != DIGEST_SCHEME:
                raise ContractError("signed under another digest scheme; sign the same decisions again")
            if self.approval.rules_fingerprint != self.digest():
                raise ContractError("edited after it was approved")

    def digest(self) -> str:
        """Fingerprint of what the rules do: no notes, version, approval or defaults."""

        def bare(obj) -> dict:
            return {
                f.name: v for f in fields(obj)
                if (v := getattr(obj, f.name)) != f.default and f.name != "note" and v not in (None, [])
            }

        payload = {
            "scheme": DIGEST_SCHEME,
            "source": self.source,
            "tier": self.tier,
            "anchor": asdict(self.anchor),
            "risk": asdict(self.risk),
            "domains": [
                bare(d) | {"rules": [bare(r) for r in sorted(d.rules, key=lambda r: r.column)]}
                for d in sorted(self.domains, key=lambda d: d.name)
            ],
        }
        blob = json.dumps(payload, sort_keys=True, separators=(",", ":"))
        return "sha256:" + hashlib.sha256(blob.encode()).hexdigest()

    def domain(self, name: str) -> Domain:
        return next(d for d in self.domains if d.name == name)

    def quasi_identifiers(self) -> list[str]:
        return [r.published for r in self.domain(self.risk.domain).rules if r.quasi_identifier and r.treatment != "drop"]

    def to_yaml(self) -> str:
        import yaml

        def lean(value):
            if isinstance(value, dict):
                return {k: lean(v) for k, v in value.items() if v not in (None, [], False)}
            return [lean(v) for v in value] if isinstance(value, list) else value

        return yaml.safe_dump(lean(asdict(self)), sort_keys=False, allow_unicode=True)

    @staticmethod
    def from_yaml(text: str) -> Contract:
        import yaml

        raw = yaml.safe_load(text)
        try:
            return Contract(
                raw["contract_version"],
                raw["source"],
                raw["tier"],
                Anchor(**raw["anchor"]),
                Risk(**raw["risk"]),
                [Domain(**(d | {"rules": [Rule(**r) for r in d.get("rules", [])]})) for d in raw["domains"]],
                Approval(**raw["approval"]) if raw.get("approval") else None,
            )
        except (TypeError, KeyError) as wrong:
            raise ContractError(f"not a contract: {wrong}") from None
