"""From a signed contract and a study to a published tier.

validate -> anchors -> screen -> treat -> risk -> blinding -> manifest.  Every
domain is one lazy plan; only random draws, counts and the write run jobs.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions import dates, numbers, rawdates, text
from veilframe.functions.naming import move_group
from veilframe.operators import blinding, detect, reassign, risk, treatments
from veilframe.operators.vault import Vault, dummy_column
from veilframe.plans.contract import NEEDS_ANCHOR, NEEDS_VAULT, Contract, ContractError, Domain, Rule
from veilframe.session import cut

ROW = "_row_id"


class ContractMismatch(ContractError):
    """Data and contract disagree."""


class RiskTargetMissed(RuntimeError):
    """The published table does not reach its k."""


@dataclass
class Published:
    tables: dict[str, DataFrame]
    queue: DataFrame | None
    risk: dict | None
    leaks: list[dict]
    manifest: dict
    notes: list[str] = field(default_factory=list)


def validate(contract: Contract, study: dict[str, DataFrame], allow_missing: bool = False) -> None:
    """Fail closed: every table and column must be declared, and be there."""
    declared = {d.name: d for d in contract.domains}
    problems = [f"undeclared domain {n}" for n in sorted(set(study) - set(declared))]
    problems += [f"missing domain {n}" for n in sorted(set(declared) - set(study))]
    for name in sorted(set(study) & set(declared)):
        have, want = set(study[name].columns) - {ROW}, {r.column for r in declared[name].rules}
        problems += [f"undeclared column {name}.{c}" for c in sorted(have - want)]
        if not allow_missing:
            problems += [f"missing column {name}.{c}" for c in sorted(want - have)]
    if problems:
        raise ContractMismatch("; ".join(problems))


class Pipeline:
    def __init__(self, contract: Contract, vault: Vault | None = None, factory=detect.PatternDetector):
        self.contract, self.vault, self.factory = contract, vault, factory
        used = {r.treatment for d in contract.domains for r in d.rules}
        if vault is None and used & NEEDS_VAULT:
            raise ContractError("this contract needs a vault")
        self.needs_anchor = bool(used & NEEDS_ANCHOR)

    def _key(self, domain: Domain, df: DataFrame) -> Column | None:
        if domain.join_key_template:
            return treatments.template(domain.join_key_template, {c: F.col(c) for c in df.columns})
        return F.col(domain.subject_key).cast("string") if domain.subject_key else None

    def anchors(self, study: dict[str, DataFrame]) -> DataFrame | None:
        if not self.needs_anchor:
            return None
        a = self.contract.anchor
        df = study[a.domain].withColumn("_key", self._key(self.contract.domain(a.domain), study[a.domain]))
        return treatments.anchors(df, "_key", a.date_column, ROW)

    def _apply(self, df: DataFrame, rule: Rule, notes: list[str]) -> tuple[DataFrame, dict[str, Column]]:
        """The frame (joined where needed) and the columns this rule publishes."""
        name, out, c = rule.column, rule.published, F.col(rule.column)
        t = rule.treatment
        if t in ("retain", "screen_freetext"):
            return df, {out: c}
        if t == "surrogate_id":
            key = F.col("_key") if rule.entity == "subject" and "_key" in df.columns else None
            prefix = None if rule.preserve_format or rule.shape_prefix_from else rule.prefix or rule.entity.upper()[:4]
            if rule.shape_prefix_from:
                head = next(r for d in self.contract.domains for r in d.rules if r.column == rule.shape_prefix_from)
                pairs = self.vault.led(df, name, rule.entity, rule.shape_prefix_from, head.entity)
                df = df.join(treatments.lookup(pairs), c == F.col("value"), "left").withColumn(f"_out_{out}", F.col("surrogate"))
                return df.drop("value", "surrogate"), {out: F.col(f"_out_{out}")}
            df = self.vault.replace(df.withColumn(f"_out_{out}", c), f"_out_{out}", rule.entity, prefix, key)
            return df, {out: F.col(f"_out_{out}")}
        if t == "faker":
            df = treatments.numbered_stand_ins(df.withColumn(f"_out_{out}", c), f"_out_{out}", ROW, rule.provider.upper())
            return df, {out: F.col(f"_out_{out}")}
        if t == "date_to_study_day":
            day = dates.study_day(c, F.col("anchor"), rule.day_zero or self.contract.anchor.day_zero)
            return df, {out: day, f"{out}_GRAN": dates.granularity(c)}
        if t == "partial_date_to_year_offset":
            return df, {out: dates.year_offset(c, F.col("anchor")), f"{out}_GRAN": dates.granularity(c)}
        if t == "dob_to_age":
            return df, {out: dates.capped_age(c, F.col("anchor"), int(rule.cap or 90))}
        if t in ("date_shift", "date_shift_raw"):
            if "_days" not in df.columns:
                offsets = self.vault.offsets(df.select("_key")).withColumnRenamed("days", "_days")
                df = df.join(treatments.lookup(offsets), F.col("_key") == F.col("value"), "left").drop("value")
            if t == "date_shift":
                return df, {out: dates.shift_iso(c, F.col("_days"))}
            order = rule.date_order
            if order is None:
                order = rawdates.infer_order(df, [name]).first()["day_order"]
                order = order if order in ("dmy", "mdy") else None
            df = df.withColumn(f"_raw_{name}", rawdates.shift_written(c.cast("string"), F.col("_days"), order))
            return df, {out: rawdates.finish(c, F.col(f"_raw_{name}"), rule.on_unparsed)}
        if t == "cap_numeric":
            return df, {out: numbers.cap_numeric(c, rule.cap)}
        if t == "generalize_numeric":
            return df, {out: numbers.bands(c, rule.bins, rule.cap)}
        if t == "zip3":
            return df, {out: text.zip3(c.cast("string"))}
        if t == "pool_rare":
            df = treatments.pool_rare(df.withColumn(f"_out_{out}", c), f"_out_{out}", rule.min_count, rule.pooled_value)
            return df, {out: F.col(f"_out_{out}")}
        if t == "label_map":
            keep = [k.strip().upper() for k in rule.keep_values or []]
            labels = self.vault.labels(df.select(name), rule.entity, rule.prefix or "LABEL", tuple(keep))
            df = df.join(treatments.lookup(labels), F.upper(F.trim(c)) == F.col("key"), "left").withColumn(
                f"_out_{out}", F.when(F.upper(F.trim(c)).isin(*keep), c).otherwise(F.col("label")) if keep else F.col("label")
            )
            return df.drop("key", "label"), {out: F.col(f"_out_{out}")}
        if t == "redact_freetext":
            found = detect.findings_of(df, name, self.factory)
            df = df.join(found, c.cast("string") == F.col("text"), "left").withColumn(
                f"_out_{out}", F.when(F.col("findings").isNotNull(), detect.redacted(c, F.col("findings"))).otherwise(c)
            )
            return df.drop("text", "findings"), {out: F.col(f"_out_{out}")}
        if t == "dummy_text":
            df = dummy_column(self.vault, df.withColumn(f"_out_{out}", c), f"_out_{out}")
            return df, {out: F.col(f"_out_{out}")}
        raise ContractError(f"treatment {t} has no plan")

    def treat(self, domain: Domain, df: DataFrame, anchor: DataFrame | None, notes: list[str]) -> DataFrame:
        """The published table of one domain (row ids kept for the review queue)."""
        key = self._key(domain, df)
        if key is not None:
            df = df.withColumn("_key", key)
        if anchor is not None and key is not None:
            df = treatments.with_anchor(df, "_key", anchor)
        elif anchor is None:
            df = df.withColumn("anchor", F.lit(None).cast("string"))
        columns: dict[str, Column] = {}
        for rule in domain.rules:
            if rule.treatment == "drop" or rule.column not in df.columns:
                continue
            df, made = self._apply(df, rule, notes)
            columns |= made
        out = df.select(ROW, *[c.alias(n) for n, c in columns.items()])
        for rule in domain.rules:
            if rule.output_template and rule.treatment != "drop":
                parts = {n: F.col(n) for n in columns} | {"value": F.col(rule.published)}
                out = out.withColumn(rule.published, treatments.template(rule.output_template, parts))
        return out

    def run(self, study: dict[str, DataFrame], allow_missing: bool = False, unreviewed: bool = False) -> Published:
        contract = self.contract
        if contract.approval is None and not unreviewed:
            raise ContractError("the contract is a draft; approve it first")
        validate(contract, study, allow_missing)
        notes: list[str] = []
        study = {n: df if ROW in df.columns else cut(df.withColumn(ROW, F.monotonically_increasing_id())) for n, df in study.items()}
        anchor = self.anchors(study)
        reassigned, given = {}, dict(study)
        for d in contract.domains:
            if d.reassign and d.name in study:
                study[d.name], reassigned[d.name] = self._reassigned(d, given, notes)
        terms = self._blind_terms(study)
        targets = [(d.name, r.column) for d in contract.domains for r in d.rules if r.treatment == "screen_freetext"]
        policy = detect.policy_of({k: v for d in contract.domains for r in d.rules for k, v in (r.screen_policy or {}).items()})
        base = self.factory

        def factory():
            return detect.CompositeDetector(base(), detect.StudyDrugDetector(terms)) if terms else base()

        queue = detect.screen(study, targets, ROW, factory, policy) if targets else None
        tables = {d.name: self.treat(d, study[d.name], anchor, notes) for d in contract.domains if d.name in study}
        quasi, measured = contract.quasi_identifiers(), None
        if quasi:
            groups = risk.classes(tables[contract.risk.domain], quasi)
            measured = risk.summary(groups, contract.risk.k_target).first().asDict()
            measured["quasi_identifiers"] = quasi
            if contract.risk.sensitive:
                found = risk.l_diversity(tables[contract.risk.domain], quasi, contract.risk.sensitive).collect()  # one row per column
                measured["l_diversity"] = {r["sensitive"]: r["l_min"] for r in found}
            if measured["k_min"] is not None and measured["k_min"] < contract.risk.k_target:
                notes.append(f"k is {measured['k_min']}, below the target of {contract.risk.k_target}")
                if contract.risk.fail_on_target_miss:
                    raise RiskTargetMissed(notes[-1])
        else:
            notes.append("no quasi-identifiers declared: risk was not measured")
        leaks = []
        if terms:
            for d in contract.domains:
                relabelled = [r.published for r in d.rules if r.treatment == "label_map"]
                leaks += [r.asDict() for r in blinding.audit(tables[d.name], terms, d.name, ROW, relabelled).collect()]  # per term and column
        manifest = self._manifest(measured, leaks, queue, notes, reassigned)
        if anchor is not None:
            manifest["anchor"] |= anchor.agg(F.count(F.lit(1)).alias("subjects"), F.count("anchor").alias("with_reference")).first().asDict()
        manifest["unconverted_dates"] = {d.name: unconverted_dates(contract, d, study[d.name], tables[d.name]) for d in contract.domains if d.name in tables}
        return Published(tables, queue, measured, leaks, manifest, notes)

    def _reassigned(self, d: Domain, study: dict[str, DataFrame], notes: list[str]) -> tuple[DataFrame, dict]:
        """The moved records and a report of counts."""
        df, a = study[d.name], self.contract.anchor
        key = self._key(d, df)
        # Tables of one kind change owners together, every kind on its own.
        group = move_group(d.name) or d.name
        if key is None:
            raise ContractError(f"{d.name}: reassigning needs a subject key")
        shifting = [r.column for r in d.rules if r.column in df.columns and (r.is_date or r.column.upper().endswith("DTC"))]
        at = self.contract.domain(a.domain)
        keyed = study[a.domain].withColumn("_key", self._key(at, study[a.domain]))
        references = cut(treatments.anchors(keyed, "_key", a.date_column, ROW))
        own = at.reassign  # no table beside the moved ones: each is its own anchor
        rows = cut(reassign.self_rows(df, key, d.subject_key, ROW) if own else reassign.subject_rows(study[a.domain], self._key(at, study[a.domain]), ROW))
        mirrors = reassign.mirrors_of(df, key, rows, [*shifting, ROW], d.subject_key, None if own else a.subject_column)
        if d.reassign_mode == "subjects":
            if d.join_key_template is None:
                mirrors.pop(d.subject_key, None)  # the recipient itself
            elif own:
                raise ContractError(f"{d.name}: records with a composed key need an anchor table that is not moved")
            orders = {r.column: r.date_order for r in d.rules if r.date_order}
            moved = reassign.by_subject(df, d.subject_key, shifting, references, self.vault, group, rows, key, mirrors, orders)
        else:
            mirrors.pop(d.subject_key, None)
            plain = [c for c in df.columns if c not in (d.subject_key, ROW, *shifting, *mirrors)]
            found = reassign.sequence_columns(df.where(F.col(d.subject_key).isNotNull()), d.subject_key, plain).where("is_sequence").collect() if plain else []  # one row per column
            sequences = [r["column_name"] for r in found] or [c for c in plain if c.upper().endswith("SEQ")][:1]
            moved = reassign.by_row(df, d.subject_key, sequences, ROW)
            if d.reassign_mode == "values":
                others = [r.column for r in d.rules if r.column in df.columns and r.column not in (d.subject_key, *sequences, *mirrors)]
                moved = reassign.shuffle_values(moved, others, ROW)
            owner = moved.withColumn("_owner", F.col(d.subject_key).cast("string"))
            moved = cut(reassign.rewritten(owner, "_owner", rows, mirrors).drop("_owner"))
        counts = reassign.report(df.withColumn("_key", key), moved.withColumn("_key", key), "_key", references).first().asDict()
        if d.reassign_mode == "subjects" and shifting:
            counts["n_kept_dates"] = self.vault.is_unanchored(group, df.select(key).where(key.isNotNull())).count()
            if counts["n_kept_dates"]:
                notes.append(f"{d.name}: {counts['n_kept_dates']} subjects keep their dates as written; derive study days again")
        if d.reassign_mode == "subjects":
            pairs = self.vault.derangement(df.select(key), group)
            counts["n_unmoved"] = pairs.where("donor = recipient").count()
            if counts["n_unmoved"]:
                notes.append(f"{d.name}: {counts['n_unmoved']} subjects had no one to change places with and keep their records")
        return moved, {"mode": d.reassign_mode, "group": group, "mirrors": sorted(mirrors)} | counts

    def _blind_terms(self, study: dict[str, DataFrame]) -> list[str]:
        values, keep = [], []
        for d in self.contract.domains:
            for r in d.rules:
                if r.treatment == "label_map" and d.name in study:
                    spared = [k.strip().upper() for k in r.keep_values or []]
                    seen = study[d.name].select(F.upper(F.trim(F.col(r.column).cast("string"))).alias("v")).where(F.col("v").isNotNull())
                    found = [v[0] for v in (seen.where(~F.col("v").isin(*spared)) if spared else seen).distinct().limit(703).collect()]
                    if len(found) > 702:  # as many as there are labels
                        raise ContractMismatch(f"{d.name}.{r.column}: more treatments than labels")
                    values += found
                    keep += r.keep_values or []
        return blinding.revealing_terms(values, keep)

    def _manifest(self, measured: dict | None, leaks: list[dict], queue: DataFrame | None, notes: list[str], reassigned: dict) -> dict:
        c = self.contract
        return {
            "tool": "veilframe",
            "run_at": datetime.now(UTC).isoformat(timespec="seconds"),
            "tier": c.tier,
            "contract": {"version": c.contract_version, "digest": c.digest(), "approved_by": c.approval.approved_by if c.approval else None},
            "anchor": {"domain": c.anchor.domain, "column": c.anchor.date_column},
            "transformation": {d.name: {r.column: r.treatment for r in d.rules} for d in c.domains},
            "reassignment": reassigned,
            "screening": detect.policy_summary(queue).first().asDict() if queue is not None else None,
            "risk": measured,
            "blinding": {"leaks": len(leaks)},
            "notes": notes,
        }


def unconverted_dates(contract: Contract, domain: Domain, source: DataFrame, out: DataFrame) -> dict[str, int]:
    """Dates that had a value and lost it, per published column; one aggregate each side."""
    rules = [r for r in domain.rules if r.treatment in ("date_to_study_day", "partial_date_to_year_offset", "date_shift", "date_shift_raw")]
    if not rules:
        return {}
    had = source.agg(*[F.count(r.column).alias(r.published) for r in rules]).first().asDict()
    has = out.agg(*[F.count(r.published).alias(r.published) for r in rules]).first().asDict()
    return {n: had[n] - has[n] for n in had if had[n] > has[n]}


def selfcheck(published: dict[str, DataFrame], source: dict[str, DataFrame], contract: Contract) -> list[str]:
    """Properties every published tier must have; returns what fails."""
    wrong = []
    iso = r"(?<![0-9])[12][0-9]{3}-[01][0-9]-[0-3][0-9](?![0-9])"
    for d in contract.domains:
        if d.name not in published:
            wrong.append(f"{d.name} is missing")
            continue
        out = published[d.name]
        dropped = {r.column for r in d.rules if r.treatment == "drop"} & set(out.columns)
        wrong += [f"{d.name}.{c} was to be dropped" for c in sorted(dropped)]
        if out.count() != source[d.name].count():
            wrong.append(f"{d.name} changed its number of rows")
        days = [r.published for r in d.rules if r.treatment in NEEDS_ANCHOR]
        strings = [c for c, t in out.dtypes if t == "string" and c not in {r.published for r in d.rules if r.treatment in ("retain", "screen_freetext", "date_shift")}]
        if contract.tier == "deidentified" and days and strings:
            tests = out.agg(*[F.count_if(F.col(c).rlike(iso)).alias(c) for c in strings]).first().asDict()
            wrong += [f"{d.name}.{c} holds dates" for c, n in tests.items() if n]
        for r in d.rules:
            if r.treatment == "surrogate_id" and r.column in source[d.name].columns:
                a = source[d.name].select(F.col(r.column).cast("string").alias("v")).distinct()
                b = out.select(F.col(r.published).alias("v")).distinct()
                if not b.where(F.col("v").isNotNull()).join(a, "v", "left_semi").isEmpty():
                    wrong.append(f"{d.name}.{r.published} keeps originals")
    return wrong
