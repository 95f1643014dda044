"""The crosswalk: random, stable, reversible stand-ins for identifiers.

Tables are append-only Parquet folders.  An entry is found by an HMAC of entity
and original, computed in the JVM; originals are stored encrypted.  Keys reach
the plans only as columns of a one-row table, never as literals.

Random draws are made once: candidates are written to a staging folder and read
back before anything depends on them, so a task that runs again cannot change a
stand-in.  Staged originals are encrypted like committed ones; ``sweep`` removes
the staging folders once the tables made from them are written.  A commit moves
the staged folder to its final name; a reader sees whole commits only.  One
writer at a time.
"""

from __future__ import annotations

import hashlib
import hmac
import json
import os
import secrets
import uuid
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.functions.text import shape_space
from veilframe.operators.ordering import dense_index
from veilframe.operators.treatments import lookup
from veilframe.sources import files

# The alphabet of prefixed stand-ins and the limits of drawing.
ALPHABET = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
BODY, ROUNDS, MIN_SPACE = 8, 64, 64
DAYS = (180, 540)
DESTROY = "DESTROY CROSSWALK"
#: Columns of staged rows that hold originals.
CLEAR = ("value", "donor", "head")
SCHEMAS = {
    "surrogate": "entity string, lookup string, original binary, surrogate string, issued_at string",
    "seen_original": "entity string, lookup string",
    "date_offset": "lookup string, days int",
    "reassignment": "grp string, donor_lookup string, recipient binary, delta int",
    "text_dummy": "lookup string, dummy string",
    "access_log": "at string, who string, justification string, surrogate string, found boolean",
}


class VaultError(RuntimeError):
    """Wrong key, missing justification or exhausted stand-ins."""


def derive(key: bytes, purpose: str) -> bytes:
    """HKDF-SHA256 with an empty salt: one 32-byte key per purpose."""
    root = hmac.new(b"\0" * 32, key, hashlib.sha256).digest()
    return hmac.new(root, purpose.encode() + b"\x01", hashlib.sha256).digest()


def prefixed(prefix: str) -> Callable[[pd.Series], list[str]]:
    def make(values: pd.Series) -> list[str]:
        return [f"{prefix}-" + "".join(secrets.choice(ALPHABET) for _ in range(BODY)) for _ in values]

    return make


def _same_shape(text: str, keep: int = 0) -> str:
    out = [text[:keep]]
    for c in text[keep:]:
        if c.isascii() and c.isdigit():
            out.append(secrets.choice("0123456789"))
        elif c.isascii() and c.isalpha():
            letter = secrets.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
            out.append(letter if c.isupper() else letter.lower())
        else:
            out.append(c)
    return "".join(out)


def shaped(values: pd.Series) -> list[str]:
    return [_same_shape(v) for v in values]


def dummy(values: pd.Series) -> list[str]:
    """Random text in the shape of a (normalised) text."""
    out = []
    for value in values:
        word = []
        for c in value:
            if "一" <= c <= "龥":
                word.append(chr(0x4E00 + secrets.randbelow(0x9FA5 - 0x4E00 + 1)))
            elif c.isdigit():
                word.append(secrets.choice("0123456789"))
            elif c.isalpha():
                word.append(secrets.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            else:
                word.append(c)
        out.append("".join(word))
    return out


class Vault:
    def __init__(self, spark: SparkSession, path: str, key: bytes):
        self.spark, self.path = spark, path.rstrip("/")
        pepper, data = derive(key, "lookup"), derive(key, "data")
        pads = [bytes(b ^ x for b in pepper.ljust(64, b"\0")) for x in (0x36, 0x5C)]
        row = [(1, bytearray(pads[0]), bytearray(pads[1]), bytearray(data))]
        self._keys = spark.createDataFrame(row, "_one int, _ipad binary, _opad binary, _key binary")
        self._check(hmac.new(derive(key, "check"), b"vault", hashlib.sha256).hexdigest())

    def _check(self, token: str) -> None:
        meta = f"{self.path}/meta.json"
        if files.exists(self.spark, meta):
            if not hmac.compare_digest(json.loads(files.read_text(self.spark, meta))["check"], token):
                raise VaultError("this key does not open the vault")
        else:
            files.write_text(self.spark, meta, json.dumps({"check": token, "created": _now()}))

    # --- tables ---------------------------------------------------------------

    def read(self, table: str) -> DataFrame:
        folder = f"{self.path}/{table}"
        commits = [f"{folder}/{n}" for n, is_dir in files.listing(self.spark, folder) if is_dir]
        if not commits:
            return self.spark.createDataFrame([], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).parquet(*commits)

    def append(self, table: str, rows: DataFrame) -> int:
        """Commits rows and returns their number (from the files' footers)."""
        name = f"{datetime.now(UTC):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        staged = f"{self.path}/_staging/{table}-{name}"
        rows.write.parquet(staged)
        final = f"{self.path}/{table}/{name}"
        files.rename(self.spark, staged, final)
        return self.spark.read.schema(SCHEMAS[table]).parquet(final).count()

    def _stage(self, rows: DataFrame) -> DataFrame:
        """Write and read back: whatever was drawn is now fixed.  Originals rest encrypted."""
        at = f"{self.path}/_staging/draw-{uuid.uuid4().hex}"
        clear = [c for c in rows.columns if c in CLEAR]
        if not clear:
            rows.write.parquet(at)
            return self.spark.read.parquet(at)
        sealed = {c: F.aes_encrypt(F.encode(F.col(c).cast("string"), "UTF-8"), F.col("_key"), F.lit("GCM")) for c in clear}
        self.keyed(rows).withColumns(sealed).select(*rows.columns).write.parquet(at)
        opened = {c: F.decode(F.aes_decrypt(F.col(c), F.col("_key"), F.lit("GCM")), "UTF-8") for c in clear}
        return self.keyed(self.spark.read.parquet(at)).withColumns(opened).select(*rows.columns)

    def sweep(self) -> int:
        """Deletes the staging folders; for when every table made from them is written."""
        folders = [n for n, is_dir in files.listing(self.spark, f"{self.path}/_staging") if is_dir and n.startswith("draw-")]
        for name in folders:
            files.delete(self.spark, f"{self.path}/_staging/{name}")
        return len(folders)

    def keyed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_one", F.lit(1)).join(F.broadcast(self._keys), "_one").drop("_one")  # one row

    @staticmethod
    def _hmac(entity: str, value: Column) -> Column:
        message = F.concat(F.encode(F.lit(entity), "UTF-8"), F.unhex(F.lit("00")), F.encode(value, "UTF-8"))
        inner = F.unhex(F.sha2(F.concat(F.col("_ipad"), message), 256))
        return F.sha2(F.concat(F.col("_opad"), inner), 256)

    def with_lookup(self, rows: DataFrame, column: str, entity: str, name: str = "lookup") -> DataFrame:
        return self.keyed(rows).withColumn(name, self._hmac(entity, F.col(column))).drop("_ipad", "_opad", "_key")

    # --- issue ----------------------------------------------------------------

    def _draw(self, asked: DataFrame, make: Callable[[pd.Series], list[str]]) -> DataFrame:
        def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                batch["surrogate"] = make(batch["value"])
                yield batch

        return self._stage(asked.select("value", "lookup").mapInPandas(draw, "value string, lookup string, surrogate string"))

    def surrogates(self, values: DataFrame, entity: str, prefix: str | None = None, leads: DataFrame | None = None) -> DataFrame:
        """(value, surrogate) of every distinct non-null value; new ones are issued.

        ``leads`` (value, lead) fixes the beginning of shaped stand-ins.

        With a prefix ``PREFIX-XXXXXXXX``, else in the shape of the original.  A
        stand-in is never its original, another stand-in, or any original seen.
        """
        distinct = values.toDF("value").where(F.col("value").isNotNull()).select(F.col("value").cast("string")).distinct()
        wanted = self._stage(self.with_lookup(distinct, "value", entity))
        issued = self.read("surrogate").where(F.col("entity") == entity)
        new = wanted.join(issued, "lookup", "left_anti")
        # One pass: how many are new, which of them are stand-ins already, which have too few shapes.
        taken = issued.select(F.col("surrogate").alias("value"), F.lit(True).alias("_taken")).distinct()
        narrow = F.lit(False) if prefix else shape_space(F.col("value")) < MIN_SPACE
        state = new.join(taken, "value", "left").agg(
            F.count(F.lit(1)).alias("n"), F.count("_taken").alias("clash"), F.count_if(narrow).alias("narrow")
        ).first()
        if state["clash"]:
            raise VaultError(f"an original of {entity} is already a stand-in")
        if state["narrow"]:
            raise VaultError(f"shapes of {entity} leave too few stand-ins")
        if state["n"]:
            known = self.read("seen_original").where(F.col("entity") == entity)
            self.append("seen_original", new.join(known, "lookup", "left_anti").select(F.lit(entity).alias("entity"), "lookup"))
            self._issue(new, state["n"], entity, prefixed(prefix) if prefix else shaped, leads)
        issued = self.read("surrogate").where(F.col("entity") == entity).select("lookup", "surrogate")
        return wanted.join(issued, "lookup").select("value", "surrogate")

    def led(self, df: DataFrame, column: str, entity: str, head: str, head_entity: str) -> DataFrame:
        """(value, surrogate): stand-ins that begin with the stand-in of another column.

        Every value must begin with its own row's head and have one head only.
        """
        rows = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value"), F.col(head).alias("head")).distinct()
        wrong = rows.where(F.col("head").isNull() | ~F.col("value").startswith(F.col("head")) | (F.length("head") >= F.length("value")))
        if not wrong.isEmpty():
            raise VaultError(f"values of {column} do not begin with {head}")
        if not rows.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            raise VaultError(f"one value of {column} has several beginnings")
        heads = self.surrogates(rows.select("head"), head_entity).select(F.col("value").alias("head"), F.col("surrogate").alias("lead"))
        leads = self._stage(rows.join(lookup(heads), "head").select("value", "lead"))
        return self.surrogates(rows.select("value"), entity, None, leads)

    def _issue(self, new: DataFrame, n: int, entity: str, make: Callable[[pd.Series], list[str]], leads: DataFrame | None = None) -> None:
        left = new.select("value", "lookup")
        for _ in range(ROUNDS):
            drawn = self._draw(left, make)
            if leads is not None:
                rest = F.expr("substr(surrogate, length(lead) + 1)")
                drawn = drawn.join(leads, "value").withColumn("surrogate", F.concat("lead", rest)).drop("lead")
            # The first of equal candidates keeps it; all others draw again.
            first = drawn.groupBy("surrogate").agg(F.min_by("lookup", "lookup").alias("_l"))
            unique = drawn.join(first, (drawn["surrogate"] == first["surrogate"]) & (drawn["lookup"] == first["_l"]), "left_semi")
            seen = self.read("seen_original").where(F.col("entity") == entity).select(F.col("lookup").alias("_as_original"))
            issued = self.read("surrogate").where(F.col("entity") == entity).select("surrogate")
            good = (
                self.with_lookup(unique, "surrogate", entity, "_as_original")
                .join(seen, "_as_original", "left_anti")
                .join(issued, "surrogate", "left_anti")
                .where(F.col("surrogate") != F.col("value"))
            )
            rows = self.keyed(good).select(
                F.lit(entity).alias("entity"),
                "lookup",
                F.aes_encrypt(F.encode("value", "UTF-8"), F.col("_key"), F.lit("GCM")).alias("original"),
                "surrogate",
                F.lit(_now()).alias("issued_at"),
            )
            n -= self.append("surrogate", rows)
            if n == 0:
                return
            left = self._stage(left.join(self.read("surrogate").where(F.col("entity") == entity), "lookup", "left_anti"))
        raise VaultError(f"no free stand-ins left for {entity}")

    def replace(self, df: DataFrame, column: str, entity: str, prefix: str | None = None, key: Column | None = None) -> DataFrame:
        """``column`` replaced by stand-ins of itself, or of ``key`` where given."""
        own = df.withColumn("_k", (key if key is not None else F.col(column)).cast("string"))
        pairs = self.surrogates(own.select("_k"), entity, prefix)
        joined = own.join(lookup(pairs), F.col("_k") == F.col("value"), "left")
        return joined.withColumn(column, F.when(F.col(column).isNotNull(), F.col("surrogate"))).drop("_k", "value", "surrogate")

    def offsets(self, keys: DataFrame) -> DataFrame:
        """(value, days): a stable shift of 180 to 540 days, either way, per key."""
        distinct = keys.toDF("value").where(F.col("value").isNotNull()).select(F.col("value").cast("string")).distinct()
        wanted = self._stage(self.with_lookup(distinct, "value", "offset"))
        new = wanted.join(self.read("date_offset"), "lookup", "left_anti")

        def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                size = [DAYS[0] + secrets.randbelow(DAYS[1] - DAYS[0] + 1) for _ in range(len(batch))]
                batch["days"] = [s if secrets.randbelow(2) else -s for s in size]
                yield batch

        if not new.isEmpty():
            self.append("date_offset", new.select("lookup").mapInPandas(draw, "lookup string, days int"))
        return wanted.join(self.read("date_offset"), "lookup").select("value", "days")

    def labels(self, values: DataFrame, entity: str, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
        """(key, label): ``PREFIX A..Z, AA..`` for trimmed upper-case values, in random order."""
        kept = {k.strip().upper() for k in keep}
        keys = values.toDF("value").where(F.col("value").isNotNull()).select(F.upper(F.trim("value")).alias("value")).distinct()
        keys = keys.where(~F.col("value").isin(*kept)) if kept else keys
        wanted = self._stage(self.with_lookup(keys, "value", entity))
        issued = self.read("surrogate").where(F.col("entity") == entity)
        new = [r[0] for r in wanted.join(issued, "lookup", "left_anti").select("value").limit(703).collect()]
        taken = issued.count()
        if len(new) + taken > 702:
            raise VaultError(f"more values of {entity} than labels")
        if new:
            secrets.SystemRandom().shuffle(new)
            rows = [(v, f"{prefix} {_letters(taken + i)}") for i, v in enumerate(new)]
            fresh = self.with_lookup(self.spark.createDataFrame(rows, "value string, surrogate string"), "value", entity)
            self.append("surrogate", self.keyed(fresh).select(
                F.lit(entity).alias("entity"), "lookup",
                F.aes_encrypt(F.encode("value", "UTF-8"), F.col("_key"), F.lit("GCM")).alias("original"),
                "surrogate", F.lit(_now()).alias("issued_at")))
        issued = self.read("surrogate").where(F.col("entity") == entity)
        return wanted.join(issued, "lookup").select(F.col("value").alias("key"), F.col("surrogate").alias("label"))

    def text_dummies(self, texts: DataFrame) -> DataFrame:
        """(value, dummy) per normalised text; never the text itself."""
        distinct = texts.toDF("value").where(F.col("value").isNotNull()).distinct()
        wanted = self._stage(self.with_lookup(distinct, "value", "text"))
        left = wanted.join(self.read("text_dummy"), "lookup", "left_anti")
        for _ in range(100):
            if left.isEmpty():
                break
            drawn = self._draw(left, dummy)
            first = drawn.groupBy("surrogate").agg(F.min("lookup").alias("_l"))
            good = drawn.join(first, (drawn["surrogate"] == first["surrogate"]) & (drawn["lookup"] == first["_l"]), "left_semi")
            good = good.where(F.col("surrogate") != F.col("value"))
            good = good.join(self.read("text_dummy").select(F.col("dummy").alias("surrogate")), "surrogate", "left_anti")
            self.append("text_dummy", good.select("lookup", F.col("surrogate").alias("dummy")))
            left = self._stage(wanted.join(self.read("text_dummy"), "lookup", "left_anti"))
        if not left.isEmpty():
            raise VaultError("a text is too short for a stand-in of its own")
        return wanted.join(self.read("text_dummy"), "lookup").select("value", "dummy")

    def derangement(self, subjects: DataFrame, group: str) -> DataFrame:
        """(donor, recipient): one random cycle through the new subjects of a group.

        Earlier pairs stay.  A single new subject has no one to change places
        with and keeps its own records; ``unmoved`` in the run's report counts it.
        """
        distinct = subjects.toDF("donor").where(F.col("donor").isNotNull()).distinct()
        wanted = self._stage(self.with_lookup(distinct, "donor", f"reassign:{group}", "donor_lookup"))
        done = self.read("reassignment").where(F.col("grp") == group)
        new = wanted.join(done, "donor_lookup", "left_anti")
        n = new.count()
        if n:
            def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    batch["_r"] = [secrets.randbits(62) for _ in range(len(batch))]
                    yield batch

            drawn = self._stage(new.select("donor", "donor_lookup").mapInPandas(draw, "donor string, donor_lookup string, _r bigint"))
            ring = dense_index(drawn, "_r", "donor").drop("_r")
            following = ring.select((F.pmod(F.col("_i") - 1, F.lit(n))).alias("_i"), F.col("donor").alias("recipient"))
            rows = self.keyed(ring.join(following, "_i")).select(
                F.lit(group).alias("grp"), "donor_lookup",
                F.aes_encrypt(F.encode("recipient", "UTF-8"), F.col("_key"), F.lit("GCM")).alias("recipient"),
                F.lit(None).cast("int").alias("delta"))
            self.append("reassignment", rows)
        pairs = self.keyed(wanted.join(self.read("reassignment").where(F.col("grp") == group), "donor_lookup"))
        opened = F.decode(F.aes_decrypt(F.col("recipient"), F.col("_key"), F.lit("GCM")), "UTF-8")
        return pairs.select("donor", opened.alias("recipient"))

    def pinned_deltas(self, group: str, moves: DataFrame) -> DataFrame:
        """(donor, delta): the days each donor's records move, fixed when both dates were first known.

        ``moves`` is (donor, delta); what an earlier run pinned wins, so a
        reference date corrected later moves no record that is already out.
        A donor without a delta (an unknown date) is not pinned here.
        """
        wanted = self._stage(self.with_lookup(moves.select(F.col("donor"), F.col("delta").cast("int").alias("delta")), "donor", f"reassign:{group}", "donor_lookup"))
        known = self.read("reassignment").where(F.col("grp") == f"{group}:delta").select("donor_lookup", F.col("delta").alias("_known"))
        new = self._stage(wanted.where(F.col("delta").isNotNull()).join(known, "donor_lookup", "left_anti").select("donor_lookup", "delta"))
        if not new.isEmpty():
            self.append("reassignment", new.select(F.lit(f"{group}:delta").alias("grp"), "donor_lookup", F.lit(None).cast("binary").alias("recipient"), "delta"))
        return wanted.join(known, "donor_lookup", "left").select("donor", F.coalesce("_known", "delta").alias("delta"))

    def labelled(self, entity: str) -> DataFrame:
        """(original, label) of a treatment namespace; these name no person, so nothing is logged."""
        if not entity.startswith("treatment"):
            raise VaultError("only treatment labels are open")
        opened = F.decode(F.aes_decrypt(F.col("original"), F.col("_key"), F.lit("GCM")), "UTF-8")
        return self.keyed(self.read("surrogate").where(F.col("entity") == entity)).select(opened.alias("original"), F.col("surrogate").alias("label"))

    def settle_unanchored(self, group: str, subjects: DataFrame, references: DataFrame) -> int:
        """Pins a shift of 0 for subjects of a group without a reference date; returns how many."""
        lost = subjects.toDF("donor").where(F.col("donor").isNotNull()).distinct().join(
            references.where(F.col("anchor").isNotNull()).select(F.col("subject").alias("donor")), "donor", "left_anti"
        )
        rows = self._stage(self.with_lookup(lost, "donor", f"reassign:{group}", "donor_lookup"))
        known = self.read("reassignment").where((F.col("grp") == f"{group}:unanchored"))
        new = self._stage(rows.join(known, "donor_lookup", "left_anti"))
        n = new.count()
        if n:
            self.append("reassignment", new.select(F.lit(f"{group}:unanchored").alias("grp"), "donor_lookup", F.lit(None).cast("binary").alias("recipient"), F.lit(0).alias("delta")))
        return n

    def is_unanchored(self, group: str, subjects: DataFrame) -> DataFrame:
        """Subjects whose shift is pinned to 0."""
        asked = self.with_lookup(subjects.toDF("donor").distinct(), "donor", f"reassign:{group}", "donor_lookup")
        return asked.join(self.read("reassignment").where(F.col("grp") == f"{group}:unanchored"), "donor_lookup", "left_semi").select("donor")

    # --- logged ways back -----------------------------------------------------

    def reverse(self, surrogates: list[str], entity: str, who: str, justification: str) -> DataFrame:
        """(surrogate, original); logged, misses included, before anything is returned."""
        if not justification.strip():
            raise VaultError("reversal needs a justification")
        asked = self.spark.createDataFrame([(s,) for s in surrogates], "surrogate string")
        issued = self.read("surrogate").where(F.col("entity") == entity)
        found = asked.join(issued, "surrogate", "left")
        self.append("access_log", found.select(
            F.lit(_now()).alias("at"), F.lit(who).alias("who"), F.lit(justification).alias("justification"),
            "surrogate", F.col("lookup").isNotNull().alias("found")))
        opened = F.decode(F.aes_decrypt(F.col("original"), F.col("_key"), F.lit("GCM")), "UTF-8")
        return self.keyed(found).select("surrogate", opened.alias("original"))

    def donor_of(self, recipient: str, group: str, who: str, justification: str, subjects: DataFrame) -> DataFrame:
        """Whose records a subject now holds; logged like a reversal."""
        if not justification.strip():
            raise VaultError("reversal needs a justification")
        pairs = self.derangement(subjects, group).where(F.col("recipient") == recipient)
        row = [(_now(), who, justification, recipient, not pairs.isEmpty())]
        self.append("access_log", self.spark.createDataFrame(row, SCHEMAS["access_log"]))
        return pairs

    def access_log(self) -> DataFrame:
        return self.read("access_log").orderBy("at")

    def stats(self) -> DataFrame:
        """(kind, n): stand-ins per entity, shifts, texts and reversals."""
        by_entity = self.read("surrogate").groupBy(F.concat(F.lit("surrogate:"), "entity").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
        out = by_entity
        for table in ("date_offset", "text_dummy", "access_log"):
            out = out.unionByName(self.read(table).agg(F.lit(table).alias("kind"), F.count(F.lit(1)).alias("n")))
        return out

    def destroy(self, phrase: str) -> dict[str, str]:
        """Deletes the crosswalk for good; needs the exact phrase."""
        if phrase != DESTROY:
            raise VaultError("the phrase does not match")
        files.delete(self.spark, self.path)
        return {"destroyed": self.path, "at": _now()}


def _now() -> str:
    return datetime.now(UTC).isoformat(timespec="microseconds")


def _letters(i: int) -> str:
    return chr(65 + i) if i < 26 else chr(65 + i // 26 - 1) + chr(65 + i % 26)


def recase(dummy_text: Column, original: Column) -> Column:
    """The dummy in the case of the original, character by character."""
    chars = lambda c: F.split(c, "")
    return F.array_join(
        F.zip_with(chars(dummy_text), chars(original), lambda d, o: F.when((o == F.lower(o)) & (o != F.upper(o)), F.lower(d)).otherwise(d)), ""
    )


def dummy_column(vault: Vault, df: DataFrame, column: str) -> DataFrame:
    """Free text replaced by random text of its shape, equal texts alike."""
    core = F.regexp_replace(F.col(column).cast("string"), r"^\s+|\s+$", "")
    # Where upper case changes the length (a sharp s), the text is keyed as written.
    key = F.when(F.length(F.upper(core)) == F.length(core), F.upper(core)).otherwise(core)
    # A text without letters and digits ("--") has only its shape and stays as it is.
    own = df.withColumn("_core", core).withColumn("_key_text", F.when(F.col("_core").rlike(r"[\p{L}\p{Nd}]"), key))
    pairs = vault.text_dummies(own.select("_key_text"))
    joined = own.join(lookup(pairs), F.col("_key_text") == F.col("value"), "left")
    lead = F.regexp_extract(F.col(column), r"^(\s*)", 1)
    tail = F.regexp_extract(F.col(column), r"(\s*)$", 1)
    new = F.when(F.col("dummy").isNotNull(), F.concat(lead, recase(F.col("dummy"), F.col("_core")), tail)).otherwise(F.col(column))
    return joined.withColumn(column, new).drop("_core", "_key_text", "value", "dummy")


def environment_key(name: str = "VEIL_VAULT_KEY") -> bytes:
    """Key from the environment (hex)."""
    value = os.environ.get(name)
    if not value:
        raise VaultError(f"{name} is not set")
    return bytes.fromhex(value)
