"""Term masking in study documents: find, count, replace, check again."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from functools import reduce
from urllib.parse import quote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilframe.functions.text import word_pattern
from veilframe.operators.termforms import HAN, NAME, TITLES, label_of, terms_of
from veilframe.operators.treatments import lookup
from veilframe.operators.vault import Vault
from veilframe.session import cut
from veilframe.sources import files

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


# What parts a list, and words that are no drug or person.
_LIST = re.compile(r"\s*(?:,|;|，|、|；|/|\band\b|\bor\b|&|和|及|与|或)\s*")
_LEAD = re.compile(r"(?i)^.*?(?:[(:：]|\b(?:such as|e\.\s?g\.?,?|i\.\s?e\.?,?|including|includes?|for example|for instance|like)\s+)")
_BULLET = re.compile(r"^\s*(?:[-*•‣◦–·]|\(?[0-9a-z]{1,2}[.)])\s+(.{3,60}?)\s*[.;,]?\s*$")
_NO_ITEM = frozenset(
    """other others drug drugs medication medications medicine medicines inhibitor inhibitors inducer inducers substrate substrates strong
    moderate potent weak agent agents product products herbal supplement supplements the a an etc all any these those certain some treatment
    therapy therapies patient patients subject subjects class classes use used not with without is are be may should must within days weeks
    prior before after during study dose doses known listed below above table section see list following include test compound
    investigational placebo matching vehicle clinical medical hospital university department institute street road""".split()
)


def _runs(lines: list[str]) -> Iterator[str]:
    """Neighbouring bullets as one list."""
    run: list[str] = []
    for line in [*lines, ""]:
        if m := _BULLET.match(line):
            run.append(m[1])
            continue
        if len(run) > 2:
            yield ", ".join(run)
        run = []


def _list_items(line: str) -> Iterator[tuple[str, str]]:
    """(category, item) of the parts of a line that could be a drug or a person and nothing else."""
    parts = _LIST.split(line)
    for part in parts if len(parts) > 1 else ():
        item = _LEAD.sub("", part.strip()).strip(" \t.。;:()（）[]\"'“”")
        words = item.split()
        if len(item) < 4 or any(w.lower().strip(".'") in _NO_ITEM for w in words):
            continue
        if len(parts) > 2 and 1 <= len(words) <= 3 and all(re.fullmatch(r"[A-Za-z][A-Za-z'’.-]*", w) for w in words):
            yield "drug", item
        if NAME.fullmatch(name := re.sub(rf"^{TITLES}", "", item)):
            yield "person", name


def _heads(before: str) -> list[str]:
    """What an alias in brackets may stand for: the last one to four words, or the last Chinese characters."""
    words = re.findall(r"[^\s,;:()（），；：]+", before)[-4:]
    chinese = re.search(rf"[{HAN}]+$", before.rstrip())
    tails = [chinese[0][-k:] for k in range(2, 13) if k <= len(chinese[0])] if chinese else []
    return list({*(" ".join(words[-k:]).lower() for k in range(1, len(words) + 1)), *tails})


def propose(blocks: DataFrame, doc: str, text: str, position: str | None = None) -> DataFrame:
    """(term_key, term, category, confidence, n, n_docs) of terms that written forms suggest.

    With them come the lines after a label (in the block, and over blocks
    where ``position`` orders them), short forms in brackets after a drug, and
    the rest of a list or a run of bullets that holds two found drugs or one
    found person.  ``ordered`` puts the surest and commonest first.
    """
    short = re.compile(r"\s*[(（]([A-Za-z][A-Za-z0-9-]{1,15})[)）]")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for d, t in zip(batch["_doc"], batch["_text"]):
                lines = [line for line in t.splitlines() if line.strip()]
                out += [(d, term, c, n, "form", None, None) for line in lines for c, term, n in terms_of(line)]
                for line, after in zip(lines, lines[1:]):
                    if (c := label_of(line)) and 3 <= len(after.strip()) <= 80:
                        out.append((d, after.strip(), c, 3, "form", None, None))
                out += [(d, m.group(1), "drug", 1, "alias", None, _heads(t[max(0, m.start() - 120) : m.start()])) for m in short.finditer(t)]
                out += [(d, item, c, 1, "list", line, None) for line in [*lines, *_runs(lines)] for c, item in _list_items(line)]
            yield pd.DataFrame(out, columns=["_doc", "term", "category", "confidence", "way", "line", "heads"])

    rows = blocks.where(F.col(text).isNotNull()).select(F.col(doc).cast("string").alias("_doc"), F.col(text).alias("_text"))
    every = rows.mapInPandas(scan, "_doc string, term string, category string, confidence int, way string, line string, heads array<string>")
    key = F.lower(F.regexp_replace(F.trim("term"), r"\s+", " "))
    every = cut(every.withColumn("term_key", key))  # read three times below
    columns = ["_doc", "term", "term_key", "category", "confidence"]
    found = every.where("way = 'form'").select(*columns)
    if position:
        lines = labelled_terms(blocks, doc, position, text)
        found = found.unionByName(lines.select(F.col("doc").cast("string").alias("_doc"), "term", key.alias("term_key"), "category", F.lit(3).alias("confidence")))
    known = found.select("term_key", "category").distinct().withColumn("_known", F.lit(True))
    named = every.where("way = 'alias'").withColumn("_at", F.monotonically_increasing_id())
    drugs = known.where("category = 'drug'").select(F.col("term_key").alias("_head"))
    named = named.withColumn("_head", F.explode("heads")).join(drugs, "_head", "left_semi").dropDuplicates(["_at"]).select(*columns)
    items = every.where("way = 'list'").join(known, ["term_key", "category"], "left")
    of_line = ["_doc", "category", F.xxhash64("line").alias("line")]
    seeds = items.where("_known").groupBy(*of_line).agg(F.count_distinct("term_key").alias("seeds"))
    seeds = seeds.where((F.col("seeds") >= 2) | (F.col("category") == "person")).drop("seeds")
    listed = items.where("_known IS NULL").select(*columns, F.xxhash64("line").alias("line")).join(seeds, ["_doc", "category", "line"], "left_semi")
    found = found.unionByName(named).unionByName(listed.select(*columns))
    per_doc = found.groupBy("term_key", "category", "_doc").agg(
        F.count(F.lit(1)).alias("n"), F.min("term").alias("term"), F.max("confidence").alias("confidence")
    )
    return per_doc.groupBy("term_key", "category").agg(
        F.min("term").alias("term"), F.max("confidence").alias("confidence"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_docs")
    )


def ordered(proposed: DataFrame) -> DataFrame:
    """Surest first, then commonest, then by term."""
    return proposed.orderBy(F.desc("confidence"), F.desc("n"), "term_key", "category")


#: Beginning of the stand-ins of each category.
STAND_INS = {"study_id": "STUDY", "drug": "DRUG", "sponsor": "SPONSOR", "site": "SITE", "person": "PERSON", "contact": "CONTACT"}


def with_stand_ins(proposed: DataFrame, vault: Vault) -> DataFrame:
    """Adds ``replacement``, the vault's stand-in of each term: the same in every document and run."""
    parts = []
    for category, prefix in STAND_INS.items():
        own = proposed.where(F.col("category") == category)
        pairs = vault.surrogates(own.select("term_key"), f"protocol:{category}", prefix)
        parts.append(own.join(lookup(pairs), F.col("term_key") == F.col("value"), "left").drop("value").withColumnRenamed("surrogate", "replacement"))
    return reduce(DataFrame.unionByName, parts)


def labelled_terms(blocks: DataFrame, doc: str, position: str, text: str) -> DataFrame:
    """(doc, category, term): values on the line after a label that ends its own line."""
    order = W.partitionBy(doc).orderBy(position)
    label = F.pandas_udf(lambda lines: lines.map(lambda t: label_of(t) if isinstance(t, str) else None), "string")
    following = blocks.select(F.col(doc).alias("doc"), F.col(text).alias("_line"), F.trim(F.lead(text).over(order)).alias("term"))
    near = following.where((F.length("_line") < 60) & F.length("term").between(3, 80))
    return near.withColumn("category", label("_line")).where(F.col("category").isNotNull()).select("doc", "category", "term")


def apply_terms(spark: SparkSession, folder: str, mapping: dict[str, str], approver: str, out: str) -> dict[str, int | str]:
    """Masked copies of all documents, read back and counted; every term needs a stand-in."""
    if not approver.strip():
        raise ValueError("masking needs a named approver")
    blank = [t for t, r in mapping.items() if not (r or "").strip()]
    if blank:
        raise ValueError(f"terms without a decision: {', '.join(sorted(blank)[:10])}")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pattern = re.compile(word_pattern(list(mapping)))
        by_key = {re.sub(r"\s+", " ", k).lower(): v for k, v in mapping.items()}
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                name = path.rsplit("/", 1)[-1]
                if name.startswith("~$"):
                    continue
                if name.endswith(".docx"):
                    new = docx_mask(content, mapping)
                else:
                    new = pattern.sub(lambda m: by_key[re.sub(r"\s+", " ", m[0]).lower()], content.decode("utf-8", "replace")).encode()
                masked = pattern.sub(lambda m: by_key[re.sub(r"\s+", " ", m[0]).lower()], name)
                files.write_here(f"{folder_out}/{quote(masked)}", new)
                rows.append((masked,))
            yield pd.DataFrame(rows, columns=["name"])

    every = spark.read.format("binaryFile").option("pathGlobFilter", "*.{txt,md,docx}").load(folder)
    folder_out = files.qualified(spark, out).rstrip("/")
    n = every.select("path", "content").mapInPandas(write, "name string").count()
    left = residual(documents(spark, out), "text", list(mapping))
    return {"documents": n, "terms": len(mapping), "residual": left, "approved_by": approver}


def term_counts(blocks: DataFrame, text: str, terms: list[str]) -> DataFrame:
    """(term, n): whole-term hits, longest first and without overlap."""
    hits = F.regexp_extract_all(F.col(text), F.lit(word_pattern(terms)), F.lit(0))
    found = blocks.select(F.explode(hits).alias("hit"))
    key = F.lower(F.regexp_replace("hit", r"\s+", " "))
    return found.groupBy(key.alias("term")).agg(F.count(F.lit(1)).alias("n"))


def mask(blocks: DataFrame, text: str, mapping: dict[str, str]) -> DataFrame:
    """Terms replaced by their stand-ins in one pass, longest first."""
    pattern = re.compile(word_pattern(list(mapping)))
    by_key = {re.sub(r"\s+", " ", k).lower(): v for k, v in mapping.items()}

    def write(values: pd.Series) -> pd.Series:
        def one(m: re.Match) -> str:
            return by_key[re.sub(r"\s+", " ", m[0]).lower()]

        return values.map(lambda t: pattern.sub(one, t) if isinstance(t, str) else t)

    return blocks.withColumn(text, F.pandas_udf(write, "string")(F.col(text)))


def residual(blocks: DataFrame, text: str, terms: list[str]) -> int:
    """Blocks that still hold a term; 0 after a correct mask."""
    return blocks.where(F.col(text).rlike(word_pattern(terms))).count()


def docx_text(content: bytes) -> list[str]:
    """Paragraph texts of all word parts (body, headers, footers, notes)."""
    out = []
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        for name in sorted(book.namelist()):
            if re.fullmatch(r"word/(document|header\d*|footer\d*|footnotes|endnotes|comments)\.xml", name):
                for p in ElementTree.fromstring(book.read(name)).iter(f"{_W}p"):
                    line = "".join(t.text or "" for t in p.iter(f"{_W}t"))
                    if line.strip():
                        out.append(line)
    return out


def docx_mask(content: bytes, mapping: dict[str, str]) -> bytes:
    """Terms replaced across runs; pictures, embedded files and authorship removed."""
    pattern = re.compile(word_pattern(list(mapping)))
    by_key = {re.sub(r"\s+", " ", k).lower(): v for k, v in mapping.items()}
    result = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as book, zipfile.ZipFile(result, "w", zipfile.ZIP_DEFLATED) as new:
        for name in book.namelist():
            data = book.read(name)
            if name.startswith(("word/media/", "word/embeddings/")):
                data = b""
            elif re.fullmatch(r"word/(document|header\d*|footer\d*|footnotes|endnotes|comments)\.xml", name):
                root = ElementTree.fromstring(data)
                for p in root.iter(f"{_W}p"):
                    runs = list(p.iter(f"{_W}t"))
                    line = "".join(t.text or "" for t in runs)
                    masked = pattern.sub(lambda m: by_key[re.sub(r"\s+", " ", m[0]).lower()], line)
                    if masked != line:
                        for i, t in enumerate(runs):
                            t.text = masked if i == 0 else ""
                data = ElementTree.tostring(root)
            elif name.startswith("docProps/"):
                root = ElementTree.fromstring(data)
                for node in root.iter():
                    if node.text and node.text.strip():
                        node.text = ""
                data = ElementTree.tostring(root)
            new.writestr(name, data)
    return result.getvalue()


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(path, block_no, text) of .txt, .md and .docx files; lock files are skipped."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                name = path.rsplit("/", 1)[-1]
                if name.startswith("~$"):
                    continue
                lines = docx_text(content) if name.endswith(".docx") else content.decode("utf-8", "replace").splitlines()
                rows += [(path, i, line) for i, line in enumerate([name.rsplit(".", 1)[0], *lines])]
            yield pd.DataFrame(rows, columns=["path", "block_no", "text"])

    every = spark.read.format("binaryFile").option("pathGlobFilter", "*.{txt,md,docx}").load(folder)
    return every.select("path", "content").mapInPandas(read, "path string, block_no int, text string")
