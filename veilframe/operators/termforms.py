"""What a line of a study document shows to be an identifying term.

Five readers look at a line, each from another side: the anatomy of code-like
tokens, labels with their values, runs of capitalised words that end in a head
word, Chinese phrases by their tail, and means of contact.  Each yields
(category, term, confidence); confidence 3 is a term that says so itself (a
registry number, a labelled value), 2 one whose form is typical, 1 one that
only its place suggests.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from veilframe.operators.detect import DRUG_ENDINGS

Found = tuple[str, str, int]
HAN = "一-龥"

# Registries (prefix of their numbers and digits after it).
REGISTRIES = {"NCT": (8, 8), "ISRCTN": (8, 8), "UMIN": (9, 9), "CTR": (8, 8), "CHICTR": (10, 10), "DRKS": (8, 8), "ACTRN": (14, 14), "JRCT": (10, 10)}
#: Words that look like codes and are none (standards, units, grading scales).
NO_CODE = frozenset("IND ICH GCP ISO CTCAE RECIST MEDDRA SNOMED CDISC SDTM WHO FDA EMA NMPA CFR COVID SARS HIV HBV HCV ECG EGFR PD HER IL CYP QTC COV DNA RNA CD BMI LDL HDL ANNEX TABLE SECTION VISIT DAY WEEK PART GRADE VERSION PHASE".split())

_TOKEN = re.compile(r"[A-Za-z0-9][A-Za-z0-9_./-]*[A-Za-z0-9]")
_COMPOUND = re.compile(r"([A-Z]{1,5})-?(\d{3,6})[A-Z]?")
_YEAR_NUMBER = re.compile(r"(?:19|20)\d\d-\d{6}-\d\d(?:-\d\d)?")


def codes(line: str) -> Iterator[Found]:
    """Tokens told apart by their anatomy: letters, digits and how they are joined."""
    for m in _TOKEN.finditer(line):
        token, groups = m[0], m[0].split("-")
        if _YEAR_NUMBER.fullmatch(token):  # European trial numbers
            yield "study_id", token, 3
            continue
        head = re.match(r"[A-Za-z]*", token)[0].upper()
        low, high = REGISTRIES.get(head, (1, 0))
        digits = token[len(head) :]
        if digits.isdigit() and low <= len(digits) <= high:
            yield "study_id", token, 3
        elif head in NO_CODE or not token[0].isupper():
            continue
        elif len(groups) > 2 and all(g and g.upper() == g and g.isalnum() for g in groups) and len(groups) < 7 and groups[0].isalpha() and len(groups[0]) > 1:
            yield "study_id", token, 2 if any(c.isdigit() for c in token) else 1
        elif _COMPOUND.fullmatch(token):
            yield "drug", token, 2
        elif m.end() < len(line) and line[m.end() : m.end() + 2].lstrip()[:1] in ("®", "™") and len(token) > 2:
            yield "drug", token, 3
    for m in re.finditer(r"\b([A-Z]{2,5}) (\d{4,6}[A-Z]?)\b", line):  # a compound code parted by a blank
        if m[1] not in NO_CODE and not re.fullmatch(r"(?:19|20)\d\d", m[2]):
            yield "drug", m[0], 2
    for m in re.finditer(r"[A-Za-z]{5,}", line):
        if any(m[0].lower().endswith(e) for e in DRUG_ENDINGS if len(e) > 3 or e in ("mab", "nib")):
            yield "drug", m[0], 2


# Labels and the category of what follows them.
LABELS: dict[str, str] = {
    "study_id": "protocol|protocol no|protocol number|protocol id|protocol code|study no|study number|study id|study code|trial number|trial id|ind|ind no|ind number|eudract no|eudract number",
    "sponsor": "sponsor|sponsor name|sponsored by|manufacturer|applicant",
    "person": "principal investigator|coordinating investigator|investigator|sub-investigator|medical monitor|sponsor contact|study director|project manager|author|authors|statistician|prepared by|written by|reviewed by|approved by|signed by|name|printed name|signatory",
    "contact": "tel|telephone|phone|fax|mobile|cell|hotline",
}
HAN_LABELS = {
    "study_id": "方案编号|试验编号|研究编号|项目编号",
    "sponsor": "申办方|申办者|申办方名称|申办者名称|生产企业",
    "person": "研究者|主要研究者|联系人|监查员|姓名|负责人|签名|撰写人|审核人|批准人|作者",
    "contact": "电话|传真|手机|联系电话",
}
_BY_LABEL = {}
for _table in (LABELS, HAN_LABELS):
    for _category, _labels in _table.items():
        _BY_LABEL |= {label: _category for label in _labels.split("|")}
_LABEL = "|".join(sorted(map(re.escape, _BY_LABEL), key=len, reverse=True))
_LABELLED = re.compile(rf"(?i)(?<![A-Za-z{HAN}-])(?P<label>{_LABEL})(?![A-Za-z])\.?\s*(?P<mark>[:：#])?\s*(?P<value>[^\n]*)")
_ALONE = re.compile(rf"(?i)^\W*(?P<label>{_LABEL})\.?\s*[:：#]?\s*$")

_GIVEN = r"[^\W\d_a-z][a-zà-ÿ'’-]+"
_INITIALS = r"(?:[A-Z]\.\s?){1,3}"
#: A person's name: given and family name, initials and family name, or a family name in capitals.
NAME = re.compile(rf"(?:{_GIVEN}(?:\s{_INITIALS.strip()})?(?:\s{_GIVEN}){{1,2}}|{_INITIALS}{_GIVEN}|[A-Z]{{2,}}\s{_GIVEN}|{_GIVEN}\s[A-Z]{{2,}})(?![A-Za-z])")
HAN_NAME = re.compile(rf"[{HAN}]{{2,4}}")
TITLES = r"(?:Drs?|Prof|Professor|Mr|Mrs|Ms|Miss|Sir)\.?\s+"
DEGREES = r"(?:M\.?D|Ph\.?D|MBBS|PharmD|RN|MSc|MPH|DO|FRCP)\b"


def label_of(line: str) -> str | None:
    """Category of a label that stands alone on its line, so that its value comes next."""
    m = _ALONE.match(line)
    return _BY_LABEL[m["label"].lower()] if m else None


def value_of(category: str, value: str) -> str | None:
    """The part of the text after a label that can be its value."""
    value = value.strip(" \t:：#-")
    if category == "study_id":
        m = re.match(r"[A-Za-z0-9][A-Za-z0-9_./,-]*", value)
        return m[0].rstrip(".,") if m and any(c.isdigit() for c in m[0]) and len(m[0]) > 3 else None
    if category == "person":
        m = NAME.match(re.sub(rf"^{TITLES}", "", value)) or HAN_NAME.match(value)
        return m[0] if m else None
    if category == "contact":
        m = re.match(r"\+?\(?\d[\d\s().-]{6,}\d", value)
        return m[0] if m else None
    phrase = re.split(r"[,，。；;]\s|\s{3,}", value)[0].strip()
    return phrase if 3 <= len(phrase) <= 80 or re.search(f"[{HAN}]{{2}}", phrase) else None


def labelled(line: str) -> Iterator[Found]:
    """Values that follow a label on the same line; names and companies only after a mark."""
    for m in _LABELLED.finditer(line):
        category = _BY_LABEL[m["label"].lower()]
        if m["mark"] or category in ("study_id", "contact"):
            if value := value_of(category, m["value"]):
                yield category, value, 3


# Head words of companies and of institutions.
COMPANY = frozenset("Inc Ltd LLC GmbH AG SA BV NV PLC Corp Corporation Pharma Pharmaceutical Pharmaceuticals Biotech Biosciences Biopharma Therapeutics Laboratories Biologics".split())
INSTITUTION = frozenset("Hospital University Clinic Institute College Infirmary Hospice Polyclinic Klinikum".split())
PAIRS = frozenset({("Medical", "Center"), ("Medical", "Centre"), ("Cancer", "Center"), ("Cancer", "Centre"), ("Health", "System"), ("Research", "Center"), ("Research", "Centre")})
_RUN = re.compile(r"(?:[A-Z][\w&'’.-]*|of|the|and|for|&)(?:,?[ \t]+(?:[A-Z][\w&'’.-]*|of|the|and|for|&))*")


def organisations(line: str) -> Iterator[Found]:
    """Runs of capitalised words up to a head word of a company or institution."""
    for run in _RUN.finditer(line):
        words = run[0].replace(",", " ,").split()
        start = 0
        for k, w in enumerate(words):
            bare, before = w.strip(".,"), words[k - 1].strip(".,") if k else ""
            kind = "sponsor" if bare in COMPANY else "site" if bare in INSTITUTION or (before, bare) in PAIRS else None
            body = [x for x in words[start:k] if x not in (",", "the", "The", "of", "and", "for", "&", "At", "In")]
            if kind and body:
                first = next(i for i in range(start, k) if words[i] in body)
                phrase = " ".join(words[max(first, k - 6) : k + 1]).replace(" ,", ",")
                # "University of Somewhere" goes on after its head word.
                if kind == "site" and words[k + 1 : k + 2] == ["of"] and k + 2 < len(words):
                    phrase = " ".join([phrase, "of", words[k + 2]])
                yield kind, phrase.rstrip(".,"), 2
                start = k + 1
            elif kind == "site" and words[k + 1 : k + 2] == ["of"] and k + 2 < len(words):
                yield kind, " ".join([w, "of", words[k + 2].rstrip(".,")]), 2


def persons(line: str) -> Iterator[Found]:
    """Names beside a title, a degree or an own mail address."""
    for m in re.finditer(rf"\b{TITLES}", line):
        rest = line[m.end() :]
        name = NAME.match(rest) or re.match(_GIVEN, rest)
        if name:
            yield "person", name[0], 3
    for m in NAME.finditer(line):
        after = line[m.end() : m.end() + 60]
        if re.match(rf",?\s+{DEGREES}", after) or re.match(r"\s*[(<\[,:–-]?\s*(?:mailto:)?[\w.+-]+@[\w-]+\.", after):
            yield "person", m[0], 2


# Tails of Chinese phrases, and titles after a name.
HAN_TAILS = {
    "drug": "单抗|替尼|他汀|沙坦|洛尔|普利|西林|沙星|霉素|拉唑|康唑|格列净|格列汀",
    "sponsor": "股份有限公司|有限公司|集团|制药|药业|医药|生物科技|生物技术",
    "site": "医院|大学|研究所|研究院|医学院|卫生院",
}
_HAN = {c: re.compile(rf"(?<![{HAN}])[{HAN}]{{1,24}}?(?:{tails})") for c, tails in HAN_TAILS.items()}
_HAN_TITLED = re.compile(rf"(?<![{HAN}])([{HAN}]{{2,3}}?)(?:医生|教授|主任|博士|先生|女士)")


def chinese(line: str) -> Iterator[Found]:
    """Chinese phrases by their tail; names before a title."""
    if re.search(f"[{HAN}]", line):
        for category, pattern in _HAN.items():
            for m in pattern.finditer(line):
                yield category, m[0], 2
        for m in _HAN_TITLED.finditer(line):
            yield "person", m[1], 2


_MAIL = re.compile(r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+")
_LINK = re.compile(r"(?:\bhttps?://|\bwww\.)[^\s<>\"')]+")
_DIAL = re.compile(r"(?<![\w+-])[+(]?\d[\d\s().-]{7,18}\d(?![\w-])")


def contacts(line: str) -> Iterator[Found]:
    """Mail addresses, links and numbers written as one dials them."""
    for pattern in (_MAIL, _LINK):
        for m in pattern.finditer(line):
            yield "contact", m[0].rstrip("."), 3
    for m in _DIAL.finditer(line):
        digits, groups = re.sub(r"\D", "", m[0]), [len(g) for g in re.findall(r"\d+", m[0])]
        if m[0][0] == "+" and 7 <= len(digits) <= 15 or groups[-3:] == [3, 3, 4] and len(groups) == 3:
            yield "contact", m[0], 2


READERS = (codes, labelled, organisations, persons, chinese, contacts)


def terms_of(line: str) -> list[Found]:
    """Every term of a line once, with its best confidence."""
    best: dict[tuple[str, str], int] = {}
    for reader in READERS:
        for category, term, confidence in reader(line):
            term = term.strip()
            if len(term) > 1:
                best[category, term] = max(confidence, best.get((category, term), 0))
    return [(c, t, n) for (c, t), n in best.items()]
