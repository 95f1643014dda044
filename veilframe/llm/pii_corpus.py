"""Generated training texts of the personal information field.

A text is put together from a clinical word group, cue phrases and details.
All of it is invented from a grammar: names from syllables, numbers from group
patterns, cues from the word lists below.  No table is read but the reference
terms the caller hands over, and no cue list was taken from a table.

Every cue belongs to a *family*.  ``sentence`` takes the families it may use, so
that the field can be measured on cues it has never met.
"""

from __future__ import annotations

import random
import re

Span = tuple[str, int, int]

# --- details -----------------------------------------------------------------

_ON = "b br c ch cl d dr f fl fr g gl gr h j k kl kr l m n p ph pr qu r s sch sh sl st t th tr v w wh x y z".split()
_VO = "a e i o u y ai au ea ee ei ie io oa oo ou ä ö ü á é è í ó å ø".split()
_CO = ["", "", "b", "ck", "d", "f", "g", "k", "l", "ll", "m", "n", "nd", "ng", "nn", "nt", "r", "rd", "rk", "rn", "rs", "s", "ss", "st", "t", "th", "tt", "v", "x", "z"]
_ENDS = ["", "", "", "son", "man", "ley", "ton", "ski", "ez", "mann", "berg", "feld", "ini", "ova", "dottir", "kamp", "worth", "ham", "er", "a", "o"]


def word(r: random.Random, parts: int) -> str:
    """An invented word of a number of syllables."""
    return "".join(r.choice(_ON) + r.choice(_VO[:6] if r.random() < 0.8 else _VO) + (r.choice(_CO) if r.random() < 0.4 else "") for _ in range(parts))


def name_word(r: random.Random, family: bool) -> str:
    out = (word(r, r.choice([1, 1, 2, 2, 3])) + (r.choice(_ENDS) if family else r.choice(_CO))).capitalize()
    if family and r.random() < 0.12:
        out = r.choice(["O'", "Mc", "D’", "Mac", "O’"]) + out
    if r.random() < 0.08:
        out += "-" + word(r, 2).capitalize()
    return out


def person(r: random.Random) -> str:
    given, family = name_word(r, False), name_word(r, True)
    if r.random() < 0.06:
        family = r.choice(["van ", "de ", "von ", "van der ", "di ", "el ", "da "]) + family
    initial = r.choice("ABCDEFGHIJKLMNOPQRSTUVWZ")
    forms = [f"{given} {family}"] * 7 + [f"{given} {initial}. {family}", f"{given} {initial} {family}", f"{given[0]}. {family}", f"{given[0]}. {family}",
             f"{given[0]} {family}", f"{family}, {given}", f"{family}, {given}", f"{family}, {given[0]}.", f"{given[0]}.{initial}. {family}", family, given, given, given,
             f"{given} {name_word(r, False)} {family}"]
    return r.choice(forms)


def digits(r: random.Random, form: str) -> str:
    """``9`` a digit, ``A`` a letter."""
    return re.sub("[9A]", lambda m: r.choice("0123456789") if m[0] == "9" else r.choice("ABCDEFGHJKLMNPQRSTUVWXYZ"), form)


def grouped(r: random.Random, sizes: list[int], seps: str = "-. ") -> str:
    return r.choice(seps).join(digits(r, "9" * n) for n in sizes)


def phone(r: random.Random) -> str:
    national = r.choice([[3, 3, 4]] * 4 + [[3, 4], [4, 3, 3], [5, 6], [5, 3, 3], [3, 7], [2, 4, 4], [4, 6], [4, 7], [2, 2, 2, 2, 2], [3, 3, 3], [4, 4], [3, 8], [2, 3, 2, 2]])
    style = r.random()
    if style < 0.25 and sum(national) > 7:
        out = f"({'0' if r.random() < 0.3 else ''}{digits(r, '9' * national[0])}){r.choice(['', ' '])}" + grouped(r, national[1:])
    elif style < 0.4:
        out = r.choice("0123456789") + digits(r, "9" * r.choice([8, 9, 9, 9, 10]))
    elif style < 0.6 or (len(national) > 1 and r.random() < 0.25):
        country = r.choice(["+9", "+99", "+99", "+999", "0099"])
        out = digits(r, country) + r.choice([" ", "-", " (0)", "", " "]) + grouped(r, national, "- ")
    elif style < 0.75:
        out = "0" + grouped(r, [n - (k == 0 and n > 2) for k, n in enumerate(national)])
    else:
        out = grouped(r, national)
    if r.random() < 0.12:
        out += r.choice([" ext. ", " ext ", " x", " x ", ", ext ", " extension "]) + digits(r, "9" * r.choice([2, 3, 4]))
    return out


_ID_KINDS = {
    "national": (
        "SSN|SS#|soc sec|social security|social security number|SIN|national ID|national id no|NI number|nat. ins.|national insurance|NHS number|NHS no|NINO|CPR|personnummer|DNI|NIE|PESEL|BSN|fiscal code|tax ID|ID|ID no|ID number|identity no|citizen ID|social sec. no",
        ["999-99-9999", "999 99 9999", "999-99-9999", "999999999", "AA 99 99 99 A", "AA999999A", "999 999 9999", "999-999-999", "999999-9999", "99999999A", "99999999999", "AA 999999 A", "99.99.99-999.99"],
    ),
    "insurance": (
        "insurance no|insurance number|insurance ID|policy no|policy|member ID|member no|health card|Medicare|Medicaid|health insurance|health plan ID|Versichertennummer|beneficiary|ins. no|ins no|insurer ref|HICN|carte vitale",
        ["A999999999", "AAA999999999", "9AA9-AA9-AA99", "9999999999", "999-99-9999A", "AA 99 99 99 A", "999999999999", "A99 999 999", "AA99999999", "9 99 99 99 999 999"],
    ),
    "passport": (
        "passport|passport no|passport number|pass no|passp.|travel document|ID card|identity card|id card no|Personalausweis|Reisepass|pasaporte|passeport|driver's licence|driving licence|DL",
        ["A9999999", "AA9999999", "A99999999", "999999999", "A99A99A99", "AA999999", "99AA99999", "A9AA9A9A9", "AAA999999"],
    ),
    "record": (
        "MRN|M.R.N.|MR#|MR no|medical record|medical record no|medical rec.|med. rec.|chart|chart number|chart #|hospital no|hospital number|hosp. no|hosp no|patient record|patient file|patient no|file no|record|record no|record number|health record|clinic no|unit number|case file|admission no",
        ["999-99999", "A99999999", "999999", "9999999", "99999999", "AA-999999", "99-99-99", "A-9999999", "999 999", "A999999", "9999-9999", "H999999", "999-999-99"],
    ),
}
_AFTER_LABEL = ["", "", " ", " ", ": ", ": ", " no. ", " no ", " # ", "#", " is ", " = ", "-no. ", " number ", ", "]


def identity(r: random.Random, kind: str | None = None) -> tuple[str, str]:
    """(label with its joiner, number)."""
    labels, forms = _ID_KINDS[kind or r.choice(list(_ID_KINDS))]
    label = r.choice(labels.split("|"))
    joiner = r.choice(_AFTER_LABEL)
    if not joiner or (joiner[0].isalpha()):
        joiner = " "
    return label + joiner, digits(r, r.choice(forms))


def email(r: random.Random, who: str | None = None) -> str:
    parts = [w.lower() for w in re.findall(r"[^\W\d_]+", who)] if who else [word(r, r.choice([1, 2])), word(r, r.choice([1, 2, 3]))]
    a, b = parts[0], parts[-1]
    sep = r.choice([".", ".", "_", "-", "", ""])
    local = r.choice([f"{a}{sep}{b}", f"{a}{sep}{b}", f"{a[0]}{sep}{b}", f"{b}{sep}{a}", f"{b}{r.randint(1, 99)}", f"{a}+{word(r, 1)}", f"{a}{sep}{b}{r.randint(1, 2030)}", b])
    host = sep.join([word(r, 2)] + ([word(r, 1)] if r.random() < 0.3 and sep in "-." and sep else [])) + "." + r.choice(["com", "org", "net", "example", "test", "co.uk", "de", "fr", "es", "invalid", "edu", "info", "mail.com", "clinic.example", "site.test"])
    style = r.random()
    if style < 0.68:
        return f"{local}@{host}"
    if style < 0.76:
        return f"{local}{r.choice([' @ ', ' @', '@ '])}{host}"
    at, dot = r.choice([("[at]", "."), (" [at] ", "."), ("(at)", "."), (" (at) ", " (dot) "), (" at ", " dot "), (" at ", "."), ("[at]", "[dot]"), (" AT ", " DOT ")])
    return f"{local}{at}{host.replace('.', dot)}"


_STREETS = (
    "Street|St|St.|Road|Rd|Rd.|Avenue|Ave|Ave.|Drive|Dr|Lane|Ln|Close|Court|Ct|Crescent|Cres|Grove|Gardens|Terrace|Ter|Way|Place|Pl|Square|Sq|Row|Hill|View|Walk|Mews|Parkway|Pkwy|"
    "Boulevard|Blvd|Blvd.|Highway|Circle|Trail|Green|Rise|Park|Path|Quay|Wharf|Broadway|Loop|Alley|Crossing|Heights|Mount|Passage"
).split("|")
_PLACE_WORDS = "High Park Church Oak Maple Station Mill Main Elm North South East West Green Lake River Spring Garden Bridge School King Queen Victoria New Old Long Cedar Pine Hill Market Castle Orchard Rose".split()


def street_name(r: random.Random) -> str:
    out = r.choice(_PLACE_WORDS) if r.random() < 0.35 else name_word(r, r.random() < 0.6)
    return f"{out} {name_word(r, False)}" if r.random() < 0.12 else out


def address(r: random.Random) -> str:
    number = str(r.randint(1, 30) if r.random() < 0.4 else r.randint(1, 9999 if r.random() < 0.2 else 400)) + (r.choice("abcABC") if r.random() < 0.08 else "")
    style = r.random()
    if style < 0.5:
        flat = ""
        if r.random() < 0.35:
            flat = r.choice(["Flat", "Apt", "Apt.", "Apartment", "Unit", "Suite", "Room", "Apt #", "Fl.", "Bldg", "Block", "Studio", "Flat no."]) + f" {r.randint(1, 60)}{r.choice(['', '', '', 'A', 'b'])}" + r.choice([", ", ", ", " ", " / "])
        out = f"{flat}{number}{r.choice([' ', ' ', ' ', ', '])}{street_name(r)} {r.choice(_STREETS)}"
        return out + (f", {r.choice(['Apt', 'Flat', 'Unit', '#'])} {r.randint(1, 60)}" if not flat and r.random() < 0.1 else "")
    name = street_name(r)
    if style < 0.64:
        kind = r.choice(["rue", "avenue", "boulevard", "place", "chemin", "impasse", "allée", "quai"])
        return f"{number}{r.choice(['', '', ' bis', ','])} {kind} {r.choice(['', 'de ', 'du ', 'des ', 'de la ', 'de l’', 'Saint-'])}{name}"
    if style < 0.82:
        kind = r.choice(["calle", "avenida", "plaza", "paseo", "camino", "via", "viale", "piazza", "corso", "rua", "C/", "Av."])
        return f"{kind} {r.choice(['', '', 'de ', 'del ', 'de la ', 'San '])}{name}{r.choice([' ', ' ', ', ', ' nº '])}{number}"
    stem = name.split()[0]
    kind = r.choice(["straße", "strasse", "str.", "weg", "platz", "allee", "gasse", "ring", "ufer", "damm", "straat", "laan", "plein", "gade", "gatan", "veien", "hof", " Straße", " Str.", " Weg", "-Platz"])
    return f"{stem}{kind} {number}"


# --- clinical word groups and decoys ------------------------------------------

_COURSE = (
    "mild|moderate|severe|acute|chronic|ongoing|possible|probable|prob.|worsening|intermittent|recurrent|slight|new|new onset|h/o|c/o|pt c/o|patient reports|subject reports|gr 1|grade 2|hx of|history of|"
    "suspected|known|?|r/o|s/p|bilateral|left|right|sudden|transient|persistent|ADE|AE:|SAE -|dx|dx of|complains of|episode of|second"
).split("|")
_ENDINGS = (
    "in am|in the evening|post dose|after dose|at home|at work|again|overnight|- resolved|/ ongoing|not treated|after infusion|(left)|(r)|bilateral|x 3 days|since yesterday|self-limiting|no action|"
    "worse at night|while resting|on exertion|with food|during sleep|aware|no change|recovered|still present|before visit|since childhood|in spring|in May|last March|by history|as per diary|"
    "see source|see narrative|see page|query open|to be coded|unrelated|not serious|@ night|w/o fever|after walking|on the road|road accident|street drugs|in the park|playing tennis|at school|after lunch|on the bus|"
    "+ fever|++|!!|?|.|;|..."
).split("|")
_FILLER = (
    "test entry page torn query pending wrong form same as last time source doc see note left bus refer to file copy attached kit appointment late not done removal battery replaced visit diary forgot ring "
    "asked new freezer broken pump alarm night family event travel unknown error entered consent signed again growth implant care house moved subject data missing illegible duplicate void cancelled please check "
    "site staff sponsor vendor monitor report raised transcribed corrected initials date time unit normal range sample shipped lost cooler courier temperature excursion label printer tablet dropped spilled"
).split()
_EPONYM = "disease|syndrome|sign|phenomenon|palsy|lymphoma|test|score|thyroiditis|contracture|oesophagus|fracture|reflex|criteria|tremor|sarcoma|node|ulcer|catheter|cyst|paralysis|scale|index".split("|")
_STOCK = "kit|kit no|kit no.|kit number|kit #|lot|lot no|lot #|lot number|batch|batch no.|device|device ID|device no|device serial|serial|serial no|serial number|s/n|pump serial|sensor|meter no|page|page no|pg|p.|see page|pages|box|bottle|vial|vial no|tube|shipment|tracking|AWB|form|protocol|barcode|accession|order no|invoice|IP kit|pen serial|catheter lot|model|ref|REF|version|sample|sample no|specimen|rack|freezer|shelf|temp log|monitor serial|patch lot|inhaler batch".split("|")


def decoy(r: random.Random) -> str:
    """A number that is no detail of a person."""
    style = r.random()
    if style < 0.62:
        forms = [f for _, fs in _ID_KINDS.values() for f in fs] + ["999-999-9999", "9999999999", "999.999.9999", "999-9999", "99-99", "9999", "999-99", "AA-9999-99", "99/999"]
        forms += ["999-99-9999", "A999999", "AA999999", "999999999"] * 4
        return r.choice(_STOCK) + r.choice([" ", " ", ": ", " # ", " no. ", " no ", ": "]) + digits(r, r.choice(forms))
    day, month, year = r.randint(1, 28), r.randint(1, 12), r.randint(1950, 2026)
    return r.choice([
        f"on {day}/{month}/{year}", f"on {year}-{month:02d}-{day:02d}", f"BP {r.randint(90, 180)}/{r.randint(50, 110)}", f"HR {r.randint(50, 150)}", f"temp {r.randint(35, 40)}.{r.randint(0, 9)}",
        f"HR {r.randint(50, 150)} temp {r.randint(35, 40)}.{r.randint(0, 9)}", f"({r.choice(['ratio', 'range', 'ALT', 'titre', 'score'])} {r.randint(1, 300)}{r.choice(':-/')}{r.randint(1, 300)})", f"after {r.randint(1, 4)} x {r.randint(1, 20) * 50} mg",
        f"{r.randint(1, 900)} {r.choice(['mg', 'ml', 'mmol/L', 'IU', 'bpm', 'kg', 'mmHg'])}", f"visit {r.randint(1, 12)}, day {r.randint(1, 120)}", f"day {r.randint(1, 200)}", f"at {r.randint(0, 23)}:{r.randint(0, 59):02d}", f"CTCAE v{r.randint(3, 5)} gr {r.randint(1, 5)}",
        f"x {r.randint(2, 14)} days", f"{r.randint(1, 12)}/{r.randint(1, 12)}", f"{r.randint(1, 28)} {r.choice(['Jan', 'February', 'MAY', 'Aug', 'OCT'])} {year}", f"week {r.randint(1, 60)}", f"since {year}", f"SpO2 {r.randint(80, 100)}%", f"cycle {r.randint(1, 9)} day {r.randint(1, 28)}",
        f"following {name_word(r, True)} {r.choice(['run', 'Road race', 'walk', 'marathon', 'cup', 'trial'])}",
    ])


def typo(r: random.Random, term: str) -> str:
    if len(term) < 5:
        return term
    i = r.randrange(1, len(term) - 1)
    return r.choice([term[:i] + term[i + 1 :], term[:i] + term[i] + term[i:], term[:i] + term[i + 1] + term[i] + term[i + 2 :], term[:i] + r.choice("aeiorst") + term[i + 1 :]])


def finding(r: random.Random, terms: list[str]) -> str:
    """A clinical word group: listed, misspelt, shortened, named after a person or unknown."""
    term, odd = r.choice(terms), r.random()
    if odd < 0.22:
        term = typo(r, term)
    elif odd < 0.3:
        term = typo(r, typo(r, term))
    elif odd < 0.38:
        term = " ".join(w[: r.randint(3, 5)] + r.choice(["", ".", "."]) for w in term.split())
    elif odd < 0.48:
        term = " ".join(word(r, r.choice([2, 3, 4])) for _ in range(r.choice([1, 1, 2, 2, 3])))
    elif odd < 0.54:
        term = " ".join(r.sample(_FILLER, r.choice([2, 3, 4])))
    elif odd < 0.6:
        own = name_word(r, True)
        term = r.choice([own + "'s ", own + "s ", own + " ", own + "’s "]) + r.choice(_EPONYM) + r.choice(["", "", " of " + r.choice(terms)])
    return r.choice([term, term.lower(), term.lower(), term.title(), term.upper(), term.capitalize()])


# --- cues: family -> phrases ---------------------------------------------------

KIN = "daughter son wife husband mother father brother sister aunt uncle niece nephew cousin grandson grandmother partner neighbour friend carer caregiver caretaker roommate colleague employer teacher guardian mum dad parent spouse fiancee stepson".split()
ROLE = "nurse doctor physician pharmacist investigator coordinator interpreter dentist therapist surgeon consultant specialist GP paramedic midwife cardiologist dermatologist monitor CRA PI sub-I matron porter receptionist psychologist ophthalmologist".split()
TITLES = "Dr Dr. Mr Mr. Mrs Mrs. Ms Ms. Miss Prof. Prof Sr Sr. Herr Frau Sra. Mme M. Sister Nurse".split()
_DONE = "seen examined reviewed assessed treated reported noted observed witnessed signed recorded referred escalated prescribed documented diagnosed checked handled verified managed sutured scheduled approved".split()
_TOLD = "discussed|confirmed|spoke|talked|arranged|agreed|clarified|reviewed|followed up|checked|corresponded".split("|")
_GAVE = "told|informed|notified|contacted|called|phoned|asked|emailed|briefed|advised|texted|met|updated|reported to|mentioned to|relayed to|passed on to|described to|disclosed to".split("|")
_SAYS = "reports|reported|states|stated|says|said|called|phoned|rang|noticed|confirmed|complained of|complains of|had|has|felt|denies|mentions|described|claims|feels|noted|experienced|suffered|presented with|developed|admits|wrote|thinks it is|was told of|recalls|attended with|came in with".split("|")
_WHEN = "|||| yesterday| today| on Monday| last night| this morning| by phone| on call| on the ward| next day| overnight| later| in clinic| at triage| last week| twice| on arrival| at bedside| via interpreter| before discharge| at follow-up| at visit".split("|")

NAME_BEFORE: dict[str, list[str]] = {
    "clinician": [f"{v} by {t}" for v in _DONE for t in ["", *TITLES]],
    "with": [f"{v} {w} {t}" for v in _TOLD for w in ("with", "w/", "w/", "to") for t in ("", "", "", "", "Dr ", "Mrs ")],
    "told": [f"{v} {x}" for v in _GAVE for x in ("", "", "Dr ", *[f"{y} " for y in ROLE[:8] + KIN[:8]])],
    "kin": [f"{p}{k} " for k in KIN for p in ("", "per ", "his ", "her ", "by ", "from ", "according to ", "with ", "as per ", "accompanied by ")],
    "role": [f"{p}{k} " for k in ROLE for p in ("", "per ", "by ", "from ", "study ", "site ", "according to ", "ward ")],
    "label": [f"{x}: " for x in "contact informant reporter witness name patient subject caller proxy signed interpreter caregiver attn author source completed-by relative kin reviewer historian escort visitor".split()],
    "patient": [f"{x} " for x in "patient subject pt pt. participant client volunteer Mr Mrs Ms Mr. Mrs. Miss Frau Herr Madame Señora".split()],
    "caller": [f"{x} " for x in ("call from", "message from", "visit from", "email from", "note from", "letter from", "fax from", "info from", "report from", "word from", "history from", "heard from", "c/o", "on behalf of", "attn", "cc", "for", "signed", "under the care of", "refer to", "see", "ask", "brought in by", "driven by", "found by", "accompanied by", "interviewed", "complaint by", "reminded by")],
}
NAME_AFTER: dict[str, list[str]] = {
    "says": [f" {v} " for v in _SAYS],
    "present": [f" {x}" for x in ("present", "was present", "in attendance", "also present", "was there", "attending", "at bedside", "on duty", "on call", "interpreting", "translated", "witnessed it", "to follow up", "aware", "informed", "notified", "to review", "agrees", "countersigned")],
    "possessive": ["'s wife", "'s notes", "'s family", " (wife)", " (son)", " (GP)", " (nurse)", " MD", ", MD", ", RN", " RN", ", PhD"],
}
PHONE_BEFORE: dict[str, list[str]] = {
    "label": [f"{x}{j}" for x in "tel|tel.|phone|ph|ph.|telephone|mobile|mob|mob.|cell|fax|contact no.|contact number|home phone|work no.|landline|pager|hotline|WhatsApp|Tel.-Nr.|Handy|móvil|tél.|voicemail|T|M|call-back no.|SMS".split("|") for j in (" ", ": ", ":", " - ", " no. ", " # ")],
    "call": [f"{x} " for x in ("call", "ring", "reach at", "reachable on", "call on", "reached on", "returned call to", "contact", "phone back on", "please call", "dial", "text", "left message at", "try", "available at", "number is", "called on", "call again on", "cb", "fax to", "leave message on")],
    "from": [f"{v} from " for v in ("called", "phoned", "telephoned", "texted", "dialled in", "patient called", "subject phoned", "message", "missed call", "messaged")],
    "kin": [f"{k}{p}" for k in KIN + ROLE for p in (" at ", " on ", ": ", ", ", " phone ", " tel ")],
}
EMAIL_BEFORE: dict[str, list[str]] = {
    "label": [f"{x}{j}" for x in "email|e-mail|mail|e mail|mailto|Mail|correo|contact|address|web contact|email address".split("|") for j in (" ", ": ", ":", " - ", " = ", " is ")],
    "to": [f"{v} {p} " for v in ("reply", "write", "send", "sent", "forwarded", "emailed", "report", "results", "scan", "copy", "image", "diary", "documents", "pictures", "form", "records", "respond", "letter", "mailed", "invoice", "consent") for p in ("to", "to")],
    "from": [f"{v} {p} " for v in ("written", "sent", "received", "reported", "message", "note", "query", "mail", "wrote", "emailed", "writes") for p in ("from", "by", "via")],
    "bare": ["cc ", "via ", "contact ", "c/o ", "at ", "use ", "attn ", "cc: ", "bcc ", "ask ", "from ", "to ", "see ", "query "],
}
ADDRESS_BEFORE: dict[str, list[str]] = {
    "home": [f"{x} " for x in ("lives at", "living at", "lives in", "lives", "resident at", "resides at", "residing at", "home is", "stays at", "staying at", "moved to", "address", "address:", "addr.", "addr:", "home address", "home address:", "from", "of", "domiciled at", "residence", "wohnhaft", "domicile:", "new address", "lodging at", "based at", "vive en", "habite")],
    "event": [f"{v} {p} " for v in ("fell", "fall", "collapsed", "tripped", "found", "stumbled", "hit by car", "accident", "bitten", "fainted", "injured", "event", "assaulted", "crashed", "stung") for p in ("at", "near", "outside", "in front of", "opposite", "on the steps of", "by", "in")],
    "sent": [f"{v} {p} " for v in ("ambulance", "taxi", "nurse", "courier", "doctor", "team", "letter", "parcel", "meds", "supplies", "kit", "equipment", "results", "oxygen", "bill", "delivery", "car", "package") for p in ("to", "sent to", "called to", "for")],
    "visit": [f"{v} {p} " for v in ("visited", "visit", "collected", "picked up", "seen", "assessed", "home visit", "discharged", "transferred", "delivered", "house call", "appointment", "clinic", "admitted", "dropped off", "check", "examined") for p in ("at", "to", "from")],
}
ID_BEFORE: dict[str, list[str]] = {
    "plain": ["", "", "", "", "", "", "", ""],
    "verb": [f"{x} " for x in ("gave", "registered under", "registered with", "admitted with", "admitted as", "verified", "verified by", "known as", "on file:", "listed as", "per", "see", "holder of", "with", "claims", "recorded under", "patient", "pt", "subject", "his", "her", "copied", "showed", "shows", "produced", "insured under", "filed under", "matched on", "billed to", "presented")],
}
_TRAILERS = "||||||||| for details| if needed| after hours| after 6 pm| for results| today| requested| on file| in chart| pending| confirmed| urgently| before noon| daily| only| per source| (home)| (work)| as above| ok| unchanged| given| re results| re visit| thanks".split("|")
_JOIN = [", ", ", ", "; ", "; ", " - ", ". ", " / ", ": ", " -- ", " | ", "\n", " ", " ", " ~ ", "  "]

FAMILIES = sorted(
    {f"{kind}:{name}" for kind, table in (("name", NAME_BEFORE), ("said", NAME_AFTER), ("phone", PHONE_BEFORE), ("email", EMAIL_BEFORE), ("address", ADDRESS_BEFORE), ("id", ID_BEFORE)) for name in table}
)


def _cue(r: random.Random, kind: str, table: dict[str, list[str]], families: set[str]) -> str:
    usable = [n for n in table if f"{kind}:{n}" in families] or list(table)
    cue = r.choice(table[r.choice(usable)])
    if r.random() < 0.06 and " " in cue.strip():  # cues no list holds
        head, _, rest = cue.partition(" ")
        cue = f"{word(r, 2)} {rest}" if r.random() < 0.5 else f"{head} {word(r, 2)} {rest}"
    return cue if not cue or cue[-1] in " :" or cue.endswith(("(", "<")) else cue + " "


def phrase(r: random.Random, families: set[str]) -> list[str | tuple[str, str]]:
    """Cue, detail and trailer, as text and (label, detail) parts."""
    kind = r.choices(["name", "phone", "email", "address", "id_number", "mixed"], [42, 10, 3, 11, 11, 26])[0]
    tail = r.choice(_TRAILERS)
    if kind == "name":
        who = ("name", person(r))
        style = r.random()
        if style < 0.66:
            title = r.choice(TITLES) + " " if r.random() < 0.1 else ""
            after = _cue(r, "said", {"present": NAME_AFTER["present"]}, families).rstrip() if r.random() < 0.2 else r.choice(_WHEN)
            return [_cue(r, "name", NAME_BEFORE, families) + title, who, after]
        if style < 0.8:
            return [(r.choice(TITLES) + " ") if r.random() < 0.2 else "", who, _cue(r, "said", {"present": NAME_AFTER["present"], "possessive": NAME_AFTER["possessive"]}, families).rstrip()]
        if style < 0.94:
            return [who, r.choice([" <", " <", " (", ", ", " "]), ("email", email(r, who[1] if r.random() < 0.6 else None)), ""]
        # A name without any cue shows only by its capitals.
        return ["", ("name", f"{name_word(r, False)} {name_word(r, True)}"), ""]
    if kind == "phone":
        more = [r.choice([" or ", " / ", ", ", " and "]), ("phone", phone(r))] if r.random() < 0.15 else []
        return [_cue(r, "phone", PHONE_BEFORE, families), ("phone", phone(r)), *more, tail]
    if kind == "email":
        return [_cue(r, "email", EMAIL_BEFORE, families) if r.random() < 0.85 else "", ("email", email(r)), tail]
    if kind == "address":
        return [_cue(r, "address", ADDRESS_BEFORE, families) if r.random() < 0.9 else "", ("address", address(r)), tail]
    if kind == "id_number":
        label, number = identity(r)
        if r.random() < 0.06:
            label, number = "", digits(r, r.choice(["999-99-9999", "AA 99 99 99 A"]))
        return [_cue(r, "id", ID_BEFORE, families).lstrip() + label, ("id_number", number), tail]
    out: list[str | tuple[str, str]] = []
    who = ("name", person(r))
    label, number = identity(r)
    every = [[who], [r.choice(["", "tel ", "phone ", "m: ", "on "]), ("phone", phone(r))], [r.choice(["", "email ", "<", "e: "]), ("email", email(r, who[1]))], [r.choice(["", "of ", "at ", "addr "]), ("address", address(r))], [label, ("id_number", number)]]
    for k, part in enumerate(r.sample(every, r.choice([2, 2, 3])) if r.random() < 0.5 else [every[0], *r.sample(every[1:], r.choice([1, 1, 2]))]):
        out += [r.choice([", ", ", ", "; ", " / ", " "])] if k else []
        out += part
    return [r.choice(["", "", "contact ", "GP ", "Dr ", "per ", "from ", "by "])] + out + [""]


def sentence(r: random.Random, terms: list[str], families: set[str] | None = None) -> tuple[str, list[Span]]:
    """One generated text with the spans of its details."""
    families = set(FAMILIES) if families is None else families
    text, spans = "", []

    def say(*parts: str | tuple[str, str]) -> None:
        nonlocal text
        for part in parts:
            if isinstance(part, tuple):
                label, detail = part
                # Names are often typed in one case whatever the rest is.
                own = r.choices([casing, "lower", "upper"], [74, 15, 11])[0]
                detail = detail.lower() if own == "lower" else detail.upper() if own == "upper" else detail
                spans.append((label, len(text), len(text) + len(detail)))
                text += detail
            else:
                text += part.lower() if casing == "lower" else part.upper() if casing == "upper" else part

    casing = r.choices(["", "lower", "upper"], [70, 18, 12])[0]
    group = finding(r, terms)
    if r.random() < 0.3:
        group = r.choice(_COURSE) + " " + group
    style = r.random()
    if style < 0.38:  # no detail
        if r.random() < 0.25:  # a condition no list knows, written like any other
            group = " ".join(word(r, r.choice([2, 3, 3, 4])) if r.random() < 0.7 else r.choice(_FILLER) for _ in range(r.choice([1, 1, 2, 3])))
            group = r.choice([group, group.capitalize(), group.capitalize(), group.title(), group.upper()])
        say(r.choice(["", "", "", "- ", "* ", " ", "(", '"']), group)
        for _ in range(r.choice([0, 1, 1, 1, 2])):
            extra = decoy(r) if r.random() < 0.6 else r.choice(_ENDINGS) if r.random() < 0.8 else " ".join(r.sample(_FILLER, r.choice([1, 2, 3])))
            say(r.choice([" ", ", ", "; ", " - ", " ", " ("]), extra)
        return text, spans
    body = phrase(r, families)
    if style < 0.5:
        # A person says or has something.
        title = r.choice(TITLES[:10] + ["patient", "subject", "pt"]) + " " if r.random() < 0.45 else ""
        say(title, ("name", person(r)), _cue(r, "said", {"says": NAME_AFTER["says"]}, families), group)
        if r.random() < 0.35:
            say(r.choice([*_WHEN, " at home", " after work", " during the visit", " since last week", " at breakfast"]))
        if r.random() < 0.2:
            say(r.choice(_JOIN), *phrase(r, families))
    elif style < 0.76:
        bracket = r.random() < 0.18
        say(group, r.choice([" (", " [", " <"]) if bracket else r.choice(_JOIN), *body, r.choice([")", "]", ""]) if bracket else "")
    elif style < 0.93:
        bare = len(body) == 3 and not body[0] and not body[2]
        say(*body, r.choice([": ", ", ", "; ", " - ", ". "] if bare else [": ", ", ", "; ", " - ", " ", " re ", " about ", " with ", " / ", " due to ", ". ", " because of "]), group)
    else:
        say(group, r.choice(_JOIN), *body, r.choice(_JOIN))
        if r.random() < 0.4:
            again = [p for p in body if isinstance(p, tuple) and p[0] == "name"]
            if again:  # the same person once more, in full or by one name
                full = again[0][1]
                say(_cue(r, "name", NAME_BEFORE, families), ("name", full if r.random() < 0.6 else re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", full)[-1]))
                return text, spans
        say(*phrase(r, families))
    odd = r.random()
    if odd < 0.15:
        say(r.choice([" ", ", ", "; "]), decoy(r))
    elif odd < 0.25:
        say(r.choice([" ", ", ", "; "]), r.choice(_ENDINGS))
    return text, spans


def cue_words() -> set[str]:
    """Words of the cue lists: known to be no names."""
    lists = [_COURSE, _ENDINGS, _FILLER, _EPONYM, _STOCK, KIN, ROLE, TITLES, _WHEN, _TRAILERS]
    lists += [v for t in (NAME_BEFORE, NAME_AFTER, PHONE_BEFORE, EMAIL_BEFORE, ADDRESS_BEFORE, ID_BEFORE) for v in t.values()]
    lists += [labels.split("|") for labels, _ in _ID_KINDS.values()]
    return {w.lower() for phrases in lists for p in phrases for w in re.findall(r"[^\W\d_]+", p)}
