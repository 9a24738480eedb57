"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs,
digits, plus signs, URI schemes and words that introduce an identifier.  From
each anchor a deterministic local parser expands to both sides to the exact
boundaries of an address or number and validates it (octets, Luhn, lengths,
mod 97).  No anchor, no work: clean text costs one scan.

Base kinds, by their definitions (leftmost, non-overlapping within a kind):
email, ip, card, phone.  Kinds that the anchors add: ``iban`` (mod-97 valid),
``ssn`` and ``account`` (a number right after a cue word), ``handle`` (the
address part of mailto:, tel: and sip: references), ``login`` (user and password
in a URL).
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import ship
from .grams import slices

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "account", "handle", "login")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_IBAN = re.compile(r"[:#]?\x20?([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_SSN = re.compile(r"[:#]?\x20?([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])")
_ACCOUNT = re.compile(r"(?:\x20(?:number|no\.?))?[:#]?\x20?([0-9](?:[\x20-]?[0-9]){5,16})(?![0-9])")
_REFERENCE = re.compile(r"[A-Za-z0-9.+%-]+(?:@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*)?")
_LOGIN = re.compile(r"([^\s/@:]+:[^\s/@]+)@[A-Za-z0-9-]")

#: Words that introduce an identifier, by what follows them; matched in lower case at a word's start.
CUES = {
    "iban": ("iban",),
    "ssn": ("ssn", "social security number"),
    "account": ("account", "acct", "konto", "compte", "cuenta"),
    "handle": ("mailto:", "tel:", "sip:"),
    "login": ("://",),
}


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
    a.add_word("@", ("email", 1))
    a.add_word("+", ("phone", 1))
    for kind, words in CUES.items():
        for w in words:
            a.add_word(w, (kind, len(w)))
    a.make_automaton()
    return a


_ANCHORS = _automaton()
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def octets(address: str) -> bool:
    """Whether each part is at most 255; parts may have leading zeros, any number of them."""
    return all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in address.split(".")))


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _email(text: str, at: int, free: int):
    a = at
    while a > free and text[a - 1] in _LOCAL:
        a -= 1
    m = a < at and _DOMAIN.match(text, at + 1)
    return (a, m.end()) if m else None


def _iban(raw: str) -> str | None:
    """The longest valid IBAN that ``raw`` starts with and that ends before a blank or at the end."""
    ends = [i for i, c in enumerate(raw) if c == " "] + [len(raw)]
    for e in reversed(ends):
        s = raw[:e].replace(" ", "")
        if 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1:
            return raw[:e]
    return None


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, in the order of anchors."""
    if not text:
        return []
    out: list[tuple[str, int, int]] = []
    free = dict.fromkeys(("email", "ip", "card", "phone", "run", *ADDED), 0)
    low = text if text.islower() else text.translate(_ASCII_LOWER) if not text.isascii() else text.lower()
    for last, (kind, size) in _ANCHORS.iter(low):
        at = last - size + 1
        if kind == "digit":
            if at >= free["card"]:
                m = _CARD.match(text, at)
                free["card"] = m.end() if m else at + 1
                if m:
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        out.append(("card", at, m.end()))
            if at >= free["ip"]:
                m = _IP.match(text, at)
                free["ip"] = m.end() if m else _DIGITS.match(text, at).end()
                if m and octets(m.group()):
                    out.append(("ip", at, m.end()))
        elif kind == "email":
            s = _email(text, at, free["email"])
            if s:
                free["email"] = s[1]
                out.append(("email", *s))
        elif kind == "phone":
            if at >= free["phone"]:
                m = _PHONE.match(text, at)
                if m:
                    free["phone"] = m.end()
                    if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                        out.append(("phone", at, m.end()))
        elif kind == "login":
            m = _LOGIN.match(text, last + 1)
            if m and m.start(1) >= free["login"]:
                free["login"] = m.end(1)
                out.append(("login", m.start(1), m.end(1)))
        elif at == 0 or not text[at - 1].isalnum():
            a = last + 1
            if kind == "handle":
                m = _REFERENCE.match(text, a)
                s = (a, m.end()) if m and (any(c.isdigit() for c in m.group()) or "@" in m.group()) else None
            elif kind == "iban":
                m = _IBAN.match(text, a)
                found = m and _iban(m.group(1))
                s = (m.start(1), m.start(1) + len(found)) if found else None
            else:
                m = (_SSN if kind == "ssn" else _ACCOUNT).match(text, a)
                s = m.span(1) if m else None
            if s and s[0] >= free[kind]:
                free[kind] = s[1]
                out.append((kind, *s))
    return out


def listed(found, kinds=(*BASE, *ADDED)) -> str:
    """kind:start:end by kind as listed, then start, comma-joined."""
    order = {k: i for i, k in enumerate(kinds)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted((x for x in found if x[0] in order), key=lambda x: (order[x[0]], x[1])))


def masked(text: str | None, found) -> str | None:
    """``text`` with each span replaced by its kind; of overlapping spans the first, then the longest, counts."""
    if not found:
        return text
    parts, at = [], 0
    for k, a, b in sorted(found, key=lambda x: (x[1], -x[2])):
        if a >= at:
            parts += [text[at:a], f"[{k.upper()}]"]
            at = b
        elif b > at:
            at = b
    return "".join([*parts, text[at:]])


_FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, masked string"


def find_personal_data(docs: DataFrame, text: str = "text", mask: bool = False) -> DataFrame:
    """The rows of ``docs`` with counts by base kind, base_sha256, spans and, if asked, the masked text.

    New columns replace input columns of the same names.  A null or empty text
    has no spans; its masked text is itself.  Every row stands alone, so repeated
    rows give repeated results, and an empty table gives an empty one.
    """
    ship(docs.sparkSession)
    new = [x.split()[0] for x in _FOUND.split(", ")]
    kept = docs.drop(*[c for c in docs.columns if c in new and c != text])
    names = [*kept.columns, *new]

    def run(batches):
        for whole in batches:
            for i, j in slices(whole.column(text), 4 << 20):
                b = whole.slice(i, j - i)
                texts = b.column(text).to_pylist()
                found = [spans(t) for t in texts]
                n = [pa.array([sum(x[0] == k for x in f) for f in found], pa.int64()) for k in BASE]
                sha = pa.array([hashlib.sha256(listed(f, BASE).encode()).hexdigest() for f in found], pa.string())
                hidden = pa.array([masked(t, f) for t, f in zip(texts, found)] if mask else [None] * len(texts), pa.string())
                yield pa.RecordBatch.from_arrays([*b.columns, *n, sha, pa.array([listed(f) for f in found], pa.string()), hidden], names)

    own = kept.withColumn(text, F.col(text).cast("string"))
    added = [StructField(n, StringType() if kind == "string" else LongType()) for n, kind in (x.split() for x in _FOUND.split(", "))]
    out = own.mapInArrow(run, StructType([StructField(f.name, f.dataType) for f in own.schema] + added))
    return out if mask else out.drop("masked")


def brute_force(text: str | None) -> list[tuple[str, int, int]]:
    """The base spans by their patterns, for tests."""
    t = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(_IP, t) if all(re.fullmatch("0*([01]?[0-9]?[0-9]|2[0-4][0-9]|25[0-5])", p) for p in m.group().split("."))]
    for m in re.finditer(_CARD, t):
        d = re.sub(r"[\x20-]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(_PHONE, t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out
