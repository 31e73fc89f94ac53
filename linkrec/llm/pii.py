"""Personal data with offset-preserving deobfuscation.

Base finders read the text itself.  A transducer then rewrites disguises: look-alike letters
and digits, invisible characters, spelled digits, and "at" / "dot" in words or
brackets.  It copies everything else, and keeps for every rewritten place where it came
from.  The same finders read the rewritten text, and what they find is mapped
back to the source characters; a find is added if it covers a rewritten place
and meets no base span.  Base spans always stay.

Edge cases: null and empty texts have no spans; offsets are code points, ends
exclusive; finds of one kind never overlap.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from linkrec.llm.common import small_batches

KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def emails(t: str) -> list[tuple[int, int]]:
    """Every match ends in an @domain; its local part is the run before it, back to the last match."""
    out, last = [], 0
    if "@" not in t:
        return out
    for m in _DOMAIN.finditer(t):
        s = m.start()
        while s > last and t[s - 1] in _LOCAL:
            s -= 1
        if s < m.start():
            out.append((s, m.end()))
            last = m.end()
    return out


def ips(t: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IP.finditer(t) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]


def cards(t: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(t):
        if m.end() - m.start() >= 13:
            d = "".join(_DIGITS.findall(m[0]))
            if 13 <= len(d) <= 19 and luhn(d):
                out.append(m.span())
    return out


def phones(t: str) -> list[tuple[int, int]]:
    if "+" not in t:
        return []
    return [m.span() for m in _PHONE.finditer(t) if 9 <= len(_DIGITS.findall(m[0])) <= 15]


FINDERS = dict(zip(KINDS, (emails, ips, cards, phones)))

#: Characters that look like the ASCII ones beside them.
LOOKALIKES = dict(zip("аеорсухіјѕԁһԛԝАВЕКМНОРСТХІЈЅοαινρυΑΒΕΗΙΚΜΝΟΡΤΥΧΖıɡ",
                      "aeopcyxijsdhqwABEKMHOPCTXIJSoaivpuABEHIKMNOPTYXZig"))
LOOKALIKES |= {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)}                      # full-width ASCII
for _start in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6):   # digits of other scripts
    LOOKALIKES |= {chr(_start + i): chr(48 + i) for i in range(10)}
LOOKALIKES |= dict.fromkeys("․。．", ".") | dict.fromkeys("‐‑‒–−", "-") | {"﹫": "@", "﹢": "+"}
INVISIBLE = "​‌‍⁠﻿­"
SPELLED = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
_WORD = "|".join(SPELLED)
_NAME = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*"
_AT = r"(?:\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|\s+at\s+|\s+@\s+)"
_DOT = r"(?:\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*|\s+dot\s+)"
_HARD_AT = r"(?:\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*|\s+@\s+)"
#: "x at y dot z", or brackets around at or dot, beside names on both sides.
_MAIL = re.compile(rf"{_NAME}(?:{_DOT}[A-Za-z0-9-]+)*(?:{_AT}[A-Za-z0-9-]+(?:(?:{_DOT}|\.)[A-Za-z0-9-]+)*{_DOT}[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*"
                   rf"|{_HARD_AT}[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+|\s+at\s+(?:[A-Za-z0-9-]+\.)+[A-Za-z]{{2,}}(?![A-Za-z0-9.-]*[0-9])|@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?:{_DOT}[A-Za-z0-9-]+)+)",
                   re.IGNORECASE)
_AT_SIGN, _DOT_SIGN = re.compile(_AT, re.I), re.compile(_DOT, re.I)
#: Words that stand before "at" and the plain name of a site, not of a person's host.
NO_NAMES = set("look looked looking available found find see seen visit visited hosted online us me it them here is are "
               "was were be been and or read more site page website order buy shop live based located published "
               "posted work works worked working information details".split())
_SITE = re.compile(r"(\S+)\s+at\s+[^@\s\[({<]+", re.I)
#: Digits, at least one of them spelled, with at most a few signs between; the finders judge the rewritten number.
_UNIT = rf"(?:(?:{_WORD})(?![A-Za-z])|[0-9]+)"
_NUMBER = re.compile(rf"(?<![A-Za-z])(?:(?:plus\s+|\+\s*)?{_UNIT}(?:[\s,.()-]{{0,3}}(?:dot\s+|point\s+|dash\s+)?{_UNIT})+)", re.I)
_DIGIT_WORD = re.compile(rf"(?<![A-Za-z])(?:{_WORD}|plus|dot|point|dash)(?![A-Za-z])", re.I)
_CHARS = re.compile("[" + re.escape("".join(LOOKALIKES) + INVISIBLE) + "]")
#: What every match of _MAIL and of a _NUMBER with a spelled digit holds.
_MAIL_HINT = re.compile(r"\sdot\s|[\[({<]\s*(?:[@.]|at|dot)\s*[\])}>]|\s@\s|\sat\s+[A-Za-z0-9-]+\.[A-Za-z0-9]", re.I)
_NUMBER_HINT = re.compile(rf"(?<![A-Za-z])(?:{_WORD})(?![A-Za-z])", re.I)


class Rewrite:
    """One transducer step: a rewritten text and, for its pieces, their source offsets."""

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        self.starts, self.sources, self.same, parts, at, out = [], [], [], [], 0, 0
        for s, e, new in [*edits, (len(text), len(text), "")]:
            for chunk, a, b, same in ((text[at:s], at, s, True), (new, s, e, False)):
                if chunk or a < b:
                    self.starts.append(out)
                    self.sources.append((a, b))
                    self.same.append(same)
                    parts.append(chunk)
                    out += len(chunk)
            at = e
        self.text = "".join(parts)

    def back(self, s: int, e: int) -> tuple[int, int]:
        """The source span of the rewritten span (s, e)."""
        i, j = bisect_right(self.starts, s) - 1, bisect_right(self.starts, e - 1) - 1
        a = self.sources[i][0] + (s - self.starts[i] if self.same[i] else 0)
        b = self.sources[j][0] + (e - self.starts[j]) if self.same[j] else self.sources[j][1]
        return a, b


def _characters(t: str) -> list[tuple[int, int, str]]:
    """Look-alikes give way to their ASCII character, invisible characters to nothing."""
    return [(m.start(), m.end(), LOOKALIKES.get(m[0], "")) for m in _CHARS.finditer(t)]


def _disguises(t: str) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    for m in _MAIL.finditer(t) if _MAIL_HINT.search(t) else ():
        site = _SITE.fullmatch(m[0])
        if site and site[1].lower() in NO_NAMES:
            continue
        for sign, rx in (("@", _AT_SIGN), (".", _DOT_SIGN)):
            out += [(x.start(), x.end(), sign) for x in rx.finditer(t, m.start(), m.end())]
    taken = [(s, e) for s, e, _ in out]
    for m in _NUMBER.finditer(t) if _NUMBER_HINT.search(t) else ():
        spelled = list(_DIGIT_WORD.finditer(t, m.start(), m.end()))
        if not any(x[0].lower() in SPELLED for x in spelled) or any(s < m.end() and e > m.start() for s, e in taken):
            continue
        for k, x in enumerate(spelled):
            word, s, e = x[0].lower(), x.start(), x.end()
            if word in SPELLED:
                if k and t[spelled[k - 1].end():s].isspace() and spelled[k - 1][0].lower() in SPELLED:
                    s = spelled[k - 1].end()                       # "four one" -> "41"
                out.append((s, e, SPELLED[word]))
            else:
                while word != "plus" and s > 0 and t[s - 1].isspace():
                    s -= 1
                while e < len(t) and t[e].isspace():
                    e += 1
                out.append((s, e, {"plus": "+", "dash": "-"}.get(word, ".")))
    out.sort()
    clean, last = [], 0
    for s, e, new in out:
        s = max(s, last)
        if s < e:
            clean.append((s, e, new))
            last = e
    return clean


def find_all(text: str | None) -> tuple[dict, dict]:
    """({kind: base spans}, {kind: added spans})."""
    t = text or ""
    base = {k: f(t) for k, f in FINDERS.items()}
    added: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    steps: list[Rewrite] = []
    now = t
    if not t.isascii():
        edits = _characters(now)
        if edits:
            steps.append(Rewrite(now, edits))
            now = steps[-1].text
    edits = _disguises(now)
    if edits:
        steps.append(Rewrite(now, edits))
        now = steps[-1].text
    if not steps:
        return base, added
    for kind, finder in FINDERS.items():
        for s, e in finder(now):
            for step in reversed(steps):
                s, e = step.back(s, e)
            if all(e <= a or s >= b for a, b in base[kind]):
                added[kind].append((s, e))
    return base, added


def span_text(spans: dict) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in KINDS for s, e in sorted(spans[k]))


def _rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for i, text in zip(pdf["doc_id"], pdf["text"]):
            base, added = find_all(text)
            both = {k: base[k] + added[k] for k in KINDS}
            rows.append((i, *[len(base[k]) for k in KINDS], hashlib.sha256(span_text(base).encode()).hexdigest(),
                         span_text(both), sum(map(len, added.values()))))
        yield pd.DataFrame(rows, columns=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans",
                                          "n_added"]).astype({"doc_id": "Int64"})


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, base counts per kind, base_sha256, spans (base and added) and n_added of every document."""
    small_batches(docs.sparkSession)
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").mapInPandas(
        _rows, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
               "n_added long")
