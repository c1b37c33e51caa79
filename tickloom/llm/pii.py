"""Personal data: patterns propose spans, validators confirm them, context words adjust the score.

Base kinds (``email, ip, card, phone``) are decided by pattern and validator alone: leftmost, non-overlapping, a match
that its validator refuses is dropped and not tried again. The other kinds start from a score of their pattern; a
validator or a telling word nearby raises it, a word that speaks against it lowers it, and spans at THRESHOLD or
above stay:

* ``iban``: two letters, two digits, 11 to 30 letters or digits; the remainder mod 97 must confirm it. What follows in
  capitals may look like more of it: the longest beginning that ends before a blank and is confirmed counts.
* ``phone_local``: 3-3-4 digits without a country code; needs a word for telephones nearby.
* ``secret``: 20 or more letters and digits of both kinds; needs a word for keys nearby.

Offsets are code points, the end is exclusive. Defined results: a null text counts as empty and an empty text has no
spans; rows are independent; patterns take linear time, so long texts are read whole.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

from pyspark.sql import DataFrame, functions as F

from .arrow import map_texts, text_rows

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "phone_local", "secret")
THRESHOLD = 0.6
#: Code points on either side of a span that count as near.
NEAR = 40

# Words near a span that speak for a kind, and such that speak against any.
FOR = {
    "email": r"mail|contact|write|reply",
    "ip": r"\bip\b|host|server|address|login",
    "card": r"card|visa|credit|debit|payment",
    "phone": r"phone|tel\b|call|fax|mobile|cell",
    "phone_local": r"phone|tel\b|call|fax|mobile|cell|teléfono|téléphone|telefon",
    "iban": r"iban|bank|account|konto|compte|cuenta",
    "secret": r"token|secret|passw|api[_-]?key|access[_-]?key|\bkey\b|credential",
}
AGAINST = r"(?<![\w.@-])(?:version|example|sample|isbn|order\s+no|serial)(?![\w@]|\.\w)"
#: Score of a pattern alone and once its validator has confirmed it.
SCORES = {"email": (0.7, 0.9), "ip": (0.4, 0.7), "card": (0.3, 0.8), "phone": (0.4, 0.7), "iban": (0.3, 0.9), "phone_local": (0.4, 0.4), "secret": (0.4, 0.4)}

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
PHONE_LOCAL = re.compile(r"(?<![0-9+.-])\(?[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
SECRET = re.compile(r"(?<![A-Za-z0-9])[A-Za-z0-9]{20,}(?![A-Za-z0-9])")
CONTEXT = {k: re.compile(w, re.IGNORECASE) for k, w in FOR.items()}
CONTRARY = re.compile(AGAINST, re.IGNORECASE)
NOT_DIGIT = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum([2 * d - 9 * (d > 4) for d in map(int, even)])) % 10 == 0


def mod97(code: str) -> bool:
    """The check of an IBAN: moved and read as a number, letters from 10 on, it leaves 1."""
    moved = code[4:] + code[:4]
    return int("".join([str(int(c, 36)) for c in moved])) % 97 == 1


def iban_end(code: str) -> int:
    """Length of the longest confirmed beginning of a proposed IBAN, 0 if there is none."""
    end = len(code)
    while len(code[:end].replace(" ", "")) >= 15:
        if mod97(code[:end].replace(" ", "")):
            return end
        end = code.rfind(" ", 0, end)
        if end < 0:
            break
    return 0


def emails(text: str) -> list[Span]:
    """From each @ back over what may stand before it, and on over the domain: linear where a scan from the left isn't."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text, start - 1):
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            out.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[Span]:
    """Confirmed spans of the base kinds, by start and then kind."""
    out = emails(text) if "@" in text else []
    if not out and text.isalpha():
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".") if p.lstrip("0")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def score(text: str, kind: str, start: int, end: int, confirmed: bool) -> float:
    near = text[max(0, start - NEAR) : start] + " \n " + text[end : end + NEAR]
    value = SCORES[kind][confirmed]
    value += 0.3 if CONTEXT[kind].search(near) else 0.0
    value -= 0.2 if CONTRARY.search(near) else 0.0
    return round(min(1.0, max(0.0, value)), 2)


def more_spans(text: str, base: list[Span]) -> list[tuple[str, int, int, float]]:
    """Spans of the other kinds that reach THRESHOLD. One that overlaps base spans must hold them whole, as a key may hold what looks like a card."""
    starts = [s for _, s, _ in base]
    reach = []
    for _, _, e in base:
        reach.append(max(e, reach[-1] if reach else 0))

    def free(start: int, end: int) -> bool:
        i = bisect_left(starts, end)
        while i and reach[i - 1] > start:
            i -= 1
            _, s, e = base[i]
            if e > start and (s < start or e > end or (s, e) == (start, end)):
                return False
        return True

    out = []
    for kind, pattern in (("iban", IBAN), ("phone_local", PHONE_LOCAL), ("secret", SECRET)):
        for m in pattern.finditer(text):
            start, end = m.span()
            confirmed = False
            if kind == "iban":
                length = iban_end(m[0])
                if not length:  # a refused checksum outweighs any context
                    continue
                end, confirmed = start + length, True
            elif kind == "secret" and (m[0].isalpha() or m[0].isdigit()):
                continue
            if free(start, end) and (value := score(text, kind, start, end, confirmed)) >= THRESHOLD:
                out.append((kind, start, end, value))
    return out


def find(text: str) -> tuple[list[Span], list[tuple[str, int, int, float]]]:
    """Base spans, and all spans with their scores, by start and then kind."""
    base = base_spans(text)
    both = [(k, s, e, score(text, k, s, e, True)) for k, s, e in base] + more_spans(text, base)
    both.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return base, both


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base`` and ``found``: arrays of kind, start, end and (found) score, of every whole text."""

    def make():
        def work(_, texts):
            both = [find(t) for t in texts]
            names = ("kind", "start", "end", "score")
            return [[[dict(zip(names, s, strict=False)) for s in b] for b, _ in both], [[dict(zip(names, s, strict=True)) for s in f] for _, f in both]]

        return work

    span = "kind string, start int, end int"
    schema = f"doc_id long, base array<struct<{span.replace(' ', ':').replace(',:', ',')}>>, found array<struct<{span.replace(' ', ':').replace(',:', ',')},score:double>>"
    return map_texts(text_rows(docs, id_col, text_col), schema, make)


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of their spans and all spans as text."""

    def joined(column: str):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE), F.sha2(joined("base"), 256).alias("base_sha256"), joined("found").alias("spans"))


def sha256_of(spans: list[Span]) -> str:
    """The hash that ``digest`` makes, for tests."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()
