"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Base kinds are ``email``, ``ip``, ``card`` and ``phone``; the method adds ``iban`` (mod-97) and
``local_phone`` (accepted only with a context word near, in one of four languages). Every pattern is scanned in time linear
in the text, so a very long text or a very long run of one character class costs no more per
character than a short one; an added span is held against the base spans by a binary search.

Defined results: a null text is the empty text (no spans); an empty table gives an empty table;
each input row gives one output row, so repeated rows and null ids are kept as they are; columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_rows

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("iban", "local_phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only begin where a digit run begins: the rest of a run fails when its head fails
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_LOCAL_PHONE = re.compile(r"(?<![\w+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![\w-])")

#: Score of a span by kind before context, and what a context word within WINDOW characters adds.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "local_phone": 0.3}
CONTEXT_BONUS, WINDOW, ACCEPT = 0.3, 40, 0.5
#: English, French, German and Spanish words, by their beginnings.
_CALLS = ("tel", "phone", "call", "mobile", "fax", "portable", "appel", "anruf", "handy", "rufnummer", "móvil", "llam", "celular")
CONTEXT = {
    "email": ("mail", "contact", "write", "courriel", "écri", "adresse", "kontakt", "schreib", "correo", "escrib"),
    "ip": ("ip", "host", "server", "address", "serveur", "hôte", "adresse", "rechner", "servidor", "dirección"),
    "card": ("card", "visa", "credit", "debit", "payment", "carte", "paiement", "karte", "kredit", "zahlung", "tarjeta", "pago"),
    "phone": _CALLS,
    "iban": ("iban", "account", "bank", "transfer", "compte", "banque", "virement", "konto", "überweis", "cuenta", "banco", "transferencia"),
    "local_phone": _CALLS,
}
_CONTEXT = {k: re.compile(r"\b(?:" + "|".join(v) + r")", re.IGNORECASE) for k, v in CONTEXT.items()}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses, found from each '@' outwards."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        end = -1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append((start, end))
        floor = end if end > 0 else at + 1
        at = text.find("@", floor)
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("email", s, e) for s, e in emails(text)]
    spans += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
              if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in m.groups())]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
                  if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return spans


def extra_spans(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    found = [("iban", m.start(), m.end()) for m in _IBAN.finditer(text) if mod97(m.group())]
    found += [("local_phone", m.start(), m.end()) for m in _LOCAL_PHONE.finditer(text)]
    edges = sorted((s, e) for _, s, e in taken)
    starts = [s for s, _ in edges]
    reach = [0, *accumulate((e for _, e in edges), max)]  # the furthest end of the first i spans
    # a taken span overlaps (s, e) if, of those that start before e, one ends after s
    return [(k, s, e) for k, s, e in found
            if reach[bisect_left(starts, e)] <= s and score(text, k, s, e) >= ACCEPT]


def score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - WINDOW):start] + " " + text[end:end + WINDOW]
    return min(1.0, SCORES[kind] + CONTEXT_BONUS * bool(_CONTEXT[kind].search(near)))


def detect(text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, extra spans) of one text, each by kind as listed, then start."""
    text = text or ""
    if "@" not in text and not any(d in text for d in "0123456789"):
        return [], []
    base = base_spans(text)
    return base, extra_spans(text, base)


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType()),
                     T.StructField("base", T.BooleanType())])
FOUND = T.StructType([T.StructField("doc_id", T.LongType()),
                      T.StructField("pii", T.ArrayType(SPAN, False)),
                      T.StructField("base_sha256", T.StringType())])


def _task():
    def rows(batch):
        for doc_id, text in batch:
            base, extra = detect(text)
            digest = hashlib.sha256(join_spans(base).encode()).hexdigest()
            yield (doc_id, [{"kind": k, "start": s, "end": e, "score": score(text, k, s, e), "base": b}
                            for group, b in ((base, True), (extra, False)) for k, s, e in group], digest)
    return rows


def join_spans(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: its spans with scores, and the base digest."""
    return map_rows(docs.select("doc_id", "text"), _task, FOUND)
