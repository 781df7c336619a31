"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds at-signs, plus signs, schemes and
identifier cues; at each anchor a small parser walks outwards and validates what
it finds.  Numbers have no anchor of their own: one linear scan finds their
runs.  Every parser is linear in the text, also on very long runs.

Per kind, spans are leftmost and do not overlap.  Email, ip, card and phone
follow fixed patterns (the base kinds); url, iban, account and secret are added.
"""

from __future__ import annotations

import re
import string
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "iban", "account", "secret")

# Patterns of the base kinds, written so that they cannot backtrack.
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++")
NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

URL = re.compile(r"[^\s<>\"'`{}|\\^]++")
HOST = re.compile(r"(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,24}(?![A-Za-z0-9.-]*@)")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
AFTER_IBAN = re.compile(r"[\s:#=.]{0,5}")
AFTER_ACCOUNT = re.compile(r"(?: ?(?:number|no\.?|nr\.?|id))?[\s:#=]{1,5}", re.IGNORECASE)
ACCOUNT = re.compile(r"[0-9](?:[ -]?[0-9]){5,33}(?![0-9])")
SECRET = re.compile(r"[\"']?\s{0,3}[:=]\s{0,3}[\"']?([^\s\"'<>,;]{6,})")

CUES = {
    "@": "email",
    "+": "phone",
    "http://": "url",
    "https://": "url",
    "ftp://": "url",
    "www.": "url",
    **{c: "iban" for c in ("iban", "Iban", "IBAN")},
    **{c: "account" for c in ("account", "Account", "ACCOUNT", "acct", "Acct", "ACCT")},
    **{
        c: "secret"
        for w in ("password", "passwd", "api_key", "apikey", "api-key", "secret", "token")
        for c in (w, w.capitalize(), w.upper())
    },
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    rest = 0
    for c in iban[4:] + iban[:4]:
        rest = (rest * (10 if c.isdigit() else 100) + int(c, 36)) % 97
    return rest == 1


def email_at(text: str, at: int, free: int):
    """The address around the at-sign; ``free``: end of the one before."""
    start = at
    while start > free and text[start - 1] in LOCAL:
        start -= 1
    domain = DOMAIN.match(text, at + 1) if start < at else None
    return (start, domain.end(), True) if domain else None


def phone_at(text: str, at: int, free: int):
    found = PHONE.match(text, at)
    return found and (at, found.end(), 9 <= sum(c.isdigit() for c in found.group()) <= 15)


def url_at(text: str, at: int, free: int):
    run = URL.match(text, at)
    end = run.end()
    while end > at and text[end - 1] in ".,;:!?)]*":
        end -= 1
    scheme = text.find("://", at, at + 9)
    host = HOST.match(text, scheme + 3 if scheme >= 0 else at, end)
    return (at, end, True) if host else None


def iban_at(text: str, at: int, free: int):
    found = IBAN.match(text, AFTER_IBAN.match(text, at + 4).end())
    if not found:
        return None
    # The longest valid prefix of the run: words after the number may look like part of it.
    for end in range(found.end(), found.start() + 14, -1):
        plain = text[found.start() : end].replace(" ", "")
        if text[end - 1] != " " and len(plain) >= 15 and mod97(plain):
            return found.start(), end, True
    return None


def account_at(text: str, at: int, free: int):
    gap = AFTER_ACCOUNT.match(text, at + (7 if text[at + 2 : at + 3] in "cC" and text[at + 3 : at + 4] in "oO" else 4))
    found = gap and ACCOUNT.match(text, gap.end())
    return found and (found.start(), found.end(), True)


def secret_at(text: str, at: int, free: int):
    word = re.compile(r"[A-Za-z_-]{5,8}").match(text, at)
    found = word and SECRET.match(text, word.end())
    return found and (found.start(1), found.end(1), True)


PARSERS = {"email": email_at, "phone": phone_at, "url": url_at, "iban": iban_at, "account": account_at, "secret": secret_at}


def number_spans(text: str):
    for found in IP.finditer(text):
        parts = (p.lstrip("0") for p in found.group().split("."))
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield "ip", found.start(), found.end()
    for found in NUMBER.finditer(text):
        if found.end() - found.start() >= 12:
            digits = found.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield "card", found.start(), found.end()


def anchor_spans(text: str, machine):
    """Spans at anchors; a match that fails its check is passed over whole, as if it had been found."""
    free = dict.fromkeys(PARSERS, 0)
    for last, (kind, length) in machine.iter(text):
        at = last - length + 1
        if at < free[kind]:
            continue
        found = PARSERS[kind](text, at, free[kind])
        if found and found[0] >= free[kind]:
            free[kind] = found[1]
            if found[2]:
                yield kind, found[0], found[1]


def build_machine():
    import ahocorasick

    machine = ahocorasick.Automaton()
    for cue, kind in CUES.items():
        machine.add_word(cue, (kind, len(cue)))
    machine.make_automaton()
    return machine


def text_spans(text: str, machine) -> list[tuple[int, int, int]]:
    """(start, index of kind, end), sorted."""
    rank = {k: i for i, k in enumerate(KINDS)}
    found = [*anchor_spans(text, machine), *number_spans(text)]
    return sorted((start, rank[kind], end) for kind, start, end in found)


def _finding(batches):
    machine = build_machine()
    for batch in batches:
        counts, starts, ends, kinds = [0], [], [], []
        for text in batch.column(1):
            for start, kind, end in text_spans(text.as_py() or "", machine):
                starts.append(start)
                ends.append(end)
                kinds.append(KINDS[kind])
            counts.append(len(starts))
        spans = pa.StructArray.from_arrays(
            [pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())], names=["kind", "start", "end"]
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.ListArray.from_arrays(pa.array(counts, pa.int32()), spans)], names=["doc", "spans"]
        )


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id and ``spans``, array of (kind, start, end) by start, then kind in order of ``KINDS``.

    Offsets are code points, end exclusive.  A null or empty text has no spans.
    Ids may be null or repeated.  Other columns are ignored.
    """
    source = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    kind = source.schema["doc"].dataType.simpleString()
    out = source.mapInArrow(_finding, f"doc {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")
    return out.withColumnRenamed("doc", id_col)


def written(spans):
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
