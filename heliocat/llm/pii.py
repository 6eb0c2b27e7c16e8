"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass: at-signs, digits, plus signs, scheme
marks and account cues. From each anchor a local parser finds the bounds of one candidate
and checks it: e-mail addresses around an at-sign, IP addresses and card numbers from the
first digit of a run, phone numbers from a plus sign, web addresses around ``://`` and
account numbers behind a cue word (IBANs by their check digits).

Spans are code points, the end exclusive. Of one kind they do not overlap; a candidate that
fails its check is dropped and the search goes on behind it. Null and empty texts have no
span; equal rows each get their result; an empty table gives an empty result; other columns are
ignored by ``spans`` and kept by ``redact``.
"""

from __future__ import annotations

import functools
import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import documents, in_small_batches, per_batch

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
CUES = ("iban", "account", "acct", "konto", "cuenta", "compte", "passport", "ssn")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_REST = re.compile(r"[^\s<>\"'`{}|\\^\[\]]+")
_HOST = re.compile(r"(?:[A-Za-z0-9-]+\.)+[A-Za-z0-9-]+|localhost", re.ASCII)
_NUMBER = re.compile(
    r"(?:[ \t]*(?:number|no\.?|nr\.?|#|:|=|is))*[ \t]*([A-Z]{2}[0-9]{2}(?:[ -]?[A-Z0-9]){11,30}|[0-9](?:[ -]?[0-9]){5,19})(?![A-Za-z0-9])"
)
_DIGITS = "0123456789"


@functools.cache
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in _DIGITS:
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            found.add_word(form, ("cue", len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban(text: str) -> bool:
    moved = text[4:] + text[:4]
    return 15 <= len(text) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _byte(digits: str) -> bool:
    """Whether a number without leading zeros is at most 255; int() refuses more than 4,300 digits."""
    return len(digits) <= 3 and int(digits or "0") <= 255


def _left(text: str, at: int, allowed: frozenset, least: int) -> int:
    while at > least and text[at - 1] in allowed:
        at -= 1
    return at


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), by kind as in KINDS, then by start."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    after = dict.fromkeys(KINDS, 0)  # where the search of a kind goes on
    for last, (what, width) in _automaton().iter(text):
        at = last - width + 1
        if what == "digit":
            if at and "0" <= text[at - 1] <= "9":
                continue
            if at >= after["ip"] and (m := _IP.match(text, at)):
                after["ip"] = m.end()
                if all(_byte(x.lstrip("0")) for x in m[0].split(".")):
                    out["ip"].append(m.span())
            if at >= after["card"] and (m := _CARD.match(text, at)):
                after["card"] = m.end()
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out["card"].append(m.span())
        elif what == "at":
            start = _left(text, at, _LOCAL, after["email"])
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                after["email"] = m.end()
                out["email"].append((start, m.end()))
        elif what == "plus":
            if at >= after["phone"] and (m := _PHONE.match(text, at)):
                after["phone"] = m.end()
                if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                    out["phone"].append(m.span())
        elif what == "scheme":
            start = _left(text, at, _SCHEME, after["url"])
            while start < at and not (text[start].isascii() and text[start].isalpha()):
                start += 1
            if start < at and _HOST.match(text, last + 1) and (m := _REST.match(text, last + 1)):
                after["url"] = last + 1 + len(m[0].rstrip(".,;:!?)"))
                out["url"].append((start, after["url"]))
        elif (not at or not text[at - 1].isalnum()) and (m := _NUMBER.match(text, last + 1)):
            number = m[1].replace(" ", "").replace("-", "")
            if m.start(1) >= after["account"] and (number.isdigit() or iban(number)):
                after["account"] = m.end()
                out["account"].append(m.span(1))
    return [(kind, a, b) for kind in KINDS for a, b in out[kind]]


def spans(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, found array<struct<kind, start, end>>; one row per input row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [find(t) for t in batch["text"].to_pylist()]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        rows = [[{"kind": k, "start": a, "end": b} for k, a, b in x] for x in found]
        return pa.record_batch({"doc_id": batch["doc_id"], "found": pa.array(rows, kind)})

    schema = "doc_id long, found array<struct<kind:string,start:long,end:long>>"
    return documents(docs, text, key).mapInArrow(per_batch(work), schema)


def redacted(text: str) -> str:
    """The text with each stretch of personal data replaced by its kind in brackets."""
    out, at, open_kind = [], 0, None
    for a, b, kind in sorted((a, b, k) for k, a, b in find(text)):
        if b <= at:
            continue
        if a >= at or open_kind is None:
            out.append(text[at:a])
            out.append(f"[{kind.upper()}]")
        at, open_kind = b, kind
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns, personal data in ``text`` replaced; a null text stays null."""
    names = docs.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        new = [None if t is None else redacted(t) for t in batch[text].to_pylist()]
        i = batch.schema.get_field_index(text)
        return batch.set_column(i, batch.schema.field(i), pa.array(new, batch.schema.field(i).type))

    return in_small_batches(docs).mapInArrow(per_batch(work, text), docs.schema).select(*names)


def digest(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a hash of the base spans, and all spans as text."""
    joined = lambda x: F.array_join(
        F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    counted = [
        F.size(F.expr(f"filter(found, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}")
        for k in BASE_KINDS
    ]
    base = F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))
    return spans(docs, text, key).select(
        "doc_id", *counted, F.sha2(joined(base), 256).alias("base_sha256"), joined("found").alias("spans")
    )


def sha256_of(found: list[tuple[str, int, int]]) -> str:
    """The base spans' hash as ``digest`` gives it."""
    base = ",".join(f"{k}:{a}:{b}" for k, a, b in found if k in BASE_KINDS)
    return hashlib.sha256(base.encode()).hexdigest()
