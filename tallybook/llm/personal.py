"""Personal data by anchor expansion.

An Aho-Corasick automaton passes once over the text and reports anchors: at-signs, schemes,
digit cues and identifier words. A deterministic parser per anchor walks left and right to the
boundaries of the entity and validates it. No regular expression runs over the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import product

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in the order that breaks ties of position; the first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE_KINDS = KINDS[:4]

_DIGITS = frozenset("0123456789")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LABEL = _DIGITS | _LETTERS | {"-"}
_LOCAL = _DIGITS | _LETTERS | frozenset("._%+-")
_PHONE = _DIGITS | frozenset(" ().-")
_URL_END = frozenset(" \t\n\r\v\f\"'<>`|")
_VALUE = _DIGITS | _LETTERS | frozenset("_-./+=")

# Schemes and cue words that name an identifier.
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "mailto:", "tel:")
CUES = (
    "account", "acct", "api_key", "apikey", "iban", "passport", "password", "passwd",
    "secret", "ssn", "token", "user_id", "userid", "username",
)


@cache
def _automaton() -> ahocorasick.Automaton:
    """Anchors and their parser. Digit cues come from a rule: every pair that can begin one."""
    words: dict[str, str] = {"@": "email"}
    digits = sorted(_DIGITS)
    words |= {f"{a}.{b}": "ip" for a, b in product(digits, digits)}
    words |= {f"{a}{sep}{b}": "card" for a, sep, b in product(digits, ("", " ", "-"), digits)}
    words |= {f"+{a}": "phone" for a in digits}
    words |= dict.fromkeys(SCHEMES, "url")
    words |= dict.fromkeys((form for c in CUES for form in {c, c.upper(), c.capitalize()}), "account")
    found = ahocorasick.Automaton()
    for word, kind in words.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def _right(text: str, at: int, allowed: frozenset[str]) -> int:
    while at < len(text) and text[at] in allowed:
        at += 1
    return at


def _left(text: str, at: int, allowed: frozenset[str], floor: int) -> int:
    while at > floor and text[at - 1] in allowed:
        at -= 1
    return at


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """``at`` is the at-sign; the local part may not reach into the address before it."""
    start = _left(text, at, _LOCAL, floor)
    end = _right(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == "." and (after := _right(text, end + 1, _LABEL)) > end + 1:
        end, labels = after, labels + 1
    return (start, end) if labels else None


def _ip(text: str, at: int, floor: int) -> tuple[int, int, bool] | None:
    """``at`` is the last digit before the first dot. Returns whether the parts are valid too."""
    start = _left(text, at + 1, _DIGITS, floor)
    end, count = _right(text, at + 1, _DIGITS), 1
    while count < 4 and end < len(text) and text[end] == ".":
        after = _right(text, end + 1, _DIGITS)
        if after == end + 1:
            return None
        end, count = after, count + 1
    if count < 4:
        return None
    parts = (p.lstrip("0") for p in text[start:end].split("."))
    return start, end, all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def _card_run(text: str, at: int) -> tuple[int, int]:
    """The whole run of digits with single blanks or hyphens between them around ``at``."""
    start, end = at, at + 1
    while True:
        if start and text[start - 1] in _DIGITS:
            start -= 1
        elif start > 1 and text[start - 1] in " -" and text[start - 2] in _DIGITS:
            start -= 2
        else:
            break
    while True:
        if end < len(text) and text[end] in _DIGITS:
            end += 1
        elif end + 1 < len(text) and text[end] in " -" and text[end + 1] in _DIGITS:
            end += 2
        else:
            return start, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _card_ok(run: str) -> bool:
    digits = run.replace(" ", "").replace("-", "")
    return 14 <= len(digits) <= 19 and luhn(digits)


def _phone(text: str, at: int) -> tuple[int, int] | None:
    """``at`` is the plus sign before a digit; the number ends at the last digit of its run."""
    end = _right(text, at + 2, _PHONE)
    while end > at + 2 and text[end - 1] not in _DIGITS:
        end -= 1
    return (at, end) if end >= at + 4 else None


def _url(text: str, at: int) -> tuple[int, int] | None:
    end = at
    while end < len(text) and text[end] not in _URL_END:
        end += 1
    colon = text.index(":", at)
    while end > colon and text[end - 1] in ".,;:!?)]}":
        end -= 1
    body = text[colon + 1 : end].lstrip("/")
    return (at, end) if body and (body[0] in _LABEL or body[0] == "+") else None


def _account(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The value after a cue word such as ``token = "..."``; it needs six characters and a digit."""
    if start and text[start - 1] in _LETTERS:
        return None
    at = _right(text, end, frozenset(" "))
    if at >= len(text) or text[at] not in ":=#":
        return None
    at = _right(text, at + 1, frozenset(" \"'"))
    stop = _right(text, at, _VALUE)
    while stop > at and text[stop - 1] in "./":
        stop -= 1
    value = text[at:stop]
    return (at, stop) if len(value) >= 6 and not _DIGITS.isdisjoint(value) else None


def find_personal(text: str) -> list[tuple[str, int, int]]:
    """All spans of one whole text (kind, start, end in code points), by start, then kind.

    Base kinds equal their patterns, leftmost and without overlap per kind: a candidate that
    fails its check still uses up its characters, as a pattern's match would.
    """
    found: list[tuple[str, int, int]] = []
    floor = dict.fromkeys(KINDS, 0)
    for last, (kind, length) in _automaton().iter(text):
        first = last - length + 1
        if first < floor[kind]:
            if kind != "ip" or first + 1 < floor[kind]:
                continue
        if kind == "email":
            span = _email(text, first, floor[kind])
        elif kind == "ip":
            if not (hit := _ip(text, first, floor[kind])) or hit[0] < floor[kind] or first < hit[0]:
                continue
            floor[kind] = hit[1]
            span = hit[:2] if hit[2] else None
        elif kind == "card":
            run = _card_run(text, first)
            floor[kind] = run[1]
            span = run if _card_ok(text[slice(*run)]) else None
        elif kind == "phone":
            span = _phone(text, first)
            if span:
                floor[kind] = span[1]
                digits = sum(c in _DIGITS for c in text[slice(*span)])
                span = span if 10 <= digits <= 15 else None
        elif kind == "url":
            span = _url(text, first)
        else:
            span = _account(text, first, last + 1)
        if span:
            found.append((kind, *span))
            floor[kind] = span[1]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
    for batch in batches:
        texts = batch.column("text")
        rows = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in find_personal(t.as_py() or "")] for t in texts]
        arrays = [batch.column("doc_id"), pa.array(rows, pa.list_(span))]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "spans"])


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id and spans array<struct<kind, start, end>>.

    Null and empty texts have no spans; a null id stays null; rows that repeat are reported
    each. Only the id and the text are read. An empty table gives no rows.
    """
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    kinds = "doc_id bigint, spans array<struct<kind: string, start: int, end: int>>"
    return slim.mapInArrow(_spans, kinds)


def mask_personal(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, with each span of its text replaced by its kind in brackets."""

    @F.udf("string")
    def masked(text: str | None) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        for kind, start, end in find_personal(text):
            if start >= at:
                out += [text[at:start], f"[{kind}]"]
                at = end
        return "".join(out) + text[at:]

    return docs.withColumn(text_col, masked(F.col(text_col)))
