"""Personal data by anchor expansion.

One Aho-Corasick pass finds the anchors: at-signs, plus-signs, digits, scheme marks and identifier
cues. At each anchor a deterministic parser expands to the boundaries of what it announces and
validates it (domain labels, address parts, Luhn and mod-97 sums, digit counts). The base kinds give
exactly the leftmost non-overlapping matches of their patterns: each keeps the place where it may
resume, and a candidate that fails validation is consumed, not retried.

Beyond the base kinds: ``login`` (user and password inside an address with a scheme), ``account``
(an IBAN with a valid check sum, a social security number or a number of 6 to 18 digits after a cue)
and ``hidden_email`` (``name [at] host [dot] tld``, also with round brackets).

Edge cases: a null or empty text has no spans; repeated rows and null ids are kept; an empty table
gives an empty result; other columns are ignored. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from platter.llm.common import sha256_hex, text_or_empty

Span = tuple[int, int]
BASE = ("email", "ip", "card", "phone")
ADDED = ("login", "account", "hidden_email")
ACCOUNT_CUES = ("iban", "account", "acct", "konto", "kontonummer", "cuenta", "compte", "ssn")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile("[0-9]+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(r"://([^\s/@:\"'<>]+:[^\s/@\"'<>]+)@[A-Za-z0-9.-]+")
_AFTER_CUE = re.compile(r"(?:\s?(?:no|number|nr|num)\b\.?)?[\s:#=.]{1,4}", re.I)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NUMBER = re.compile(r"[0-9]{6,18}(?![0-9])")
_HIDDEN = re.compile(r"[\[(] ?at ?[\])] ?([A-Za-z0-9-]+(?: ?[\[(] ?dot ?[\])] ?[A-Za-z0-9-]+)+)", re.I)


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for mark in ("[at]", "(at)", "[ at ]", "( at )", "[AT]", "(AT)"):
        found.add_word(mark, ("hidden", len(mark)))
    for cue in ACCOUNT_CUES:
        for form in (cue, cue.upper(), cue.capitalize()):
            found.add_word(form, ("cue", len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if k % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    flat = text.replace(" ", "")
    rest = 0
    for c in flat[4:] + flat[:4]:
        rest = (rest * (10 if c.isdigit() else 100) + int(c, 36)) % 97
    return rest == 1


def _account(text: str, start: int, end: int) -> Span | None:
    """The account that a cue at ``start:end`` announces."""
    if start and text[start - 1].isalnum():
        return None
    gap = _AFTER_CUE.match(text, end)
    if gap is None:
        return None
    at = gap.end()
    found = _IBAN.match(text, at)
    if found:
        # The greedy match may run into following capitals: the longest valid prefix counts.
        for stop in range(found.end(), at + 14, -1):
            if text[stop - 1] != " " and (stop >= len(text) or not text[stop].isalnum() or stop < found.end()) and iban_valid(text[at:stop]):
                return at, stop
    found = _SSN.match(text, at) or _NUMBER.match(text, at)
    return found.span() if found else None


def _name_start(text: str, end: int, least: int) -> int:
    """Where the mailbox name that ends at ``end`` starts, not before ``least``."""
    low = end
    while low > least and text[low - 1] in _LOCAL:
        low -= 1
    return low


def personal_spans(text: str) -> dict[str, list[Span]]:
    """All spans of one text by kind, each kind's from left to right without overlaps."""
    spans: dict[str, list[Span]] = {kind: [] for kind in (*BASE, *ADDED)}
    resume = dict.fromkeys(spans, 0)
    for last, (anchor, width) in _automaton().iter(text):
        at = last - width + 1
        if anchor == "digit":
            if at >= resume["card"]:
                found = _CARD.match(text, at)
                resume["card"] = found.end() if found else at + 1
                if found:
                    digits = found[0].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        spans["card"].append(found.span())
            if at >= resume["ip"]:
                found = _IP.match(text, at)
                resume["ip"] = found.end() if found else _DIGITS.match(text, at).end()
                if found:
                    parts = [p.lstrip("0") for p in found[0].split(".")]
                    if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                        spans["ip"].append(found.span())
        elif anchor == "at":
            domain = _DOMAIN.match(text, at)
            low = _name_start(text, at, resume["email"])
            if domain and low < at:
                spans["email"].append((low, domain.end()))
                resume["email"] = domain.end()
        elif anchor == "plus":
            found = _PHONE.match(text, at) if at >= resume["phone"] else None
            if found:
                resume["phone"] = found.end()
                if 9 <= sum(c.isdigit() for c in found[0]) <= 15:
                    spans["phone"].append(found.span())
        elif anchor == "scheme":
            found = _LOGIN.match(text, at)
            if found and at >= resume["login"]:
                spans["login"].append(found.span(1))
                resume["login"] = found.end()
        elif anchor == "cue":
            if at >= resume["account"] and (found := _account(text, at, last + 1)):
                spans["account"].append(found)
                resume["account"] = found[1]
        elif at >= resume["hidden_email"] and (found := _HIDDEN.match(text, at)):
            end = at - (at > resume["hidden_email"] and text[at - 1] == " ")
            low = _name_start(text, end, resume["hidden_email"])
            if low < end:
                spans["hidden_email"].append((low, found.end()))
                resume["hidden_email"] = found.end()
    return spans


def joined(spans: dict[str, list[Span]], kinds: tuple[str, ...]) -> str:
    """``kind:start:end`` by start, then by the order of ``kinds``, joined by commas."""
    order = sorted((s, n, e) for n, kind in enumerate(kinds) for s, e in spans[kind])
    return ",".join(f"{kinds[n]}:{s}:{e}" for s, n, e in order)


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, counts of the base kinds, ``base_sha256`` and ``spans`` (base and added)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [personal_spans(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array([len(f[kind]) for f in found], pa.int64()) for kind in BASE),
                    pa.array([sha256_hex(joined(f, BASE).encode()) for f in found], pa.string()),
                    pa.array([joined(f, (*BASE, *ADDED)) for f in found], pa.string()),
                ],
                [id_col, *(f"n_{kind}" for kind in BASE), "base_sha256", "spans"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE)
    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, {counts}, base_sha256 string, spans string"
    )
