"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors in a text (at-signs, plus signs, digits, scheme
separators and identifier cues); a small deterministic parser per kind expands each anchor
to the span's boundaries and validates it. No regular expression scans the text.

Base kinds are exactly the leftmost non-overlapping matches of

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ip ``[0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)``, parts at most 255
* card ``[0-9]([\\x20-]?[0-9])+``, 14 to 19 digits that pass Luhn
* phone ``\\+[0-9][\\x20().0-9-]+[0-9]``, 10 to 15 digits

with failing matches dropped and not retried. Added kinds:

* url: ``scheme://`` with a scheme of letters, up to white space, quotes or angle brackets,
  and a host that is not empty; closing punctuation is left out
* account: the value after an identifier cue (password, token, api_key, account, iban, ... in any
  ASCII case) and ``=`` or ``:``, at least six characters, quoted or with a digit among them
* secret: a key that shows by its form: a well-known prefix and as many characters as belong to
  it, or the header line of a private key
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_blocks

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account", "secret")

DIGITS = frozenset("0123456789")
ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
EMAIL_LOCAL = ALNUM | frozenset("._%+-")
EMAIL_LABEL = ALNUM | frozenset("-")
PHONE_INNER = DIGITS | frozenset(" ().-")
ACCOUNT_VALUE = ALNUM | frozenset("_-./+=$")
KEY_CHARS = ALNUM | frozenset("_-")
URL_END = frozenset(" \t\n\r\x0b\x0c\"'<>`|\\^{}")
URL_CLOSING = ".,;:!?)]*"

#: Cues that announce an identifier; matched whatever the case of ASCII letters.
CUES = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "api-key", "access_key", "private_key", "account", "acct", "iban", "username", "user_id", "login", "ssn", "passport")

#: Prefixes of keys, and how many letters and digits (and ``_`` or ``-``) follow at least (fixed values).
KEY_PREFIXES = {"AKIA": 16, "ASIA": 16, "ghp_": 36, "gho_": 36, "ghs_": 36, "glpat-": 20, "sk_live_": 16, "xoxb-": 20, "xoxp-": 20, "AIza": 35}
#: What a private key's header starts with, and what it ends with.
KEY_HEADER, KEY_HEADER_END = "-----BEGIN ", "PRIVATE KEY-----"
#: Shortest account value.
ACCOUNT_CHARS = 6
#: Longest header of a private key.
HEADER_CHARS = 60


@cache
def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    a.add_word("@", ("email", 1))
    a.add_word("+", ("phone", 1))
    a.add_word("://", ("url", 3))
    for d in DIGITS:
        a.add_word(d, ("digits", 1))
    for cue in CUES:
        a.add_word(cue, ("account", len(cue)))
    for cue in (*KEY_PREFIXES, KEY_HEADER):
        a.add_word(cue.lower(), ("secret", len(cue)))
    a.make_automaton()
    return a


#: A-Z as a-z.
_LOWER = {c: c + 32 for c in range(65, 91)}


def _lowered(text: str) -> str:
    """The text in lower case, place by place. A letter whose lower case is longer leaves only A-Z to be changed."""
    lower = text.lower()
    return lower if len(lower) == len(text) else text.translate(_LOWER)


def _run(text: str, at: int, chars: frozenset) -> int:
    """End of the run of ``chars`` from ``at``."""
    n = len(text)
    while at < n and text[at] in chars:
        at += 1
    return at


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Around the at-sign at ``at``, not before ``floor``, the end of the email before."""
    start = at
    while start > floor and text[start - 1] in EMAIL_LOCAL:
        start -= 1
    end = _run(text, at + 1, EMAIL_LABEL)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == "." and (more := _run(text, end + 1, EMAIL_LABEL)) > end + 1:
        end, labels = more, labels + 1
    return (start, end) if labels else None


def _ip(text: str, at: int) -> tuple[int, bool]:
    """From the digit at ``at``: the end of what the pattern reads (or of the digits and dots
    that it can't use), and whether it is an address."""
    parts, end = [], at
    while True:
        stop = _run(text, end, DIGITS)
        parts.append(text[end:stop])
        end = stop
        if len(parts) == 4:
            return end, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts)
        if not (end + 1 < len(text) and text[end] == "." and text[end + 1] in DIGITS):
            return end, False
        end += 1


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _card(text: str, at: int) -> tuple[int, bool]:
    """From the digit at ``at``: the end of the run of digits with single spaces or hyphens
    between, and whether it is a card number."""
    end, n = at + 1, len(text)
    while end < n:
        if text[end] in DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in DIGITS:
            end += 2
        else:
            break
    if end - at < 14:
        return end, False
    digits = text[at:end].replace(" ", "").replace("-", "")
    return end, 14 <= len(digits) <= 19 and _luhn(digits)


def _phone(text: str, at: int) -> tuple[int, bool] | None:
    """From the plus sign at ``at``."""
    if not (at + 1 < len(text) and text[at + 1] in DIGITS):
        return None
    end = _run(text, at + 2, PHONE_INNER)
    while end > at + 2 and text[end - 1] not in DIGITS:
        end -= 1
    if end - at < 4:
        return None
    return end, 10 <= sum(c in DIGITS for c in text[at:end]) <= 15


def _url(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """Around the separator ``://`` at ``at``."""
    start = at
    while start > floor and text[start - 1] in ALNUM:
        start -= 1
    end, n = at + 3, len(text)
    if start == at or not text[start].isalpha() or end >= n or text[end] not in ALNUM:
        return None
    while end < n and text[end] not in URL_END and text[end].isprintable():
        end += 1
    while end > at + 3 and text[end - 1] in URL_CLOSING:
        end -= 1
    return (start, end) if end > at + 3 else None


class _Values:
    """Runs of value characters. The last run is remembered: cues inside a value that was no account don't scan it again."""

    def __init__(self, text: str):
        self.text, self.start, self.stop, self.end, self.digit = text, 0, 0, 0, -1

    def run(self, at: int) -> tuple[int, int, bool]:
        """From ``at``: the end of the run, that without closing characters, and whether a digit is in the latter."""
        if not self.start <= at < self.stop:
            self.start, self.stop = at, _run(self.text, at, ACCOUNT_VALUE)
            self.end = self.stop
            while self.end > at and self.text[self.end - 1] in ".=/":
                self.end -= 1
            self.digit = self.end - 1
            while self.digit >= at and self.text[self.digit] not in DIGITS:
                self.digit -= 1
        return max(at, self.stop), max(at, self.end), self.digit >= at


def _account(text: str, at: int, values: _Values) -> tuple[int, int] | None:
    """The value after a cue that ends at ``at``."""
    n = len(text)
    while at < n and text[at] in " \"'":
        at += 1
    if at >= n or text[at] not in "=:":
        return None
    at += 1
    while at < n and text[at] in " \"'":
        at += 1
    stop, end, digit = values.run(at)
    quoted = text[at - 1] in "\"'" and text[stop : stop + 1] == text[at - 1]
    if end - at < ACCOUNT_CHARS or not (quoted or digit):
        return None
    return at, end


def _secret(text: str, at: int, size: int) -> tuple[int, int] | None:
    """From the key prefix or header at ``at``, in its own case and not inside a word."""
    cue = text[at : at + size]
    if at and text[at - 1] in ALNUM:
        return None
    if cue == KEY_HEADER:
        end = text.find(KEY_HEADER_END, at + size, at + HEADER_CHARS + len(KEY_HEADER_END))
        return None if end < 0 else (at, end + len(KEY_HEADER_END))
    end = _run(text, at + size, KEY_CHARS)
    return (at, end) if cue in KEY_PREFIXES and end - at - size >= KEY_PREFIXES[cue] else None


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, end exclusive, by start and then kind."""
    found: list[tuple[str, int, int]] = []
    over = dict.fromkeys(KINDS, 0)  # where each kind may go on
    values = _Values(text)
    for end, (what, size) in _automaton().iter(_lowered(text)):
        at = end + 1 - size
        if what == "digits":
            if at >= over["ip"]:
                over["ip"], good = _ip(text, at)
                if good:
                    found.append(("ip", at, over["ip"]))
            if at >= over["card"]:
                over["card"], good = _card(text, at)
                if good:
                    found.append(("card", at, over["card"]))
        elif what == "email":
            if at >= over["email"] and (span := _email(text, at, over["email"])):
                found.append(("email", *span))
                over["email"] = span[1]
        elif what == "phone":
            if at >= over["phone"] and (hit := _phone(text, at)):
                over["phone"] = hit[0]
                if hit[1]:
                    found.append(("phone", at, hit[0]))
        elif what == "url":
            if at >= over["url"] and (span := _url(text, at, over["url"])):
                found.append(("url", *span))
                over["url"] = span[1]
        elif at >= over[what] and (span := _account(text, end + 1, values) if what == "account" else _secret(text, at, size)):
            found.append((what, *span))
            over[what] = span[1]
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(found, key=lambda s: (s[1], order[s[0]]))


def pii_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans, an array of (kind, start, end), for every row and whole text.

    Null and empty texts give an empty array, and repeated rows repeated results. Other
    columns are not read. No row moves.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for block in text_blocks(batches, "text"):
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t)] if t else [] for t in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind: string, start: int, end: int>>")


def span_text(spans) -> F.Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
