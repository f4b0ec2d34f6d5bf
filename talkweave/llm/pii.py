"""Personal data: patterns propose spans, checksums confirm them, context words score them.

The four base kinds (email, ip, card, phone) are found leftmost and without
overlap within a kind, and checked: parts of an address, digits of a number, the
Luhn sum of a card. Further kinds are proposed by wider patterns: account numbers
confirmed by their remainder modulo 97 at each word end where they may stop, and secrets such as access keys, which
need a word like ``password`` in front. Words near a span raise or lower
its score; base spans stay whatever their score, the others need ``LEAST_SCORE``.

Defined cases: a missing or empty text has no spans; offsets count code points,
the end is exclusive; repeated rows give the same spans; no rows give no rows;
further columns are ignored. Every pattern is linear in the length of a text:
none starts anew inside a run of characters that it has already read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from talkweave.llm.rows import in_tasks, keyed, shown_id

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is entered at its first digit only; starting later in the run
# would find the same parts after it.
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# The shortest number only; ``_accounts`` tries every longer one.
ACCOUNT = re.compile(r"[A-Z](?<![A-Za-z0-9].)[A-Z][0-9]{2}(?:\x20?[A-Z0-9]){11}")
ACCOUNT_MOST = 34
#: How many characters the numbers of a country have; those of others may end at any word's end.
ACCOUNT_LENGTH = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18,
    "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24,
    "SM": 27, "TR": 26,
}
ACCESS_KEY = re.compile(r"A[KS]IA(?<![A-Za-z0-9]....)[A-Z0-9]{16}(?![A-Za-z0-9])")
SECRET = re.compile(r"[=:]\x20?[\"']?([A-Za-z0-9_./+-]{12,200})")
SECRET_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")

NEAR = 60
LEAST_SCORE = 0.5
#: Words that speak for a kind when they stand near a span of it.
FOR = {
    "email": re.compile(r"\b(?:e-?mail|contact|write|mailto|courriel|correo)\b", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address|login|adresse)\b", re.I),
    "card": re.compile(r"\b(?:card|visa|mastercard|credit|payment|carte|karte|tarjeta)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|call|mobile|fax|telefon|téléphone|teléfono)\b", re.I),
    "account": re.compile(r"\b(?:iban|account|bank|konto|compte|cuenta)\b", re.I),
    "secret": re.compile(r"\b(?:key|secret|password|token|login)\b", re.I),
}
#: Words that speak against any kind.
AGAINST = re.compile(r"\b(?:version|isbn|example|sample|order|serial)\b", re.I)
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "account": 0.7, "secret": 0.7}

BASE_KINDS = ("email", "ip", "card", "phone")


class Span(NamedTuple):
    """A place of personal data in code points, and how sure it is."""

    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """The check digit of card numbers."""
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def mod_97(account: str) -> bool:
    """The check digits of international account numbers."""
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for found in DOMAIN.finditer(text) if "@" in text else ():
        start = found.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < found.start():
            yield start, found.end()
            done = found.end()


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for found in IP.finditer(text):
        parts = [part.lstrip("0") for part in found[0].split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            yield found.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for found in CARD.finditer(text):
        digits = _digits(found[0]) if found.end() - found.start() >= 13 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for found in PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_digits(found[0])) <= 15:
            yield found.span()


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    """Numbers that end at a word's end and are confirmed: of the country's length if that is known, else the longest."""
    at = 0
    while found := ACCOUNT.search(text, at):
        start, end = found.span()
        account = found[0].replace(" ", "")
        length = ACCOUNT_LENGTH.get(account[:2])
        confirmed = 0
        while True:
            following = text[end : end + 1]
            whole = not (following.isascii() and following.isalnum())
            if whole and length in (None, len(account)) and mod_97(account):
                confirmed = end
            step = end + (following == " ")
            character = text[step : step + 1]
            if len(account) == ACCOUNT_MOST or not (character.isascii() and (character.isdigit() or character.isupper())):
                break
            account += character
            end = step + 1
        if confirmed:
            yield start, confirmed
        # Another number may begin at a later word of one that is not confirmed.
        at = confirmed or start + 1


def _secrets(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    spans = [m.span() for m in ACCESS_KEY.finditer(text)]
    for found in SECRET.finditer(text):
        name = text[max(0, found.start() - 10) : found.start()].rstrip(" ").lower()
        if name.endswith(SECRET_NAMES) and any("0" <= c <= "9" for c in found[1]):
            spans.append(found.span(1))
    for start, end in sorted(spans):
        if start >= done:
            yield start, end
            done = end


FINDERS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": _emails, "ip": _ips, "card": _cards, "phone": _phones, "account": _accounts, "secret": _secrets,
}


def find(text: str) -> list[Span]:
    """All spans of a text, by kind as listed in ``FINDERS``, then by start."""
    spans = []
    for kind, finder in FINDERS.items():
        for start, end in finder(text):
            near = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]
            score = PRIOR[kind] + 0.25 * bool(FOR[kind].search(near)) - 0.25 * bool(AGAINST.search(near))
            if kind in BASE_KINDS or score >= LEAST_SCORE:
                spans.append(Span(kind, start, end, round(min(score, 1.0), 2)))
    return spans


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    for batch in batches:
        spans = [[s._asdict() for s in find(text.as_py())] for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key_id"), batch.column("key_hash"), pa.array(spans, kind)], ["key_id", "key_hash", "spans"]
        )


def find_spans(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the spans of every document: kind, start, end, score."""
    found = in_tasks(
        keyed(docs), _find, "key_id bigint, key_hash bigint, spans array<struct<kind:string,start:int,end:int,score:double>>"
    )
    return found.select(shown_id(), "key_hash", "spans")


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one."""
    out, done = [], 0
    for span in sorted(spans, key=lambda s: (s.start, -s.end)):
        if span.start >= done:
            out += [text[done : span.start], f"[{span.kind}]"]
        done = max(done, span.end)
    return "".join(out) + text[done:]


def digest(spans: list[Span]) -> str:
    """SHA-256 of spans written as ``kind:start:end``, comma-joined."""
    return hashlib.sha256(",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans).encode()).hexdigest()
