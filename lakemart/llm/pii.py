"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, schemes, cues of identifiers, and the
shortest digit groups that addresses and numbers hold. A local parser for each kind expands an
anchor to the whole candidate and validates it.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
from pyspark.sql import DataFrame, SparkSession

from lakemart.llm.common import documents, map_rows, whole_texts
from lakemart.llm.spans import SPANS, digest_columns, not_inside, one_per_code_point, ordered

BASE = ("email", "ip", "card", "phone")
#: What the method adds: bank accounts, other cued identifiers, and credentials in URLs.
KINDS = (*BASE, "iban", "account", "login")

#: Words that announce an identifier.
CUES = ("iban", "account", "acct", "ssn", "social security", "passport", "customer id", "routing", "tax id", "licence no", "license no")
LOCAL_PART = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBER_CHAIN = re.compile(rb"[0-9]+(?:\.[0-9]+)*")
CARD_CHAIN = re.compile(rb"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(rb"[\x20:#.=]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
IDENTIFIER = re.compile(
    rb"(?:\x20?(?:number|no|num|nr|id|code))?\.?[\x20:#=]{1,4}(?=(?:[A-Za-z-]*[0-9]){5})([A-Za-z0-9]+(?:-[A-Za-z0-9]+)*)", re.I
)
USER_INFO = re.compile(rb"://([^\s/?#@:<>\"']+:[^\s/?#@<>\"']+)@[A-Za-z0-9.-]+")

#: Digits become 0 and letters lower case, so that one pattern stands for all digits.
FOLD = bytes(0x30 if 0x30 <= b <= 0x39 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


@functools.cache
def anchors() -> ahocorasick.Automaton:
    """Automaton of (kind of anchor, its length)."""
    automaton = ahocorasick.Automaton()
    patterns = {"@": "at", "://": "scheme", "00": "digits", "0 0": "digits", "0-0": "digits", "0.0": "dotted", "+0": "plus"}
    for pattern, kind in (patterns | dict.fromkeys(CUES, "cue")).items():
        automaton.add_word(pattern, (kind, len(pattern)))
    automaton.make_automaton()
    return automaton


def luhn(digits: bytes) -> bool:
    values = [d - 0x30 for d in digits]
    return sum(values[-1::-2] + [2 * d - 9 * (d > 4) for d in values[-2::-2]]) % 10 == 0


def iban_valid(number: bytes) -> bool:
    raw = number.replace(b" ", b"").decode()
    if not 15 <= len(raw) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in raw[4:] + raw[:4])) % 97 == 1


def email(raw: bytes, at: int, least: int) -> tuple[int, int] | None:
    """Address around an at-sign; it starts no earlier than ``least``."""
    start = at
    while start > least and raw[start - 1] in LOCAL_PART:
        start -= 1
    domain = DOMAIN.match(raw, at + 1) if start < at else None
    return (start, domain.end()) if domain else None


def addresses(raw: bytes, start: int) -> tuple[list[tuple[int, int]], int]:
    """IP addresses in the dotted chain that starts at ``start``, and the chain's end."""
    chain = NUMBER_CHAIN.match(raw, start)
    parts, at, out = chain[0].split(b"."), start, []
    for i in range(0, len(parts) - 3, 4):
        four = parts[i : i + 4]
        end = at + sum(map(len, four)) + 3
        if all(len(p.lstrip(b"0")) <= 3 and int(p.lstrip(b"0") or b"0") <= 255 for p in four):
            out.append((at, end))
        at = end + 1
    return out, chain.end()


def find(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text, by start and then in the order of ``KINDS``."""
    raw = one_per_code_point(text)
    base, extra = [], []
    email_end = chain_end = card_end = 0
    for last, (anchor, length) in anchors().iter(raw.translate(FOLD).decode("latin-1")):
        first = last - length + 1
        if anchor == "at":
            if first >= email_end and (span := email(raw, first, email_end)):
                base.append(("email", *span))
                email_end = span[1]
        elif anchor == "dotted":
            if first >= chain_end:
                while first > chain_end and 0x30 <= raw[first - 1] <= 0x39:
                    first -= 1
                found, chain_end = addresses(raw, first)
                base += [("ip", *span) for span in found]
        elif anchor == "digits":
            if first >= card_end:
                card = CARD_CHAIN.match(raw, first)
                card_end = card.end()
                if card_end - first >= 12:
                    digits = re.sub(rb"[^0-9]", b"", card[0])
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        base.append(("card", first, card_end))
        elif anchor == "plus":
            number = PHONE.match(raw, first)
            if number and 9 <= len(re.sub(rb"[^0-9]", b"", number[0])) <= 15:
                base.append(("phone", first, number.end()))
        elif anchor == "scheme":
            if login := USER_INFO.match(raw, first):
                extra.append(("login", *login.span(1)))
        elif first == 0 or not chr(raw[first - 1]).isalnum():
            if (number := IBAN.match(raw, last + 1)) and iban_valid(number[1]):
                extra.append(("iban", *number.span(1)))
            elif number := IDENTIFIER.match(raw, last + 1):
                extra.append(("account", *number.span(1)))
    return ordered(base + not_inside(extra, base), KINDS)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row; positions count code points, ends are exclusive.

    A null text counts as empty and has no spans; repeated rows each give a row; an empty table
    gives none; other columns are not read. Spans of different kinds may overlap; of the spans that
    the method adds, those wholly inside a base span are left out.
    """
    rows = whole_texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def call(batch: list[dict]) -> list[tuple]:
        return [(r["doc_id"], [{"kind": k, "start": a, "end": b} for k, a, b in find(r["text"])]) for r in batch]

    return map_rows(rows, f"doc_id {kind}, spans {SPANS}", call)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return digest_columns(find_pii(documents(spark, sf_dir)), BASE)
