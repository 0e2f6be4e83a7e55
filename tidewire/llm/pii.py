"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds at-signs, plus signs, digits, schemes and identifier cues. At each anchor a
parser for that kind expands to both sides and validates what it has: emails around at-signs, IP addresses and card
numbers from digits, phone numbers from plus signs, account numbers (IBAN with check digits, or a cue with a number),
web addresses that carry a user name and password, secrets (a cue such as "token", an assignment sign and a value of
mixed characters, or a key with a known beginning) and IPv6 addresses around colons.

Kinds ``email ip card phone`` are found leftmost first and do not overlap within their kind; candidates that fail their
test are dropped without another try inside them. ``account``, ``address``, ``secret`` and ``ipv6`` come in addition. Offsets are code points,
ends exclusive. Null and empty texts have no spans. Texts are read whole.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("account", "address", "secret", "ipv6")
KINDS = (*BASE, *ADDED)

# Anchors by what they may start.
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://")
CUES = ("iban", "account no", "account number", "acct", "kontonummer", "ssn", "social security number")
SECRET_CUES = (
    "token", "api key", "api_key", "api-key", "apikey", "secret", "secret key", "secret_key", "access key", "access_key",
    "auth key", "auth_key", "password", "passwd", "pwd",
)
KEY_STARTS = ("akia", "ghp_", "gho_", "ghs_", "-----begin ")
DIGITS = "0123456789"

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
RUN = re.compile(r"[0-9]+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
NUMBER = re.compile(r"[0-9](?:[ -]?[0-9]){7,17}(?![0-9])")
AFTER_CUE = re.compile(r"(?: ?(?:is|no|number|nr|[.:#=]))*[ .:#=]*", re.IGNORECASE)
LOGIN = re.compile(r"[^\s/@:<>\"']+:[^\s/@<>\"']+@[A-Za-z0-9.-]+(?::[0-9]+)?")


ASSIGNED = re.compile(r"[\"']?[ \t]*(?:=>|:=|=|:)[ \t]*[\"']?")
VALUE = re.compile(r"[A-Za-z0-9_./+=~!@#$%^&*-]{8,}")
KEY = re.compile(r"(?:AKIA[0-9A-Z]{16}|gh[pos]_[A-Za-z0-9]{36})(?![A-Za-z0-9])|-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----")
HEX = frozenset("0123456789abcdefABCDEF:")


def mixed(value: str) -> bool:
    """Letters and digits, and enough different characters that no word or number looks like it."""
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and len(set(value)) >= 6


def ipv6_valid(text: str) -> bool:
    """Three groups or more, one of them with a digit, in a form that the address parser takes."""
    groups = [g for g in text.split(":") if g]
    if len(groups) < 3 or len(text) > 39 or not any(c.isdigit() for c in text):
        return False
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return True


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def ssn_valid(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"


def octet(part: str) -> bool:
    """Whether digits stand for at most 255; of any length, where int() would stop at 4,300 digits."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def only_digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for word, kind in [
        ("@", "@"), ("+", "+"), *((d, "0") for d in DIGITS), *((s, "scheme") for s in SCHEMES), *((c, "cue") for c in CUES),
        *((c, "secret") for c in SECRET_CUES), *((k, "key") for k in KEY_STARTS), (":", ":"),
    ]:
        automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All (kind, start, end), by start, then by kind as listed."""
    spans: set[tuple[str, int, int]] = set()
    email_end = ip_end = card_end = phone_end = hex_end = 0
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # A-Z only: same offsets
    for last, (kind, length) in anchors().iter(lowered):
        at = last - length + 1
        if kind == "0":
            # A run of digits is tried at its first digit that no earlier match took.
            if at >= card_end and (m := CARD.match(text, at)):
                card_end = m.end()
                digits = only_digits(m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    spans.add(("card", at, card_end))
            if at >= ip_end:
                if m := IP.match(text, at):
                    ip_end = m.end()
                    if all(octet(part) for part in m.group().split(".")):
                        spans.add(("ip", at, ip_end))
                else:  # nor does it match from a later digit of the run
                    ip_end = RUN.match(text, at).end()
        elif kind == "@":
            start = at
            while start > email_end and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                email_end = m.end()
                spans.add(("email", start, email_end))
        elif kind == "+":
            if at >= phone_end and (m := PHONE.match(text, at)):
                phone_end = m.end()
                if 10 <= len(only_digits(m.group())) <= 15:
                    spans.add(("phone", at, phone_end))
        elif kind == ":":
            if at >= hex_end:
                start, end = at, at + 1
                while start > hex_end and text[start - 1] in HEX:
                    start -= 1
                while end < len(text) and text[end] in HEX:
                    end += 1
                hex_end = end
                inner = text[start - 1 : start].isalnum() or text[end : end + 1].isalnum()  # part of a longer word
                if not inner and ipv6_valid(text[start:end]):
                    spans.add(("ipv6", start, end))
        elif kind == "secret":
            begun = not text[at - 1 : at].isalnum() or at == 0
            if begun and (m := ASSIGNED.match(text, last + 1)) and (v := VALUE.match(text, m.end())) and mixed(v.group()):
                spans.add(("secret", v.start(), v.end()))
        elif kind == "key":
            if (m := KEY.match(text, at)) and not text[at - 1 : at].isalnum():
                spans.add(("secret", at, m.end()))
        elif kind == "scheme":
            if m := LOGIN.match(text, last + 1):
                spans.add(("address", at, m.end()))
        else:
            begin = AFTER_CUE.match(text, last + 1).end()
            for form, valid in ((IBAN, iban_valid), (SSN, ssn_valid), (NUMBER, lambda _: True)):
                if m := form.match(text, begin):  # the first form that fits decides
                    if valid(m.group()):
                        spans.add(("account", begin, m.end()))
                    break
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def personal_data(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans): array of struct(kind, start, end) per row."""
    key_type = docs.schema[key].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [dict(zip(("kind", "start", "end"), s, strict=True)) for s in find_spans(t.as_py() or "")]
                for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(span))], names=[key, "spans"])

    return docs.select(key, F.col(text).alias("text")).mapInArrow(
        find, f"{key} {key_type}, spans array<struct<kind: string, start: int, end: int>>"
    )


def span_report(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts per base kind, a hash of the base spans, all spans as text, and counts of the added kinds and of all."""
    found = personal_data(docs, key=key, text=text)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text_of = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    ), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        key, *[count(kind) for kind in BASE], F.sha2(text_of(base).cast("binary"), 256).alias("base_sha256"),
        text_of(F.col("spans")).alias("spans"), *[count(kind) for kind in ADDED], F.size("spans").cast("long").alias("n_spans"),
    )
