"""Secret scans whose candidates are decoded and parsed before they are reported.

Plain patterns (assignments, access ids, long hex runs) are kept as they are. Encoded candidates, in base64, base64url
or hex, count only if what they hold is built like a key: nested lengths that add up (DER), the fields of a private
OpenSSH key, or the header and claims of a signed token.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

ship(__name__)

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

#: All kinds, in the order in which spans with the same start are listed; the first three are the base.
KINDS = ("assign", "access", "hex", "der", "openssh", "jwt")

LONG_RUN = re.compile(r"[A-Za-z0-9+/_-]{32}")
# Base64 of a DER sequence, of OpenSSH's magic word or of a PEM text, also after an escape; lines of any width may be parted by blanks, line
# ends and their escapes.
KEY_START = re.compile(r"M[A-P][A-Za-z0-9+/_-]{2}|b3BlbnNz|LS0tLS1C")
ESCAPES = ("\\n", "\\r", "\\t")
LINE = re.compile(r"([A-Za-z0-9+/_-]+)(?:[ \t\r\n]|\\+[nrt])*")
PEM_END = re.compile(r"-----END [A-Z0-9 ]{1,40}-----\r?\n?")
#: Characters of base64 that the shortest key takes, and those that a PEM text starts with.
KEY_LEAST, PEM_START = 40, "LS0tLS1C"
HEX_BYTES = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{2}){24,}(?![0-9A-Za-z])|(?<![0-9A-Za-z])(?:[0-9A-F]{2}){24,}(?![0-9A-Za-z])")
HEX_PAIRS = re.compile(r"(?<![0-9A-Za-z:])30(?::\s{0,80}[0-9A-Fa-f]{2}){23,}(?![0-9A-Za-z])")
# The dot before the claims of a token, and the part after them.
CLAIMS = re.compile(r"\.(?=([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*))")
URL_DIGITS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")
DIGITS = URL_DIGITS | {"+", "/"}


def der_items(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the values that fill ``data[start:end]`` exactly, or None."""
    items = []
    while start < end:
        if end - start < 2:
            return None
        tag, length, start = data[start], data[start + 1], start + 2
        if length == 0x80:
            return None
        if length > 0x80:
            count = length & 0x7F
            if count > 4 or start + count > end:
                return None
            length, start = int.from_bytes(data[start : start + count], "big"), start + count
        if start + length > end:
            return None
        items.append((tag, start, start + length))
        start += length
    return items


def is_der_key(data: bytes) -> bool:
    """Whether the bytes are one DER sequence with the fields of a private key: PKCS#1, DSA, SEC 1, PKCS#8, encrypted PKCS#8."""
    outer = der_items(data, 0, len(data)) if data[:1] == b"\x30" else None
    if not outer or len(outer) != 1:
        return False
    fields = der_items(data, outer[0][1], outer[0][2])
    if not fields or len(fields) < 2:
        return False
    tags = [tag for tag, _, _ in fields]

    def names_algorithm(field: tuple[int, int, int]) -> bool:
        inside = der_items(data, field[1], field[2])
        return bool(inside) and inside[0][0] == 0x06 and inside[0][2] > inside[0][1]

    if tags[0] == 0x02:
        version = data[fields[0][1] : fields[0][2]]
        if version not in (b"\x00", b"\x01"):
            return False
        if len(tags) in (6, 9) and set(tags) == {0x02}:
            return fields[1][2] - fields[1][1] >= 32
        if len(tags) >= 3 and tags[1] == 0x30 and tags[2] == 0x04:
            return names_algorithm(fields[1])
        return tags[1] == 0x04 and fields[1][2] - fields[1][1] >= 16 and all(t in (0xA0, 0xA1) for t in tags[2:])
    return tags == [0x30, 0x04] and names_algorithm(fields[0])


def openssh_size(read: Callable[[int, int], bytes]) -> int | None:
    """Length of a private OpenSSH key by its fields: its magic word, then fields with their lengths; ``read`` gives bytes from one place to another."""
    magic = b"openssh-key-v1\x00"
    if read(0, len(magic)) != magic:
        return None

    def number(at: int | None) -> int | None:
        found = b"" if at is None else read(at, at + 4)
        return int.from_bytes(found, "big") if len(found) == 4 else None

    def field(at: int | None) -> int | None:
        size = number(at)
        return None if size is None else at + 4 + size

    at = field(field(field(len(magic))))  # cipher, key derivation, its options
    keys = number(at)
    if keys is None or not 1 <= keys <= 64:
        return None
    at += 4
    for _ in range(keys + 1):  # public keys, then the private part
        at = field(at)
    return at


def is_openssh_key(data: bytes) -> bool:
    """Whether the bytes are a private OpenSSH key, whose fields add up to the end."""
    return openssh_size(lambda a, b: data[a:b]) == len(data)


class _Run:
    """Lines of base64 characters from a place on, parted by nothing but blanks, line ends and their escapes, and what they hold."""

    def __init__(self, text: str, start: int):
        lines, self.places, self.before, at = [], [], [0], start
        while line := LINE.match(text, at):
            lines.append(line[1])
            self.places.append(line.span(1))
            self.before.append(self.before[-1] + len(line[1]))
            at = line.end()
        self.plain, self.starts = "".join(lines).translate(str.maketrans("-_", "+/")), [a for a, _ in self.places]
        self.end = self.places[-1][1]

    def offset(self, place: int) -> int:
        """Number of the run's character that stands at a place of the text."""
        k = bisect_right(self.starts, place) - 1
        return self.before[k] + place - self.starts[k]

    def bytes(self, offset: int, start: int, end: int) -> bytes:
        """Bytes ``start`` to ``end`` of what is encoded from a character on; fewer at the end of the run."""
        low = start // 3
        some = self.plain[offset + 4 * low : offset + 4 * -(-end // 3)]
        some = some[: len(some) - (len(some) % 4 == 1)]
        return base64.b64decode(some + "=" * (-len(some) % 4))[start - 3 * low : end - 3 * low]

    def key(self, offset: int) -> tuple[str, int] | None:
        """Kind of the key that is encoded from a character on and the place where its last line ends, which must end with it."""
        head = self.bytes(offset, 0, 16)
        if len(head) < 16:
            return None
        if head.startswith(b"-----B"):
            return self.nested(offset)
        if head[0] == 0x30:
            count = head[1] & 0x7F if head[1] > 0x80 else 0
            size = 2 + count + (int.from_bytes(head[2 : 2 + count], "big") if count else head[1])
            kind, confirmed = "der", is_der_key
        else:
            size = openssh_size(lambda a, b: self.bytes(offset, a, b))
            kind, confirmed = "openssh", is_openssh_key
        # The last character that is needed must be the last of its line; lines below it are not of the key.
        last = offset + -(-size * 4 // 3) if size else 0
        k = bisect_left(self.before, last)
        if not size or k == len(self.before) or self.before[k] != last or not confirmed(self.bytes(offset, 0, size)):
            return None
        return kind, self.places[k - 1][1]


    def nested(self, offset: int) -> tuple[str, int] | None:
        """Kind and end of a PEM text that is encoded as a whole and holds a key; it ends with its last line."""
        text = self.bytes(offset, 0, (self.before[-1] - offset) * 3 // 4).decode("latin-1")
        end = PEM_END.search(text)
        inside = find_keys(text[: end.end()], False) if end else []
        if not inside:
            return None
        last = offset + -(-end.end() * 4 // 3)
        k = bisect_left(self.before, last)
        return inside[0][0], self.places[k - 1][0] + last - self.before[k - 1]


def find_keys(text: str, nested: bool = True) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the keys in base64, padding included; with ``nested``, also of PEM texts encoded once more."""
    spans, run, at = [], None, 0
    while found := KEY_START.search(text, at):
        start = found.start()
        if start and text[start - 1] in DIGITS and text[max(start - 2, 0) : start] not in ESCAPES:
            at = start + 1
            continue
        if run is None or start >= run.end:
            run = _Run(text, start)
        offset = run.offset(start)
        worth = run.before[-1] - offset >= KEY_LEAST and (nested or found[0] != PEM_START)
        key = run.key(offset) if worth else None
        at = start + 1
        if key:
            at = key[1] + next(k for k in (2, 1, 0) if text.startswith("=" * k, key[1]))
            spans.append((key[0], start, at))
    return spans


def unbase64(run: str) -> bytes | None:
    plain = re.sub(r"[\r\n=]", "", run).translate(str.maketrans("-_", "+/"))
    if len(plain) % 4 == 1:
        return None
    try:
        return base64.b64decode(plain + "=" * (-len(plain) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(header: str, claims: str, signature: str) -> bool:
    """Whether header and claims are JSON objects and the header names an algorithm; without one, no signature follows."""
    start = unbase64(header[:16]) if len(header) >= 10 else None
    if start is None or not start.lstrip().startswith(b"{"):
        return False
    try:
        head, body = json.loads(unbase64(header) or b""), json.loads(unbase64(claims) or b"")
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(body, dict) or not isinstance(head.get("alg"), str):
        return False
    return signature == "" if head["alg"].lower() == "none" else len(signature) >= 16 and unbase64(signature) is not None


def find_tokens(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of signed tokens: any three dotted parts whose first decodes to a header, whatever stands before."""
    spans, least = [], 0
    for found in CLAIMS.finditer(text):
        start = found.start()
        while start > least and text[start - 1] in URL_DIGITS:
            start -= 1
        if is_signed_token(text[start : found.start()], found[1], found[2]):
            spans.append(("jwt", start, found.end(2)))
        least = spans[-1][2] if spans else 0
    return spans


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points of all findings, by start and kind."""
    spans = []
    lower = text.lower()
    if any(word in lower for word in KEYWORDS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    # A run of digits and letters that long holds every candidate in hex.
    if LONG_RUN.search(text):
        spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
        spans += [("der", m.start(), m.end()) for m in HEX_BYTES.finditer(text) if m[0][:2] == "30" and is_der_key(bytes.fromhex(m[0]))]
    if "30:" in text:
        spans += [("der", m.start(), m.end()) for m in HEX_PAIRS.finditer(text) if is_der_key(bytes.fromhex(re.sub(r"[:\s]", "", m[0])))]
    spans += find_keys(text)
    spans += find_tokens(text)
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redacted(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """The text with each run of overlapping spans replaced by the mark."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan_column(text: Column) -> Column:
    """Spans of a text, an array of (kind, start, end); empty for null."""

    @F.pandas_udf("array<struct<kind:string,start:long,end:long>>")
    def scan(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t or "")] for t in texts], dtype=object)

    return scan.asNondeterministic()(text)


def scan_secrets(docs: DataFrame, carried: list[str], text: str = "text") -> DataFrame:
    """The ``carried`` columns and ``spans`` of every row, in one pass; texts do not leave their partition.

    A null or empty text has no spans, repeated rows are scanned each, an empty table gives an empty one.
    """
    return docs.select(*carried, scan_column(F.col(text)).alias("spans"))


def redact_secrets(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The table with every finding in ``text`` replaced by ``mark``; texts without one, and nulls, stay as they are."""
    schema = docs.schema

    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([t if t is None or not (s := find_spans(t)) else redacted(t, s, mark) for t in texts], dtype=object)

    # Marked so that a plan which uses the result twice does not work it out twice.
    replace = F.pandas_udf(clean, "string").asNondeterministic()
    return docs.withColumn(text, replace(F.col(text))).select(*schema.names)
