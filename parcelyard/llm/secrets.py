"""Secrets in texts, confirmed by their structure before they are reported (operator 11).

Two groups of findings. *Base* findings are plain patterns: an assignment to a telling name, an access key id, a long
run of hex digits. *Confirmed* findings are candidates in base64 or hex that are decoded and must then parse as what
they claim to be, down to nested lengths:

* ``rsa``, ``dsa``, ``ec``, ``pkcs8``, ``encrypted``: private keys in DER. Every length must fit into the one around it,
  and the parts must be those of the encoding (integers, object identifiers, octet strings, in that order).
* ``openssh``: magic, then length-prefixed strings, as many public keys as announced, a private part of whole blocks
  and, where it is not encrypted, its two equal check numbers.
* ``jwt``: header and claims are base64url of JSON objects, the header names a signature algorithm, and the signature has
  the size that this algorithm makes.

Base64 may be wrapped over lines (also with written ``\\n``), and may hold a PEM text in its turn. A key ends where its
outermost length says, so text that follows it does not belong to the span. Random digits, hashes and words in base64
letters don't parse and are not reported as confirmed; base findings stay whether they parse or not.

Each text is looked through on its own, whole, in one pass of its task; rows stay where they are and nothing is shuffled.
Positions count code points, ends are exclusive. Defined cases: NULL and empty texts have no spans; repeated rows and
rows with equal or NULL ids give a row each; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import binascii
import functools
import json
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelyard.llm.common import only

BASE = ("assign", "access", "hex")
CONFIRMED = ("rsa", "dsa", "ec", "pkcs8", "encrypted", "openssh", "jwt")
KINDS = BASE + CONFIRMED  # the order of spans that start together
SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"
# Patterns of the base findings. Runs are maximal, so a least length in the pattern equals a later check.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
LEAST_ASSIGNED = 12

# Candidates. Lines of wrapped base64 are joined by line ends, real or written. A token begins where its letters begin,
# so a run of letters is read once and not from each of its places.
BASE64 = r"[A-Za-z0-9+/_-]{24,}(?:(?:\r?\n|\\r\\n|\\n)[A-Za-z0-9+/_-]{4,})*"
HEX_KEY = r"[0-9A-Fa-f]{64,}"
TOKEN = r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]{16,}"
LINE_END = r"\r?\n|\\r\\n|\\n"

# Sizes in bytes of the signatures of signed tokens.
SIGNATURES = {
    "HS256": (32,), "HS384": (48,), "HS512": (64,), "ES256": (64,), "ES256K": (64,), "ES384": (96,), "ES512": (132,),
    "EdDSA": (64, 114), **{f"{kind}{bits}": tuple(range(128, 1025, 8)) for kind in ("RS", "PS") for bits in (256, 384, 512)},
}
# Tags of DER.
INTEGER, BITS, OCTETS, OBJECT, SEQUENCE, CONTEXT_0, CONTEXT_1 = 0x02, 0x03, 0x04, 0x06, 0x30, 0xA0, 0xA1
OPENSSH = b"openssh-key-v1\0"


class Malformed(ValueError):
    """The bytes are not what they would have to be."""


def element(data: bytes, at: int, end: int) -> tuple[int, int, int]:
    """Tag, start and end of the contents of the DER element at ``at``, which must end by ``end``."""
    if at + 2 > end:
        raise Malformed
    tag, size, at = data[at], data[at + 1], at + 2
    if size >= 0x80:
        digits = size & 0x7F
        if not 1 <= digits <= 4 or at + digits > end or data[at] == 0:
            raise Malformed
        size, at = int.from_bytes(data[at : at + digits], "big"), at + digits
        if size < 0x80:
            raise Malformed
    if at + size > end:
        raise Malformed
    return tag, at, at + size


def elements(data: bytes, at: int, end: int) -> list[tuple[int, int, int]]:
    """The elements that fill the bytes from ``at`` to ``end`` exactly."""
    found = []
    while at < end:
        found.append(element(data, at, end))
        at = found[-1][2]
    return found


def _algorithm(data: bytes, part: tuple[int, int, int]) -> bool:
    """Is the part a sequence that begins with an object identifier?"""
    if part[0] != SEQUENCE:
        return False
    inner = elements(data, part[1], part[2])
    return bool(inner) and inner[0][0] == OBJECT and inner[0][2] > inner[0][1]


def der_key(data: bytes) -> tuple[str, int]:
    """Kind and size of the private key in DER that ``data`` begins with."""
    tag, at, end = element(data, 0, len(data))
    if tag != SEQUENCE:
        raise Malformed
    parts = elements(data, at, end)
    tags = [p[0] for p in parts]
    if tags[:2] == [SEQUENCE, OCTETS] and len(tags) == 2 and _algorithm(data, parts[0]):
        if parts[1][2] - parts[1][1] < 16:
            raise Malformed
        return "encrypted", end
    if not tags or tags[0] != INTEGER or parts[0][2] - parts[0][1] != 1:
        raise Malformed
    version = data[parts[0][1]]
    numbers = all(t == INTEGER and p[2] > p[1] and data[p[1]] < 0x80 for t, p in zip(tags, parts))
    if numbers and len(tags) == 9 and version == 0:
        return "rsa", end
    if numbers and len(tags) == 6 and version == 0:
        return "dsa", end
    if tags[1:3] == [SEQUENCE, OCTETS] and version <= 1 and set(tags[3:]) <= {CONTEXT_0, CONTEXT_1, 0x81}:
        if _algorithm(data, parts[1]) and parts[2][2] - parts[2][1] >= 16:
            return "pkcs8", end
    if tags[1:2] == [OCTETS] and version == 1 and set(tags[2:]) <= {CONTEXT_0, CONTEXT_1}:
        for t, start, stop in parts[2:]:
            inner = elements(data, start, stop)
            if [x[0] for x in inner] != [OBJECT if t == CONTEXT_0 else BITS]:
                raise Malformed
        if 16 <= parts[1][2] - parts[1][1] <= 72:
            return "ec", end
    raise Malformed


def openssh_key(data: bytes) -> tuple[str, int]:
    """Kind and size of the private key file that ``data`` begins with."""
    if not data.startswith(OPENSSH):
        raise Malformed
    at = len(OPENSSH)

    def number() -> int:
        nonlocal at
        if at + 4 > len(data):
            raise Malformed
        at += 4
        return struct.unpack_from(">I", data, at - 4)[0]

    def string() -> bytes:
        nonlocal at
        size = number()
        if at + size > len(data):
            raise Malformed
        at += size
        return data[at - size : at]

    cipher, _, _ = string(), string(), string()
    keys = number()
    if not 1 <= keys <= 64:
        raise Malformed
    for _ in range(keys):
        public = string()
        if len(public) < 8 or struct.unpack_from(">I", public)[0] > len(public) - 4:
            raise Malformed
    private = string()
    if not private or len(private) % 8 or (cipher == b"none" and private[:4] != private[4:8]):
        raise Malformed
    return "openssh", at


def pem_key(data: bytes) -> tuple[str, int]:
    """Kind of the private key in a PEM text, and the size of that text up to its last line."""
    found = re.match(rb"-----BEGIN [A-Z ]*PRIVATE KEY-----\s+([A-Za-z0-9+/=\s]+)-----END [A-Z ]*PRIVATE KEY-----\s*", data)
    if not found:
        raise Malformed
    return key(decoded(b"".join(found[1].split()).decode()))[0], found.end()


def key(data: bytes) -> tuple[str, int]:
    """Kind and size of the key that ``data`` begins with."""
    if data[:1] == b"0":  # the tag of a sequence
        return der_key(data)
    if data[:1] == b"o":
        return openssh_key(data)
    if data[:1] == b"-":
        return pem_key(data)
    raise Malformed


def decoded(letters: str) -> bytes:
    """Bytes of base64 in either alphabet, without regard to padding."""
    letters = letters.rstrip("=").replace("-", "+").replace("_", "/")
    if len(letters) % 4 == 1:
        letters = letters[:-1]
    return base64.b64decode(letters + "=" * (-len(letters) % 4))


def signed_token(text: str) -> bool:
    """Do the three parts hold a header with an algorithm, claims, and a signature of that algorithm's size?"""
    header, claims, signature = text.split(".")
    try:
        header, claims = json.loads(decoded(header)), json.loads(decoded(claims))
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(claims, dict):
        return False
    algorithm = header.get("alg")
    return isinstance(algorithm, str) and len(decoded(signature)) in SIGNATURES.get(algorithm, ())


@functools.cache
def _patterns() -> dict[str, re.Pattern]:
    return {
        "assign": re.compile(ASSIGN, re.IGNORECASE | re.ASCII), "access": re.compile(ACCESS), "hex": re.compile(HEX),
        "base64": re.compile(BASE64), "hex key": re.compile(HEX_KEY), "token": re.compile(TOKEN), "line end": re.compile(LINE_END),
    }


def base_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Plain patterns, leftmost and without overlaps for each kind."""
    patterns = _patterns()
    for found in patterns["assign"].finditer(text):
        if found.end(2) - found.start(2) >= LEAST_ASSIGNED:
            yield "assign", found.start(), found.end()
    for kind in ("access", "hex"):
        for found in patterns[kind].finditer(text):
            yield kind, found.start(), found.end()


def confirmed_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """Candidates that parse."""
    patterns = _patterns()
    for found in patterns["base64"].finditer(text):
        start, end = found.span()
        breaks = [m.span() for m in patterns["line end"].finditer(text, start, end)]
        letters = patterns["line end"].sub("", found[0]) if breaks else found[0]
        try:
            kind, size = key(decoded(letters))
        except (Malformed, binascii.Error):
            continue
        last = start + -(-size * 4 // 3)
        for a, b in breaks:  # line ends before the last letter move it on
            if a >= last:
                break
            last += b - a
        padding = re.match("={0,2}", text[last : last + 2]).end()
        yield kind, start, last + padding
    for found in patterns["hex key"].finditer(text):
        digits = found[0]
        try:
            kind, size = key(bytes.fromhex(digits[: len(digits) // 2 * 2]))
        except Malformed:
            continue
        yield kind, found.start(), found.start() + 2 * size
    for found in patterns["token"].finditer(text):
        if signed_token(found[0]):
            yield "jwt", *found.span()


def spans_of(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text by start, then kind as listed, then end."""
    if not text:
        return []
    return sorted({*base_spans(text), *confirmed_spans(text)}, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end, value) of each row of ``docs``."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            found = [[{"kind": k, "start": a, "end": b, "value": t[a:b]} for k, a, b in spans_of(t)] for t in texts]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, kind)], ["doc_id", "spans"])

    rows = only(docs, "doc_id", "text")
    return rows.mapInArrow(scan, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def report(docs: DataFrame) -> DataFrame:
    """A row for each span: doc_id, kind, start, end, value."""
    return find_secrets(docs).select("doc_id", F.inline("spans"))


def _of(*kinds: str) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(*kinds))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digests(docs: DataFrame) -> DataFrame:
    """Per row: counts of base findings, a digest of their places, and all spans as text."""
    counts = [F.size(_of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE]
    return find_secrets(docs).select(
        "doc_id", *counts, F.sha2(_listed(_of(*BASE)), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
        F.size(_of(*CONFIRMED)).cast("long").alias("n_confirmed"),
    )
