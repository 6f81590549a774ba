"""Secrets against slow readings of the definitions, and keys built byte by byte."""

import base64
import hashlib
import json
import random
import re
import struct

import pytest

from parcelyard.llm import queries, secrets
from parcelyard.llm.common import table


def brute_base(text):
    """The definition: patterns without least lengths, matches that fail are dropped."""
    found = []
    for kind, pattern, flags, good in (
        ("assign", secrets.ASSIGN, re.I | re.A, lambda m: len(m[2]) >= 12),
        ("access", "AKIA[A-Z0-9]+", 0, lambda m: len(m[0]) >= 18),
        ("hex", "[0-9a-f]+", 0, lambda m: len(m[0]) >= 16),
    ):
        at = 0
        while m := re.compile(pattern, flags).search(text, at):
            at = m.end()
            if good(m):
                found.append((m.start(), secrets.KINDS.index(kind), kind, m.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        want = brute_base(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        counts = [sum(w.startswith(f"{k}:") for w in want) for k in secrets.BASE]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == counts
        listed = r["spans"].split(",") if r["spans"] else []
        assert [s for s in listed if s.split(":")[0] in secrets.BASE] == want
        assert len(listed) - len(want) == r["n_confirmed"]


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_op11_matches_brute_force(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    check(queries.op11_structural_secrets(spark, sf_dir).collect(), texts)


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else b"\x82" + struct.pack(">H", len(body)) if len(body) > 255 else bytes([0x81, len(body)])
    return bytes([tag]) + size + body


def integer(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


rng = random.Random(11)
RSA = der(0x30, integer(0), *[integer(rng.getrandbits(512)) for _ in range(8)])
DSA = der(0x30, integer(0), *[integer(rng.getrandbits(300)) for _ in range(5)])
EC = der(0x30, integer(1), der(4, rng.randbytes(32)), der(0xA0, der(6, bytes.fromhex("2a8648ce3d030107"))), der(0xA1, der(3, b"\0" + rng.randbytes(64))))
EDWARDS = der(0x30, integer(0), der(0x30, der(6, bytes.fromhex("2b6570"))), der(4, der(4, rng.randbytes(32))))
ENCRYPTED = der(0x30, der(0x30, der(6, bytes.fromhex("2a864886f70d01050d")), der(0x30)), der(4, rng.randbytes(128)))


def ssh(data):
    return struct.pack(">I", len(data)) + data


PUBLIC = ssh(b"ssh-ed25519") + ssh(rng.randbytes(32))
OPENSSH = secrets.OPENSSH + ssh(b"none") + ssh(b"none") + ssh(b"") + struct.pack(">I", 1) + ssh(PUBLIC) + ssh(b"abcdabcd" + rng.randbytes(120))


def url64(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def token(algorithm="HS256", size=32, claims=None):
    header = json.dumps({"alg": algorithm, "typ": "JWT"}).encode()
    return ".".join((url64(header), url64(json.dumps(claims or {"sub": "1"}).encode()), url64(b"\x01" * size)))


def confirmed(text):
    return [s for s in secrets.spans_of(text) if s[0] in secrets.CONFIRMED]


@pytest.mark.parametrize("kind, data", [("rsa", RSA), ("dsa", DSA), ("ec", EC), ("pkcs8", EDWARDS), ("encrypted", ENCRYPTED), ("openssh", OPENSSH)])
def test_keys_in_every_coding(kind, data):
    flat = base64.b64encode(data).decode()
    lines = [flat[k : k + 64] for k in range(0, len(flat), 64)]
    pem = "-----BEGIN PRIVATE KEY-----\n" + "\n".join(lines) + "\n-----END PRIVATE KEY-----\n"
    for coded in (flat, "\n".join(lines), "\r\n".join(lines), "\\n".join(lines), data.hex(), data.hex().upper(),
                  base64.b64encode(pem.encode()).decode()):
        for before, after in (("", ""), ("é key: ", " end"), ("x=\n", "\n")):
            text = before + coded + after
            assert confirmed(text) == [(kind, len(before), len(before) + len(coded))], text
    assert [s[0] for s in confirmed(pem)] == [kind]
    for broken in (data[:-1], data[:1] + bytes([data[1] ^ 1]) + data[2:], rng.randbytes(len(data))):
        assert confirmed("a " + base64.b64encode(broken).decode() + " b") == []
    # What follows on the next line belongs to the candidate, not to the key.
    if len(data) % 3 == 0:
        assert confirmed(flat + "\nWords and so on") == [(kind, 0, len(flat))]


def test_tokens():
    good = token()
    assert confirmed(f"bearer {good}, then") == [("jwt", 7, 7 + len(good))]
    assert [s[0] for s in confirmed(token("RS256", 256) + " " + token("ES512", 132))] == ["jwt", "jwt"]
    bad = [token(size=31), token("none"), token("ZZ"), "aaaaaaaa.bbbbbbbb.cccccccccccccccc", good.replace(".", ".AA", 1), "[" * 10_000]
    deep = ".".join((url64(b"[" * 200_000), url64(b"{}"), "a" * 43))
    assert confirmed(" ".join([*bad, deep])) == []


def test_hard_rows(spark, documents, hard):
    flat = base64.b64encode(RSA).decode()
    rows = [
        (1, f'Password = "{"x" * 12}" {flat}'), (2, "token: secret=abcdefghijklmnop"), (3, "API_KEY:'" + "a" * 11), (4, "apikey" * 3 + "=" * 20),
        (5, "AKIA" + "A" * 13 + " AKIA" + "A" * 14), (6, "AKIAAKIA" * 9), (7, "0123456789abcdef" + "G" + "0" * 15), (8, "ſecret=" + "a" * 12),
        (9, "\U0001f600 token=" + "K" * 20 + " passwd=" + "=" * 12), (10, None), (11, ""), (12, ("secret = " + "ab" * 9 + "\n") * 20_000), (13, "a" * 300_000),
    ]
    docs = documents(rows, extra="1 as spans").withColumn("kind", secrets.F.lit(1)).withColumn("n_hex", secrets.F.lit(1))
    got = secrets.secret_digests(docs).collect()
    check(got, dict(rows))
    assert got[0]["spans"] == f"assign:0:24,rsa:{26}:{26 + len(flat)}"
    twice = secrets.secret_digests(docs.union(docs)).collect()
    assert sorted(twice) == sorted(got + got)
    assert secrets.secret_digests(hard).count() == hard.count()
    assert secrets.secret_digests(docs.limit(0)).collect() == []
    values = {(r["doc_id"], r["kind"]): r["value"] for r in secrets.report(docs).collect()}
    assert values[1, "rsa"] == flat and values[9, "assign"] == "passwd=" + "=" * 12
