"""Secret scan with structural confirmation.

Base kinds are patterns alone: ``assign`` (a key word set to a value; the span is the
whole match), ``access`` and ``hex``.  Confirmed kinds are candidates that decode and
parse:

* ``der``: base64 or hex that decodes to one DER element, all nested lengths of which
  fill their parents exactly, in the shape of a key: PKCS#1, PKCS#8, SEC1 EC or a public
  key (SubjectPublicKeyInfo), or an encrypted PKCS#8 key; base64 lines between PEM marks count as
  one candidate, and base64 of PEM text (as in cluster secrets) is decoded twice at most;
* ``ssh``: base64 that decodes to OpenSSH key data, its length-prefixed fields filling
  it exactly (``openssh-key-v1``) or starting with its own algorithm name;
* ``jwt``: three base64url parts, the first a JSON object with a string ``alg``,
  the second a JSON object; or five, the first a JSON object with ``alg`` and ``enc``.

A candidate that does not parse is not reported; base64 broken over lines without PEM marks is
not joined.  Every pattern is linear in the text.  Spans are in code points, end exclusive.

Scale: one pass over whole texts, no shuffle; a batch is bounded in bytes.  Cheap
substring tests go before each pattern.

Defined results: a null text is empty; without spans the digest is that of the empty
string; within a kind spans are leftmost and do not overlap, across kinds they
may; equal starts go in the order of ``KINDS``; rows that share a doc_id are scanned
each for itself; a null doc_id is kept; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, map_batches

KINDS = ["assign", "access", "hex", "der", "ssh", "jwt"]
BASE = KINDS[:3]

_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ASSIGN_SIGN = re.compile(r"(?ai:passw|secret|token|api_?key)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs of 24 and more are the runs that `[0-9a-f]+` finds and that are long enough.
_HEX = re.compile(r"[0-9a-f]{24,}")
_HEX_ANY = re.compile(r"[0-9A-Fa-f]{32,}")
_PEM_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----")
# Lines end in white space or, in JSON and .env files, in an escaped line feed.
_BREAKS = re.compile(r"(?:\s++|\\++[nr])*+")
_PEM_BODY = re.compile(r"(?:[A-Za-z0-9+/=\s]++|\\++[nr])++")
# What DER, OpenSSH data and PEM text ("-----BEGIN ") start with.
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M[A-Za-z0-9+/_-]{23,}|AAAA[A-Za-z0-9+/_-]{20,}|b3BlbnNzaC1rZXktdjE[A-Za-z0-9+/_-]{20,}"
                     r"|LS0tLS1CRUdJTi[A-Za-z0-9+/_-]{20,})={0,2}")
# Base64url of "{" and any byte is "e" and one of the last 16 signs.
_JWT = re.compile(r"(?<![A-Za-z0-9_-])e[w-z0-9_-][A-Za-z0-9_-]{8,}\.e[w-z0-9_-][A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
_JWT_SIGN = re.compile(r"\.e[w-z0-9_-][A-Za-z0-9_-]{2,}\.")
# An encrypted token: header, wrapped key (may be empty), nonce, text, tag.
_JWE = re.compile(r"(?<![A-Za-z0-9_-])e[w-z0-9_-][A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]*+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]{16,}+")

_OIDS = {
    bytes.fromhex("2a864886f70d010101"),  # rsaEncryption
    bytes.fromhex("2a8648ce3d0201"),  # id-ecPublicKey
    bytes.fromhex("2a8648ce380401"),  # id-dsa
    bytes.fromhex("2b656e"), bytes.fromhex("2b656f"), bytes.fromhex("2b6570"), bytes.fromhex("2b6571"),  # X25519 .. Ed448
    bytes.fromhex("2a864886f70d010301"),  # dhKeyAgreement
}


#: Password-based encryption of a PKCS#8 key.
_PBE = {bytes.fromhex("2a864886f70d01050d")} | {bytes.fromhex("2a864886f70d0105") + bytes([k]) for k in (1, 3, 4, 6, 10, 11)}
#: How often base64 around PEM text is taken off.
LAYERS = 2


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """(tag, start of value, end of value) of the DER element at ``at``."""
    if end - at < 2:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or end - at < n or data[at] == 0:
            return None
        size, at = int.from_bytes(data[at:at + n], "big"), at + n
        if size < 0x80:
            return None
    return (tag, at, at + size) if size <= end - at else None


def _parts(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``data[at:end]`` exactly."""
    found = []
    while at < end:
        e = _element(data, at, end)
        if e is None:
            return None
        found.append(e)
        at = e[2]
    return found


def _algorithm(data: bytes, e: tuple[int, int, int], known: set[bytes] = _OIDS) -> bool:
    inner = _parts(data, e[1], e[2]) if e[0] == 0x30 else None
    return bool(inner) and inner[0][0] == 0x06 and data[inner[0][1]:inner[0][2]] in known


def is_der_key(data: bytes) -> bool:
    """Whether ``data`` is one DER element in the shape of a key."""
    top = _parts(data, 0, len(data))
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    parts = _parts(data, top[0][1], top[0][2])
    if not parts or len(parts) < 2:
        return False
    tags = [p[0] for p in parts]
    if tags == [0x30, 0x04]:  # encrypted PKCS#8: algorithm, octets
        return _algorithm(data, parts[0], _PBE) and parts[1][2] - parts[1][1] >= 16
    if tags[0] == 0x30:  # public key: algorithm, bit string
        return len(parts) == 2 and tags[1] == 0x03 and _algorithm(data, parts[0]) and data[parts[1][1]:parts[1][2]][:1] == b"\0"
    if tags[0] != 0x02:
        return False
    version = data[parts[0][1]:parts[0][2]]
    if len(version) > 1:  # public PKCS#1: modulus, exponent
        return tags == [0x02, 0x02] and len(version) >= 32 and 1 <= parts[1][2] - parts[1][1] <= 8
    if tags[1] == 0x30:  # PKCS#8: version, algorithm, key [, attributes]
        return len(parts) >= 3 and tags[2] == 0x04 and _algorithm(data, parts[1])
    if tags[1] == 0x04:  # SEC1: version 1, key [, curve, public key]
        return version == b"\x01" and all(t in (0xA0, 0xA1) for t in tags[2:]) and parts[1][2] - parts[1][1] >= 16
    # PKCS#1: version and eight integers (or DSA: five)
    return all(t == 0x02 for t in tags) and len(parts) in (6, 9) and parts[1][2] - parts[1][1] >= 32


def _fields(data: bytes, at: int) -> list[bytes] | None:
    """Length-prefixed fields that fill the rest of ``data`` exactly."""
    found = []
    while at < len(data):
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data) or len(data) - at < 4:
            return None
        found.append(data[at + 4:at + 4 + size])
        at += 4 + size
    return found


def is_ssh_key(data: bytes) -> bool:
    """Whether ``data`` is an OpenSSH private key file's or public key's body."""
    magic = b"openssh-key-v1\0"
    if data.startswith(magic):
        at, cipher = len(magic), []
        for _ in range(3):  # cipher, kdf, kdf options
            size = int.from_bytes(data[at:at + 4], "big")
            if at + 4 + size > len(data):
                return False
            cipher.append(data[at + 4:at + 4 + size])
            at += 4 + size
        keys = int.from_bytes(data[at:at + 4], "big")
        rest = _fields(data, at + 4)
        return bool(cipher[0]) and keys >= 1 and rest is not None and len(rest) == keys + 1
    fields = _fields(data, 0)
    return bool(fields) and len(fields) >= 2 and re.fullmatch(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]{3,60}", fields[0]) is not None


def _decode(text: str) -> bytes | None:
    text = re.sub(r"\s|\\+[nr]", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _object(part: str) -> dict | None:
    try:
        found = json.loads(_decode(part) or b"")
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def _is_token(text: str) -> bool:
    head, body = text.split(".")[:2]
    head = _object(head)
    return head is not None and isinstance(head.get("alg"), str) and _object(body) is not None


def _is_encrypted_token(text: str) -> bool:
    head = _object(text.split(".")[0])
    return head is not None and isinstance(head.get("alg"), str) and isinstance(head.get("enc"), str)


def _key_kind(data: bytes | None) -> str | None:
    return None if not data else "der" if is_der_key(data) else "ssh" if is_ssh_key(data) else None


def pem_bodies(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the base64 lines between matching PEM marks.

    A body holds no hyphen, so it ends at the next one: its characters are read once, and the
    bodies of different marks do not overlap."""
    for m in _PEM_BEGIN.finditer(text):
        end = text.find("-", m.end())
        start = _BREAKS.match(text, m.end()).end()
        if end < 0 or not m.end() < start < end or not text.startswith(f"-----END {m[1]}-----", end):
            continue
        if _PEM_BODY.fullmatch(text, start, end) is None:
            continue
        while True:  # line breaks at the end
            shorter = len(text[start:end].rstrip()) + start
            if text[shorter - 2:shorter] in ("\\n", "\\r"):
                shorter -= 1
                while text[shorter - 1] == "\\":
                    shorter -= 1
            if shorter == end:
                break
            end = shorter
        yield start, end


def confirmed_spans(text: str, layers: int = LAYERS) -> list[tuple[str, int, int]]:
    """Spans of the confirmed kinds.  Base64 around PEM text is taken off up to ``layers`` times; the
    span is then that of the outer base64."""
    found, taken = [], []
    if "-----BEGIN " in text:
        for a, b in pem_bodies(text):
            kind = _key_kind(_decode(text[a:b]))
            if kind:
                found.append((kind, a, b))
                taken.append((a, b))
    k = 0
    for m in _BASE64.finditer(text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k < len(taken) and taken[k][0] < m.end():
            continue
        data = _decode(m[0])
        kind = _key_kind(data)
        if kind is None and layers and data and data.startswith(b"-----BEGIN "):
            kind = next((x for x, _, _ in confirmed_spans(data.decode("utf-8", "replace"), layers - 1) if x != "jwt"), None)
        if kind:
            found.append((kind, *m.span()))
    for m in _HEX_ANY.finditer(text):
        if m[0][:2] == "30" and len(m[0]) % 2 == 0 and is_der_key(bytes.fromhex(m[0])):
            found.append(("der", *m.span()))
    if _JWT_SIGN.search(text):
        found += [("jwt", *m.span()) for m in _JWT.finditer(text) if _is_token(m[0])]
    if text.count(".") >= 4:
        found += [("jwt", *m.span()) for m in _JWE.finditer(text) if _is_encrypted_token(m[0])]
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base kinds."""
    found = []
    if _ASSIGN_SIGN.search(text):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_confirmed of every document."""
    bounded_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, spans, more = [], [], [], []
        for text in batch.column(1).to_pylist():
            base = base_spans(text or "")
            extra = confirmed_spans(text or "")
            kinds = [k for k, _, _ in base]
            counts.append([kinds.count(k) for k in BASE])
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans.append(joined(base + extra))
            more.append(len(extra))
        return pa.record_batch([batch.column(0), *(pa.array([c[k] for c in counts], pa.int64()) for k in range(3)),
                                pa.array(digests), pa.array(spans), pa.array(more, pa.int64())],
                               names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_confirmed"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                       "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                       "spans string, n_confirmed long")
