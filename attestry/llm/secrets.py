"""Secret scans with structural confirmation.

Base kinds are exact patterns: assignments to secret-like names, access key ids, and long
hexadecimal runs; matches are leftmost and do not overlap within a kind, and those that fail
their length are dropped.

The method adds spans that a pattern alone would not justify. A base64 or hexadecimal
candidate is decoded and reported only if its structure holds (kind ``key``): the DER encoding
of a private key, with its version, algorithm and key fields (PKCS #8 plain or encrypted, RSA,
DSA, elliptic curves), or an OpenSSH private key with its magic and length-prefixed fields.
Public keys and certificates have other fields and are not reported. A bare candidate is any
base64 or hexadecimal run that begins like one of these; the length that it states says how
far it goes, over line breaks too, up to 64 KB (``MOST``); it is decoded whole only if the heads
of its parts fill that length, so a text of nothing but candidates takes time in proportion. A PEM block with encryption headers must name a cipher and
hold whole cipher blocks. A dotted token (``token``) must have a header that is a JSON object
with a signing algorithm and a payload that is a JSON object.

Defined cases: a null text counts as empty; spans count code points, the end is exclusive;
spans of two kinds may overlap, those of equal start are ordered by kind; rows that repeat get
equal spans, each for itself; texts of any length are taken whole; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import functools
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("assign", "access", "hex")
ADDED_KINDS = ("key", "token")
KINDS = BASE_KINDS + ADDED_KINDS

# patterns of the base kinds (fixed values)
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# a run of 32 or more; runs are maximal, so shorter ones need not be looked at
_HEX = re.compile(r"[0-9a-f]{32}[0-9a-f]*")

_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
_HEADERS = re.compile(r"(?:\s|\\[nr])*Proc-Type: ?4,ENCRYPTED(?:\s|\\[nr])+DEK-Info: ?([A-Z0-9-]+),([0-9A-Fa-f]+)(?=[\s\\])")
_BREAK = re.compile(r"\\[nr]|\s|\\")
# first characters of base64 that decode to a DER sequence, and to the magic of OpenSSH keys
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M[A-P]|b3BlbnNzaC1rZXktdjEA)[A-Za-z0-9+/_-]{2}")
_HEX_RUN = re.compile(r"(?<![0-9a-fA-F])(?:30[0-9a-fA-F]{62}|6f70656e7373682d6b65792d7631)[0-9a-fA-F]*")
_PART = re.compile(r"(?!-----)([A-Za-z0-9+/_-]+)|[\x20\t]*(?:\\r|\\n|\r|\n)(?:\\r|\\n|\s)*")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_.-])(e[w-z0-9_-][A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]{16,})(?![A-Za-z0-9_-])")
_OPENSSH = b"openssh-key-v1\x00"
#: The shortest key encoding, and the longest that is looked for, in bytes.
LEAST, MOST = 32, 1 << 16
#: Most parts of a key's outer sequence: nine of an RSA key, and one with further primes.
_ITEMS = 16

# DER tags and object identifiers (fixed values)
_INTEGER, _BITS, _OCTETS, _OID, _SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30
_RSA, _DSA, _EC = (bytes.fromhex(x) for x in ("2a864886f70d010101", "2a8648ce380401", "2a8648ce3d0201"))
_EDWARDS = {bytes.fromhex("2b65" + x): n for x, n in (("6e", 32), ("6f", 56), ("70", 32), ("71", 57))}


def _from_base64(text: str) -> bytes | None:
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), altchars=b"-_" if "-" in text or "_" in text else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def der_size(data: bytes) -> int:
    """Bytes of the DER item that ``data`` begins with, its head included; 0 if the head is none."""
    if len(data) < 2:
        return 0
    first = data[1]
    if first < 0x80:
        return 2 + first
    n = first & 0x7F
    size = int.from_bytes(data[2 : 2 + n], "big")
    if not 1 <= n <= 4 or len(data) < 2 + n or data[2] == 0 or size < 0x80:
        return 0
    return 2 + n + size


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, body) of the items that fill ``data``; None where their lengths do not."""
    out, at = [], 0
    while at < len(data):
        size = der_size(data[at : at + 6])
        if not size or at + size > len(data):
            return None
        head = 2 if data[at + 1] < 0x80 else 2 + (data[at + 1] & 0x7F)
        out.append((data[at], data[at + head : at + size]))
        at += size
    return out


def _algorithm(body: bytes) -> bytes | None:
    """The identifier that an algorithm sequence names."""
    found = der_items(body)
    return found[0][1] if found and len(found) <= 2 and found[0][0] == _OID and len(found[0][1]) >= 3 else None


def _integers(found: list[tuple[int, bytes]]) -> bool:
    return all(tag == _INTEGER and body for tag, body in found)


def private_key_holds(data: bytes) -> bool:
    """Whether ``data`` is the DER encoding of a private key, to its last byte."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != _SEQUENCE:
        return False
    found = der_items(outer[0][1])
    if not found or len(found) < 2:
        return False
    tags = [t for t, _ in found]
    if tags == [_SEQUENCE, _OCTETS]:  # encrypted: the cipher's identifier, then whole blocks
        return _algorithm(found[0][1]) is not None and len(found[1][1]) >= 16 and len(found[1][1]) % 8 == 0
    if tags[0] != _INTEGER or found[0][1] not in (b"\x00", b"\x01"):
        return False
    if tags[1:3] == [_SEQUENCE, _OCTETS] and all(t in (0xA0, 0x81, 0xA1) for t in tags[3:]):
        name, inner = _algorithm(found[1][1]), found[2][1]
        if name in (_RSA, _EC):
            return private_key_holds(inner)
        if name in _EDWARDS:
            held = der_items(inner)
            return bool(held) and len(held) == 1 and held[0][0] == _OCTETS and len(held[0][1]) == _EDWARDS[name]
        if name == _DSA:
            held = der_items(inner)
            return bool(held) and len(held) == 1 and _integers(held)
        return name is not None and bool(inner)
    if _integers(found):  # RSA: nine numbers, more with further primes; DSA: six, of 512 and 160 bits at least
        large = len(found[1][1]) >= 64  # 512 bits
        return found[0][1] == b"\x00" and large and (len(found) == 9 or len(found) == 6 and len(found[2][1]) >= 20) or found[0][1] == b"\x01" and len(found) > 9
    # elliptic curves: a number of one of the usual sizes, then tagged fields
    return found[0][1] == b"\x01" and tags[1] == _OCTETS and 20 <= len(found[1][1]) <= 72 and all(t in (0xA0, 0xA1) and der_items(b) for t, b in found[2:])


def openssh_size(data: bytes) -> int:
    """Bytes of the OpenSSH private key that ``data`` begins with; 0 if its fields don't hold."""
    if not data.startswith(_OPENSSH):
        return 0
    at = len(_OPENSSH)

    def field() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    cipher, method, options = field(), field(), field()
    if not cipher or not method or options is None or not (cipher + method).isascii():
        return 0
    count, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    blobs = [field() for _ in range(count)] if 1 <= count <= 8 else [None]
    private = field()
    return at if all(blobs) and private and len(private) % 8 == 0 else 0


def key_size(data: bytes) -> int:
    """Bytes of the private key encoding that ``data`` begins with; 0 if there is none."""
    size = openssh_size(data) or der_size(data)
    if not LEAST <= size <= min(MOST, len(data)):
        return 0
    return size if data.startswith(_OPENSSH) or private_key_holds(data[:size]) else 0


def key_holds(text: str) -> bool:
    """Whether base64 text, white space aside, is a private key encoding and nothing else."""
    raw = _from_base64(_BREAK.sub("", text))
    return raw is not None and len(raw) > 0 and key_size(raw) == len(raw)


def pem_holds(body: str) -> bool:
    """Whether the body of a private key block is a key, or an encrypted one with its headers."""
    if m := _HEADERS.match(body):
        raw = _from_base64(_BREAK.sub("", body[m.end() :]))
        block = 8 if "DES" in m[1] else 16
        return len(m[2]) == 2 * block and raw is not None and len(raw) >= LEAST and len(raw) % block == 0
    return key_holds(body)


def _pem_blocks(text: str) -> Iterator[tuple[int, int]]:
    begins = [(m.start(), m.end(), m[1]) for m in _BEGIN.finditer(text)]
    for k, (start, after, label) in enumerate(begins):
        last = begins[k + 1][0] if k + 1 < len(begins) else min(len(text), after + 4 * MOST)
        end = text.find(f"-----END {label}-----", after, last)
        if end >= 0 and pem_holds(text[after:end]):
            yield start, end + len(label) + 14


class _Run:
    """Base64 characters from a place on, over line breaks, gathered once for all keys that may begin in them."""

    def __init__(self, text: str, start: int):
        parts, self.places, self.firsts, size, at = [], [], [], 0, start
        while m := _PART.match(text, at):
            if m[1]:
                parts.append(m[1])
                self.places.append(at)
                self.firsts.append(size)
                size += len(m[1])
            at = m.end()
        self.chars, self.end = "".join(parts), at

    def index(self, place: int) -> int:
        k = bisect.bisect(self.places, place) - 1
        return self.firsts[k] + place - self.places[k]

    def after(self, index: int) -> int:
        """The place behind the character before ``index``."""
        k = bisect.bisect(self.firsts, index - 1) - 1
        return self.places[k] + index - self.firsts[k]

    def bytes(self, index: int, at: int, n: int) -> bytes:
        """``n`` bytes from byte ``at`` on of what the characters from ``index`` on encode, fewer at the end."""
        first, last = at // 3 * 4, -(-(at + n) // 3) * 4
        part = self.chars[index + first : index + last]
        raw = _from_base64(part[: len(part) - (len(part) % 4 == 1)]) or b""
        return raw[at - at // 3 * 3 :][:n]


def _der_extent(read: Callable[[int, int], bytes], size: int) -> bool:
    """Whether the items of a sequence of ``size`` bytes begin as a private key's do and fill it, by their heads alone."""
    head = read(0, 6)
    if len(head) < 6 or head[0] != _SEQUENCE:
        return False
    at = 2 if head[1] < 0x80 else 2 + (head[1] & 0x7F)
    for k in range(_ITEMS):
        head = read(at, 6)
        item = der_size(head)
        if not item or k == 0 and not (head[0] == _SEQUENCE or head[:2] == b"\x02\x01" and head[2] <= 1):
            return False
        at += item
        if at >= size:
            return at == size and k > 0
    return False


def _openssh_extent(read: Callable[[int, int], bytes]) -> int:
    """Bytes of the OpenSSH key that the fields' lengths tell of; 0 if one is longer than any key's."""
    at = len(_OPENSSH)
    fields = 3
    count = None
    while fields:
        raw = read(at, 4)
        size = int.from_bytes(raw, "big")
        if len(raw) < 4 or size > MOST:
            return 0
        at, fields = at + 4 + size, fields - 1
        if not fields and count is None:
            count = int.from_bytes(read(at, 4), "big")
            if not 1 <= count <= 8:
                return 0
            at, fields = at + 4, count + 1
    return at


def _bare_keys(text: str) -> Iterator[tuple[int, int]]:
    """Places of key encodings in base64 outside of blocks; their own lengths say where they end.

    A candidate is decoded whole only when the heads of its parts, a few bytes each, fill the
    length that it states.
    """
    run = None
    for m in _RUN.finditer(text):
        at = m.start()
        if run is None or at >= run.end:
            run = _Run(text, at)
        i = run.index(at)
        read = functools.partial(run.bytes, i)
        if text.startswith("b3Blbn", at):
            size = _openssh_extent(read)
        else:
            size = der_size(read(0, 6))
            size = size if LEAST <= size <= MOST and _der_extent(read, size) else 0
        need = -(-size * 4 // 3)
        if not LEAST <= size <= MOST or i + need > len(run.chars):
            continue
        raw = _from_base64(run.chars[i : i + need])
        if raw and key_size(raw) == size:
            end = run.after(i + need)
            while end < len(text) and text[end] == "=":
                end += 1
            if end == len(text) or not (text[end].isascii() and (text[end].isalnum() or text[end] in "+/")):
                yield at, end


def _hex_keys(text: str) -> Iterator[tuple[int, int]]:
    for m in _HEX_RUN.finditer(text):
        if len(m[0]) % 2 == 0 and len(m[0]) <= 2 * MOST and key_size(raw := bytes.fromhex(m[0])) == len(raw):
            yield m.span()


def token_holds(header: str, payload: str) -> bool:
    """Whether a signed token's header names an algorithm and its payload is an object."""
    for part, need in ((header, "alg"), (payload, None)):
        raw = _from_base64(part)
        try:
            obj = json.loads(raw) if raw is not None else None
        except (ValueError, RecursionError):
            return False
        if not isinstance(obj, dict) or need is not None and not isinstance(obj.get(need), str):
            return False
    return True


def scan(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every secret, by start and then kind as listed."""
    out = []
    if ":" in text or "=" in text:
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    keys = list(_pem_blocks(text)) if "PRIVATE KEY-----" in text else []
    starts = [a for a, _ in keys]
    for a, b in sorted({*_bare_keys(text), *_hex_keys(text)}):
        k = bisect.bisect(starts, a) - 1
        if k < 0 or keys[k][1] < b:
            out.append(("key", a, b))
    out += [("key", a, b) for a, b in keys]
    if "." in text:
        out += [("token", m.start(), m.end()) for m in _TOKEN.finditer(text) if token_holds(m[1], m[2])]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and spans, an array of (kind, start, stop), of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "stop")
        for batch in batches:
            spans = [[dict(zip(names, s, strict=True)) for s in scan(t.as_py() or "")] for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(spans, _SPANS)], names=["key", "spans"])

    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, f"key {kind}, spans array<struct<kind string, start long, stop long>>").withColumnRenamed("key", id_col)
