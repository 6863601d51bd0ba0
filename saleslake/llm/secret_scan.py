"""Secrets in texts: patterns, and candidates that decode to the structure of a key or a signed token.

Patterns report what looks like an assignment of a password or token, an access key id, or a long run of hex
digits. Structural confirmation reports further spans only after decoding them:

* ``pem``: a private-key block between its markers whose base64 body is a key encoding, or is marked as
  encrypted and fills whole cipher blocks;
* ``key``: a bare run of base64 or hex digits that decodes to a key encoding. Encodings are DER (every nested
  length must fill its element exactly, and the elements must be those of a private key) and the binary
  form of OpenSSH (every length-prefixed field must end where the next begins, and the last at the end);
* ``jwt``: three base64url parts, a header that is a JSON object naming an algorithm, a payload that is
  a JSON object, and a signature of the length that the algorithm gives.

One compiled search over a whole column of texts picks those that can hold anything; only they are looked at
one by one. A text is searched as a whole, every search is linear in it, and nothing is shuffled.

Spans count code points, their end is exclusive. They are sorted by start, then by kind in the
order of ``KINDS``; the spans of one kind don't overlap, those of different kinds may. A null text
is empty and has none. Rows that repeat are searched each for itself. If the table has a column of
the name asked for already, that column stays and the new one takes the first free name
``name_1``, ``name_2``…
"""

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from saleslake.llm.tables import free_name

# The kinds, and the patterns of the first three with the lengths that they need.
KINDS = ["assign", "access", "hex", "pem", "key", "jwt"]
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32

MARKER = re.compile(r"-----(BEGIN|END) ((?:[A-Z0-9]+ )*PRIVATE KEY)-----")
RUN_LENGTH = 64  # base64 digits of the shortest key encoding, rounded down
BASE64_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M|b3BlbnNzaC1rZXktdjEA)[A-Za-z0-9+/_-]{44,}={0,2}")
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[fF]70656[eE]7373682[dD]6[bB]65792[dD]763100)[0-9A-Fa-f]{66,}")
JWT = re.compile(r"(?<![A-Za-z0-9_-])(e[w-z0-9_-][A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)(?![A-Za-z0-9_-])")
OPENSSH = b"openssh-key-v1\0"
# Bytes of a signature by algorithm; those with an RSA key have the length of the key.
SIGNATURE_BYTES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}
LEAST_RSA_BYTES = 128

# Any text with a span matches this; the syntax is that of both engines.
_ANY = "|".join(
    [
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8}""",
        r"AKIA[A-Z0-9]{12}",
        r"[0-9a-f]{32}",
        r"PRIVATE KEY-----",
        r"(?:M|b3BlbnNzaC1rZXktdjEA)[A-Za-z0-9+/_-]{44}",
        r"(?:30|6[fF]70656[eE]7373682[dD]6[bB]65792[dD]763100)[0-9A-Fa-f]{66}",
        r"e[w-z0-9_-][A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.",
    ]
)

Span = tuple[str, int, int]
SPANS = T.ArrayType(T.StructType().add("kind", T.StringType()).add("start", T.LongType()).add("end", T.LongType()))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def pattern_spans(text: str) -> Iterator[Span]:
    """Leftmost matches without overlap, those that are too short left out."""
    for m in ASSIGN.finditer(text):
        if m.end(1) - m.start(1) >= ASSIGN_LENGTH:
            yield "assign", m.start(), m.end()
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= ACCESS_LENGTH:
            yield "access", m.start(), m.end()
    for m in HEX.finditer(text):
        if m.end() - m.start() >= HEX_LENGTH:
            yield "hex", m.start(), m.end()


def _elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents of DER elements that fill ``data`` exactly; None where they don't."""
    found, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size == 0x80 or size > 0x84:
            return None  # no definite length, or one beyond any key
        if size > 0x80:
            width = size & 0x7F
            size = int.from_bytes(data[at : at + width], "big")
            at += width
        if at + size > len(data):
            return None
        found.append((tag, data[at : at + size]))
        at += size
    return found


# Tags of the elements that key encodings consist of.
_INTEGER, _BITS, _OCTETS, _OID, _SEQUENCE, _FIELD_0, _FIELD_1 = 0x02, 0x03, 0x04, 0x06, 0x30, 0xA0, 0xA1


def _algorithm(content: bytes) -> list[tuple[int, bytes]] | None:
    parts = _elements(content)
    return parts if parts and parts[0][0] == _OID and parts[0][1] else None


def is_der_key(data: bytes) -> bool:
    """Whether ``data`` is a private key in one of its DER forms, to the last byte."""
    whole = _elements(data)
    if not whole or len(whole) != 1 or whole[0][0] != _SEQUENCE:
        return False
    parts = _elements(whole[0][1])
    if not parts:
        return False
    tags = [tag for tag, _ in parts]
    if tags == [_SEQUENCE, _OCTETS]:  # encrypted key: algorithm with parameters, data
        algorithm = _algorithm(parts[0][1])
        return bool(algorithm) and len(algorithm) == 2 and algorithm[1][0] == _SEQUENCE and _elements(algorithm[1][1]) is not None
    if tags[0] != _INTEGER or parts[0][1] not in (b"\0", b"\1"):
        return False
    if set(tags) == {_INTEGER}:  # RSA: modulus, exponents, primes, …; DSA: primes, generator, keys
        return len(tags) in (6, 9) and all(content for _, content in parts)
    if tags[1:3] == [_SEQUENCE, _OCTETS]:  # any algorithm and its key
        return bool(_algorithm(parts[1][1])) and bool(parts[2][1]) and set(tags[3:]) <= {_FIELD_0, _FIELD_1, 0x81}
    if tags[1] == _OCTETS:  # elliptic curve: number, curve, public point
        nested = [_elements(content) for _, content in parts[2:]]
        fields = {_FIELD_0: _OID, _FIELD_1: _BITS}
        return len(parts[1][1]) >= 16 and all(
            tag in fields and inner and inner[0][0] == fields[tag] for (tag, _), inner in zip(parts[2:], nested, strict=True)
        )
    return False


def is_openssh_key(data: bytes) -> bool:
    """Whether length-prefixed fields after the magic word end exactly at the end."""
    if not data.startswith(OPENSSH):
        return False
    at = len(OPENSSH)

    def field() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size : at]

    if any(field() is None for _ in ("cipher", "kdf", "kdf options")):
        return False
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 0 < keys <= len(data):
        return False
    return all(field() for _ in range(keys + 1)) and at == len(data)


def _base64(text: str) -> bytes | None:
    digits = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(digits) % 4 == 1:
        return None
    try:
        return base64.b64decode(digits + "=" * (-len(digits) % 4), validate=True)
    except binascii.Error:
        return None


def is_key(data: bytes | None) -> bool:
    return data is not None and (is_openssh_key(data) or is_der_key(data))


def _is_pem_body(body: str) -> bool:
    lines = body.replace("\\r", "").replace("\\n", "\n").split("\n")
    headers = [x for x in lines if ":" in x]
    data = _base64("".join("".join(x.split()) for x in lines if ":" not in x))
    if any(x.strip().startswith("Proc-Type:") and "ENCRYPTED" in x for x in headers):
        return bool(data) and len(data) % 8 == 0
    return is_key(data)


def _json_object(text: str) -> dict | None:
    data = _base64(text)
    try:
        value = json.loads(data) if data is not None else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(header: str, payload: str, signature: str) -> bool:
    names = _json_object(header)
    algorithm = names.get("alg") if names else None
    if not isinstance(algorithm, str) or algorithm.lower() == "none" or _json_object(payload) is None:
        return False
    size = len(_base64(signature) or b"")
    if algorithm[:2] in ("RS", "PS"):
        return size >= LEAST_RSA_BYTES
    return size == SIGNATURE_BYTES.get(algorithm, size) and size > 0


def confirmed_spans(text: str) -> Iterator[Span]:
    """Candidates whose decoded content has the structure of a key or a signed token."""
    blocks, opened = [], None
    for m in MARKER.finditer(text):
        if m[1] == "BEGIN":
            opened = m
        elif opened:
            if opened[2] == m[2] and _is_pem_body(text[opened.end() : m.start()]):
                blocks.append((opened.start(), m.end()))
                yield "pem", *blocks[-1]
            opened = None
    last = -1
    runs = [(m.start(), m.end(), _base64(m[0])) for m in BASE64_RUN.finditer(text)]
    runs += [(m.start(), m.end(), bytes.fromhex(m[0])) for m in HEX_RUN.finditer(text) if len(m[0]) % 2 == 0]
    for start, end, data in sorted(runs, key=lambda x: x[:2]):
        if start >= last and is_key(data) and not _inside(blocks, start):
            last = end
            yield "key", start, end
    for m in JWT.finditer(text):
        if is_signed_token(m[1], m[2], m[3]):
            yield "jwt", m.start(), m.end()


def _inside(blocks: list[tuple[int, int]], at: int) -> bool:
    import bisect

    k = bisect.bisect_right(blocks, (at, at)) - 1
    return k >= 0 and at < blocks[k][1]


def secret_spans(text: str) -> list[Span]:
    return sorted([*pattern_spans(text), *confirmed_spans(text)], key=lambda s: (s[1], KINDS.index(s[0])))


def find_secrets(df: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """All columns, and the spans of secrets (kind, start, end) of a text column."""
    schema = T.StructType([*df.schema.fields, T.StructField(free_name(df, into), SPANS)])
    at = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            maybe = pc.fill_null(pc.match_substring_regex(texts, _ANY), False).to_pylist()
            found = [
                [{"kind": k, "start": a, "end": b} for k, a, b in secret_spans(texts[i].as_py())] if flag else []
                for i, flag in enumerate(maybe)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _ARROW_SPANS)], names=schema.names)

    return df.mapInArrow(run, schema)


def redact(df: DataFrame, text: str = "text", mark: str = "[{kind}]") -> DataFrame:
    """All rows with every span of a secret replaced by its mark; overlapping spans become one, named by the first."""
    schema, at = df.schema, df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at)
            maybe = pc.fill_null(pc.match_substring_regex(texts, _ANY), False)
            clean = [_redacted(value.as_py(), mark) if flag.as_py() else value.as_py() for value, flag in zip(texts, maybe, strict=True)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, texts.type))

    return df.mapInArrow(run, schema)


def _redacted(text: str, mark: str) -> str:
    parts, at = [], 0
    for kind, start, end in secret_spans(text):
        if start >= at:
            parts += [text[at:start], mark.format(kind=kind)]
        at = max(at, end)
    return "".join([*parts, text[at:]])
