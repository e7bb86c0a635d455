"""Secret scans with structural confirmation.

Three plain kinds are reported as matched: ``assign`` (a credential word, a
sign, a value of 6+ characters), ``access`` (AKIA keys of 20+ characters), ``hex``
(24+ hexadecimal digits). The other kinds are reported only after their
candidate has been decoded and its structure holds:

``jwt``   three base64url parts whose first two decode to JSON objects and whose
          header names an algorithm (a signature is there unless it is "none")
``pem``   a private key block whose body decodes to one of the key encodings below,
          or to bytes of a cipher's block size under an encryption header
``key``   base64 or hexadecimal text that decodes to a private key: DER (PKCS#1,
          PKCS#8 plain or encrypted, SEC1, DSA) with all nested lengths filled
          exactly, or the OpenSSH format with all its length-prefixed fields
``wrapped`` base64 or hexadecimal text that decodes to printable text which itself
          holds an access key, a confirmed token or a confirmed key block

Candidates are runs of 27 base64 characters (an access key, without padding) or 40
hexadecimal digits and more; lines of equal width, the last one shorter, are joined
before decoding (their breaks and indents are part of the span; the body of a reported
``pem`` is not reported again); a base64 run is also tried from behind each of its
separators ``/ - _ +``.

Spans are (kind, start, end) in code points, end exclusive, ordered by start, then
kind in the order of ``KINDS``; of one kind they are leftmost and do not overlap.

Plan: one pass, no shuffle; regular expressions anchored at the start of a run,
so time is linear in the text.

Defined results: null and empty texts have no spans; texts are scanned whole;
repeated rows get equal spans; other columns pass through, whatever their names.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "pem", "key", "wrapped")

_ASSIGN = re.compile(
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])e[w-z][A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
_PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ ){0,4}PRIVATE KEY)-----\s*((?:[A-Za-z-]+: [^\n]*\n)*)([A-Za-z0-9+/=\s]+)-----END \1-----")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{27,}={0,2}")
_ANY_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){20,}(?![0-9A-Fa-f])")
_FOLDED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]+(?:\r?\n[ \t]*[A-Za-z0-9+/_-]+)+(?:(?:\r?\n[ \t]*)?=){0,2}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]+")
#: Usual line widths of folded text, for a block of two lines glued to the text before it.
_WIDTHS = (60, 64, 70, 72, 76)
_SEPARATOR = re.compile(r"[+/_-]")
_UNPRINTABLE = re.compile(rb"[^\x20-\x7e\r\n\t]")
_CREDENTIAL_WORDS = ("passw", "secret", "token", "api")

INTEGER, BITS, OCTETS, OID, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30


def der(data: bytes, depth: int = 0) -> list[tuple[int, object]] | None:
    """The elements of ``data`` if definite lengths fill it exactly: (tag, bytes),
    for constructed tags (tag, elements). None if a length does not fit."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data) or depth > 12:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size = int.from_bytes(data[at:at + n], "big")
            at += n
        if at + size > len(data):
            return None
        body = data[at:at + size]
        at += size
        if tag & 0x20:
            inner = der(body, depth + 1)
            if inner is None:
                return None
            out.append((tag, inner))
        else:
            out.append((tag, body))
    return out


def is_der_key(data: bytes) -> bool:
    """True for one whole private key in DER."""
    if len(data) < 16 or data[0] != SEQUENCE:
        return False
    whole = der(data)
    if whole is None or len(whole) != 1:
        return False
    parts = whole[0][1]
    tags = [t for t, _ in parts]
    if len(tags) < 2:
        return False
    version = int.from_bytes(parts[0][1], "big") if tags[0] == INTEGER and len(parts[0][1]) == 1 else None
    if version in (0, 1) and len(tags) >= 9 and set(tags[:9]) == {INTEGER}:
        return True                                           # PKCS#1
    if version == 0 and len(tags) == 6 and set(tags) == {INTEGER}:
        return True                                           # DSA
    if version in (0, 1) and tags[1:3] == [SEQUENCE, OCTETS] and parts[1][1] and parts[1][1][0][0] == OID:
        return True                                           # PKCS#8
    if version == 1 and tags[1] == OCTETS and 16 <= len(parts[1][1]) <= 72 and set(tags[2:]) <= {0xA0, 0xA1}:
        return True                                           # SEC1
    return tags == [SEQUENCE, OCTETS] and bool(parts[0][1]) and parts[0][1][0][0] == OID and len(parts[1][1]) >= 16  # encrypted PKCS#8


def is_openssh_key(data: bytes) -> bool:
    """True if the OpenSSH private key format's fields fill ``data`` exactly."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def field():
        nonlocal at
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data):
            raise ValueError
        at += 4 + size
        return data[at - size:at]

    try:
        field(), field(), field()
        keys = int.from_bytes(data[at:at + 4], "big")
        at += 4
        for _ in range(keys if 0 < keys < 64 else 0):
            field()
        private = field()
    except ValueError:
        return False
    return 0 < keys < 64 and at == len(data) and len(private) >= 16 and len(private) % 8 == 0


def is_key(data: bytes) -> bool:
    return is_der_key(data) or is_openssh_key(data)


def from_base64(text: str) -> bytes | None:
    """Bytes of standard or URL-safe base64, padded or not."""
    body = text.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part: str) -> dict | None:
    data = from_base64(part)
    try:
        got = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return got if isinstance(got, dict) else None


def is_token(text: str) -> bool:
    """True for a signed token: JSON header naming an algorithm, JSON claims, signature bytes."""
    head, claims, signature = text.split(".")
    header = _json_object(head)
    if header is None or not isinstance(header.get("alg"), str) or _json_object(claims) is None:
        return False
    signed = from_base64(signature)
    return header["alg"].lower() == "none" if not signature else signed is not None and len(signed) >= 16


def is_block(headers: str, body: str) -> bool:
    data = from_base64("".join(body.split()))
    if not data:
        return False
    if "ENCRYPTED" in headers:
        return len(data) >= 16 and len(data) % 8 == 0
    return is_key(data)


def _is_wrapper(data: bytes) -> bool:
    if not data.isascii():
        return False
    text = data.decode("ascii")
    if not all(c.isprintable() or c in "\r\n\t" for c in text):
        return False
    return bool(_ACCESS.search(text)) or any(is_token(m[0]) for m in _JWT.finditer(text)) \
        or any(is_block(m[2], m[3]) for m in _PEM.finditer(text))


def _kind(data: bytes | None) -> str | None:
    if not data:
        return None
    return "key" if is_key(data) else "wrapped" if _is_wrapper(data) else None


def _decoded(pattern: re.Pattern, decode, text: str, spans: list) -> None:
    for m in pattern.finditer(text):
        kind = _kind(decode(m[0]))
        if kind:
            spans.append((kind, m.start(), m.end()))
        elif decode is from_base64:
            spans += [(kind, m.start() + at, m.end()) for kind, at in _behind_separators(m[0])]


def _may_be_key(run: str, at: int, size: int) -> bool:
    """Whether the base64 text run[at:size] starts as a key: DER of just that length, or OpenSSH."""
    if run.startswith("b3BlbnNzaC1rZXktdjE", at):
        return True
    head = from_base64(run[at:at + 8]) if run[at] == "M" and size - at >= 20 else None
    if not head:
        return False
    n = head[1] & 0x7F if head[1] & 0x80 else 0
    return n <= 4 and 2 + n + (int.from_bytes(head[2:2 + n], "big") if n else head[1]) == (size - at) * 3 // 4


def _behind_separators(run: str) -> list[tuple[str, int]]:
    """(kind, place): what the rest of a base64 run behind one of its separators decodes to.

    The rest is decoded only where it starts as a key or, of the places alike modulo 4,
    at the first from which all is printable: linear in the run."""
    size = len(run.rstrip("="))
    starts = [m.end() for m in _SEPARATOR.finditer(run, 0, size) if size - m.end() >= 27]
    out, clean = [], {}
    for at in starts:
        if _may_be_key(run, at, size) and _kind(from_base64(run[at:])) == "key":
            out.append(("key", at))
        if at % 4 not in clean:
            data = from_base64(run[at:])
            bad = [m.end() for m in _UNPRINTABLE.finditer(data)] if data else []
            clean[at % 4] = (at + (bad[-1] + 2) // 3 * 4 if bad else at) if data else size
        if at >= clean[at % 4]:
            clean[at % 4] = size
            if _kind(from_base64(run[at:])) == "wrapped":
                out.append(("wrapped", at))
    return out


def _unfolded(text: str, inside: list[tuple[str, int, int]], spans: list) -> None:
    """Spans of base64 or hexadecimal text folded into lines of one width."""
    for m in _FOLDED.finditer(text):
        if any(a <= m.start() and m.end() <= b for _, a, b in inside):
            continue
        runs = [r.span() for r in _RUN.finditer(text, m.start(), m.end())]
        width = [b - a for a, b in runs]
        i = 0
        while i + 1 < len(runs):
            j = i + 1
            while j < len(runs) and width[j] == width[i + 1]:
                j += 1
            # runs[i + 1:j] are of one width; the first line may be glued to the text before it
            full = width[i + 1]
            lasts = [j] + ([j + 1] if j < len(runs) and width[j] < full else [])
            firsts = {runs[i][0], runs[i][1] - full} if width[i] >= full else set()
            if j == i + 2 and width[i] > full:  # one full line, maybe glued, and the rest
                both = text[slice(*runs[i])] + text[slice(*runs[i + 1])]
                cuts = [x.end() for x in _SEPARATOR.finditer(both, 0, width[i])]
                firsts |= {runs[i][0] + c for n, c in enumerate(cuts) if n + 1 == len(cuts) or _may_be_key(both, c, len(both))}
                firsts |= {runs[i][1] - w for w in _WIDTHS if width[i] >= w}
            for last in lasts:
                end = m.end() if last == len(runs) else runs[last - 1][1]
                for first in firsts:
                    body = text[first:runs[i][1]] + "".join([text[a:b] for a, b in runs[i + 1:last]])
                    kind = _kind(from_base64(body)) if len(body) >= 27 else None
                    if not kind and len(body) >= 40 and len(body) % 2 == 0 and _ANY_HEX.fullmatch(body):
                        kind = _kind(bytes.fromhex(body))
                    if kind:
                        spans.append((kind, first, end))
            i = j - 1 if j > i + 1 and width[i] != full else j


def scan(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a whole text, in order."""
    if not text:
        return []
    spans: list[tuple[str, int, int]] = []
    low = text.lower()
    if any(w in low for w in _CREDENTIAL_WORDS):
        spans += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    spans += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    spans += [("jwt", m.start(), m.end()) for m in _JWT.finditer(text) if is_token(m[0])]
    if "-----BEGIN" in text:
        spans += [("pem", m.start(), m.end()) for m in _PEM.finditer(text) if is_block(m[2], m[3])]
    found: list[tuple[str, int, int]] = []
    _decoded(_BASE64, from_base64, text, found)
    _decoded(_ANY_HEX, bytes.fromhex, text, found)
    _unfolded(text, [x for x in spans if x[0] == "pem"], found)
    spans += _apart(found)
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _apart(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Leftmost spans of every kind that do not overlap."""
    out, ends = [], {}
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= ends.get(kind, 0):
            out.append((kind, start, end))
            ends[kind] = end
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
                                  T.StructField("end", T.IntegerType())]))


def with_spans(docs: DataFrame, text: str = "text", out: str = "spans", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` (all by default) and the spans of every whole text."""
    kept = docs.columns if carry is None else carry
    narrow = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(kept)], docs[text].cast("string").alias("t"))
    schema = T.StructType([T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(kept)] + [T.StructField("spans", SPANS)])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in scan(t.as_py())] for t in batch.column(len(kept))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, arrow)], names=[*batch.schema.names[:-1], "spans"])

    return narrow.mapInArrow(run, schema).toDF(*kept, out)
