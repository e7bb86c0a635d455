"""Secret scans: plain kinds against the stated patterns, confirmed kinds against built structures."""

import base64
import hashlib
import json
import random
import re

from itemscope.llm import secrets

ASSIGN = r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute_base(text):
    out = [("assign", m.start(), m.end()) for m in re.finditer(ASSIGN, text) if len(m[1]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], secrets.BASE_KINDS.index(s[0])))


def tlv(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | len(n.to_bytes((n.bit_length() + 7) // 8, "big"))]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


def integer(x):
    return tlv(2, x.to_bytes(x.bit_length() // 8 + 1, "big"))


rng = random.Random(4)
PKCS1 = tlv(0x30, integer(0) + b"".join(integer(rng.getrandbits(256) | 1) for _ in range(8)))
PKCS8 = tlv(0x30, integer(0) + tlv(0x30, tlv(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x01\x01") + tlv(5, b"")) + tlv(4, PKCS1))
SEC1 = tlv(0x30, integer(1) + tlv(4, rng.randbytes(32)) + tlv(0xA0, tlv(6, b"\x2a\x86\x48\xce\x3d\x03\x01\x07")))


def field(b):
    return len(b).to_bytes(4, "big") + b


OPENSSH = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + (1).to_bytes(4, "big") + field(rng.randbytes(51)) + field(rng.randbytes(136))


def b64url(data):
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def token(alg="HS256", signature=rng.randbytes(32)):
    return ".".join([b64url(json.dumps({"alg": alg, "typ": "JWT"}).encode()), b64url(b'{"sub":"1"}'), b64url(signature)])


def pem(name, data):
    body = base64.encodebytes(data).decode()
    return f"-----BEGIN {name}-----\n{body}-----END {name}-----"


def kinds(text):
    return [(k, text[a:b]) for k, a, b in secrets.scan(text) if k not in secrets.BASE_KINDS]


def test_confirmed_kinds():
    for data in (PKCS1, PKCS8, SEC1, OPENSSH):
        assert secrets.is_key(data)
        assert not secrets.is_key(data[:-1]) and not secrets.is_key(data + b"\0")
        plain = base64.b64encode(data).decode()
        assert ("key", plain) in kinds(f"é see {plain}, ok")
        assert ("key", data.hex()) in kinds(f"see {data.hex()} ok")
    block = pem("RSA PRIVATE KEY", PKCS1)
    assert ("pem", block) in kinds(f"日本 {block} tail")
    assert kinds(pem("RSA PRIVATE KEY", PKCS1[:-3])) == []
    assert kinds(pem("PUBLIC KEY", PKCS1).replace("\n", "\n ")) == []
    assert kinds(f"a {token()} b") == [("jwt", token())]
    assert kinds(f"a {token('none', b'')} b") == [("jwt", token("none", b""))]


def test_lookalikes_are_not_reported():
    digest = hashlib.sha512(b"x").digest()
    texts = [base64.b64encode(digest).decode(), digest.hex(), "exyz.abc.def", "eyJhbGciOiJIUzI1NiJ9.notjson.abc", "0" * 96, "A" * 80,
             ".".join([b64url(b'{"typ":"JWT"}'), b64url(b"{}"), b64url(digest)])]
    for t in texts:
        assert kinds(t) == [], t


def test_wrapped():
    inner = f"aws AKIA{'A1' * 8} and more text to fill"
    wrapped = base64.b64encode(inner.encode()).decode()
    assert ("wrapped", wrapped) in kinds(f"config: {wrapped}")
    assert ("wrapped", token().encode().hex()) in kinds(token().encode().hex())


def test_plain_kinds_match_the_stated_patterns():
    pieces = ["password", "PassWd", "secret", "TOKEN", "api_key", "APIKEY", "ſecret", "toKen", '"', "'", " ", "  ", ":", "=", "abcdef", "abc", "AKIA",
              "AKIA" + "Z9" * 8, "0123456789abcdef" * 2, "ABCDEF", "é", "\n", "x.y-z_", "deadbeef" * 3]
    r = random.Random(1)
    for _ in range(3000):
        text = "".join(r.choice(pieces) for _ in range(r.randint(1, 14)))
        assert [s for s in secrets.scan(text) if s[0] in secrets.BASE_KINDS] == brute_base(text), text


def test_edge_rows_and_query(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "token=abcdef", "c"), (3, "token=abcdef", "c"), (None, "x" * 200000, "d")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = secrets.with_spans(df, out="found").collect()
    assert sorted((r.spans, len(r.found)) for r in got) == [("a", 0), ("b", 0), ("c", 1), ("c", 1), ("d", 0)]
    assert secrets.with_spans(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    from itemscope.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = QUERIES["op7_secrets"](spark, sf).collect()
    assert len(out) == len(docs)
    for r in out:
        base = brute_base(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == x for k, _, _ in base) for x in secrets.BASE_KINDS)


def test_access_key_wrapped_on_its_own():
    key = b"AKIA" + b"Z9" * 8
    for wrapped in (base64.b64encode(key).decode(), base64.b64encode(key).decode().rstrip("="), key.hex()):
        assert ("wrapped", wrapped) in kinds(f"see {wrapped} ok"), wrapped


def test_folded_text_is_joined():
    def fold(x, n, indent=""):
        return ("\n" + indent).join(x[i:i + n] for i in range(0, len(x), n))
    inner = pem("RSA PRIVATE KEY", PKCS1).encode()
    for n in (64, 76, 70):
        for data, kind in ((PKCS1, "key"), (PKCS8, "key"), (SEC1, "key"), (OPENSSH, "key"), (inner, "wrapped")):
            for plain in (base64.b64encode(data).decode(), data.hex()):
                for indent in ("", "  "):
                    block = fold(plain, n, indent)
                    for text in (f"say:\n{indent}{block}\nend of it", f"data: {block}", f"k/{block}"):
                        assert (kind, block) in kinds(text), (n, kind, text)
    assert [k for k, _ in kinds(pem("RSA PRIVATE KEY", PKCS1))] == ["pem"]
    assert kinds(fold(base64.b64encode(PKCS1[:-3]).decode(), 64)) == []


def test_keys_behind_a_separator():
    for data in (PKCS1, PKCS8, SEC1, OPENSSH):
        plain = base64.b64encode(data).decode()
        for before in ("path/to/", "a-", "my_key_", "x+"):
            assert ("key", plain) in kinds(f"see {before}{plain} ok"), before
    wrapped = base64.b64encode(b"aws AKIA" + b"Z9" * 8 + b" x").decode()
    assert ("wrapped", wrapped) in kinds(f"see v1/{wrapped}")
