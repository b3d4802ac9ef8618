import base64
import hashlib
import json
import re

import pytest
from llm_cases import LONG, documents, no_documents
from pyspark.sql import functions as F

from wellgauge.llm import secrets as sc


def tlv(tag, body):
    n = len(body)
    length = bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")
    return bytes([tag]) + length + body


def integer(value):
    return tlv(2, value)


def string(value):
    return len(value).to_bytes(4, "big") + value


RSA = tlv(0x30, integer(b"\0") + b"".join(integer(b"\1" * n) for n in (128, 3, 128, 64, 64, 64, 64, 64)))
ALGORITHM = tlv(0x30, tlv(6, b"\x2a\x86\x48") + tlv(5, b""))
PKCS8 = tlv(0x30, integer(b"\0") + ALGORITHM + tlv(4, RSA))
ENCRYPTED = tlv(0x30, ALGORITHM + tlv(4, b"\7" * 64))
CURVE = tlv(0x30, integer(b"\1") + tlv(4, b"\5" * 32) + tlv(0xA0, tlv(6, b"\x2a\x86")))
SSH = b"openssh-key-v1\0" + string(b"none") * 2 + string(b"") + (1).to_bytes(4, "big")
SSH += string(b"public") + string(b"private" * 9)
KEYS = [(RSA, "der"), (PKCS8, "der"), (ENCRYPTED, "der"), (CURVE, "der"), (SSH, "ssh")]
PUBLIC = tlv(0x30, ALGORITHM + tlv(3, b"\0" + b"\1" * 90))


def signed(header, payload):
    def part(x):
        return base64.urlsafe_b64encode(json.dumps(x).encode()).rstrip(b"=").decode()

    return f"{part(header)}.{part(payload)}.c2lnbmVk"


def kinds(text):
    return [s.kind for s in sc.structural_spans(text)]


def test_a_container_of_many_keys():
    head = b"openssh-key-v1\0" + string(b"none") * 2 + string(b"")
    parts = [string(b"public %d" % i) for i in range(300)] + [string(b"private" * 9)]
    for count, want in ((300, ["ssh"]), (299, []), (301, []), (2**32 - 1, []), (0, [])):
        data = head + count.to_bytes(4, "big") + b"".join(parts)
        assert kinds(f"x={data.hex()} ") == want
        assert kinds(f"key\n{base64.encodebytes(data).decode()}end") == want


@pytest.mark.parametrize(("data", "kind"), KEYS)
def test_keys_that_parse(data, kind):
    plain = base64.b64encode(data).decode()
    wrapped = base64.encodebytes(data).decode()
    assert kinds(f"key {plain}, and") == [kind]
    assert kinds(f"-----BEGIN KEY-----\n{wrapped}-----END KEY-----") == [kind]
    assert kinds(f"-----BEGIN KEY-----\r\n{wrapped.replace(chr(10), chr(13) + chr(10))}-----") == [kind]
    assert kinds(f"x={data.hex()} ") == [kind] == kinds(data.hex().upper())
    span = sc.structural_spans(f"é {plain} é")[0]
    assert f"é {plain} é"[span.start : span.end] == plain


@pytest.mark.parametrize(("data", "kind"), KEYS)
def test_lengths_that_do_not_fit(data, kind):
    for wrong in (data[:-1], data + b"\0", data[:1] + bytes([data[1] ^ 1]) + data[2:], data[1:]):
        assert kinds(base64.b64encode(wrong).decode()) == [] == kinds(wrong.hex())


def test_what_is_no_secret():
    assert kinds(base64.b64encode(PUBLIC).decode()) == []
    assert kinds(base64.b64encode(bytes(range(200))).decode() + " " + "ab" * 60 + " " + LONG) == []
    assert kinds("eyJ.eyJ.x " + "eyJhbGci" * 3000 + ".eyJ.x " + "A" * 100_001) == []
    assert kinds("[" * 5000 + "eyJ" + "W" * 5000 + ".e30.x") == []


def test_signed_tokens():
    token = signed({"alg": "HS256", "typ": "JWT"}, {"sub": 1})
    assert kinds(f"bearer {token}.") == ["signed"] and kinds(f"x{token}") == []
    assert kinds(signed({"typ": "JWT"}, {})) == [] == kinds(signed({"alg": "x"}, [1]))


def slow_base(text):
    """The contract's patterns, applied one match after another."""
    found = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    first = re.compile(re.sub(r"(?<=[(|])([a-z_?]+)(?=[|)])", lambda m: "".join(
        f"[{c}{c.upper()}]" if c.isalpha() else c for c in m[1]), assign))
    for rank, (kind, pattern, ok) in enumerate([
        ("assign", first, lambda m: len(m[2]) >= 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ]):
        found += [(m.start(), rank, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text) if ok(m)]
    return [f[2] for f in sorted(found)]


BASE = [
    'TOKEN: "abcdef" secret: token: abcdef password=token=abcdef é apikey="AKIA' + "Z9" * 9,
    "AKIAAKIA" + "A" * 12 + " AKIA123 " + "0f" * 12 + " " + "0F" * 12 + " g" + "a" * 24 + "g",
    "ſecret=abcdefgh toKen=abcdefgh Api_Key  ==  x.y-z/1 passwd'  :  'short passwd:'longer",
    "secret=" + "f" * 30 + ";api__key=abcdefg token=" + "a" * 24,
    "",
]


@pytest.mark.parametrize("text", BASE)
def test_base_spans_as_the_contract(text):
    assert [f"{s.kind}:{s.start}:{s.end}" for s in sc.base_spans(text)] == slow_base(text)


def test_registered_query(spark):
    from wellgauge.llm.queries import op9_secrets

    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    found = op9_secrets(spark, d).collect()
    assert len(found) == len(texts)
    for row in found:
        spans = slow_base(texts[row.doc_id])
        counts = [sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex")]
        assert counts == [row.n_assign, row.n_access, row.n_hex]
        assert row.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(row.spans.split(","))


def test_redaction(spark):
    token = signed({"alg": "none"}, {})
    rows = [(1, f"a token: {token} b"), (2, "clean"), (3, None), (4, ""), (None, "passwd=hunter22!")]
    table = documents(spark, rows)
    out = sc.redact(table)
    assert out.schema.simpleString() == table.schema.simpleString()
    assert [r.text for r in out.collect()] == ["a [assign secret] b", "clean", None, "", "[assign secret]!"]


def test_awkward_rows(spark):
    table = documents(spark)
    assert sc.scan(table).count() == table.count()
    long_run = F.col("doc_id").eqNullSafe(8)  # of letters that are hexadecimal digits
    marked = F.when(long_run, "[hex secret]").otherwise(F.col("text"))
    expected = table.withColumn("text", marked).collect()
    assert sorted(map(str, sc.redact(table).collect())) == sorted(map(str, expected))
    assert sc.scan(no_documents(spark)).collect() == [] == sc.redact(no_documents(spark)).collect()


def found(text):
    return [(s.kind, text[s.start : s.end]) for s in sc.structural_spans(text)]


def sized(data, rest):
    """A key of the same kind whose size leaves ``rest`` when divided by three."""
    if data == SSH:
        return SSH[:-67] + string(b"p" * (63 + (rest - len(SSH)) % 3))
    if data == RSA:
        more = (rest - len(RSA)) % 3
        numbers = b"".join(integer(b"\1" * n) for n in (128, 3, 128, 64, 64, 64, 64, 64 + more))
        return tlv(0x30, integer(b"\0") + numbers)
    return tlv(0x30, ALGORITHM + tlv(4, b"\7" * (64 + (rest - len(ENCRYPTED)) % 3)))


@pytest.mark.parametrize("data", [RSA, ENCRYPTED, SSH])
@pytest.mark.parametrize("rest", [0, 1, 2])
def test_keys_among_other_lines(data, rest):
    data = sized(data, rest)
    assert len(data) % 3 == rest
    kind = "ssh" if data.startswith(b"openssh") else "der"
    plain = base64.b64encode(data).decode()
    wrapped = base64.encodebytes(data).decode().rstrip()
    for key in (plain, plain.rstrip("="), wrapped, wrapped.rstrip("=")):
        for newline in ("\n", "\r\n"):
            for indent in ("", "    ", "\t", " \t "):
                shown = key.replace("\n", newline + indent)
                word = "aWordOfMoreThanTwentyFourLetters"
                for before in ("", "see: ", word + newline, plain[:40] + newline):
                    for after in ("", f"{newline}The next line", f"{newline}{word}", f" {newline}  End"):
                        assert found(before + indent + shown + after) == [(kind, shown)]
    both = f"{plain.rstrip('=')}\n{plain.rstrip('=')}\nword"
    assert found(both) == [(kind, plain.rstrip("="))] * 2
    assert found(plain.rstrip("=") + "x\nword") == [] == found(plain[:-8] + "\nThe next line")


def test_blocks_of_lines_that_are_no_keys():
    assert found("\n".join(["MIT/////AAAA" + "A" * 52] * 20_000)) == []
    assert found("\n".join(["b3BlbnNzaC1rZXktdjEA" + "/" * 44] * 5_000)) == []
    assert found("MA" + "A" * 30 + "\nM" + "A" * 30 + "\n" + "M" * 25) == []


def test_redaction_of_an_unpadded_and_an_indented_key(spark):
    plain = base64.b64encode(sized(RSA, 1)).decode().rstrip("=")
    indented = base64.encodebytes(PKCS8).decode().strip().replace("\n", "\n    ")
    rows = [(1, f"{plain}\nThe next line"), (2, f"key: |\n    {indented}\nother: 1")]
    out = [r.text for r in sc.redact(documents(spark, rows)).collect()]
    assert out == ["[der secret]\nThe next line", "key: |\n    [der secret]\nother: 1"]
