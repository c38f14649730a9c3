import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib

import pytest
import zstandard

from docketry.llm import secrets

SECRET = "password: hunter2hunter2"
HEX = "0123456789abcdef" * 2
b64 = lambda data: base64.b64encode(data if isinstance(data, bytes) else data.encode()).decode()


def brute(text):
    """The base findings by the plain definition: match, then drop what is too short."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(secrets.KINDS[k], a, b) for a, k, b in sorted(found)]


@pytest.mark.parametrize(
    "text",
    [
        "", "password: token = abcdefghij", "API_KEY='abc' apikey=\"12345678\"", "tokenſecret=abcdefgh", "AKIA" + "A" * 11, "AKIAAKIA" + "B" * 12 + " AKIAx", HEX + "g" + HEX[:-1],
        "secret=" + HEX, "é token = " + HEX, "token=token=abcdefgh", "PASSWD  :  '" + "x" * 9,
    ],
)
def test_base_findings(text):
    assert secrets.find(text) == brute(text)
    assert secrets.spans(text)[0] == brute(text)
    assert set(brute(text)) <= set(secrets.spans(text)[1])


@pytest.mark.parametrize(
    "wrap",
    [
        b64, lambda s: b64(b64(s)), lambda s: "".join(f"\\u{ord(c):04x}" for c in s), lambda s: "".join(f"&#{ord(c)};" for c in s), lambda s: "".join(f"%{ord(c):02X}" for c in s),
        lambda s: urllib.parse.quote(b64(gzip.compress(s.encode())), safe=""), lambda s: b64(zlib.compress(s.encode())), lambda s: b64(bz2.compress(s.encode())), lambda s: b64(lzma.compress(s.encode())),
        lambda s: b64(zstandard.compress(s.encode())), lambda s: b64(gzip.compress(zlib.compress(s.encode()))), lambda s: s.encode().hex().upper(), lambda s: b64(urllib.parse.quote(s)),
        lambda s: "".join(f"%{b:02x}" for b in "".join(f"\\x{ord(c):02x}" for c in b64(s)).encode()), lambda s: base64.urlsafe_b64encode(gzip.compress(s.encode())).decode(),
    ],
)
def test_layers_are_unwrapped_to_spans_of_the_original(wrap):
    for before in ("", "é 漢 "):
        text = f"{before}<{wrap(SECRET)}> end"
        base, every = secrets.spans(text)
        hits = [(a, b) for kind, a, b in every if kind == "assign" and (kind, a, b) not in base]
        start, end = len(before) + 1, len(before) + 1 + len(wrap(SECRET))
        assert hits and all(start <= a < b <= end for a, b in hits)
        assert "hunter2" not in str(secrets.spans(secrets.redacted(text, every)))


def test_spans_inside_a_layer_are_as_narrow_as_the_encoding_allows():
    text = b64("x" * 30 + " " + SECRET + " " + "y" * 30)
    (kind, a, b), = secrets.spans(text)[1]
    assert kind == "assign" and 30 <= a <= 44 and 70 <= b <= 84
    text = "a%20" + "".join(f"%{ord(c):02x}" for c in SECRET) + "%20 z"
    assert secrets.spans(text)[1] == [("assign", 4, 4 + 3 * len(SECRET))]


def test_cycles_and_bombs_end():
    assert secrets.spans(b64(gzip.compress(b"z" * 10_000_000)), max_layer_bytes=1000) == ([], [])
    nested = SECRET
    for _ in range(12):
        nested = b64(nested)
    assert secrets.spans(nested)[1]
    assert secrets.spans("%25" * 500 + "41")[0] == []


def test_table(documents, odd_texts):
    rows = [(k if k != 4 else None, t) for k, t in enumerate([*odd_texts, SECRET, b64(SECRET), SECRET])]
    out = sorted(secrets.scan(documents(rows)).collect(), key=lambda r: -1 if r.doc_id is None else r.doc_id)
    rows.sort(key=lambda r: -1 if r[0] is None else r[0])
    assert len(out) == len(rows)
    for r, (doc_id, text) in zip(out, rows, strict=True):
        base = brute(text or "")
        kinds = [k for k, _, _ in base]
        assert (r.doc_id, r.n_assign, r.n_access, r.n_hex) == (doc_id, *(kinds.count(k) for k in secrets.KINDS))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert r.spans == secrets.listed(secrets.spans(text or "")[1])
    assert secrets.scan(documents([])).count() == 0


def test_redaction_keeps_rows_and_columns(documents):
    table = documents([(1, None), (2, "clean"), (3, f"a {SECRET} b {HEX}"), (3, f"a {SECRET} b {HEX}")])
    out = secrets.redact(table)
    assert out.schema == table.schema
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out.collect() if r.doc_id > 1) == [(2, "clean", 5), (3, "a [SECRET] b [SECRET]", 21), (3, "a [SECRET] b [SECRET]", 21)]


LONG = f"{'x y ' * 40}{SECRET}{' y z' * 40}"


@pytest.mark.parametrize("packed", [LONG.encode(), gzip.compress("".join(hashlib.sha256(bytes([k])).hexdigest()[:20] + "\n" for k in range(40)).encode() + SECRET.encode())])
@pytest.mark.parametrize("wrap", [lambda d: base64.encodebytes(d).decode(), lambda d: base64.encodebytes(d).decode().replace("\n", "\r\n  "), lambda d: base64.encodebytes(d).decode().replace("\n", "\\n")])
def test_wrapped_base64_is_joined(packed, wrap):
    for before, after in (("", ""), ("see attached\n", "\nRegards")):
        text = f"{before}{wrap(packed)}{after}"
        every = secrets.spans(text)[1]
        assert any(kind == "assign" for kind, _, _ in every)
        assert not any(kind == "assign" for kind, _, _ in secrets.spans(secrets.redacted(text, every))[1])


@pytest.mark.parametrize("before", ["/", "a/", "ab-", "abc_", "name-", "https://host/path/segment/", "x" * 17 + "/", "x" * 18 + "-", "x" * 19 + "_"])
@pytest.mark.parametrize("packed", [SECRET.encode(), zlib.compress(SECRET.encode()), b"\xe9" + SECRET.encode()])
def test_base64_after_a_path_or_a_name(before, packed):
    text = f"{before}{b64(packed)} end"
    hits = [(a, b) for kind, a, b in secrets.spans(text)[1] if kind == "assign"]
    assert hits and all(len(before) <= a + 4 and a < b <= len(text) - 4 for a, b in hits)
    hexed = f"{before}{packed.hex()} end"
    assert any(kind == "assign" for kind, _, _ in secrets.spans(hexed)[1])


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress])
def test_every_stream_is_read(pack):
    for parts in ([b"first line of a log\n", SECRET.encode()], [SECRET[:12].encode(), SECRET[12:].encode()], [b"a log\n"] * 40 + [SECRET.encode()]):
        data = b"".join(pack(p) for p in parts)
        for whole in (data, pack(data), b"\0\xff" * 8 + data + b"\xff\0" * 8):
            assert any(kind == "assign" for kind, _, _ in secrets.spans(b64(whole))[1])


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress])
def test_large_layers_are_read_to_their_end(pack):
    for shift in range(0, 1200, 97):
        text = "é漢" * 500 + "." * shift + " " + SECRET + " " + "漢é" * 500
        assert any(kind == "assign" for kind, _, _ in secrets.spans(b64(pack(text.encode())), max_layer_bytes=1001)[1])
    assert any(kind == "assign" for kind, _, _ in secrets.spans(b64(pack(b"\xc3\xa9" * 3_000_000 + SECRET.encode())), max_layer_bytes=1 << 20)[1])


@pytest.mark.parametrize("form, bad", [("%{:02x}", "%E9"), ("\\x{:02x}", "\\xe9"), ("\\u{:04x}", "\\ud83d")])
def test_a_bad_byte_leaves_the_rest_of_a_run_decoded(form, bad):
    run = "".join(form.format(b) for b in SECRET.encode())
    for before, after in ((bad, ""), ("", bad), (bad, bad + bad)):
        text = f"{before}{run}{after}"
        assert [s for s in secrets.spans(text)[1] if s[0] == "assign"] == [("assign", len(before), len(before) + len(run))]
    assert secrets.spans(bad * 3) == ([], [])


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress])
@pytest.mark.parametrize(
    "wrap",
    [
        lambda d: "".join(f"%{b:02x}" for b in d), lambda d: "".join(f"\\x{b:02X}" for b in d), urllib.parse.quote, urllib.parse.quote_plus, repr,
        lambda d: urllib.parse.quote("".join(f"\\x{b:02x}" for b in d)), lambda d: b64("".join(f"%{b:02X}" for b in d)),
    ],
)
def test_compressed_bytes_in_escapes(pack, wrap):
    text = f"é <{wrap(pack(SECRET.encode() + b' of the house'))}> end"
    every = secrets.spans(text)[1]
    assert any(kind == "assign" for kind, _, _ in every)
    assert not any(kind == "assign" for kind, _, _ in secrets.spans(secrets.redacted(text, every))[1])


PLAIN = b"password: hunter2hunter2"


def test_layers_that_are_easily_lost():
    """Each hides the same secret; spans lie within the part that holds it, and cover what is needed to read it."""
    b64 = lambda data: base64.b64encode(data).decode()
    wrapped = lambda text: "\n".join(text[i : i + 64] for i in range(0, len(text), 64))
    filler = bytes(random.Random(1).randbytes(150)).hex().replace("a", "g").encode()
    cases = {
        "after a path": ("https://h.io/a/", b64(PLAIN)), "after letters": ("abc", b64(PLAIN)), "wrapped gzip": ("", wrapped(b64(gzip.compress(filler + PLAIN)))),
        "second gzip member": ("", b64(gzip.compress(b"nothing here") + gzip.compress(PLAIN))), "second bz2 stream": ("", b64(bz2.compress(b"nothing") + bz2.compress(PLAIN))),
        "second xz stream": ("", b64(lzma.compress(b"nothing") + lzma.compress(PLAIN))), "second zstandard frame": ("", b64(zstandard.compress(b"nothing") + zstandard.compress(PLAIN))),
        "utf-16": ("", b64(PLAIN.decode().encode("utf-16-le"))), "utf-16 big": ("", b64(PLAIN.decode().encode("utf-16-be"))), "utf-16 with a mark": ("", b64(PLAIN.decode().encode("utf-16"))), "utf-32": ("", b64(PLAIN.decode().encode("utf-32"))),
        "utf-16 in gzip": ("", b64(gzip.compress(PLAIN.decode().encode("utf-16")))), "odd bytes": ("", b64(b"\xff\xfe\x80" + PLAIN + b"\xe9")), "gzip as JSON escapes": ("", "".join(f"\\u{c:04x}" for c in gzip.compress(PLAIN))),
    }
    for name, (before, hidden) in cases.items():
        text = f"x {before}{hidden} y"
        base, every = secrets.spans(text)
        found = [s for s in every if s not in base and s[0] == "assign"]
        assert found, name
        lo, hi = 2 + len(before), 2 + len(before) + len(hidden)
        assert all(lo - 4 <= a < b <= hi for _, a, b in found), (name, found)
        masked = secrets.redacted(text, every)
        assert not any(s[0] == "assign" for s in secrets.spans(masked)[1]), name


def test_spans_of_wide_signs_are_exact():
    text = "k=" + base64.b64encode(("é" * 8 + PLAIN.decode() + " , " + "z" * 9).encode("utf-16-be")).decode()
    (span,) = [s for s in secrets.spans(text)[1] if s[0] == "assign"]
    first = 16  # bytes before the secret
    assert span[1:] == (2 + first // 3 * 4, 2 + -(-(first + 2 * len(PLAIN)) // 3) * 4)


def test_masking_edges(documents):
    long = "password: hunter2hunter2 " + "lorem ipsum " * 100_000
    out = {r.doc_id: r for r in secrets.redact(documents([(1, None), (2, ""), (3, long), (3, long)])).collect()}
    assert out[1].text is None and out[2].text == "" and out[3].text.startswith("[SECRET] lorem") and out[3].n_chars == len(out[3].text)
    assert secrets.redact(documents([])).count() == 0
