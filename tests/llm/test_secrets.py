"""Secret scans: base patterns as written down, planted secrets below layers of encodings, odd rows."""

import base64
import gzip
import random
import re
import zlib
from urllib.parse import quote

import pytest

from weektide.llm.secrets import base_spans, redacted, scan_text, secret_spans

SECRET = "password=hunter2secret"
PLAIN = {
    0: re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
    1: re.compile(r"(AKIA[A-Z0-9]+)"),
    2: re.compile(r"([0-9a-f]+)"),
}
LEAST = (6, 20, 24)


def plain(text):
    return sorted((m.start(), k, m.end()) for k, p in PLAIN.items() for m in p.finditer(text) if len(m[1]) >= LEAST[k])


def test_base_equals_the_patterns():
    pick = random.Random(8)
    bits = ["password", "PassWd", "secret", "ſecret", "TOKEN", "api_key", "apiKey", "toKen", ":", "=", " ", '"', "'", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "f", "x", ".", "-", "\n", "é"]
    for _ in range(5000):
        text = "".join(pick.choice(bits) for _ in range(pick.randrange(14)))
        assert base_spans(text) == plain(text), text


def b64(data):
    return base64.b64encode(data if isinstance(data, bytes) else data.encode()).decode()


@pytest.mark.parametrize(
    "hidden",
    [
        b64(SECRET),
        base64.urlsafe_b64encode(f"{SECRET}??>>".encode()).decode(),
        b64(b64(SECRET)),
        b64(gzip.compress(SECRET.encode())),
        b64(zlib.compress(b64(gzip.compress(SECRET.encode())).encode())),
        b64(quote(b64(SECRET), safe="") + "%20"),
        "".join(f"\\u{ord(c):04x}" for c in SECRET),
        "".join(f"&#{ord(c)};" for c in SECRET),
        "".join(f"%{ord(c):02X}" for c in SECRET),
        "".join(f"%25{ord(c):02X}" for c in SECRET),
        "".join(f"%{ord(c):02x}" for c in "".join(f"\\x{ord(c):02x}" for c in SECRET)),
    ],
)
def test_finds_what_layers_hide(hidden):
    for before, after in (("", ""), ("é😀 plain ", " token: abcdef end")):
        base, spans, layers, unread = scan_text(f"{before}{hidden}{after} {hidden}")
        assert unread == 0 and layers > 0 and set(base) <= set(spans)
        second = len(before) + len(hidden) + len(after) + 1
        for at in (len(before), second):
            assert any(k == 0 and at <= a and at + len(hidden) >= b for a, k, b in spans), (at, spans)


def test_maps_single_characters():
    text = "x%20%41 token%3Dabcdefg y"
    assert scan_text(text)[1] == [(8, 0, 23)]


def test_ends_and_limits():
    assert scan_text(b64("x" * 40) + b64(b"\x1f\x8b broken data and more"))[1] == []
    large = b64(zlib.compress(b"z " * 2500 + SECRET.encode()))
    assert scan_text(large, limit=1000)[3] == 1
    assert scan_text(large)[3] == 0 and len(scan_text(large)[1]) == 1
    assert scan_text("%" * 50 + "\\u{110000} &#0; \\ud800 %ff%fe")[1] == []


def covered(text, hidden):
    at = text.index(hidden)
    return [s for s in scan_text(text)[1] if s[1] == 0 and at <= s[0] and s[2] <= at + len(hidden)]


def wrapped(data, width, end="\n"):
    text = b64(data)
    return end.join(text[k : k + width] for k in range(0, len(text), width))


NOISE = "".join(random.Random(3).choices("ghijkl mnop", k=3000))


@pytest.mark.parametrize("width", [20, 64, 76])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
def test_runs_go_over_line_ends(width, end):
    for data in (NOISE[:41] + SECRET, gzip.compress((NOISE + SECRET).encode()), zlib.compress((NOISE + SECRET).encode())):
        hidden = wrapped(data, width, end)
        assert covered(f"key:\n{hidden}\n\nend of it", hidden)
        assert covered(f"word {hidden} word", hidden)


def test_runs_behind_separators():
    for before in ("https://example/cb/", "x/", "ab_", "abc-", "a/bc/d_"):
        for data in (SECRET, gzip.compress(SECRET.encode()), zlib.compress(SECRET.encode())):
            at, text = len(before), before + b64(data)
            assert any(k == 0 and a <= at and b == len(text) for a, k, b in scan_text(text)[1]), before


def test_other_bytes_and_members():
    assert covered(b64(b"\xff" * 50 + SECRET.encode() + b"\xfe"), b64(b"\xff" * 50 + SECRET.encode() + b"\xfe"))
    assert scan_text("%FF" + "".join(f"%{ord(c):02X}" for c in SECRET))[1]
    members = b64(gzip.compress(b"nothing") + gzip.compress(NOISE.encode()) + b"\0\0" + gzip.compress(SECRET.encode()))
    assert covered(members, members)
    broken = b64(gzip.compress((SECRET + NOISE).encode())[:-9])
    assert covered(broken, broken)


def test_large_layers_are_read(monkeypatch):
    for name, value in (("LAYER_BYTES", 20000), ("PIECE", 700), ("WINDOW", 5000), ("OVERLAP", 1000)):
        monkeypatch.setattr(f"weektide.llm.secrets.{name}", value)
    pick = random.Random(4)
    letters = lambda n: "".join(pick.choice("ghijkl mnop\n") for _ in range(n))
    packed = gzip.compress((letters(30000) + SECRET).encode())
    deep, in_lines = b64(packed), wrapped(packed, 76)
    assert len(deep) > 9000
    for inside in (SECRET, b64(SECRET), quote(b64(SECRET), safe="") + "%20", b64(gzip.compress(SECRET.encode())), deep, in_lines, f"password{' ' * 9000}= abcdefg"):
        for before in (0, 4990, 31234):
            data = f"{letters(before)} {inside} {letters(30000)}".encode()
            packed = b64(zlib.compress(gzip.compress(data)) if before else gzip.compress(data))
            _, spans, _, unread = scan_text(f"see {packed} end")
            assert unread == 0 and (4, 0, 4 + len(packed)) in spans, (inside[:40], before)
    plain = f"see {b64(gzip.compress(letters(60000).encode()))} end"
    assert scan_text(plain)[1] == [] and scan_text(plain)[3] == 0


def test_a_layer_beyond_the_old_bound():
    hidden = b64(gzip.compress(b"." * (66 << 20) + b" " + SECRET.encode()))
    assert scan_text(hidden)[1] == [(0, 0, len(hidden))] and scan_text(hidden)[3] == 0


def test_unread_runs_are_replaced(spark):
    hidden = b64(zlib.compress(b"z " * 2500 + SECRET.encode()))
    docs = spark.createDataFrame([(f"see {hidden} end",)], "text string")
    assert redacted(docs, limit=1000).first().text == redacted(docs).first().text == "see [secret] end"


def test_table(spark):
    rows = [(1, None, 5), (2, "", 5), (None, f"a {SECRET}", 5), (4, f"{b64(SECRET)} x", 5), (4, f"{b64(SECRET)} x", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = {(r.doc_id, len(r.base), len(r.spans)) for r in secret_spans(docs).collect()}
    assert got == {(1, 0, 0), (2, 0, 0), (None, 1, 1), (4, 0, 1)}
    clean = sorted(map(tuple, redacted(docs).collect()), key=str)
    assert clean == sorted([(1, None, 5), (2, "", 5), (None, "a [secret]", 5), (4, "[secret] x", 5), (4, "[secret] x", 5)], key=str)
    assert secret_spans(docs.where("false")).collect() == []
