import base64
import bz2
import gzip
import hashlib
import html
import json
import lzma
import random
import re
import time
import zlib
from urllib.parse import quote, quote_plus

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from brinewake.llm import license_scan, secret_scan

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def base_spans(t):
    s = [(m.start(), 0, m.end(), "assign") for m in re.finditer(ASSIGN, t, re.I | re.A) if len(m[2]) >= 6]
    s += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    s += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return [(a, k, e) for a, _, e, k in sorted(s)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "TOKEN", "api_key", "apikey", "secret", "=", ":", " ", '"', "'", "abcdef", "abc", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", "ſecret", "K", "\n", "%3D", "/"]), max_size=14).map("".join))
def test_base_rules_against_plain_patterns(text):
    assert secret_scan.scan_text(text) == base_spans(text)
    base, added, _ = secret_scan.scan(text)
    assert base == base_spans(text)
    assert not {(k, s, e) for k, _, s, e in added} & {(k, s, e) for s, k, e in base}


SECRET = "password=hunter2hunter2"


@pytest.mark.parametrize(
    ("wrap", "via"),
    [
        (lambda s: s.replace("=", "%3D"), "url"),
        (lambda s: "".join(f"\\u{ord(c):04x}" for c in s), "unicode"),
        (lambda s: "".join(f"&#{ord(c)};" for c in s), "unicode"),
        (lambda s: base64.b64encode(s.encode()).decode(), "base64"),
        (lambda s: base64.b64encode(gzip.compress(s.encode(), mtime=0)).decode(), "base64+compressed"),
        (lambda s: base64.urlsafe_b64encode(zlib.compress(s.encode())).decode(), "base64+compressed"),
        (lambda s: base64.b64encode(base64.b64encode(s.encode())).decode().replace("=", "%3D"), "base64+base64"),
    ],
)
def test_layers_are_unwrapped_and_mapped(wrap, via):
    coded = wrap(SECRET)
    text = f"some éarlier text {coded} and after"
    base, added, _ = secret_scan.scan(text)
    at = text.index(coded)
    hits = [x for x in added if x[0] == "assign"]
    assert any(via in x[1] for x in hits), added
    for _, _, s, e in hits:
        assert at <= s < e <= at + len(coded)


@pytest.mark.parametrize("size", [45, 48, 51, 54, 57])
@pytest.mark.parametrize(("before", "after"), [("", "Then more words"), ("", "then-some"), (hashlib.sha256(b"x").hexdigest() + "\n", ""), (hashlib.sha256(b"x").hexdigest() + "\n", "Then")])
def test_full_base64_lines_beside_other_lines(size, before, after):
    one = base64.b64encode(SECRET.ljust(size, " ").encode()).decode()
    two = base64.b64encode(b"n" * (size - 9)).decode() + base64.b64encode(b"n" * 9 + SECRET.encode().rjust(size)).decode()
    two = "\n".join(two[i : i + len(one)] for i in range(0, len(two), len(one)))
    for coded in (one, two):
        text = f"{before}{coded}\n{after}"
        hits = [x for x in secret_scan.scan(text)[1] if x[0] == "assign"]
        assert hits, text
        assert all(text.index(coded) <= s < e <= text.index(coded) + len(coded) for _, _, s, e in hits)


@pytest.mark.parametrize(
    "raw",
    [
        gzip.compress(zlib.compress(SECRET.encode())),
        gzip.compress(gzip.compress(gzip.compress(SECRET.encode()))),
        gzip.compress(b"one member ") + gzip.compress(SECRET.encode()),
        gzip.compress(b"one member ") + zlib.compress(SECRET.encode()),
        bz2.compress(b"one member ") + bz2.compress(SECRET.encode()),
        b"\0" + SECRET.encode() + b"\0\x07",
        b"\xff\xfe\xe9 " + SECRET.encode() + b"\x80",
        SECRET.encode("utf-16"),
        SECRET.encode("utf-16-be"),
        gzip.compress(b"\1" + SECRET.encode("utf-16-le")),
    ],
)
def test_bytes_are_inflated_to_the_end_and_read(raw):
    coded = base64.b64encode(raw).decode()
    hits = [x for x in secret_scan.scan(f"see {coded} end")[1] if x[0] == "assign"]
    assert hits
    assert all(4 <= s < e <= 4 + len(coded) for _, _, s, e in hits)


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, lambda x: gzip.compress(zlib.compress(x))])
@pytest.mark.parametrize("escape", [quote, quote_plus, lambda r: repr(r), lambda r: "".join(f"\\x{c:02x}" for c in r), lambda r: "".join(f"%{c:02x}" for c in r), lambda r: "".join(f"&#{c};" for c in r), lambda r: json.dumps(r.decode("latin-1"))])
def test_compressed_bytes_behind_escapes(pack, escape):
    coded = escape(pack(b"some words before it " + SECRET.encode()))
    hits = [x for x in secret_scan.scan(f"see data={coded} end")[1] if x[0] == "assign"]
    assert hits
    assert all(9 <= s < e <= 9 + len(coded) for _, _, s, e in hits)


def test_span_of_a_part_of_a_base64_run_is_narrow():
    coded = base64.b64encode(b"nothing to see here, then token=abcdefghij").decode()
    (kind, _, s, e), *_ = secret_scan.scan(coded)[1]
    assert kind == "assign"
    assert s >= len("nothing to see here, then ") * 4 // 3 - 2
    assert e <= len(coded)


def test_cycles_end_and_bombs_are_reported():
    assert secret_scan.scan("%2525252525")[2] >= 4
    bomb = base64.b64encode(gzip.compress(b"a" * (1 << 23))).decode()
    assert ("oversize", "base64+compressed", 0, len(bomb)) in secret_scan.scan(bomb, 1000, 1 << 21)[1]
    assert secret_scan.scan("%26%231;") == ([], [], 3)


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, lambda x: zstandard.compress(x), lambda x: gzip.compress(b"first member ") + gzip.compress(x)])
def test_layers_beyond_the_held_bytes_are_read_as_streams(pack):
    """The secret stands across an edge of two blocks, and far behind the bytes that are held at once."""
    raw = b"plain words " * 90_000
    raw = raw[: (1 << 20) - 10] + SECRET.encode() + b" more" * 300_000
    coded = base64.b64encode(pack(raw)).decode()
    added = secret_scan.scan(f"see {coded} end", held_bytes=10_000)[1]
    assert [x for x in added if x[0] == "assign"] and not [x for x in added if x[0] == "oversize"]
    assert all(4 <= s < e <= 4 + len(coded) for _, _, s, e in added)


@pytest.mark.parametrize(
    ("chain", "n"),
    [
        (lambda n: "password%" + "25" * n + "3Dhunter2hunter2", 50_000),
        (lambda n: "password\\x5c" + "x5c" * n + "x3Dhunter2hunter2", 30_000),
        (lambda n: "password&#38;" + "#38;" * n + "#61;hunter2hunter2", 30_000),
        (lambda n: "password" + "%5c" + "x25" + "5cx25" * n + "3Dhunter2hunter2", 20_000),
        (lambda n: "&" * n + "&#1;" + "#1;" * n + "password&#61;hunter2hunter2", 20_000),
    ],
)
def test_deep_nesting_costs_its_length(chain, n):
    text = chain(n)
    began = time.process_time()
    added = secret_scan.scan(text)[1]
    assert time.process_time() - began < 30
    (hit, *_) = [x for x in added if x[0] == "assign"]
    assert text[hit[2] :].startswith("password") and hit[3] == len(text)


PIECES = ["password", "%3D", "=", "%253D", "\\x3d", "&#61;", "\\u003D", "%5Cx3d", "hunter2hunter2", " ", "%20", "%25", "25", "AKIA", "ABCDEFGH12345678", "%41", "&#x4B;", "IA", "0123456789abcdef", "%66", "\\u{66}", "\n", "é", "%C3%A9", "%"]


def one_level(t):
    """All layers a level of whole-text decoding away, by the plainest of means."""
    yield re.sub(r"(?:%[0-9A-Fa-f]{2})+", lambda m: (raw := bytes.fromhex(m[0].replace("%", ""))) and (raw.decode() if not _bad(raw) else raw.decode("latin-1")), t)
    code = r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
    t = re.sub(code, lambda m: chr(int(next(filter(None, m.groups())), 16)), t)
    yield re.sub(r"&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};", lambda m: html.unescape(m[0]), t)


def _bad(raw):
    try:
        raw.decode()
    except UnicodeDecodeError:
        return True


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_every_layer_is_scanned(text):
    """Whatever fires in some layer of a plain breadth-first decoding is reported as such a kind."""
    seen, work, kinds = {text}, [text], set()
    while work:
        for new in one_level(work.pop()):
            if new not in seen:
                seen.add(new)
                work.append(new)
                kinds |= {k for _, k, _ in base_spans(new)}
    base, added, _ = secret_scan.scan(text)
    assert kinds <= {k for _, k, _ in base} | {k for k, *_ in added}


def test_secret_edges(spark, edge, nothing):
    got = secret_scan.scan_secrets(edge).collect()
    assert len(got) == edge.count()
    assert all(r["base_sha256"] == hashlib.sha256(b"").hexdigest() and r["spans"] == "" for r in got)
    assert secret_scan.scan_secrets(nothing).count() == 0


def words_of(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))


def test_license_against_brute_force(spark):
    rng = random.Random(3)
    pool = ["MIT", "License", "license,", "apache", "General", "public", "é", "word", "(mit)", "LICENSE", "-", "\n", "x1"]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(0, 30))) for _ in range(150)]
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        w = words_of(t)
        hits = sorted((j, lab) for p, lab in license_scan.BASE.items() for j in range(len(w)) if w[j : j + len(p.split())] == p.split())
        r = got[i]
        assert (r["n_words"], r["n_base"]) == (len(w), len(hits))
        assert (r["first_word"], r["last_word"]) == ((hits[0][0], hits[-1][0]) if hits else (None, None))
        assert r["base_labels"] == ",".join(sorted({h[1] for h in hits}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


@pytest.mark.parametrize(
    ("expression", "named", "allowed"),
    [
        ("mit", {"mit"}, True),
        ("gpl-2.0-only or mit", {"gpl", "mit"}, True),
        ("gpl-2.0-only and mit", {"gpl", "mit"}, False),
        ("mit or gpl-2.0 and agpl-3.0", {"mit", "gpl", "agpl"}, True),
        ("(mit or gpl-2.0) and agpl-3.0", {"mit", "gpl", "agpl"}, False),
        ("gpl-2.0-or-later with classpath-exception-2.0 or apache-2.0", {"gpl", "apache"}, True),
        ("lgpl-2.1+ and (bsd-3-clause or isc)", {"lgpl", "bsd", "isc"}, False),
    ],
)
def test_expressions(expression, named, allowed):
    postfix, text = license_scan.to_postfix(expression)
    assert text.replace(" ", "") == expression.replace(" ", "")
    assert license_scan.evaluate(postfix, frozenset(license_scan.ALLOWED)) == (named, allowed)


def test_expressions_in_text_and_broken_ones(spark):
    texts = ["// SPDX-License-Identifier: MIT OR GPL-2.0-only\ncode", "SPDX-License-Identifier: AND MIT", "License: MIT and then something else", "nothing"]
    got = {r["doc_id"]: r for r in license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert (got[0]["labels"], got[0]["score"], got[0]["allowed"], got[0]["expressions"]) == ("gpl,mit", 1.0, True, ["mit or gpl-2.0-only"])
    assert got[1]["expressions"] == []
    assert got[2]["expressions"] == ["mit"]
    assert (got[3]["labels"], got[3]["score"], got[3]["allowed"]) == ("", 0.0, None)


def test_license_edges(edge, nothing):
    got = license_scan.scan_licenses(edge).collect()
    assert len(got) == edge.count()
    assert {r["doc_id"]: r["n_words"] for r in got}[4] == 140_000
    assert license_scan.scan_licenses(nothing).count() == 0
