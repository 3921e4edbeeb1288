"""The training-data operators against brute force on small tables, and their edge cases."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import corpus_pipeline
from lakeloom.llm import licenses, mixing, neardup, pagetext, pieces, quality, queries, secretscan, suffixdedup, topk, urlfilter

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, rk int, n int, host int"
ROWS = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, " \n\t", "en", "a", 3), (3, "one two", "en", None, 7), (3, "one two", "en", None, 7), (4, "w " * 3000, "en", "b", 6000), (5, "É ▁   \x0b x", "fr", "b", 9)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, "k", 1, 2, 3) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_near_duplicates(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rng = random.Random(3)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    for k in range(60):  # one large group of near copies
        copy = list(base)
        for _ in range(rng.randrange(0, 4)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(9999)}"
        rows.append((10_000 + k, " ".join(copy)))
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b]) if sets[a] and sets[b] else 0
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == sorted((d, len(sets[d]), find(d), find(d) == d) for d in sets)


def test_pipeline_drops_near_duplicates_from_80_percent(spark):
    words = [f"w{k}" for k in range(100)]
    copy = [f"x{k}" if k in (30, 60) else w for k, w in enumerate(words)]  # 86 of 106 shingles: 0.81
    rows = [(k, " ".join(w), "en", "a", len(" ".join(w))) for k, w in enumerate((words, copy))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()] == [0]
    assert neardup.near_duplicates(docs, num=85, den=100).where("kept").count() == 2


def brute_repeats(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (d, _), raw in zip(rows, raws, strict=True):
        mask = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                mask[i : i + length] = b"\1" * length
        runs = sum(1 for k in range(len(raw)) if mask[k] and not (k and mask[k - 1]))
        out.append((d, len(raw), sum(mask), runs, hashlib.sha256(bytes(x for x, m in zip(raw, mask, strict=True) if not m)).hexdigest()))
    return out


@pytest.mark.parametrize("budget", [64 << 20, 4000])
def test_suffix_dedup(spark, budget):
    rng = random.Random(5)
    base = [" ".join(rng.choice(["the", "of", "ab", "aaaa", "é"]) for _ in range(200)) for _ in range(4)]
    rows = [(None, None), (1, ""), (2, "a" * 300), (3, "ab" * 200), (3, "ab" * 200)]
    for k in range(40):
        a = rng.randrange(0, 300)
        rows.append((10 + k, "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 90))) + rng.choice(base)[a : a + rng.randrange(30, 260)] + str(k)))
    got = suffixdedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 64, budget).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_repeats(rows, 64)))


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(300)] + [(500 + i, [0.5] * 8) for i in range(40)] + [(900, None), (901, [float("nan")] * 8), (None, [1.0] * 8), (950, [1.0, 2.0])]
    rows += [rows[0]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect())
    able = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows if i is not None and v and len(v) == 8 and np.isfinite(v).all()}
    want = []
    for q in [i for i in able if i % 50 == 0]:
        best = sorted((-int(able[q] @ v), i) for i, v in able.items() if i != q)[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_quality(spark, docs):
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    for d in docs.select("doc_id", "text").collect():
        w = words(d.text)
        tri = Counter(zip(w, w[1:], w[2:]))
        covered = {i + j for i, t in enumerate(zip(w, w[1:], w[2:])) if tri[t] > 1 for j in range(3)}
        lines = [x for x in (d.text or "").split("\n") if words(x)]
        r = got[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", d.text)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.base_failed and r.kept)
    kept = sorted(d for d, r in got.items() if r.kept)
    names = sorted(quality.rules_on(F.lit(None)))
    for order in (None, names, names[::-1]):
        assert sorted(r.doc_id for r in quality.kept_rows(docs, order).select("doc_id").collect()) == kept


def test_secrets():
    key = "AKIA" + "A" * 16
    inner = base64.b64encode(gzip.compress(f"password = {'q7' * 10}".encode())).decode()
    base, spans, layers, _ = secretscan.find(f"x {key} y")
    assert base == spans == [(2, 1, 22)] and layers == 0
    base, spans, layers, _ = secretscan.find(f"see {inner} end")
    assert base == [] and spans == [(4, 0, 4 + len(inner.rstrip("=")))] and layers == 1
    text = "tok%65n%3Dabcdefghijklmnop"
    assert secretscan.find(text)[1] == [(0, 0, len(text))]
    assert secretscan.hide(f"a {key} b") == "a [secret] b"
    assert secretscan.find("\\u0070assword: 123456789012")[1] == [(0, 0, 27)]


def plain_scan(text):
    """The contract's base spans by one scan of the whole text with another regular-expression engine."""
    kinds = ((r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12), (r"AKIA[A-Z0-9]+", 0, 18), (r"[0-9a-f]+", 0, 16))
    return sorted((m.start(), k, m.end()) for k, (pattern, group, least) in enumerate(kinds) for m in regex.finditer(pattern, text) if len(m.group(group)) >= least)


def test_secrets_equal_a_plain_scan(spark, docs):
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    rng = random.Random(11)
    bits = ["password", "PassWd", "ſecret", "toKen", "api_key", "APIKEY", '"', "'", " ", "  ", ":", "=", "AKIA", "A" * 14, "A" * 13, "0a" * 8, "0a" * 7, "f", "Z9", "+/", "_-.", "é", "\n", "%41", "\\u0041"]
    texts |= {10_000 + k: "".join(rng.choice(bits) for _ in range(rng.randrange(0, 40))) for k in range(1500)}
    got = {r.doc_id: r for r in secretscan.find_secrets(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)).collect()}
    found = Counter()
    for d, text in texts.items():
        base = plain_scan(text)
        r = got[d]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for _, k, _ in base) for kind in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{secretscan.KINDS[k]}:{a}:{b}" for a, k, b in base).encode()).hexdigest()
        spans = [(int(a), secretscan.KINDS.index(k), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert spans == sorted(set(spans)) and set(base) <= set(spans) and all(0 <= a < b <= len(text) for a, _, b in spans)
        found.update(k for _, k, _ in base)
    assert min(found[k] for k in range(3)) > 50


def test_secrets_in_random_nestings():
    wraps = {
        "percent": lambda s: "".join(f"%{b:02X}" for b in s.encode()),
        "unicode": lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
        "base64": lambda s: base64.b64encode(s.encode()).decode().rstrip("="),
        "gzip": lambda s: base64.b64encode(gzip.compress(s.encode(), mtime=0)).decode().rstrip("="),
    }
    rng = random.Random(7)
    for _ in range(300):
        secret = "secret=" + "".join(rng.choice("ghijkmnpqrstuvwxyz") for _ in range(rng.randrange(12, 30)))
        wrapped, chain = secret, [rng.choice(sorted(wraps)) for _ in range(rng.randrange(1, 4))]
        for name in chain:
            wrapped = wraps[name](wrapped)
        before = "é then " * rng.randrange(0, 3)
        spans = secretscan.find(f"{before}{wrapped} end")[1]
        assert any(k == 0 and len(before) <= a < b <= len(before) + len(wrapped) for a, k, b in spans), chain
        hidden = secretscan.hide(f"{before}{wrapped} end")
        assert not any(k == 0 for _, k, _ in secretscan.find(hidden)[1]), chain


def test_secrets_in_layers_of_any_characters():
    secret = b"password = " + b"q7" * 10
    b64 = lambda raw: base64.b64encode(raw).decode().rstrip("=")
    noise = random.Random(5).randbytes(1 << 16)
    encoded = [
        b64("d\u00e9j\u00e0\u00a0vu ".encode() + secret), b64(b"\xef\xbb\xbf" + secret), b64(b"page\x0c" + secret), b64(b"\xff\xfe" + secret),
        b64(gzip.compress(b"caf\xe9 " + secret)), b64(gzip.compress(noise + b" " + secret + b" " + noise)),
        *(b64(pack(b"first") + pack(secret)) for pack in (gzip.compress, bz2.compress, lzma.compress)),
        *("x" * k + b64(secret + b" ok") for k in range(1, 4)), *("x" * k + b64(gzip.compress(secret)) for k in range(1, 9)), b64(secret + b"!!") + "x",
        b64("x password = ".encode("utf-16") + (b"q7" * 10).decode().encode("utf-16-le")), b64(secret.decode().encode("utf-16-be")), b64(gzip.compress(secret.decode().encode("utf-16-le"))), b64(secret + b"\0\0"),
        "".join(f"%u{c:04X}" for c in secret), "host/" + b64(secret), "id-" + b64(secret),
        "%FF" + "".join(f"%{c:02x}" for c in secret) + "%C3",
        b64(gzip.compress(b"ab, cd\0" * (12 << 20) + secret)),  # 84 MB unpacked
        b64(gzip.compress(gzip.compress(b"ab, cd\0" * (1 << 20) + secret + b"\n" + b"fgh, " * (1 << 18)))),
    ]
    for text in encoded:
        base, spans, layers, unopened = secretscan.find(f"see {text} end")
        assert not [s for s in base if s[1] == 0] and unopened == 0 and layers >= 1, text[:60]
        assert any(kind == 0 and 4 <= a < b <= 4 + len(text) for a, kind, b in spans), text[:60]
    long = b"a" * (3 << 20) + b" password = " + b"q" * (3 << 20) + b"\n"
    assert b"".join(secretscan._blocks(iter([long[k : k + 1000] for k in range(0, len(long), 1000)]))) == long
    assert secretscan.find(b64(gzip.compress(b"!" * (1 << 20) + long)))[1][0][1] == 0


def test_places_of_a_long_token():
    token = base64.b64encode(b"password = " + b"q7" * 10 + b" " * 3_000_000).decode().rstrip("=")
    assert secretscan.find(f"see {token} end")[1] == [(4, 0, 4 + 42)]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        db.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = queries.queries()[name](spark, SF)
    cols = sorted(df.columns)
    found = db.execute(queries.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    want = sorted(repr(tuple(r[names.index(c)] for c in cols)) for r in found.fetchall())
    assert want and sorted(repr(tuple(r)) for r in df.select(*cols).collect()) == want


def test_url_filter(spark):
    urls = ["http://a.Example.com/en/71?x", "https://example.com/en/6", "http://www.spam-farm.example.org/x/", "http://x.net/de/1", "http://example.net/de/8", None, "nothing", "http://org/es/1#a", "http://spam-farm.example.org.net/"]
    listed = spark.createDataFrame([("HTTP://Spam-Farm.example.org",), (None,)], "entry string")
    got = {r.page_id: r for r in urlfilter.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), listed).collect()}
    assert [(got[i].rule, got[i].verdict) for i in range(9)] == [("example.com/en/7", "allow"), ("com/en/", "block"), (None, "block"), ("net/de/", "allow"), ("example.net/de/8", "block"), (None, "allow"), (None, "allow"), ("org/es/", "block"), (None, "allow")]
    assert (got[0].host, got[0].path, got[6].host) == ("a.example.com", "/en/71", "")


def test_page_text(spark):
    page = "<html><head><title>t</title></head><body><header><h2>Site</h2></header><div class='cookie-notice'>ok</div><main><article><h1>A &amp; B</h1><p>x <b>y\n z<br>q<p>second</article></main><div id=comments>no</div><form>f</form></body>"
    plain = "<div>menu one</div><p>text %d</p>"
    rows = [(1, "http://h/1", page), (2, None, None)] + [(10 + i, f"http://s.org/{i}", plain % i) for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for limit in (1 << 20, 0):  # broadcast templates, and joined ones
        got = {r.page_id: r for r in pagetext.extract(df, limit).collect()}
        assert got[1].text == "A & B\nx y z q\nsecond" and got[2].text == "" and got[2].n_chars == 0
        assert got[12].text == "text 2" and got[12].n_templates == 1


def test_pieces_equal_the_library(spark, docs):
    sp = pytest.importorskip("sentencepiece")
    model_pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = model_pb2.ModelProto()
    with open(pieces.MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for p in model.pieces:  # scores of -1e9 do not add up in the library's 32-bit floats
        p.score = max(p.score, -40000.0) if p.type == 1 else p.score
    library = sp.SentencePieceProcessor(model_proto=model.SerializeToString())
    got = pieces.encode(docs.limit(60), max_hot=500)
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in got.collect():
        assert r.round_trip and r.ids == library.encode(text[r.doc_id])
    assert {r.doc_id: r.text for r in pieces.decode(got).collect()} == {r.doc_id: text[r.doc_id] for r in got.select("doc_id").collect()}


def test_mixing(spark, docs):
    out = mixing.mix(docs, {"src1": 3.0, "src2": 1.0}, epochs=2.0)
    size = {r[0]: r[1] for r in out.groupBy("source").agg(F.sum(F.length("text"))).collect()}
    assert set(size) <= {"src1", "src2"}
    assert out.select("doc_id", "copy").distinct().count() == out.count()
    again = [tuple(r) for r in mixing.mix(docs, {"src1": 3.0, "src2": 1.0}, epochs=2.0).select("doc_id", "copy").collect()]
    assert [tuple(r) for r in out.select("doc_id", "copy").collect()] == again
    few = spark.createDataFrame([(float(r),) for r in (0.5, 3.0, 900.0)], "rate double").select("rate", mixing.poisson_cdf(F.col("rate")).alias("c")).collect()
    for r in few:
        assert abs(r.c[-1] - 1) < 1e-9 and abs(sum(1 - p for p in r.c) - r.rate) < 1e-6 * r.rate + 1e-9


def test_licenses(spark):
    rows = [(1, "a/b/LICENSE", "Released under the MIT License."), (2, "a/b/c/x.py", "code of the thing"), (3, "a/y.py", "more"), (4, "a/b/z.py", "Licensed under the Apache License, Version 2.0.\n" + "code here and there " * 20), (5, None, None), (6, "a/b/q", ""), (6, "a/b/q", "")]
    got = sorted((r.doc_id, r.license, r.kind) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect())
    assert got == sorted([(1, "MIT", "file"), (2, "MIT", "inherited"), (3, None, None), (4, "Apache-2.0", "header"), (5, None, None), (6, "MIT", "inherited"), (6, "MIT", "inherited")], key=lambda r: r[0])


def test_licence_line_with_a_common_word(spark):
    prose = [f"on w{k} v{k}" for k in range(300)]
    rows = [(k, f"p{k}/x", t) for k, t in enumerate(["code\non Released under the MIT License.\nmore code here", *prose])]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).where("license is not null").collect()
    counts = Counter(w for _, _, t in rows for w in set(re.findall(r"\w+", t.lower())))
    weight = {w: 1000 + round(1000 * np.log((1 + len(rows)) / (1 + counts[w]))) for w in "on released under the mit license".split()}
    shared = sum(x * x for w, x in weight.items() if w != "on")
    assert [(r.doc_id, r.license, r.kind, r.score) for r in got] == [(0, "MIT", "header", int(1000 * shared / np.sqrt(shared * (shared + weight["on"] ** 2)) + 1e-9))]
    assert got[0].score > 950


def test_licence_wrapped_over_lines_and_long_files(spark):
    grant = licenses.TEMPLATES[1][1].split()
    wrapped = "\n".join("# " + " ".join(grant[k : k + 10]) for k in range(0, len(grant), 10))
    code = "\n".join(f"a{k} = b{k} + c{k}" for k in range(300))
    rows = [(1, "p/a.py", f"# the thing\n#\n{wrapped}\n\n{code}"), (2, "q/LICENSE", "\n".join([licenses.TEMPLATES[5][1]] * 20)), (3, "q/r/x.py", code)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).orderBy("doc_id").collect()
    assert [(r.license, r.kind) for r in got] == [("MIT", "header"), ("GPL-3.0", "file"), ("GPL-3.0", "inherited")]
    assert got[0].score == 1000


@pytest.mark.parametrize("operator", [neardup.near_duplicates, neardup.keep_one, suffixdedup.remove_repeats, quality.judge, quality.kept_rows, secretscan.find_secrets, secretscan.redact, mixing.mix, pieces.encode])
def test_odd_and_empty_documents(odd, operator):
    n = len(operator(odd).collect())
    assert n == len(ROWS) or operator in (neardup.keep_one, quality.kept_rows, mixing.mix)
    assert operator(odd.limit(0)).collect() == []


def test_empty_tables(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).collect() == []
    pages = spark.createDataFrame([], "page_id long, url string, html string, host string, text string")
    assert pagetext.extract(pages).collect() == []
    assert urlfilter.filter_urls(pages, spark.createDataFrame([], "entry string")).collect() == []
    assert licenses.scan(spark.createDataFrame([], "doc_id long, path string, text string")).collect() == []


CLASHING = ("rk", "n", "host", "path", "rule", "verdict", "entry", "kept", "score", "rank", "cell", "v", "query_id", "license", "n_chars", "h1", "block")


def clashing(df, *own):
    return df.select("*", *[F.lit(7).alias(c) for c in CLASHING if c not in own])


def test_odd_pages(spark):
    rows = [(None, None, None), (1, "", ""), (2, "http://h/1", "<p>same</p>"), (2, "http://h/1", "<p>same</p>"), (3, None, "<p>" + "long word " * 30000 + "</p>"), (4, "://", "<<<>&#0;&bogus;<p")]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    texts = sorted(((r.page_id is not None, r.page_id), r.n_chars, len(r.text)) for r in pagetext.extract(pages).collect() if r.page_id is not None)
    assert [t[0][1] for t in texts] == [1, 2, 2, 3, 4] and all(n == size for _, n, size in texts) and texts[3][1] == 299_999
    listed = spark.createDataFrame([(None,), ("",), ("h",), ("h",)], "entry string")
    urls = urlfilter.filter_urls(pages, listed).collect()
    assert sorted((r.page_id or 0, r.host, r.path, r.verdict) for r in urls) == [(0, "", "", "allow"), (1, "", "", "allow"), (2, "h", "/1", "block"), (2, "h", "/1", "block"), (3, "", "", "allow"), (4, "", "", "allow")]


def test_odd_vectors(spark):
    rows = [(None, None), (0, []), (1, None), (50, [1.0, 1.0]), (51, [1.0, 1.0]), (52, [1.0, 1.0]), (53, [1.0, None]), (54, [float("inf"), 1.0])]
    vectors = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(vectors, F.col("vec_id") % 50 == 0).collect())
    assert got == [(50, 1, 51, 131072), (50, 2, 52, 131072)]


def test_odd_files(spark):
    rows = [(None, None, None), (1, "", ""), (2, "/", "MIT License"), (3, "a//b/", "x " * 50000), (4, "a/LICENSE", None), (4, "a/LICENSE", None)]
    files = clashing(spark.createDataFrame(rows, "doc_id long, path string, text string"), "path")
    assert sorted(r.doc_id or 0 for r in licenses.scan(files).collect()) == [0, 1, 2, 3, 4, 4]
