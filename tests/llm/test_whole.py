"""The pipeline and further operators against plain Python, and inputs that once went wrong."""

import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeloom.llm import bytehash, common
from lakeloom.llm import components as connected
from lakeloom.llm import licenses, mixing, neardup, pagetext, pieces, quality, queries, secretscan, suffixdedup, topk, urlfilter

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def unigram_library():
    """The public library's unigram encoder on the given pieces and scores."""
    sp = pytest.importorskip("sentencepiece")
    model_pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = model_pb2.ModelProto()
    with open(pieces.MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    for p in model.pieces:  # scores of -1e9 do not add up in the library's 32-bit floats
        p.score = max(p.score, -40000.0) if p.type == 1 else p.score
    return sp.SentencePieceProcessor(model_proto=model.SerializeToString())


# ---- the pipeline ------------------------------------------------------------------------------


def good(text):
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    tri = Counter(zip(w, w[1:], w[2:]))
    covered = {i + j for i, t in enumerate(zip(w, w[1:], w[2:])) if tri[t] > 1 for j in range(3)}
    n, chars, n_lines = max(len(w), 1), sum(map(len, w)), max(len(lines), 1)
    share = lambda pattern: sum(bool(re.search(pattern, x)) for x in lines)
    return not (len(w) < 50 or 2 * len(covered) > len(w) or len(re.findall(r"[#*$%&|<>]", text)) > quality.MAX_SYMBOLS_PER_WORD * n or not quality.MEAN_WORD[0] <= chars / n <= quality.MEAN_WORD[1]
                or sum(c.isalpha() for c in text) < quality.MIN_LETTERS * chars or len(lines) - len(set(lines)) > quality.MAX_DUP_LINES * n_lines
                or share(r"(\.\.\.|…)\s*$") > quality.MAX_ELLIPSIS_LINES * n_lines or share(r"^\s*[-*•‣◦]\s") > quality.MAX_BULLET_LINES * n_lines)


def components(sets, num, den):
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]) > 0:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def unit(*parts):
    return (int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) + 0.5) / 2.0**52


def test_pipeline_equals_plain_python(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {d: r for d, r in docs.items() if good(r.text)}
    assert 0 < len(kept) < len(docs)
    root = components({d: shingles(r.text) for d, r in kept.items()}, 80, 100)
    single = {d: r for d, r in kept.items() if root[d] == d}
    assert len(single) < len(kept)
    texts = {d: secretscan.hide(r.text) for d, r in single.items()}
    assert any(texts[d] != r.text for d, r in single.items())
    size = Counter()
    for d, r in single.items():
        size[r.source] += len(texts[d])
    copies = {}
    for d, r in single.items():
        rate, u, n, p, total = sum(size.values()) / len(size) / size[r.source], unit(17, "n", d), 0, 0.0, 0.0
        p = math.exp(-rate)
        while u >= (total := total + p):
            n, p = n + 1, p * rate / (n + 1)
        copies[d] = n
    assert len(set(copies.values())) > 2
    library = unigram_library()
    want = Counter({(d, tuple(library.encode(texts[d]))): n for d, n in copies.items() if n})
    got = corpus_pipeline.run(spark, SF).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want and all(r.round_trip for r in got)


@pytest.mark.parametrize("k", range(4))
def test_stages_return_the_columns_of_documents(spark, k):
    rows = [(None, None, None, None, None, 1), (1, "", "en", "a", 0, 1), (2, "w " * 3000, None, "b", 6000, 1), (2, "w " * 3000, None, "b", 6000, 1), (3, "one two", "en", None, 7, 1)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept int")
    for docs in (odd, odd.limit(0)):
        assert corpus_pipeline.STAGES[k][1](spark, docs, SF).columns == list(corpus_pipeline.COLUMNS)


# ---- hashes and keys ---------------------------------------------------------------------------


def thue_morse(n):
    text = "".join("ab"[bin(k).count("1") % 2] for k in range(n))
    return text, text.translate(str.maketrans("ab", "ba"))


def test_hashes_tell_thue_morse_strings_apart(spark):
    a, b = thue_morse(1024)
    data = np.frombuffer((a + b).encode(), np.uint8)
    begin, end = np.array([0, 1024]), np.array([1024, 2048])
    assert len(set(bytehash.word_hashes(data, begin, end).tolist())) == 2
    for family in (0, 1):
        assert len(set(bytehash.Fingerprints(data, family).ranges(begin, end).tolist())) == 2
    got = neardup.near_duplicates(spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string"), 85, 100)
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(1, 1), (2, 2), (3, 1)]


def test_fingerprints_are_polynomials_modulo_a_prime():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 400).astype(np.uint8)
    prime = bytehash.PRIME
    for family in (0, 1):
        prints, base = bytehash.Fingerprints(data, family), bytehash.BASES[family]
        for i, e in ((0, 400), (7, 390), (13, 13), (250, 251)):
            want = sum(int(bytehash.VALUES[family][data[t]]) * pow(base, int(t - i), prime) for t in range(i, e)) % prime
            assert int(prints.ranges(np.array([i]), np.array([e]))[0]) == want
    edge = np.array([0, 1, prime - 1, prime - 2], np.uint64)
    assert [int(x) for x in bytehash.times(edge, edge[::-1])] == [int(x) * int(y) % prime for x, y in zip(edge, edge[::-1])]


def test_row_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (None, "a"), (None, None)], "d long, t string").select(common.row_key("d", "t").alias("k"))
    keys = [bytes(r.k) for r in df.collect()]
    assert {len(k) for k in keys} == {16} and keys[0] == keys[1] and len(set(keys)) == 4


# ---- suffix dedup ------------------------------------------------------------------------------


def test_one_core_between_very_many_neighbours(spark):
    """A shard whose strings, names and results all go to disk."""
    rng = random.Random(9)
    core = "".join(rng.choice("abcdefgh") for _ in range(64))
    rows = [(k, "".join(rng.choice("xyz") for _ in range(rng.randrange(0, 60))) + core + "".join(rng.choice("xyz") for _ in range(rng.randrange(0, 60)))) for k in range(400)]
    raws = [t.encode() for _, t in rows]
    seen = Counter(r[i : i + 64] for r in raws for i in range(len(r) - 63))
    want = {}
    for (d, _), raw in zip(rows, raws, strict=True):
        mask = bytearray(len(raw))
        for i in range(len(raw) - 63):
            if seen[raw[i : i + 64]] > 1:
                mask[i : i + 64] = b"\1" * 64
        want[d] = sum(mask)
    for budget in (64 << 20, 2000):
        got = suffixdedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 64, budget).collect()
        assert {r.doc_id: r.n_removed for r in got} == want


# ---- pieces ------------------------------------------------------------------------------------


def test_words_of_any_length_equal_the_library(spark):
    rng = random.Random(1)
    texts = ["x" * 5000, "".join(rng.choice("etaoinsr") for _ in range(5000)), "the" * 700 + " and " + "ing" * 300, " " * 300 + "word  two ", "é漢字" * 300 + "\n\n a", *("a" * n for n in range(127, 130)), "aQz9" * 200,
             "\t\tint x = 3;\n", "", " ", "-" * 3000, "".join(rng.choice("abcXYZ019+/") for _ in range(4000)), "a  b   c", " lead", "trail ", "\n", "a\n b\n\nc"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    library = unigram_library()
    for block in (3000, 1 << 24):
        got = pieces.encode(docs, max_hot=50, block_bytes=block)
        for r in got.collect():
            assert r.round_trip and r.ids == library.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids), texts[r.doc_id][:50]
        assert {r.doc_id: r.text for r in pieces.decode(got).collect()} == dict(enumerate(texts))


def test_no_word_is_broadcast(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    one, other = ({r.doc_id: r.ids for r in pieces.encode(docs, max_hot=n).collect()} for n in (0, 200_000))
    assert one == other


# ---- mixing ------------------------------------------------------------------------------------


def test_large_rates_are_poisson_and_quick(spark):
    rows = [(1, "tiny", "t"), (2, "x" * 4_000_000, "big"), (3, "y" * 4_000_000, "big")]
    began = time.time()
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), {"t": 1.0, "big": 1.0}).where("source = 't'")
    n, distinct = out.agg(F.count("*"), F.countDistinct("copy")).first()
    rate = (4 + 8_000_000) / 2 / 4
    assert abs(n - rate) < 6 * math.sqrt(rate) and distinct == n
    assert time.time() - began < 60


def test_rates_on_either_side_of_a_part(spark):
    for rate in (0.3, 255.9, 256.1, 5000.0):
        docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("0123456789").alias("text"), F.lit("s").alias("source"))
        counts = [r["count"] for r in mixing.mix(docs, epochs=rate).groupBy("doc_id").count().collect()]
        assert abs(sum(counts) - 40 * rate) < 6 * math.sqrt(40 * rate)


# ---- licences ----------------------------------------------------------------------------------


def plain_licences(rows, threshold=licenses.THRESHOLD):
    """TF-IDF cosine of every line, window and text to every template it may be like, with no short cut."""
    cut = lambda text: [w for w in re.split(r"[\W_]+", text.lower()) if w]
    n = len(rows)
    counts = Counter(w for _, _, t in rows for w in set(cut(t or "")))
    weight = lambda w: 1000 + round(1000 * math.log((1 + n) / (1 + counts[w])))
    vector = lambda ws: {w: k * weight(w) for w, k in Counter(ws).items()}
    short = [(name, vector(cut(t))) for name, t in licenses.TEMPLATES]
    full = [(name, vector(cut(t))) for name, t in licenses.FULL_TEXTS]
    longest = max(len(cut(t)) for _, t in licenses.TEMPLATES)

    def scores(ws, templates):
        v = vector(ws)
        own = sum(x * x for x in v.values())
        for k, (name, u) in enumerate(templates):
            dot = sum(x * u.get(w, 0) for w, x in v.items())
            score = int(1000 * dot / math.sqrt(own * sum(x * x for x in u.values())) + 1e-9) if dot else 0
            if score >= 1000 * threshold:
                yield score, -k, name

    out = {}
    for d, _, text in rows:
        lines = [cut(x) for x in (text or "").split("\n") if cut(x)]
        whole = list(scores([w for ws in lines for w in ws], short + full)) if lines else []
        headers = []
        for i in range(len(lines)):
            ws = []
            for k in range(i, len(lines)):
                if len(ws) >= longest:
                    break
                ws = ws + lines[k]
                headers += scores(ws, short)
        if whole:
            out[d] = (max(whole)[2], max(whole)[0], "file")
        elif headers:
            out[d] = (max(headers)[2], max(headers)[0], "header")
    return out


def test_licences_equal_plain_cosine(spark):
    rng = random.Random(2)
    prose = lambda n: " ".join(rng.choice(["the", "on", "code", "of", "permission", "license", "software", "value", f"w{rng.randrange(99)}"]) for _ in range(n))
    rows = []
    for k in range(60):
        name, text = rng.choice((*licenses.TEMPLATES, *licenses.FULL_TEXTS))
        ws = [w for w in text.split() if rng.random() > rng.choice([0, 0, 0.1, 0.4])]
        step = rng.choice([4, 8, 200])
        body = "\n".join(" ".join(ws[i : i + step]) for i in range(0, len(ws), step))
        rows.append((k, f"d{k % 7}/f{k}", rng.choice(["{0}", "{1}\n{0}\n{2}", "{1} {0}"]).format(body, prose(rng.randrange(0, 12)), prose(rng.randrange(0, 80)))))
    rows += [(100 + k, f"d{k % 7}/e{k}", prose(30)) for k in range(60)]
    want = plain_licences(rows)
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).where("kind in ('file', 'header')").collect()
    assert {r.doc_id: (r.license, r.score, r.kind) for r in got} == want
    assert {k for _, _, k in want.values()} == {"file", "header"}


def test_full_texts_mark_their_directory(spark):
    rows = [(k, f"p{k}/LICENSE", text.replace("(c)", f"(c) 2024 Somebody{k}")) for k, (_, text) in enumerate(licenses.FULL_TEXTS)] + [(50 + k, f"p{k}/x.py", f"code {k}") for k in range(len(licenses.FULL_TEXTS))] + [(99, "long/LICENSE", licenses.FULL_TEXTS[0][1] * 5), (98, "long/a/b.c", "code")]
    got = {r.doc_id: (r.license, r.kind) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()}
    for k, (name, _) in enumerate(licenses.FULL_TEXTS):
        assert got[k] == (name, "file") and got[50 + k] == (name, "inherited")
    assert got[99] == ("MIT", "file") and got[98] == ("MIT", "inherited")


# ---- pages -------------------------------------------------------------------------------------


def site(n):
    """A host whose template, and a plain paragraph inside the article, only recurrence can tell."""
    pages = []
    for k in range(n):
        body = f"<div>Our shop of things</div><article><h1>Title {k}</h1><p>First of {k}.</p><p>Read our other pages too.</p><p>Quoted by two.</p><p>Last of {k}.</p></article><div>Made in {k}</div><section><p>All rights kept</p></section>"
        pages.append((k, f"http://s.org/{k}", body if k < 2 else body.replace("<p>Quoted by two.</p>", "")))
    return pages


def test_templates_decide(spark):
    pages = site(40) + [(100 + k, f"http://plain.org/{k}", f"<div>Menu of plain</div><p>Text {k}</p>") for k in range(12)] + [(200, "http://few.org/1", "<div>Menu of few</div><p>Text</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    for limit in (1 << 20, 0):
        got = {r.page_id: r.text for r in pagetext.extract(df, limit).collect()}
        assert got[0] == "Title 0\nFirst of 0.\nQuoted by two.\nLast of 0." and got[5] == "Title 5\nFirst of 5.\nLast of 5."
        assert got[103] == "Text 3" and got[200] == "Menu of few\nText"


def test_templates_equal_plain_counts(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()] + site(40)
    seen = defaultdict(set)
    articles = defaultdict(set)
    for _, url, html in pages:
        host = re.match(r"[^/?#]*", url.split("://", 1)[1]).group().lower() if url and "://" in url else ""
        order, held = pagetext.prepare(html or "")
        article = tuple(n.key for n in held)
        articles[host].add(article)
        for n, inner in pagetext.deletable(order, held):
            seen[host, n.key, inner].add(article)
    want = Counter(host for (host, _, inner), pages_ in seen.items() if host and len(pages_) >= (max(pagetext.MIN_TEXT_PAGES, pagetext.MIN_TEXT_SHARE * len(articles[host])) if inner else max(pagetext.MIN_PAGES, pagetext.MIN_SHARE * len(articles[host]))))
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    hosted = df.withColumn("__url", F.col("url"))
    hosted = hosted.withColumn("host", F.coalesce(urlfilter.host_and_path(F.col("__url"))[0], F.lit("")))
    got = pagetext.templates(hosted, common.Scratch(spark, "test"))
    assert {r["host"]: r["count"] for r in got.groupBy("host").count().collect()} == dict(want) and want["s.org"] >= 3


def test_comments_menus_and_several_articles():
    text = lambda html: pagetext.main_text(pagetext.prepare(html)[1])
    assert text("<article><p>one</p></article><div class=ad>buy</div><article><p>two</p></article><section id=comments><article><p>no</p></article></section>") == "one\ntwo"
    assert text("<div class='layout with-sidebar'><article>a</article><div class=sidebar>b</div></div>") == "a"
    assert text("<article></article><main>m<nav>n</nav></main>") == "m"
    assert text("<article><header><h1>t</h1></header><p>x<aside>y</aside></article><header>h</header>") == "t\nx"


def test_no_markup_fails_or_stalls():
    rng = random.Random(3)
    bits = ["<", "</", ">", "<!--", "-->", "<![", "]]>", "<!", "<?", "p", "div", "article", "script", "a href=", "'", '"', "=", "/", " ", "text", "&amp;", "&#x41;", "&#xD800;", "td", "tr", "table", "\0", "é", "<p>", "</p>", "<br/>", "<article>", "</article>", "<title>", "</title>"]
    for _ in range(5000):
        order, held = pagetext.prepare("".join(rng.choice(bits) for _ in range(rng.randrange(0, 40))))
        pagetext.main_text(held).encode()
        pagetext.deletable(order, held)
    assert pagetext.main_text(pagetext.prepare("<![foo[ x ]]>abc")[1]) == "abc"
    began = time.time()
    for deep in ("<div>" * 20000 + "x", "<article>" * 20000 + "x", "<p><table>" + "<div>" * 20000, "<b>" * 10000 + "</i>" * 10000, "<header>" * 5000 + "<h1>t", "<!--" * 100000, '<a b="' * 50000, "<" * 100000):
        order, held = pagetext.prepare(deep)
        pagetext.main_text(held)
        pagetext.deletable(order, held)
    assert time.time() - began < 20


# ---- URLs --------------------------------------------------------------------------------------


def test_long_list_and_false_positives(spark):
    n = 1_000_000
    listed = spark.range(n).select(F.concat(F.lit("h"), F.col("id").cast("string"), F.lit(".example."), F.element_at(F.array(F.lit("com"), F.lit("net")), (F.col("id") % 2 + 1).cast("int")), F.lit("/")).alias("entry"))
    pages = spark.range(0, 40_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://www.h"), (F.col("id") * 50).cast("string"), F.lit(".example.com/a/b")).alias("url"))
    want = {k for k in range(40_000) if k * 50 < n}  # even numbers are listed under com
    scratch = common.Scratch(spark, "test")
    entries = scratch.save(listed, "entries")
    for most in (urlfilter.MAX_BLOCKS, 1):  # broadcast, and joined
        got = urlfilter.filter_urls(pages, listed, (), most).where("verdict = 'block'").collect()
        assert {r.page_id for r in got} == want and all(r.listed == f"h{r.page_id * 50}.example.com/" for r in got)
    foreign = spark.range(200_000).select(F.lit("k").alias("__key"), F.array(F.concat(F.lit("x"), F.col("id").cast("string"))).alias("forms"))
    passed = {most: sorted(r.form for r in urlfilter.possible_hits(foreign, entries, scratch, most).collect()) for most in (urlfilter.MAX_BLOCKS, 1)}
    false = passed[urlfilter.MAX_BLOCKS]
    assert false == passed[1] and 0 < len(false) < 0.01 * 200_000


# ---- top k -------------------------------------------------------------------------------------


def test_huge_components(spark):
    rows = [(0, [1.0, 1.0]), (1, [2.0, 2.0]), (2, [1e300, None]), (None, [1e300, 1.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 1, 2 * 512 * 256)]
    with pytest.raises(Exception, match="does not fit"):
        topk.top_k(spark.createDataFrame([(0, [1e300, 1.0])], "vec_id long, embedding array<double>"), F.lit(True)).collect()


def test_large_cells_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CELL_BLOCK", 7)
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=4), 1)]) for i in range(400)]
    able = {i: np.floor(256 * np.array(v)).astype(int) for i, v in rows}
    want = [(q, k + 1, i, -s) for q in range(0, 400, 20) for k, (s, i) in enumerate(sorted((-int(able[q] @ v), i) for i, v in able.items() if i != q)[:5])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(want)


# ---- near copies in crowded band values ----------------------------------------------------------


def brute_components(rows, num, den):
    sets = {d: shingles(text) for d, text in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b]) if a < b else 0
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in sets}


@pytest.mark.parametrize("num", [80, 85])
def test_near_copies_of_a_crowd_are_linked(spark, num, monkeypatch):
    """Copies at 0.75 to 0.95 of one text: few are linked to the hub of a band value, most to some other copy."""
    monkeypatch.setattr(neardup, "BLOCK", 40)
    monkeypatch.setattr(neardup, "MEMBERS", 10_000)
    rng = random.Random(11)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(240):
        copy = list(base)
        for at in rng.sample(range(len(copy)), rng.randrange(2, 9)):
            copy[at] = f"x{rng.randrange(10**9)}"
        rows.append((k, " ".join(copy)))
    want = brute_components(rows, num, 100)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), num, 100).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_common_counts_are_intersection_sizes(monkeypatch):
    monkeypatch.setattr(neardup, "FEW", 4)
    monkeypatch.setattr(neardup, "SLICE", 7)
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, k, rng.integers(0, 60)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64) for k in (20, 60, 60, 400, 400, 400, 1) * 3]
    got = neardup.common_counts(np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets]), len(sets))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert i == j or got[i, j] == len(np.intersect1d(a, b))


# ---- components ------------------------------------------------------------------------------------


@pytest.mark.parametrize("last", [0, 60, 1 << 17])
def test_components_by_rounds_and_by_a_last_task(spark, tmp_path, last, monkeypatch):
    monkeypatch.setattr(connected, "LAST", last)
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(0, 60, 2)] + [(k + 2, k) for k in range(0, 60, 4)] + [(1000 - k, 1001 - k) for k in range(70)] + [(500, k) for k in range(501, 560)]
    links += [(2000 + rng.randrange(90), 2000 + rng.randrange(90)) for _ in range(60)] + [(-7, 3000), (7, 7), (4000, None), (None, 4001)]
    links += links[:20]
    near = defaultdict(set)
    for u, v in links:
        if u is not None and v is not None and u != v:
            near[u].add(v)
            near[v].add(u)
    want = {}
    for start in sorted(near):
        todo = [start] if start not in want else []
        while todo:
            if (x := todo.pop()) not in want:
                want[x] = start
                todo += near[x]
    scratch = common.Scratch(spark, "components-test")
    table = scratch.save(spark.createDataFrame(links, "u long, v long").repartition(5), "links")
    got = connected.components(scratch, table, "test").collect()
    assert len(got) == len(want) and {r.node: r.component for r in got} == want
    assert not connected.components(scratch, table.where("u = 7"), "none").collect()


@pytest.mark.parametrize("last", [0, 1 << 17])
def test_crowded_copies_take_few_steps(spark, last, monkeypatch):
    """Each step is a round of jobs over every partition; chains of copies once took three for each round of contraction."""
    monkeypatch.setattr(connected, "LAST", last)
    steps, save = [], common.Scratch.save
    monkeypatch.setattr(common.Scratch, "save", lambda self, df, name: steps.append(name) or save(self, df, name))
    monkeypatch.setattr(neardup, "BLOCK", 40)
    rng = random.Random(11)
    base, rows = [f"w{k}" for k in range(300)], []
    for k in range(200):
        copy = list(base)
        for at in rng.sample(range(len(copy)), rng.randrange(2, 9)):
            copy[at] = f"x{rng.randrange(10**9)}"
        rows.append((k, " ".join(copy)))
    for k in range(70):  # each copy differs from the one before by one word
        base = list(base)
        base[rng.randrange(len(base))] = f"y{rng.randrange(10**9)}"
        rows.append((1000 + (37 * k) % 70, " ".join(base)))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 85, 100).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows, 85, 100)
    assert "crossed" in steps and (len(steps) <= 14 or not last)
