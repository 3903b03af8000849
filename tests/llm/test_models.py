import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from tidemark.llm import bloom_lm, html_extract, quality, toxicity

WORDS = [a + b + c for a in "bcdfg" for b in "aeiou" for c in "lmnprstz"]


def corpus(rng, n):
    rows, labels = [], []
    for i in range(n):
        w = [WORDS[min(int(rng.paretovariate(0.7)), 199)] for _ in range(rng.randrange(20, 80))]
        toxic, junk = rng.random() < 0.2, rng.random() < 0.4
        if toxic:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(["vile", "Nasty"]))
        if junk:
            w = [x + "###" for x in w]
        rows.append((i, " ".join(w), "x"))
        labels.append((i, int(not junk), int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus(random.Random(1), 600)
    docs = spark.createDataFrame([*rows, (9001, None, "x"), (9002, "", "x"), (None, "vile nasty vile nasty vile", "x")], "doc_id long, text string, score string")
    return docs.cache(), spark.createDataFrame([*labels, (5, None, None), (77777, 1, 1)], "doc_id long, quality int, toxic int").cache(), dict((i, (q, t)) for i, q, t in labels)


@pytest.mark.parametrize(("score", "k"), [(quality.score_quality, 0), (toxicity.score_toxicity, 1)])
def test_held_out_accuracy(tables, score, k):
    docs, labels, truth = tables
    rows = score(docs, labels).collect()
    assert len(rows) == 603 and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == truth[r.doc_id][k] for r in held) / len(held) > 0.93


def test_toxicity_of_held_out_rows_of_a_corpus(spark):
    """Recall at the fixed cut, and at the cut that 5 % of the clean rows reach."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_toxicity(docs.select("doc_id", "text"), labels).join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic").collect()
    clean = sorted(r.score for r in rows if not r.toxic)
    toxic = [r for r in rows if r.toxic]
    assert len(toxic) > 80 and sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.01 * len(clean)
    assert sum(r.score > clean[int(0.95 * len(clean))] for r in toxic) >= 0.9 * len(toxic)


def test_toxic_stems_and_repeats():
    """A form that the sample lacks is judged by its stem; a context counts once, however often it repeats."""
    m = toxicity.ToxicModel(weights={"vile": 5.0, "vilely": -0.4}, stems={"vil": 4.0, "nasti": 3.0})
    assert [s for *_, s in m.segments("a vile b c d e f g h i j k l m n vileness o".split())] == [5.0, 4.0]
    assert m.segments(["vilely", "vil", "nasti", "kind", "thing"]) == []
    assert m.segments(["vile"] * 9)[0][2] < 3 * 5.0 and m.segments([]) == []
    assert m.features([], 0) == m.features([], 10) == (0.0, 0.0)


def test_passages_and_drop(tables):
    docs, labels, truth = tables
    rows = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    spans = [text[i][p.start : p.end] for i, r in rows.items() if i in truth and truth[i][1] for p in r.passages]
    assert spans and all("vile" in s.lower() or "nasty" in s.lower() for s in spans)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= {i for i, r in rows.items() if not r.predicted}
    assert {i for i, (_, toxic) in truth.items() if not toxic} - {r.doc_id for r in kept.collect()} == set()
    assert {r.doc_id for r in toxicity.drop_toxic(docs, labels, threshold=0.5).collect()} == {i for i, r in rows.items() if not r.predicted}


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_without_labels(spark, tables, score):
    docs, labels, _ = tables
    assert len({round(r.score, 9) for r in score(docs, labels.limit(0)).collect()}) == 1
    assert score(docs.limit(0), labels).count() == 0


def test_segments_like_brute_force():
    rng = random.Random(3)

    def best(s):
        return max((sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=0)

    def maximal(s, at=0):
        """Recursive definition: the best segment, then those left and right of it."""
        spans = [(sum(s[i:j]), -(j - i), -i) for i in range(len(s)) for j in range(i + 1, len(s) + 1)]
        if not spans or max(spans)[0] <= 0:
            return []
        top = max(x[0] for x in spans)
        i, j = min(((i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1) if abs(sum(s[i:j]) - top) < 1e-9), key=lambda p: (p[1] - p[0], p[0]))
        return [*maximal(s[:i], at), (at + i, at + j), *maximal(s[j:], at + j)]

    for _ in range(200):
        s = [rng.choice([-2.0, -1.0, -0.5, 0.75, 1.25, 3.0]) + rng.random() * 1e-3 for _ in range(rng.randrange(0, 14))]
        found = toxicity.maximal_segments(s)
        assert [(b, e) for b, e, _ in found] == maximal(s)
        assert max((v for _, _, v in found), default=0) == pytest.approx(max(best(s), 0))


def test_language_model(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["The cat", "the dog", "a bird", "runs fast", "sleeps now", f"x{i}"]) for _ in range(rng.randrange(0, 30)))) for i in range(300)]
    rows += [(1000, None), (None, "the cat"), (7, rows[7][1]), (1001, "unseen words only here")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int")
    fold = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7
    tok = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    c = Counter(w for (i, _), ws in zip(rows, tok, strict=True) if fold(i) != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((i or 0, fold(i) == 2, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for (i, _), ws in zip(rows, tok, strict=True))
    scores = brute_force_scores([ws for (i, _), ws in zip(rows, tok, strict=True) if fold(i) != 2], tok, n, v)
    for options in ({}, {"max_broadcast": 300}, {"top_words": 3}, {"max_broadcast": 300, "top_words": 0, "bytes_per_shard": 10**9}):
        got = bloom_lm.score(docs, **{"bytes_per_shard": 2000, "bits": 64, **options}).collect()
        assert sorted((r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
        # neither the way to the filter nor the exact counts change what the model says
        assert sorted((r.doc_id or 0, round(r.score, 6)) for r in got) == sorted((i or 0, round(x, 6)) for (i, _), x in zip(rows, scores, strict=True))
    assert bloom_lm.score(docs.limit(0)).count() == 0
    alone = bloom_lm.score(docs.filter("doc_id is null or pmod(crc32(cast(cast(doc_id as string) as binary)), 7) = 2")).filter("held_out").collect()
    assert alone and all(r.train_tokens < 10 and r.score <= 0 for r in alone)


def brute_force_scores(training, texts, n, v):
    """The model's formula over counters, levels read off exact counts. None is the end of a text."""
    c1, c2, c3 = Counter(), Counter(), Counter()
    for ws in training:
        chain = ["<s>", *ws]
        c1.update(ws)
        c2.update(zip(chain, chain[1:], strict=False))
        c3.update(zip(chain, chain[1:], chain[2:], strict=False))
    low = lambda c: 2.0 ** (c.bit_length() - 1) if c else 0.0
    high = lambda c: 2.0 ** c.bit_length() - 1

    def weight(history, once):
        unseen = lambda mu: sum((low(c) + high(c)) / 2 * mu / (max((low(c) + high(c)) / 2 - 1, 0) + mu) for c in history)
        lo, hi = 1e-2, 1e6
        for _ in range(200):
            lo, hi = (math.sqrt(lo * hi), hi) if unseen(math.sqrt(lo * hi)) < once else (lo, math.sqrt(lo * hi))
        return lo

    mu2, mu3 = (weight(h.values(), sum(x == 1 for x in c.values())) for h, c in ((c1, c2), (c2, c3)))
    out = []
    for ws in texts:
        chain, total = ["<s>", *ws], 0.0
        for i, w in enumerate(ws, 1):
            first = high(c1[chain[i - 1]] if i > 1 else len(training))
            second = high(c2[chain[i - 2], chain[i - 1]]) if i > 1 else 0.0
            p = (low(c1[w]) + 1) / (n + v + 1)
            p = (min(low(c2[chain[i - 1], w]), first) + mu2 * p) / (first + mu2)
            total += math.log10((min(low(c3[chain[i - 2], chain[i - 1], w]) if i > 1 else 0.0, second) + mu3 * p) / (second + mu3))
        out.append(total)
    return out


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p><p>no";</script></head><body><header><h2>Site</h2></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use cookies</div><main><article class=post><div class="entry-header"><h1>Title {i}</h1></div><p class="byline">Follow us for more stories</p><p>First&nbsp;&amp; {i}
line<br>next <b>bold</b>text<p>Second &#233; {i}<ul><li>item {i}<li>other {i}</ul><form><input><label>Mail</label></form><!-- <p>hidden</p> --><div class="ad">Buy now {i}</div></article>
<section id="comments"><p>Reader {i} says hi</p></section></main><aside>Related {i}</aside><footer>&copy; x</footer></body></html>"""


def test_extraction(spark):
    rows = [(i, f"https://www.x.org/{i}", PAGE.format(i=i)) for i in range(20)]
    plain = "<html><body><div id=top><a href=1>menu</a></div><div><p>Only text here that is long enough</p><p>and more of it</p></div>"
    rows += [(100, None, None), (101, "x", ""), (102, "https://y.org/1", plain), (103, "https://y.org/2", "just words &lt; more"), (0, "https://www.x.org/0", PAGE.format(i=0))]
    got = [(r.page_id, r.text) for r in html_extract.extract(spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, text string")).collect()]
    assert len(got) == len(rows)
    for i, text in got:
        if i < 100:
            assert text == f"Title {i}\n\nFirst & {i} line next boldtext\n\nSecond é {i}\n\nitem {i}\n\nother {i}"
    text = dict(got)
    assert text[100] == text[101] == "" and text[103] == "just words < more" and text[102] == "Only text here that is long enough\n\nand more of it"
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_equal_pages_count_once_for_template(spark):
    page = "<html><body><main><article><h1>{0} title</h1><p>{0} text</p></article></main></body></html>"
    rows = [(i, f"https://z.org/{i}", page.format("copied" if i < 6 else f"own {i}")) for i in range(9)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: "copied title\n\ncopied text" if i < 6 else f"own {i} title\n\nown {i} text" for i in range(9)}


def test_template_in_shapes_beyond_the_reference(spark):
    """The reference holds the first shape only; texts that the others share, among themselves or with it, are template too."""
    page = "<html><body><main><article>{}</article></main></body></html>"
    rows = [(i, f"<h2>Head {i}</h2><p>Same text</p>") for i in range(10)]
    rows += [(i, f"<h2>Head {i}</h2><p>Mine {i}</p>" + "".join(f"<h{3 + j}>Part {i}</h{3 + j}>" for j in range(4) if i >> j & 1) + "<blockquote><p>Sign up</p></blockquote>") for i in range(10, 16)]
    rows += [(16, "<h2>Head</h2><p>Mine</p><h2>Next</h2><p>Same text</p>")]
    df = spark.createDataFrame([(i, f"https://z.org/{i}", page.format(t)) for i, t in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(df, reference_chars=20).collect()}
    assert all(got[i] == f"Head {i}" for i in range(10))
    assert all(got[i] == "\n\n".join([f"Head {i}", f"Mine {i}", *[f"Part {i}"] * i.bit_count()]) for i in range(10, 16))
    assert got[16] == "Head\n\nMine\n\nNext"


def test_tree_matching():
    w = html_extract.Shapes()
    a, b = w.decode("(b(p)(div(p)(q))(p))"), w.decode("(b(div(q))(p)(x))")
    assert w.match(a, b) == 4 and w.match(a, a) == 6 and w.match(w.decode("(a)"), w.decode("(b)")) == 0
    u = w.union(a, b)
    assert w.match(u, a) == 6 and w.match(u, b) == 5
    assert w.decode(w.encode(u)) == u and w.aligned(a, b) == {0: 1, 1: 2}


def test_tree_matching_like_brute_force():
    rng = random.Random(9)

    def tree(depth):
        return (rng.choice("ab"), *(tree(depth - 1) for _ in range(rng.randrange(0, 4) if depth else 0)))

    def text(t):
        return "(" + t[0] + "".join(map(text, t[1:])) + ")"

    def best(a, b):
        def rows(x, y):
            return 0 if not x or not y else max(rows(x[1:], y), rows(x, y[1:]), best(x[0], y[0]) + rows(x[1:], y[1:]))

        return 0 if a[0] != b[0] else 1 + rows(a[1:], b[1:])

    for _ in range(150):
        a, b = tree(3), tree(3)
        w = html_extract.Shapes()
        assert w.match(w.decode(text(a)), w.decode(text(b))) == best(a, b)


def test_deep_and_broken_pages():
    main = lambda t: html_extract.main_text(html_extract.parse(t))
    n = 10_000
    deep = html_extract.parse("<div>" * n + "deep" + "</div>" * n)
    assert html_extract.main_text(deep) == "deep"
    w = html_extract.Worker()
    reference = w.reference(w.shapes.encode(w.shapes.take(deep)))
    other = html_extract.parse("<div>" * (n - 7) + "<p>x</p>deep" + "</i></div></table>" * n)
    assert len(w.align(other, reference)) == n - 7 + 3 and w.shapes.size[w.shapes.union(reference, other[0].shape)] == n + 5
    assert main("<a href=x title=it's>two</a> and they don't<p>more") == "two and they don't\n\nmore"
    assert main("<p title='a > b' class=\"c\">text</p><p x='open>lost") == "text"
    assert main("<article><p>a<section id=related-work><p>b</section><div class='social science'>c</div><div class='related-posts'><a href=x>r</a></div></article>") == "a\n\nb\n\nc"
    assert main("word " * 300_000) == " ".join(["word"] * 300_000)
    assert main("<" * 1000 + "&#xZZ; &bogus; &amp" + "</p>" * 1000).endswith("&bogus; &")


def test_wrapper_decides(spark):
    """Where no article is marked, what varies over a host's pages is content, though a page by itself would suggest the long constant part."""
    terms = "Terms and conditions apply to all of what we say here and elsewhere. " * 20
    page = "<html><body><div><h2>Place</h2></div><div class=x><p>{0}</p><p>Written at home</p></div><div class=y><p>{1}</p></div></body></html>"
    rows = [(i, f"https://w.org/{i}", page.format(f"Story {i} has been told " * 3, terms)) for i in range(12)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: " ".join([f"Story {i} has been told"] * 3) for i in range(12)}
    alone = {i: html_extract.main_text(html_extract.parse(h)) for i, _, h in rows}
    assert all(alone[i] != got[i] and terms.strip() in alone[i] for i in alone)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<article><p>We walked to <a href="/x" title="the hidden valley">the valley</a> today.</p></article>', "We walked to the valley today."),
        ('<article><p class="overflow hidden x">kept</p><p data-hidden=1>too</p><p hidden>a</p><p style="color:red; DISPLAY : none">b</p><p aria-hidden=TRUE>c</p><p hidden=until-found>d</p></article>', "kept\n\ntoo"),
        ('<article><h2 id="how-to-bake-cookies">Bake</h2><section id="menu"><p>Soup</p></section><div class="market-share"><p>Up</p></div><div id="ten-facts-about-comments"><p>Ten</p></div></article>', "Bake\n\nSoup\n\nUp\n\nTen"),
        ('<article><p>x</p><div class="share">on <a>f</a></div><div class="social-share"><a>all links here</a></div><div class="comments"><p>reader</p></div><section class="market-share"><a>a</a> <a>b</a></section></article>', "x"),
        ('<body><form id="aspnetForm" method=post><div class="nav">menu</div><article><p>Text</p></article></form></body>', "Text"),
        ('<body><form id="f"><input><p>All the text that the page has.</p></form><p>x</p></body>', "All the text that the page has."),
        ('<article><p>Long enough text of the article itself.</p><form><p>Your name</p></form></article>', "Long enough text of the article itself."),
        ('<article><blockquote><header>On peace</header><p>Said</p><footer>A. Author</footer></blockquote><footer>Site</footer></article>', "On peace\n\nSaid\n\nA. Author"),
    ],
)
def test_what_names_and_attributes_tell(page, want):
    assert html_extract.main_text(html_extract.parse(page)) == want


def test_quality_on_held_out_rows(spark):
    """Of the given documents' held-out labels nearly all are ranked right, and judged right at the cut of 0.3."""
    sf = "/root/testdata/sf0.1"
    scores = quality.score_quality(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf}/labels.parquet"))
    judged = scores.filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet").filter("quality is not null"), "doc_id").select("score", "predicted", "quality").collect()
    good, bad = ([r for r in judged if r.quality == v] for v in (1, 0))
    assert len(good) > 100 and len(bad) > 100
    wins = sum((g.score > b.score) + 0.5 * (g.score == b.score) for g in good for b in bad)
    assert wins / (len(good) * len(bad)) >= 0.97
    assert sum(r.predicted for r in good) >= 0.96 * len(good) and sum(r.predicted for r in bad) <= 0.1 * len(bad)


def test_probes_of_a_large_filter_stay_small_on_disk(spark, tmp_path, monkeypatch):
    """Beyond max_broadcast keys go to the filter once, as differences, and bare levels come back; what was exchanged for the counts is gone by then."""
    keys = np.unique(bloom_lm.mix(np.arange(1, 20001, dtype=np.uint64)) & bloom_lm.KEPT)
    to, cuts = bloom_lm._by_shard(keys, 7)
    first = bloom_lm._first_of(to, 7)
    packed = bloom_lm.pack(keys, first, bloom_lm.PAIR, cuts)
    assert np.array_equal(np.concatenate([bloom_lm.unpack(p, int(f), bloom_lm.PAIR) for p, f in zip(packed, first, strict=True)]), keys)
    assert sum(map(len, packed)) < 6 * len(keys) and (bloom_lm.shard_of(first, 7) == to).all()
    words = np.unique(bloom_lm.mix(np.arange(1, 1001, dtype=np.uint64)))
    assert np.array_equal(bloom_lm.unpack(bloom_lm.pack(words, np.zeros(1, np.uint64), bloom_lm.WORD, [(0, 1000)])[0], 0, bloom_lm.WORD), words)

    rng = random.Random(3)
    docs = spark.createDataFrame([(i, " ".join(f"w{int(rng.random() ** 3 * 5000)}" for _ in range(400))) for i in range(400)], "doc_id long, text string")
    written, remove = {}, []
    real = bloom_lm.C.materialise

    def materialise(df, tag, **options):
        out = real(df, tag, **options)
        written[tag] = written.get(tag, 0) + sum(p.stat().st_size for p in Path(out._tidemark_path).rglob("*.parquet"))
        remove.append(options.get("keep_exchanged"))
        return out

    monkeypatch.setattr(bloom_lm.C, "materialise", materialise)
    got = bloom_lm.score(docs, max_broadcast=0).count()
    # what is written before the filter is asked takes less than the tokens' hashes alone
    assert got == 400 and sum(n for tag, n in written.items() if tag not in ("ngram-counts", "lm-scores")) < 400 * 400 * 8
    assert remove.count(False) >= 2
