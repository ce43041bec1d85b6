"""Trained models by held-out accuracy; pages and archives by planted cases; the pipeline by its stages."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from knockwork.llm import fixity, htmlwrap, langid, sampling, toxicity

D = "/root/testdata/sf0.001"


def test_language(spark):
    rng = random.Random(1)
    sounds = {"xx": ["ka", "mi", "tor", "un"], "yy": ["shé", "lo", "vra", "eek"]}
    rows = [(i, " ".join("".join(rng.choice(sounds[l]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(2, 30))), l) for i, l in enumerate(rng.choice(["xx", "yy"]) for _ in range(200))]
    rows += [(900, None, "xx"), (901, "", None), (902, "12 !?", "yy")] + rows[:3]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.judge(docs).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert len(got) == len(rows) and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert {(r.lang_pred, r.score) for r in got if r.doc_id >= 900} == {("und", 0.0)}
    assert all(0 <= r.score <= 1 for r in got)
    nothing = langid.judge(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_toxicity(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(500):
        bad = rng.random() < 0.3
        rows.append((i, " ".join(rng.choice(words) for _ in range(40)) + (" you utter foobar, go" if bad else "")))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame([*rows, (900, None), (901, "")], "doc_id long, text string")
    got = toxicity.judge(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    unknown = toxicity.judge(docs, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert {r.score for r in unknown} == {0.5}


PAGE = (
    '<!DOCTYPE html><html><head><title>t</title><script>x("<p>no")</script></head><body><header>no</header><nav><a>no</a></nav>'
    '<article><h1>Title</h1><p>One <b>t</b>wo &lt;3<br>four<p>five</p><div class="comments"><p>no</p></div><form>no<input></form></article>'
    '<aside>no</aside><div id="cookie-notice">no</div><footer>no</footer></body></html>'
)


def test_main_text(spark):
    rows = [(1, "http://a.example/x", PAGE), (2, "http://a.example/y", None), (3, None, ""), (4, "http://b.example/", "<p>plain  text</p><ul><li><a>menu</a></ul>"), (1, "http://a.example/x", PAGE)]
    got = sorted((r.page_id, r.text, r.n_chars) for r in htmlwrap.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    said = "Title One two <3 four five"
    assert got == [(1, said, len(said)), (1, said, len(said)), (2, "", 0), (3, "", 0), (4, "plain text", 10)]


def wrapped(sources):
    """Pages, the wrapper that their inference gives and its judge."""
    pages, shapes = [htmlwrap.tokens(s) for s in sources], {}
    for p in pages:
        nodes, articles = htmlwrap.shape_of(p)
        key = repr([x.sign for x in nodes])
        if key in shapes:
            htmlwrap._meet(shapes[key], nodes, 1, articles)
        else:
            shapes[key] = htmlwrap.Wrapper(nodes, 1, articles)
    wrapper = htmlwrap.aligned(shapes.values())
    return pages, wrapper, wrapper.judged()


def test_wrapper_learns_furniture():
    pages, wrapper, judge = wrapped([f"<body><div>Same line</div><div>{'<p>words %d</p>' % i * (i % 3 + 1)}</div>{'<div><i>odd</i></div>' if i == 2 else ''}</body>" for i in range(6)])
    assert [htmlwrap.extract(pages[i], judge) for i in (4, 3)] == ["words 4 words 4", "words 3"]
    assert any(x.sign is None for x in wrapper.nodes) and wrapper.pages == 6


def test_wrapper_holds_all_nodes_of_long_pages_and_many_templates():
    def odd(i, n):  # boxes that don't repeat
        return "".join(f"<x{i}-{k}>filler {i} {k}</x{i}-{k}><div>" + "<p>a</p><ul></ul>" * (k % 3) + "</div>" for k in range(n))

    for sources in (
        [f"<body>{odd(0, 900)}<div>story {i}</div><section>end line</section></body>" for i in range(5)],
        [f"<body>{odd(i, 300)}<div>story {i}</div><section>end line</section></body>" for i in range(12)],
    ):
        for order in (sources, sources[::-1]):
            pages, wrapper, judge = wrapped(order)
            assert all("story" in t and "end line" not in t for t in (htmlwrap.extract(p, judge) for p in pages))
    assert len(wrapper.nodes) < 2 * len(htmlwrap.nodes_of(pages[0]))


def test_slots_decide_where_tags_mislead():
    top = '<body><nav><ul><li><a href="/">one %d</a></li></ul></nav>'
    page = top + '<div class="ad">buy %d</div><article><h1>title %d</h1><p>story %d</p></article><div>by %d</div></body>'
    broken = page.replace("buy %d</div>", "buy %d")  # the advert is never closed
    bare = page.replace("<article>", "<div>").replace("</article>", "</div>").replace(' class="ad"', "")
    pages, _, judge = wrapped([page % ((i,) * 5) for i in range(5)] + [broken % ((7,) * 5), bare % ((8,) * 5)])
    for p, i, alone in ((pages[2], 2, "title 2 story 2"), (pages[5], 7, ""), (pages[6], 8, "buy 8 title 8 story 8 by 8")):
        assert htmlwrap.extract(p, None) == alone
        assert htmlwrap.extract(p, judge) == f"title {i} story {i}"
    text = "<body>" + "".join("<div>" + ("<a href='x'>a linked sentence %d</a>" if k == 1 else "plain words %d") + "</div>" for k in range(3)) + "<section><a>menu %d</a></section></body>"
    pages, _, judge = wrapped([text % (i, i, i, i) for i in range(5)])
    assert htmlwrap.extract(pages[3], judge) == "plain words 3 a linked sentence 3 plain words 3"
    assert htmlwrap.extract(pages[3], None) == "plain words 3 plain words 3"


def test_nothing_else_of_an_article_is_dropped():
    page = '<body><article><p>the same first line</p><section id="social-history"><p>told %d</p></section><p><a href="x">a linked paragraph</a></p><div class="share-buttons">share</div></article></body>'
    pages, _, judge = wrapped([page % i for i in range(6)])
    for wrapper in (judge, None):
        assert htmlwrap.extract(pages[1], wrapper) == "the same first line told 1 a linked paragraph"


def test_single_occurrences_join_groups():
    sources = ["<body><nav>m</nav>" + "<p>only %d" % i * (1 if i % 2 else 3) + "<ul>" + "<li>item %d" % i * (i % 3 + 1) + "</ul></body>" for i in range(6)]
    _, wrapper, _ = wrapped(sources)
    assert [x.sign for x in wrapper.nodes].count(None) == 0
    assert ("+", "p", "#") in [x.sign for x in wrapper.nodes] and ("+", "li", "#") in [x.sign for x in wrapper.nodes]


def test_partitions_and_order_change_no_text(spark, monkeypatch):
    monkeypatch.setattr(htmlwrap, "FAN", 8)
    rng = random.Random(9)
    rows = []
    for i in range(300):
        boxes = "".join(f"<section><h{k}>head</h{k}>{'<p>text %d</p>' % rng.randrange(40) * rng.randint(1, 3)}</section>" for k in range(1, 7) if rng.random() < 0.6)
        rows.append((i, f"http://h{i % 2}/", f"<body><div>same</div>{boxes}<div>end {i % 5}</div></body>"))
    rows += [(900, None, None), (901, "http://h1/", "")]
    kind = "page_id long, url string, html string"
    want = None
    for n in (1, 7):
        rng.shuffle(rows)
        got = {r.page_id: (r.text, r.n_chars) for r in htmlwrap.main_text(spark.createDataFrame(rows, kind).repartition(n)).collect()}
        assert want is None or got == want
        want = got
    assert len(want) == 302 and want[900] == ("", 0) and all("end" in t for i, (t, _) in want.items() if i < 900)
    clash = spark.createDataFrame([(*r, "x", 1, b"w") for r in rows[:20]], kind + ", k string, host int, wrapper binary")
    assert htmlwrap.main_text(clash).columns == ["page_id", "url", "text", "n_chars"] and htmlwrap.main_text(clash.limit(0)).count() == 0


def test_texts_that_differ_after_a_long_opening():
    opening = "the same standard opening of every story " * 8
    sources = [f"<body><div>{opening}story {i}</div><section>end line</section><p>{opening}one {i}</p><p>{opening}two {i}</p></body>" for i in range(6)]
    pages, _, judge = wrapped(sources)
    said = " ".join(opening.split())
    for i, p in enumerate(pages):
        assert htmlwrap.extract(p, judge) == f"{said} story {i} {said} one {i} {said} two {i}"


def test_copies_of_a_page_make_no_furniture(spark):
    copy = "<body><h1>Title</h1><p>first one</p><p>second one</p></body>"
    near = "<body><div>Only story</div><div class='advert'><b>buy %d</b></div></body>"
    page = "<body><div>Same line</div><section>story %d</section></body>"
    rows = [("http://copies/", copy)] * 9 + [("http://near/", near % i) for i in range(9)]
    rows += [("http://three/", page % (i % 3)) for i in range(9)] + [("http://four/", page % (i % 4)) for i in range(9)]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string").repartition(5)
    got = {(r.url, r.text) for r in htmlwrap.main_text(pages).collect()}
    assert got == {("http://copies/", "Title first one second one"), ("http://near/", "Only story")} | {("http://three/", f"Same line story {i}") for i in range(3)} | {("http://four/", f"story {i}") for i in range(4)}


def test_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(30))] for _ in range(2))
        best = [[0] * (len(b) + 1)]
        for x in a:
            row = [0]
            for j, y in enumerate(b):
                row.append(best[-1][j] + 1 if x == y else max(row[-1], best[-1][j + 1]))
            best.append(row)
        got = htmlwrap.common(a, b)
        assert len(got) == best[-1][-1] and all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:]))


def test_archive_audit(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"<p>{i}</p>") for i in range(200)] + [(500, None, None), (7, "http://x/7", "<p>7</p>")], "page_id long, url string, html string")
    other = pages.withColumn("html", F.when(F.col("page_id").isin(3, 150), F.lit("<p>x</p>")).otherwise(F.col("html"))).withColumn("html", F.when(F.col("page_id") == 3, F.lit("<p>y</p>")).otherwise(F.col("html")))
    got = fixity.compare_archives(fixity.archive(pages, segment=64), fixity.archive(other, segment=64)).collect()
    assert len(got) == 201
    assert {r.key for r in got if r.damaged} == {3, 150}
    assert {r.key for r in got if r.moved} == set(range(151, 192))  # a longer record moves those behind it in its file
    same = fixity.compare_archives(fixity.archive(pages), fixity.archive(pages))
    assert same.filter("damaged").count() == 0
    assert fixity.compare_archives(fixity.archive(pages.limit(0)), fixity.archive(pages.limit(0))).count() == 0


def test_what_a_lost_record_moves(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", f"<p>{i}</p>") for i in range(40)] + [(None, "u", f"n{i}") for i in range(9)], "page_id long, url string, html string")
    got = fixity.compare_archives(fixity.archive(pages), fixity.archive(pages.filter("page_id is null or page_id <> 20"))).collect()
    assert len(got) == 49 and [r.key for r in got if r.damaged] == [20] and {r.key for r in got if r.moved} == set(range(21, 40))
    assert len({r.segment for r in got if r.key is None}) > 1
    extra = spark.createDataFrame([(1, "u", "h", "x", 3, True)], "page_id long, url string, html string, sha256 string, offset int, damaged boolean")
    assert fixity.archive(extra).columns == ["segment", "record_no", "key", "offset", "n_bytes", "sha256"]
    large = spark.createDataFrame([(1, "u", "é" * 3_000_000)], "page_id long, url string, html string")
    assert fixity.archive(large).first().n_bytes > 6_000_000


def test_warc_files(spark, tmp_path):
    body = b"".join(b"WARC/1.0\r\nWARC-Record-ID: <urn:%d>\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (i, len(t), t) for i, t in enumerate([b"one", b"", b"three"]))
    (tmp_path / "a.warc").write_bytes(body)
    rows = fixity.read_warc(spark, str(tmp_path / "a.warc")).orderBy("record_no").collect()
    assert [r.key for r in rows] == ["<urn:0>", "<urn:1>", "<urn:2>"] and rows[-1].offset + rows[-1].n_bytes == len(body)
    assert rows[0].sha256 == hashlib.sha256(body[: rows[0].n_bytes]).hexdigest()


def plain_subwords(text):
    """Buckets of a text's subwords, one byte run after another."""
    out = []
    for word in re.findall(rb"[a-z\x80-\xff]+", (text or "").encode().lower()):
        for n in langid.SIZES:
            for i in range(len(word) + 2 - n):
                part = (word + b" ")[i : i + n]
                h = (int.from_bytes(part, "little") ^ (0x5BD1E995 if i == 0 else 0)) * (0x9E3779B1 + 2 * n) & 0xFFFFFFFF
                out.append((h ^ h >> 15) * 0x85EBCA6B % 2**32 >> 32 - langid.BITS)
    return out


def test_language_scores_of_a_small_model():
    rng = np.random.default_rng(4)
    model = langid.Model(["aa", "bb", "cc"], rng.normal(size=(1 << langid.BITS, 3)), rng.normal(size=3), 1.7, 0.5)
    texts = ["Hello wörld, it's", "ab", "a", "12 !?", "", None, "x" * 5000, "Ünï cödé 中文 abc"]
    got = model.probabilities(langid.means(pa.array(texts), model.table))
    for t, p in zip(texts, got, strict=True):
        rows = [model.table[b] for b in plain_subwords(t)]
        x = ((np.mean(rows, axis=0) if rows else np.zeros(3)) + model.bias) / model.temperature
        assert np.allclose(p, np.exp(x) / np.exp(x).sum())


def test_language_calibration_and_rejection(spark):
    """Of mixed texts, those above the floor are right as often as it promises; sure predictions are sure."""
    rng = random.Random(8)
    sounds = {"xx": ["ka", "mi", "tor"], "yy": ["shé", "lo", "vra"]}
    rows = []
    for i in range(900):
        own = rng.choice(["xx", "yy"])
        share = rng.choice([0.5, 0.6, 0.95, 1.0])
        rows.append((i, " ".join("".join(rng.choice(sounds[own if rng.random() < share else "xxyy".replace(own, "")[:2]]) for _ in range(3)) for _ in range(6)), own))
    got = langid.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r.held_out]
    kept = [r for r in held if not r.rejected]
    right = [r.lang_pred == truth[r.doc_id] for r in kept]
    assert 0 < len(kept) < len(held) and sum(right) >= 0.94 * len(right)
    assert min(r.score for r in kept) > max((r.score for r in held if r.rejected), default=0)
    mean = sum(r.score for r in held) / len(held)
    assert abs(mean - sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held)) < 0.1


M64 = (1 << 64) - 1


def plain_mix(x):
    x = (x ^ x >> 33) * 14029467366897019727 & M64
    x = (x ^ x >> 29) * 1609587929392839161 & M64
    return x ^ x >> 32


def plain_ngrams(text):
    h = [xxhash.xxh64_intdigest(w, 42) for w in re.findall(rb"[a-z0-9\x80-\xff]+", (text or "").encode().lower())]
    found = [plain_mix(x) for x in h]
    for gap, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        found += [plain_mix((a * factor + b) & M64) for a, b in zip(h, h[gap:])]
    return {x >> 64 - toxicity.BITS for x in found}


def test_toxicity_scores_of_a_small_model():
    texts = ["You utter foobar", "a b a b a b", "", None, "ÀB c, d!", "w " * 4000, "one"]
    known = sorted(b for t in texts for b in list(plain_ngrams(t))[::2])
    known = sorted(set(known))
    model = toxicity.Model(np.array(known), np.linspace(-2, 2, len(known)), -0.3)
    weight = dict(zip(known, model.weights, strict=True))
    bucket, text = toxicity.features(pa.array(texts))
    got = model.logits(bucket, text, len(texts))
    assert np.allclose(got, [-0.3 + sum(weight.get(b, 0.0) for b in plain_ngrams(t)) for t in texts])


def test_ftrl_equals_a_plain_one():
    rng = random.Random(3)
    examples = [(np.array(sorted(rng.sample(range(50), rng.randint(0, 9))), np.int64), rng.randint(0, 1)) for _ in range(60)]
    model = toxicity.learn(examples, 2, 11, 0.4)
    rate = sum(y for _, y in examples) / 60
    z, n = {}, {}
    bias = 1 << toxicity.BITS
    z[bias] = -math.log(rate / (1 - rate)) * (toxicity.BETA / toxicity.ALPHA + toxicity.L2)

    def weight(i):
        l1 = 0.0 if i == bias else 0.4
        x = z.get(i, 0.0)
        return 0.0 if abs(x) <= l1 else -(x - math.copysign(l1, x)) / ((toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2)

    order = np.random.default_rng(11)
    for _ in range(2):
        for i in order.permutation(60):
            at, y = [*examples[i][0].tolist(), bias], examples[i][1]
            w = [weight(j) for j in at]
            g = 1 / (1 + math.exp(-sum(w))) - y
            for j, x in zip(at, w, strict=True):
                s = (math.sqrt(n.get(j, 0.0) + g * g) - math.sqrt(n.get(j, 0.0))) / toxicity.ALPHA
                z[j] = z.get(j, 0.0) + g - s * x
                n[j] = n.get(j, 0.0) + g * g
    assert model.bias == pytest.approx(weight(bias))
    assert {b: pytest.approx(w) for b, w in zip(model.buckets.tolist(), model.weights.tolist())} == {i: weight(i) for i in sorted(z) if i != bias and weight(i)}
    assert toxicity.penalty(examples) in toxicity.L1S and toxicity.penalty([]) == toxicity.L1S[0]


def test_models_take_bounded_samples(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "abc " * 10) for i in range(20)] + [(99, None)], "doc_id long, text string")
    known = sampling.chosen(docs, "doc_id", "doc_id", 50)
    assert len(known) == 21 and list(sampling.within(docs, known, "doc_id", "text", 200)) == [k for k in known][: len(sampling.within(docs, known, "doc_id", "text", 200))]
    assert 5 <= len(sampling.within(docs, known, "doc_id", "text", 200)) <= 6
    assert sampling.within(docs, {}, "doc_id", "text", 200) == {}


def test_subword_table_of_nothing():
    bucket, text = langid.subwords(pa.array(["", None, "1 2"]))
    assert len(bucket) == len(text) == 0


def good(text):
    """The verdict of the default quality rules, rule by rule."""
    from test_texts import SPACE, counts

    n, chars, symbols, dup, again = counts(text)
    lines, words = (text or "").split("\n"), SPACE.findall(text or "")
    bad = n < 50 or 100 * again > 50 * n or symbols > n or chars < 2 * n or chars > 20 * n or max(map(len, words), default=0) > 2000
    bad = bad or 2 * len(regex.findall(r"\p{L}", text)) < chars or 2 * dup > len(lines) or 2 * sum(x.endswith(("...", "…")) for x in lines) > len(lines)
    bad = bad or 10 * sum(bool(re.match(r"[ \t]*[-*•]", x)) for x in lines) > 9 * len(lines) or (n >= 200 and 20 * len(set(words)) < n)
    return not bad


def test_pipeline_equals_its_stages_by_brute_force(spark):
    import corpus_pipeline
    import public_tokenizers as P
    import tiktoken
    from test_texts import RANKS, contamination_of, groups, without_repeats

    from knockwork.llm import vocab

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=vocab.ranks(vocab.read(RANKS)), special_tokens={})
    docs = spark.read.parquet(f"{D}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert len(dict(rows)) == len(rows)
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{D}/benchmark.parquet").collect()]
    want = [(i, t) for i, t in rows if good(t)]
    assert 0 < len(want) < len(rows) and sorted(r.doc_id for r in corpus_pipeline.drop_junk(spark, docs, D).collect()) == sorted(i for i, _ in want)
    one = set(groups(want, each=True))
    want = [(i, t) for i, t in want if i in one]
    want = [(i, left if n else t) for (i, t), (_, _, n, left) in zip(want, without_repeats(want, 50), strict=True)]
    clean = {w[0] for w in contamination_of(want, bench) if not w[5]}
    assert len(clean) < len(want)
    expected = []
    for i, t in want:
        if i in clean:
            ids = library.encode_ordinary(t)
            expected.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = corpus_pipeline.run(spark, D)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


def test_stages_keep_columns_and_take_empty_tables(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{D}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs.limit(0), D)
        assert out.schema == docs.schema and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), D).count() == 0


CLASH = "k string, t int, text_ int, fp long, score double, h int, sieve_key int, substr_runs int, lang_pred string"


@pytest.mark.parametrize("name", ["tokens", "bpe", "simhash", "substr", "contamination", "quality", "language", "toxicity"])
def test_empty_tables_very_long_texts_and_clashing_columns(spark, name):
    import public_tokenizers as P
    from test_texts import RANKS, WORDS_JSON

    from knockwork.llm import bytebpe, decontam, quality, simhash, substr, tokencount

    run = {
        "tokens": lambda d: tokencount.count_tokens(d, WORDS_JSON, 2048), "bpe": lambda d: bytebpe.encode_documents(d, RANKS, P.PATTERN, runs=bytebpe.RUNS),
        "simhash": simhash.near_duplicates, "substr": substr.digests, "contamination": lambda d: decontam.contamination(d, spark.createDataFrame([(1, "word0 word1 word2")], "item_id long, text string")),
        "quality": quality.judge, "language": langid.judge, "toxicity": lambda d: toxicity.judge(d, spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")),
    }[name]
    kind = "doc_id long, text string, lang string, " + CLASH
    rest = ("aa", "k", 1, 2, 3, 0.5, 4, 5, 6, "x")
    long = " ".join(f"word{i % 9973}" for i in range(300_000)) + " " + "z" * 200_000
    rows = [(1, long, *rest), (2, None, *rest), (3, "", *rest), (None, None, *rest), (3, "", *rest), (4, "plain words", *rest)]
    out = run(spark.createDataFrame(rows, kind))
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r[0]) for r in rows)
    empty = run(spark.createDataFrame([], kind))
    assert empty.schema.simpleString() == out.schema.simpleString() and empty.count() == 0
