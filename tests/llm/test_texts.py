"""Operators on texts against plain versions of what they compute."""

import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from knockwork.llm import bytebpe, decontam, quality, simhash, substr, textscan, tokencount, vocab

SPACE = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TEXTS = st.text(alphabet=list("abAB 's\t\n\x1c\x85éÉΣßﬁ中🎉‍.,<|>1２'l"), max_size=60)
WORDS_JSON, RANKS = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.tiktoken")


def rows_of(seed, n, words, most):
    rng = random.Random(seed)
    base = ["".join(rng.choice(words) + rng.choice([" ", "  ", "\n"]) for _ in range(rng.randint(0, most))) for _ in range(n)]
    return [(rng.choice([None, *range(n // 2)]), rng.choice(base) + t) for t in base] + [(n, None), (n + 1, ""), (n + 2, " \n")]


def table(spark, rows):
    doubled = rows + rows[:5]
    return spark.createDataFrame([(*r, "x", 1) for r in doubled], "doc_id long, text string, q_n_words string, tag int").repartition(3)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_token_counts_are_the_librarys(text):
    global _counter
    try:
        counter, library = _counter
    except NameError:
        counter, library = _counter = tokencount.Counter(vocab.read(WORDS_JSON)), Tokenizer.from_file(WORDS_JSON)
    said = text + "<|endoftext|>" + text
    assert counter.count(said) == len(library.encode(said, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def codec():
    return bytebpe.Codec(vocab.read(RANKS), P.PATTERN, bytebpe.RUNS)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_bytes(codec, library):
    rng = random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice("abAB 's\t\n\x1c\x85éß中🎉1'll  ") for _ in range(rng.randint(0, 50)))
        assert codec.encode(text) == library.encode_ordinary(text)
        assert codec.decode(" ".join(map(str, codec.encode(text))).encode()) == text.encode()
        for chunk, overlap in ((7, 3), (16, 8), (5, 0)):
            assert bytebpe.pieces(text, codec.pattern.findall, chunk, overlap) == codec.pattern.findall(text)
            assert codec.encode(text, chunk, overlap) == library.encode_ordinary(text)


def test_encoding_of_long_short_and_null(spark, library):
    rows = rows_of(2, 12, ["ab", "'ll", "é", "12"], 40) + [(90, "z" * 300 + " y" * 100)]
    want = []
    for i, t in rows + rows[:5]:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    docs = table(spark, rows)
    for sizes in ({"chunk": 40, "overlap": 8, "spread": 1}, {"chunk": 9, "overlap": 5, "spread": 4}, {"chunk": 16, "overlap": 8}, {}):
        for runs in (None, bytebpe.RUNS):
            assert plain(bytebpe.encode_documents(docs, RANKS, P.PATTERN, runs=runs, **sizes)) == sorted(want, key=str)
    assert bytebpe.encode_documents(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_ids_are_given_and_decoded(spark, library):
    rows = [(1, "Hello  wörld, it's 中🎉"), (2, None), (3, ""), (4, "x" * 70_000 + " y")]
    ids = bytebpe.encode(spark.createDataFrame(rows, "doc_id long, text string"), RANKS, P.PATTERN, runs=bytebpe.RUNS)
    assert {r.doc_id: list(r.ids) for r in ids.collect()} == {i: library.encode_ordinary(t or "") for i, t in rows}
    assert {r.doc_id: bytes(r.raw) for r in bytebpe.decode(ids, RANKS).collect()} == {i: (t or "").encode() for i, t in rows}


def test_token_count_rows(spark):
    got = plain(tokencount.count_tokens(table(spark, [(1, "Hello, <|endoftext|>"), (2, None), (3, "")]), WORDS_JSON, 2))
    assert got == sorted([(1, 20, 3, True), (2, 0, 0, False), (3, 0, 0, False)] * 2, key=str)


def counts(text):
    words = SPACE.findall(text or "")
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, t in enumerate(triples) if triples.count(t) > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if SPACE.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_quality_counts(spark):
    rows = rows_of(3, 40, ["a", "b", "c#", "é"], 30) + [(80, " ".join(f"wort{i}" for i in range(60))), (81, "#$ " * 70)]
    got = plain(quality.judge(table(spark, rows)))
    base = {}
    for i, t in rows:
        c = counts(t)
        base.setdefault((i, *c), c[0] < 50 or 100 * c[4] > 50 * c[0])
    assert {g[:6] for g in got} == set(base) and len(got) == len(rows) + 5
    assert all(g[6] == base[g[:6]] and not (g[6] and g[7]) for g in got)
    kept = quality.keep_good(table(spark, rows))
    assert kept.columns == ["doc_id", "text", "q_n_words", "tag"]
    assert {r.doc_id for r in kept.collect()} == {g[0] for g in got if g[7]} >= {80}
    assert {(r.q_n_words, r.tag) for r in kept.collect()} == {("x", 1)}
    lines = spark.createDataFrame([(80, rows[-2][1], 60, 5)], "doc_id long, text string, q_lines int, Q_Part int")
    assert [tuple(r) for r in quality.keep_good(lines).collect()] == [(80, rows[-2][1], 60, 5)]
    with pytest.raises(ValueError):
        quality.features(lines)
    assert quality.judge(table(spark, rows).limit(0)).count() == 0


def test_cascade_order(spark):
    docs = spark.createDataFrame([(i, "word " * 60 + ("#" if i % 4 == 0 else "")) for i in range(400)], "doc_id long, text string")
    always, quarter, never = F.col("q_n_words") > 0, F.col("q_n_symbols") > 0, F.col("q_n_words") < 0
    rules = [
        quality.Rule("dear_never", never, 900.0), quality.Rule("never", never), quality.Rule("dear_always", always, 900.0), quality.Rule("quarter", quarter),
        quality.Rule("grows_quarter", quarter, F.char_length("text") * 1.0), quality.Rule("always", always),
    ]
    for n in (1, 3, 8):
        order = [r.name for r in quality.plan_cascade(docs.repartition(n), rules)]
        assert order == ["always", "quarter", "dear_always", "never", "grows_quarter", "dear_never"] or order == ["always", "quarter", "dear_always", "grows_quarter", "never", "dear_never"]
    large = docs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("copy")
    orders = {tuple(r.name for r in quality.plan_cascade(large, rules, sample_rows=300)) for _ in range(3)}
    assert len(orders) == 1 and next(iter(orders))[0] == "always" and next(iter(orders))[-1] == "dear_never"
    assert quality.plan_cascade(docs.limit(0), rules) == rules


def fingerprint(text):
    words = SPACE.findall((text or "").translate(LOWER))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def groups(rows, each=False):
    """Smallest id reachable by links of three bits or fewer; ``each`` gives it once for each group."""
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                root[max(find(i), find(j))] = min(find(i), find(j))
    of = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            of[find(i)] = min(of.get(find(i), key), key)
    if each:
        return [of.get(r) for r in {find(i) for i in range(len(rows))}]
    return [(key, f"{p:016x}", of.get(find(i))) for i, ((key, _), p) in enumerate(zip(rows, prints, strict=True))]


def test_simhash_groups(spark):
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(500)}" for _ in range(300))
    rows = rows_of(6, 20, ["a", "B", "c"], 25) + [(i, long + " x" * (i % 3)) for i in range(60, 66)]
    got = plain(simhash.near_duplicates(table(spark, rows)))
    assert got == sorted(groups(rows + rows[:5]), key=str)
    kept = simhash.one_of_each(table(spark, rows)).collect()
    assert sorted((r.doc_id for r in kept), key=str) == sorted(groups(rows, each=True), key=str)
    assert simhash.near_duplicates(table(spark, rows).limit(0)).count() == simhash.one_of_each(table(spark, rows).limit(0)).count() == 0
    kept = [tuple(r) for r in kept]
    assert {r[:2] for r in kept} <= set(rows) and {r[2:] for r in kept} == {("x", 1)}


def test_sieve_lets_every_key_through(spark):
    from knockwork.llm.scratch import Scratch
    from knockwork.llm.sieve import Sieve

    rows = spark.range(3000).select(F.when(F.col("id") > 9, F.col("id")).alias("k"), F.lit(1).alias("sieve_bits"), F.lit("t").alias("block"))
    for keys in (spark.range(100, 400), spark.range(0)):
        maybe, clean = Sieve(keys, F.xxhash64("id"), Scratch(spark, "test")).split(rows, F.xxhash64("k"))
        inside, outside = [r.k for r in maybe.collect()], [r.k for r in clean.collect()]
        assert maybe.columns == clean.columns == rows.columns and len(inside) + len(outside) == 3000
        wanted = {r.id for r in keys.collect()}
        assert wanted <= set(inside) and len(inside) <= 2 * len(wanted)


def test_one_row_of_every_group_stays(spark):
    import corpus_pipeline

    rng = random.Random(6)
    a, b, c, d = (" ".join(f"{x}{rng.randrange(500)}" for _ in range(300)) for x in "abcd")
    rows = [(None, a), (None, b), (None, b), (1, c), (1, d), (2, d + " x"), (2, a + " x"), (3, c), (1, c)]
    prints = {t: simhash.fingerprints_of(pa.array([t]))[0] for _, t in rows}
    assert all((int(prints[x]) ^ int(prints[x + " x"])).bit_count() <= 3 for x in (a, d))
    kept = corpus_pipeline.drop_near_duplicates(spark, table(spark, rows), "")
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(None, b), (1, c), (1, d), (2, a + " x")], key=str)


def test_balls_meet_every_link(spark):
    rng = random.Random(8)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for b in list(prints):
        for n in (1, 2, 3, 4):
            x = b
            for k in rng.sample(range(64), n):
                x ^= 1 << k
            prints.add(x)
    prints = sorted(prints)
    frame = spark.createDataFrame([(p - 2**64 if p >> 63 else p,) for p in prints], "fp long")
    found = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(frame, len(prints)).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)

    def classes(pairs):
        root = {p: p for p in prints}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            root[max(find(a), find(b))] = min(find(a), find(b))
        return [find(p) for p in prints]

    assert classes(found) == classes([(a, b) for a in prints for b in prints if (a ^ b).bit_count() <= 3])


def without_repeats(rows, n):
    first = {}
    split = [(i, SPACE.findall(t or "")) for i, t in rows]
    for i, w in split:
        for p in range(len(w) - n + 1 if i is not None else 0):
            k = tuple(w[p : p + n])
            first[k] = min(first.get(k, i), i)
    out = []
    for i, w in split:
        gone = {p + k for p in range(len(w) - n + 1 if i is not None else 0) if first[tuple(w[p : p + n])] < i for k in range(n)}
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return out


@pytest.mark.parametrize("n", [1, 4, 5])
def test_substring_dedup(spark, n):
    rows = rows_of(9, 40, ["a", "b", "é", "dd"], 40)
    want = [(i, a, b, hashlib.sha256(t.encode()).hexdigest()) for i, a, b, t in without_repeats(rows + rows[:5], n)]
    assert plain(substr.digests(table(spark, rows), window=n)) == sorted(want, key=str)
    for remembered in (3, 50, 1 << 16):
        assert plain(substr.digests(table(spark, rows), window=n, block_bytes=60, remembered=remembered)) == sorted(want, key=str)


def test_substring_removal_keeps_columns(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, passage), (2, f"start {passage}  end"), (3, "alone  here"), (4, None)]
    got = {r.doc_id: (r.text, r.n) for r in substr.remove_repeats(spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, n long"), length="n").collect()}
    assert got == {1: (passage, 7), 2: ("start end", 9), 3: ("alone  here", 7), 4: (None, 7)}
    clash = spark.createDataFrame([(*r, 7, "u") for r in rows], "doc_id long, text string, doc long, substr_tag string")
    assert sorted(tuple(r)[2:] for r in substr.remove_repeats(clash).collect()) == [(7, "u")] * 4
    assert substr.remove_repeats(clash.limit(0)).count() == substr.digests(clash.limit(0)).count() == 0
    with pytest.raises(TypeError):
        substr.digests(clash.withColumn("doc_id", F.lit("x")))


def test_substring_dedup_of_a_very_long_text(spark):
    rng = random.Random(12)
    long = [f"w{rng.randrange(5000)}" for _ in range(400_000)]
    rows = [(1, " ".join(long[1000:1060])), (2, " ".join(long)), (3, " ".join(long[399_000:]))]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in substr.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (60, 0), 2: (400_000, 60), 3: (1000, 1000)}


NOT_BETWEEN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def contamination_of(rows, bench, size=13, near=0.8):
    """What op3 returns, by trying every window at every place."""
    split = [NOT_BETWEEN.findall((t or "").translate(LOWER)) for _, t in rows]
    often = {}
    for w in split:
        for x in w:
            often[x] = often.get(x, 0) + 1
    windows = {}
    for i, t in bench:
        w = NOT_BETWEEN.findall((t or "").translate(LOWER))
        for p in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[p : p + size]), set()).add(i)
    want = []
    for (i, _), w in zip(rows, split, strict=True):
        hit, items, close = set(), set(), set()
        for k, of in windows.items():
            rare = sorted((often.get(x, 0), o, x) for o, x in enumerate(k))
            second = next((x for _, _, x in rare if x != rare[0][2]), rare[0][2])
            for p in range(len(w)):
                if w[p : p + len(k)] == list(k):
                    hit |= set(range(p, p + len(k)))
                    items |= of
                around = set(w[max(0, p - size + 1) : p + size])
                if w[p] == rare[0][2] and second in around and len(around & set(k)) >= near * len(set(k)):
                    close |= of
        want.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w), len(items | close)))
    return want


def test_decontamination(spark):
    rows = rows_of(10, 30, ["a", "B", "É", "0"], 40) + [(70, "z" * 70 + " y"), (71, "z" * 71 + " y")]
    bench = [(i % 5, rows[i][1][:60]) for i in range(8)] + [(7, "a"), (8, None), (9, "..."), (10, "z" * 71)]
    want = contamination_of(rows + rows[:5], bench)
    benchmark = spark.createDataFrame(bench, "item_id long, text string")
    docs = table(spark, rows)
    assert plain(decontam.contamination(docs, benchmark)) == sorted(want, key=str)
    assert plain(decontam.contamination(docs, benchmark, block_terms=3, block_windows=7)) == sorted(want, key=str)
    clash = docs.withColumn("decon_doc", F.lit(3)).withColumn("tag", F.lit("t"))
    clean = decontam.keep_clean(clash, benchmark)
    assert clean.columns == clash.columns
    assert sorted(((r.doc_id, r.tag, r.decon_doc) for r in clean.collect()), key=str) == sorted(((w[0], "t", 3) for w in want if not w[5]), key=str)
    assert decontam.contamination(docs, benchmark.limit(0)).filter("contaminated or n_hit > 0 or n_near > 0").count() == 0
    assert decontam.contamination(docs.limit(0), benchmark).count() == decontam.keep_clean(docs.limit(0), benchmark).count() == 0


def test_proximity(spark):
    said = "one two three four five six seven eight nine ten eleven twelve thirteen"
    there = said.split()
    rows = [
        (1, said), (2, " ".join(there[::-1])), (3, " ".join(there[:11] + ["x", "y"])), (4, " ".join(there[:9])), (5, "none of these"),
        (6, " ".join(f"{w} gap gap" for w in there)), (7, "one two " * 40), (8, "thirteen thirteen twelve thirteen"),
    ]
    bench = [(0, said), (1, "quick brown")]
    got = plain(decontam.contamination(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")))
    assert got == sorted(contamination_of(rows, bench), key=str)
    assert [(g[0], g[3], g[6]) for g in got if g[6]][:2] == [(1, 1, 1), (2, 0, 1)]


def test_scan_and_hashes():
    rng = random.Random(3)
    texts = ["".join(rng.choice(" \t\n\x0babcÉß中🎉") for _ in range(rng.randint(0, 50))) for _ in range(100)] + [None, "", "a" * 90]
    words = textscan.scan(pa.array(texts))
    raw = words.data.tobytes()
    for i, t in enumerate(texts):
        a, b = words.first[i], words.first[i + 1]
        assert [raw[x:y].decode() for x, y in zip(words.start[a:b], words.end[a:b], strict=True)] == SPACE.findall(t or "")
    found = textscan.xxh64(words.data, words.start, words.end - words.start)
    assert found.tolist() == [xxhash.xxh64_intdigest(raw[a:b], 42) for a, b in zip(words.start, words.end, strict=True)]
    x = np.arange(30, dtype=np.uint64) % np.uint64(7)
    for n in (1, 3, 5, 25):
        r = textscan.rolling(textscan.mix(x), n, 12345)
        assert len(r) == 31 - n and len(set(r.tolist())) == len({tuple(x[i : i + n]) for i in range(31 - n)})


def test_byte_bpe_remembers_no_more_than_it_is_told():
    data = vocab.read(P.path("byte_bpe_50k.tiktoken"))
    few, many = (bytebpe.Codec(data, P.PATTERN, bytebpe.RUNS, *m) for m in ((50,), ()))
    for i in range(40):
        units = few.units(" ".join(f"w{j} {chr(97 + j % 26)}é{j % 7}" for j in range(20 * i, 20 * i + 60)))
        few.meet(units)
        many.meet(units)
        assert few.written(units) == many.written(units) and len(few) <= 50 + len(units) and len(few.before) <= 50 + len(units)
    assert len(many) > 500
