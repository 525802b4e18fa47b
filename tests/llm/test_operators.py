"""Every operator on the awkward rows: nulls, empty and very long texts, ties
and repeated rows, empty tables, and extra columns with clashing names."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rivulet.llm import attention, language_id, lm_score, toxicity
from rivulet.llm.common import held_out, sample_by_hash
from rivulet.llm.html_text import html_text, main_text, main_text_tree
from rivulet.llm.quality_rules import keep_quality, quality_rules
from rivulet.llm.queries import PIECE_MODEL
from rivulet.llm.sentence_pieces import ChunkTable, sentence_piece_digests, sentence_pieces
from rivulet.llm.simhash import keep_one, links, simhash_groups
from rivulet.llm.components import components
from rivulet.llm.source_mixing import mix, source_mixing
from rivulet.llm.topk_search import topk_codes
from rivulet.llm.url_filter import url_filter

DOCS = "doc_id long, text string, lang string, source string, n_words long, `key` string"
LONG = " ".join(f"word{i % 977} of the" for i in range(40_000))
ROWS = [
    (0, "The cat sat on the mat and it was all that we saw of the day in the end.", "en", "a", 1, "x"),
    (1, "The cat sat on the mat and it was all that we saw of the day in the end.", "en", "a", 1, "x"),
    (1, "The cat sat on the mat and it was all that we saw of the day in the end.", "en", "a", 1, "x"),
    (2, None, "en", "b", 2, None),
    (3, "", "de", "b", 3, None),
    (4, " \t\n ", None, None, 4, None),
    (5, LONG, "en", "c", 5, "y"),
    (None, "Der Hund und die Katze sind nicht auf dem Haus, das ist für den Hund zu hoch.", "de", "c", 6, ""),
    (6, "Der Hund und die Katze sind nicht auf dem Haus, das ist für den Hund zu hoch.", "de", "b", 6, ""),
    (7, "one two three four five six one two three four five six one two", "en", "a", None, "z"),
    (8, "## ** && || $$ ## ** && || $$ ##", "fr", "a", 8, "z"),
    (9, "12345 67890", "fr", "d", 9, "z"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("doc_id > 1000")


def words(text):
    return (text or "").encode().lower().split()


# --- quality rules ----------------------------------------------------------

def repeats(w):
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    twice = {g for g, n in Counter(grams).items() if n > 1}
    return len({i + k for i, g in enumerate(grams) if g in twice for k in range(5)})


def test_quality_rules(docs, none):
    got = Counter(tuple(r)[:6] for r in quality_rules(docs).collect())
    want = Counter()
    for doc_id, text, *_ in ROWS:
        w = [x.decode() for x in (text or "").encode().split()]
        lines = [x for x in (text or "").split("\n") if x.split()]
        want[(doc_id, len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"),
              len(lines) - len(set(lines)), repeats(w))] += 1
    assert got == want
    verdicts = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules(docs).collect()}
    assert verdicts[0] == (False, True) and verdicts[2] == (True, False)
    assert verdicts[8] == (True, False) and verdicts[7] == (True, False)
    assert quality_rules(none).count() == 0


def test_keep_quality_keeps_whole_rows(docs, none):
    kept = keep_quality(docs)
    assert kept.columns == docs.columns and keep_quality(none).count() == 0
    good = Counter(r.doc_id for r in quality_rules(docs).filter("kept").collect())
    assert Counter(r.doc_id for r in kept.collect()) == good


# --- SimHash ----------------------------------------------------------------

def brute_fingerprint(text):
    w = words(text)
    grams = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_roots(values, distance):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


def test_simhash_groups(docs, none):
    got = Counter(tuple(r) for r in simhash_groups(docs).collect())
    fps = [brute_fingerprint(r[1]) for r in ROWS]
    root = brute_roots(sorted(set(fps)), 2)
    least = {}
    for r, f in zip(ROWS, fps):
        if r[0] is not None:
            least[root[f]] = min(least.get(root[f], r[0]), r[0])
    assert got == Counter((r[0], f"{f:016x}", least.get(root[f])) for r, f in zip(ROWS, fps))
    assert simhash_groups(none).count() == 0


def test_keep_one(docs, none):
    kept = keep_one(docs)
    assert kept.columns == docs.columns and keep_one(none).count() == 0
    assert Counter(r.doc_id for r in kept.collect()) == Counter([0, 2, 5, 6, 7, 8, 9])


@pytest.mark.parametrize("distance,matches", [(0, 512), (2, 512), (2, 2), (3, 2)])
def test_links_find_all_components(spark, distance, matches):
    rng = np.random.default_rng(distance * 7 + matches)
    values = set()
    for _ in range(25):
        center = int(rng.integers(0, 1 << 63))
        for _ in range(8):
            v = center
            for b in rng.choice(64, rng.integers(0, distance + 3), replace=False):
                v ^= 1 << int(b)
            values.add(v)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    fps = spark.createDataFrame([(x,) for x in signed.values()], "fp long")
    got = {r.node: r.root for r in components(links(fps, distance, matches)).collect()}
    root = brute_roots(sorted(values), distance)
    groups = {}
    for v, r in root.items():
        groups.setdefault(r, []).append(signed[v])
    want = {x: min(g) for g in groups.values() if len(g) > 1 for x in g}
    assert got == want


def test_components_of_long_paths(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 102), (101, 102)],
                                  "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}
    assert components(edges.filter("u > 1000")).count() == 0


# --- SentencePiece ----------------------------------------------------------

def test_sentence_pieces_equal_the_library(spark, docs, none):
    model = ChunkTable(PIECE_MODEL, limit=50).model
    odd = ["", " ", "  ", "a", " a", "a ", "a  b", "▁", "a▁b", "<s>", "</s>", "\n", "\x00", "😀 é\t x",
           "   three", "ﬁ ﬂ", "ab" * 3000]
    rows = [(i, t) for i, t in enumerate(odd)] + [(99, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in sentence_pieces(df, PIECE_MODEL).collect()}
    digest = {r.doc_id: r for r in sentence_piece_digests(df, PIECE_MODEL).collect()}
    for i, t in rows:
        ids = [1, *model.encode(t or ""), 2]
        assert list(got[i].ids) == ids and got[i].decoded == model.decode(ids)
        assert digest[i].n_tokens == len(ids)
        assert digest[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert digest[i].decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest()
    assert sentence_pieces(docs, PIECE_MODEL).count() == len(ROWS)
    assert sentence_pieces(none, PIECE_MODEL).count() == 0


# --- mixing -----------------------------------------------------------------

def water_fill(sizes, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), sum(sizes.values())
    while True:
        share = left / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if share * weight[s] > 3 * sizes[s]}
        if not over:
            return target | {s: share * weight[s] for s in open_}
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
        open_ -= over


@pytest.fixture(scope="module")
def many(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "w " * int(n), [None, "a", "b", "c", "dd", "e"][int(s)])
            for i, (n, s) in enumerate(zip(rng.integers(0, 60, 6000),
                                           rng.choice(6, 6000, p=[.02, .6, .01, .17, .1, .1])))]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_source_mixing(many, docs, none):
    rows, df = many
    got = source_mixing(df).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += t.count("w")
    target, taken = water_fill(sizes), Counter()
    source = {i: s for i, _, s in rows}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and math.isclose(r.target, target[s])
        assert r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
        taken[s] += r.taken
    assert len(got) == len(rows)
    assert all(abs(taken[s] - target[s]) <= 120 for s in sizes)
    assert 0 <= sum(sizes.values()) - sum(taken.values()) <= 180
    assert sorted(map(tuple, got)) == sorted(map(tuple, source_mixing(df.repartition(7)).collect()))
    assert source_mixing(docs).count() == len(ROWS) and source_mixing(none).count() == 0
    assert source_mixing(docs.filter("text is null")).select("taken").first()[0] == 0


def test_mix_repeats_the_rows_it_takes(many, docs, none):
    _, df = many
    copies = {r.doc_id: r.copies for r in source_mixing(df).collect()}
    got = Counter(r.doc_id for r in mix(df).collect())
    assert got == Counter({k: n for k, n in copies.items() if n})
    assert mix(docs).columns == docs.columns and mix(none).count() == 0


# --- exact search -----------------------------------------------------------

def test_topk_codes(spark):
    rng = np.random.default_rng(4)
    codes = rng.integers(-2 ** 63, 2 ** 63 - 1, 300).tolist()
    codes += [codes[0]] * 60 + [codes[1] ^ 1, codes[1] ^ 6]  # a hot code, and near ones
    rows = list(enumerate(codes))
    df = spark.createDataFrame(rows, "id long, code long")
    got = {}
    for r in topk_codes(df, df.filter("id % 20 = 0"), 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.distance, r.neighbor_id))
    for i, c in rows[::20]:
        near = sorted((((c ^ d) & (2 ** 64 - 1)).bit_count(), j) for j, d in rows if j != i)[:5]
        assert sorted(got[i]) == [(k + 1, *n) for k, n in enumerate(near)]
    few = df.filter("id < 3")
    assert topk_codes(few, few, 5).count() == 6
    assert topk_codes(df.filter("id < 0"), df.filter("id < 0"), 5).count() == 0


# --- URLs and pages ---------------------------------------------------------

def test_url_filter(spark):
    urls = [("https://A.Example.ORG/en/2", "a.example.org", "/en/2", "org/", "allow"),
            ("http://x.example.org/en/12?q=1", "x.example.org", "/en/12", "example.org/en/1", "block"),
            ("http://x.example.org/es/#top", "x.example.org", "/es/", "example.org/es/", "block"),
            ("ftp://b.com/fr/1", "b.com", "/fr/1", "com/fr/", "allow"),
            ("https://b.com/de/1", "b.com", "/de/1", "com/de/", "block"),
            ("https://org", "org", "", None, None), ("https://com?x=/de/", "com", "", None, None),
            ("https://forg/x", "forg", "/x", None, None), ("no scheme", "", "", None, None),
            (None, "", "", None, None), ("", "", "", None, None),
            ("https://é.net/a#://b", "é.net", "/a", None, None),
            ("https://b.net/" + "x/" * 20_000, "b.net", "/" + "x/" * 20_000, None, None)]
    schema = "page_id long, url string, rule string, length int"
    df = spark.createDataFrame([(i, u[0], "r", 1) for i, u in enumerate(urls)], schema)
    got = {r.page_id: r for r in url_filter(df, sample=50).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
    assert url_filter(df.filter("page_id < 0")).count() == 0
    assert {r.verdict for r in url_filter(df.filter("page_id in (4, 7)")).collect()} == {"block"}
    assert {r.verdict for r in url_filter(df.filter("page_id > 6")).collect()} == {"allow"}


def test_html_text(spark):
    nav = "<nav><ul><li><a href='/a'>A</a></li><li><a href='/b'>B</a></li></ul></nav>"
    pages = {
        0: (f"<html><head><title>T</title><style>p{{}}</style></head><body>{nav}"
            "<div class='ad'>Buy now, it is all very cheap today.</div><article><h1>Head  line</h1>"
            "<p>One &amp; two<br>three <b>bo</b>ld.<p>Of.</p><div id=comments><p>nice one</p></div>"
            "<form><p>Your name</p></form></article><aside>See also</aside>"
            "<footer>&copy; us</footer></body></html>",
            "Head line\nOne & two three bold.\nOf."),
        1: ("", ""), 2: (None, ""), 3: ("<article><p>cut o<", "cut o<"), 4: ("<!-- x <p>y", ""),
        5: ("<article><p>a &lt;p&gt; b</p><script>x</script><p>c &am", "a <p> b\nc &am"),
        6: ("<article>" + "<p>w</p>" * 30_000 + "</article>", "\n".join(["w"] * 30_000)),
        7: ("plain text of no element", "plain text of no element"),
        8: (f"<body>{nav}<header><p>Our site</p></header></body>", ""),
    }
    df = spark.createDataFrame([(k, "u", h, "t") for k, (h, _) in pages.items()],
                               "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_text(df).collect()}
    for k, (_, text) in pages.items():
        assert got[k].text == text and got[k].n_chars == len(text)
    assert html_text(df.filter("page_id < 0")).count() == 0


# --- learned operators ------------------------------------------------------

def test_language_id(spark, docs, none):
    texts = {"en": "the house of the man with a dog that was in the garden and on the road",
             "de": "das haus von dem mann mit einem hund der im garten und auf der strasse war",
             "fr": "la maison de cet homme avec un chien qui se trouvait dans le jardin et la rue"}
    rng = np.random.default_rng(2)
    rows = []
    for i in range(150):
        lang = ("en", "de", "fr")[i % 3]
        rows.append((i, " ".join(rng.permutation(texts[lang].split())), lang))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit_language_model(df.filter(~held_out("doc_id", 5, 0)))
    got = {r.doc_id: r for r in language_id.language_id(df, model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    odd = {r.doc_id: r for r in language_id.language_id(docs, model).collect()}
    assert len(odd) == len({r[0] for r in ROWS})
    for i in (2, 3, 4, 8, 9):
        assert (odd[i].lang_pred, odd[i].score) == ("und", 0.0)
    assert 0 <= odd[5].score <= 1 and odd[5].lang_pred == "en"
    kept = language_id.keep_languages(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} <= {0, 1, 5, 6, 7, None}
    empty = language_id.fit_language_model(none)
    assert {r.lang_pred for r in language_id.language_id(docs, empty).collect()} == {"und"}
    one = language_id.fit_language_model(df.filter("lang = 'en'"))
    assert language_id.language_id(df.limit(1), one).first().lang_pred == "en"


def test_toxicity(spark, docs, none):
    rng = np.random.default_rng(3)
    plain = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(600):
        t, toxic = list(rng.choice(plain, 30)), int(i % 6 == 0)
        if toxic:
            t[3], t[11] = "vile" + str(rng.choice(["", "ness", "st"])), "rotten"
        rows.append((i, " ".join(t)))
        labels.append((i, toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels + [(None, 1), (5, None), (0, 0)], "doc_id long, toxic int")
    weights = toxicity.fit_toxicity(df, lab.filter(~held_out("doc_id", 5, 0)))
    score = {r.doc_id: r.score for r in toxicity.toxicity(df, weights).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(score[i] >= 0.5) == bool(i % 6 == 0) for i in held]) > 0.97
    odd = toxicity.toxicity(docs, weights).collect()
    assert len(odd) == len(ROWS) and all(0 <= r.score <= 1 for r in odd)
    blank = toxicity.fit_toxicity(df, lab.filter("doc_id < 0"))
    assert {r.score for r in toxicity.toxicity(docs, blank).collect()} == {0.5}
    assert toxicity.toxicity(none, weights).count() == 0


def test_attention_gradients_and_windows():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 40, 16, 33])
    classes = rng.integers(0, attention.CLASSES, lengths.sum())
    windows, targets, weight, first = attention.cut(classes, lengths)
    assert weight.sum() == lengths.sum() and (targets[weight] == classes).all()
    assert first.tolist() == [0, 1, 4, 5]
    model = attention.Attention.start()
    model.out = rng.normal(0, 0.3, model.out.shape).astype(np.float32)
    grads = model.gradients(windows, targets, weight)

    def loss():
        return -float((model.log_likelihood(windows, targets) * weight).sum()) / weight.sum()
    for name in ("query", "key", "value", "own", "out", "bias", "near"):
        a, g = getattr(model, name), grads[name]
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept = a[at]
        a[at] = kept + 0.02
        up = loss()
        a[at] = kept - 0.02
        down = loss()
        a[at] = kept
        assert math.isclose((up - down) / 0.04, g[at], rel_tol=0.05, abs_tol=2e-5), name
    alone = attention.cut(classes[1:41], lengths[1:2])[:2]
    assert np.allclose(model.log_likelihood(*alone), model.log_likelihood(windows, targets)[1:4],
                       atol=1e-4)  # a text's score does not depend on its neighbours


def test_lm_score_base(docs, none, monkeypatch):
    monkeypatch.setattr(lm_score, "FREQUENT", 20)  # so that most words take the join
    held = held_out("doc_id", 7, 2)
    model = lm_score.fit_language_model(docs.filter(~held), PIECE_MODEL)
    got = Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
                  for r in lm_score.lm_score(docs, model).collect())
    train = [r for r in ROWS if r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 != 2]
    c = Counter(w for r in train for w in [*words(r[1]), None])
    n, v = sum(c.values()), len(c)
    want = Counter()
    for r in ROWS:
        w = [*words(r[1]), None]
        want[(r[0], len(w), sum(c[x] > 0 for x in w), n,
              round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 4))] += 1
    assert got == want
    assert all(r.score < 0 for r in lm_score.lm_score(docs, model).collect())
    untrained = lm_score.fit_language_model(none, PIECE_MODEL)
    assert {r.n_known for r in lm_score.lm_score(docs, untrained).collect()} == {0}
    assert lm_score.lm_score(none, model).count() == 0


def test_attention_learns(spark):
    text = " ".join(["red blue green yellow"] * 200)
    df = spark.createDataFrame([(i, text) for i in range(8)], "doc_id long, text string")
    model = lm_score.fit_language_model(df, PIECE_MODEL)
    r = lm_score.lm_score(df, model).first()
    assert r.score / r.n_tokens > -0.1  # the order is certain; counts alone give -0.6


def test_frequent_ids_keep_an_identity():
    of = attention.Classes.from_counts(np.arange(32_000, 0, -1)).of
    assert len(set(of[:300])) == 300 and of.max() + 1 >= 384


def test_order_of_less_frequent_pieces_counts():
    ids = np.random.default_rng(4).permutation(300)  # each is followed by one other, always
    classes = attention.Classes.from_counts(np.bincount(ids, minlength=32_000))
    text = np.tile(ids, 112)  # a multiple of the block
    windows, targets, weight, _ = attention.cut(classes.of[text], np.array([len(text)]))
    model = attention.train(windows, targets, weight)
    log_p = model.log_likelihood(windows, targets).ravel() + classes.log_within[text]
    assert log_p[-300:].mean() > -1  # chance is -5.7


def test_attention_learns_beyond_the_first_sample(spark):
    """Texts outside the sample of the first fit have an order of their own."""
    ids = spark.range(1_200).select(F.col("id").alias("doc_id"))
    share = 20 / 1_200
    first = {r.doc_id for r in sample_by_hash(ids, F.col("doc_id"), share, 40).collect()}
    assert 0 < len(first) < 40
    plain, other = " ".join(["day night"] * 300), " ".join(["red blue green yellow"] * 200)
    df = spark.createDataFrame([(i, plain if i in first else other) for i in range(1_200)],
                               "doc_id long, text string").repartition(3)
    model = lm_score.fit_language_model(df, PIECE_MODEL, sample=20)
    scores = [r.score / r.n_tokens for r in lm_score.lm_score(df, model).collect()
              if r.doc_id not in first]
    assert min(scores) > -0.3  # counts alone give -0.6


@pytest.mark.parametrize("text", ["\u00a0", "\u3000 \u3000", "\x1c", "\x1f\t\x85", " \t\n\x0b\x0c\r", ""])
def test_words_of_other_white_space(text):
    assert lm_score.ascii_words(text) == [w.decode() for w in words(text)]


def test_long_words_are_not_broadcast(spark):
    long = "x" * 100_000
    df = spark.createDataFrame([(i, f"{long} a b") for i in range(3)], "doc_id long, text string")
    model = lm_score.fit_language_model(df, PIECE_MODEL)
    assert sorted(model.frequent) == ["a", "b"]
    assert {(r.n_tokens, r.n_known, round(r.base_score, 4)) for r in
            lm_score.lm_score(df, model).collect()} == {
        (4, 4, round(4 * math.log10(4 / (12 + 4 + 1)), 4))}


PARAGRAPH = " ".join(f"word{i}" for i in range(45)) + "."
MENU = '<nav><a href="/">Home</a> <a href="/b">More</a></nav>'


@pytest.mark.parametrize("page,kept", [
    ('<div class="layout has-sidebar"><article><p>{0}</p></article></div>', True),
    ('<article class="post comments-open"><p>{0}</p></article>', True),
    ('<div id="legal-news"><p>{0}</p></div>', True),
    ('<div class="overflow-hidden"><p>{0}</p></div>', True),
    ('<div class="sidebar"><article class="post"><p>{0}</p></article></div>', True),
    ('<div class="widget"><main><p>{0}</p></main></div>', True),
    ('<form id="aspnet"><article><p>{0}</p></article></form>', True),
    ('<div class="widget"><p>' + "{0} " * 20 + "</p></div>", True),
    ('<div class="sidebar"><p>{0}</p></div>', False),
    ('<article><p>' + "More text here. " * 300 + '</p><div class="widget">{0}</div></article>', False),
    ('<div class="comments"><p>' + "{0} " * 20 + "</p></div>", False),
    ('<article class="comment"><p>{0}</p></article>', False),
    ('<div class="comments"><article><p>{0}</p></article></div>', False),
    ('<main><div class="related-posts"><article><p>{0}</p></article></div></main>', False),
    ('<aside><article><p>{0}</p></article></aside>', False),
    ('<div hidden><main><p>{0}</p></main></div>', False),
    ('<div class="cookie-notice"><p>{0}</p></div>', False),
])
def test_html_wrappers(page, kept):
    text = main_text(f"<html><body>{page.format(PARAGRAPH)}{MENU}</body></html>", main_text_tree())
    assert (PARAGRAPH in text) == kept and "Home" not in text


def test_toxicity_learns_a_repeated_id_once(spark):
    rows = [(i, f"{'awful' if i % 2 else 'lovely'} text number{i % 7} here") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    repeated = docs.union(spark.createDataFrame(rows[:1] * 400, docs.schema)).repartition(4)
    once = toxicity.fit_toxicity(docs, labels)
    assert once and toxicity.fit_toxicity(repeated, labels) == once
