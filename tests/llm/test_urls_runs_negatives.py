"""URL rules, periodic runs and hard negatives against brute force, and odd rows."""

import random
import re

import numpy as np
import pytest

from patronflow.llm import negatives, runs, urlfilter

# --- URL rules ---------------------------------------------------------------------


def plain_host_path(url):
    if not url or "://" not in url:
        return "", ""
    m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S)
    return re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]


def plain_verdict(url, rules):
    host, path = plain_host_path(url)
    labels = host.split(".")
    fits = [(len(h) + len(p), len(h), h + p) for h, p in
            ((".".join(labels[-k:]), path[:e]) for k in range(1, len(labels) + 1)
             for e in range(len(path) + 1)) if h and h + p in rules]
    best = max(fits, default=None)
    return host, path, best and best[2], rules[best[2]] if best else "allow"


ODD_URLS = [None, "", "abc", "http://", "HTTP://EXAMPLE.NET/en/x", "http://x.example.net?a=/en/",
            "a://b.net/://c", "http://fooexample.net/en/", "http://example.net", "http://net/",
            "http://..net/", "ftp://Ünet.org/fr/#x", "http://a.net/\n/x", "x://y.org/fr/?q#f",
            "http://" + "s." * 300 + "org/fr/" + "p" * 5000]


def test_urls_match_brute_force(spark, rows):
    random.seed(5)
    part = lambda: random.choice(["a", "b", "ab", "en", "x"])
    urls = [f"http://{'.'.join(part() for _ in range(random.randint(1, 4)))}"
            f"/{'/'.join(part() for _ in range(random.randint(0, 3)))}" for _ in range(800)] + ODD_URLS
    pages = [(k % 700, u, "x", "y") for k, u in enumerate(urls)]
    listed, rules = [], {}
    for url in random.sample(urls[:800], 150):
        host, path = plain_host_path(url)
        labels = host.split(".")
        host, path = ".".join(labels[-random.randint(1, len(labels)):]), path[:random.randint(0, len(path))]
        listed.append((host, path, random.choice(["allow", "block"])))
        if rules.get(host + path) != "block":
            rules[host + path] = listed[-1][2]
    listed += [(None, "/", "block"), ("a", None, "block"), ("", "/", "block"), listed[0]]
    got = urlfilter.judge(spark.createDataFrame(pages, "page_id long, url string, rule string, key string"),
                          spark.createDataFrame(listed, "host string, path string, verdict string"))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert rows(got) == sorted(((k, *plain_verdict(u, rules)) for k, u, *_ in pages), key=repr)


def test_url_rules_without_rows(spark, rows):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (None, None)], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    one = spark.createDataFrame([("net", "/", "block")], none.schema)
    assert rows(urlfilter.judge(pages, none)) == sorted(
        [(1, "a.net", "/x", None, "allow"), (None, "", "", None, "allow")], key=repr)
    assert rows(urlfilter.judge(pages.limit(0), one)) == []
    with pytest.raises(ValueError):
        urlfilter.judge(pages, spark.createDataFrame([("net", "/", "maybe")], none.schema))


def test_cascade_is_exact_over_its_keys(spark):
    listed = spark.range(0, 30_000, 7).selectExpr("concat('k', id) AS key")
    others = spark.range(0, 30_000).selectExpr("concat('k', id) AS key")
    cascade = urlfilter.build_cascade(listed.union(listed), others)
    assert len(cascade.levels) > 2
    found = others.filter(cascade.member(others["key"]))
    assert found.exceptAll(listed).isEmpty() and found.count() == listed.count()


# --- Periodic runs -----------------------------------------------------------------


def plain_runs(words, least, repeats):
    found, n = {}, len(words)
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, repeats * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, q, n) for (s, n), q in found.items())


def random_words():
    words = [random.choice("ab" if random.random() < 0.5 else "abc") for _ in range(random.randint(0, 40))]
    if words and random.random() < 0.5:
        a, p = random.randrange(len(words)), random.randint(1, 6)
        words = [w if i < a else words[min(a + (i - a) % p, len(words) - 1)] for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize("least,repeats", [(6, 4), (2, 2), (4, 3)])
def test_runs_match_brute_force(least, repeats):
    random.seed(least)
    for _ in range(400):
        docs = [random_words() for _ in range(random.randint(1, 4))]
        base = np.cumsum([0] + [len(d) for d in docs])
        doc = np.repeat(np.arange(len(docs)), np.diff(base))
        values = np.array([ord(w) for d in docs for w in d], dtype=np.uint64)
        start, length, period = runs.find_runs(values, doc, least, repeats)
        got = [(int(d), int(s - base[d]), int(q), int(n)) for d, s, n, q in
               zip(doc[start], start, length, period)]
        assert got == [(k, *r) for k, d in enumerate(docs) for r in plain_runs(d, least, repeats)]


def test_runs_of_odd_texts(spark):
    texts = [None, "", " \t\n", "one", "a a a a a a", "a\ta  a\x0ba a A a", "ä ä ä ä ä ä z",
             "x y " * 30_000, "w " + "u v w " * 5 + "u q"] + [" ".join(random_words()) for _ in range(300)]
    docs = spark.createDataFrame([(k % 290, t, 1, 2) for k, t in enumerate(texts)],
                                 "doc_id long, text string, runs int, collapsed int")
    got = sorted((r.doc_id, [(x.start, x.period, x.length) for x in r.runs], r.collapsed)
                 for r in runs.periodic_runs(docs).collect())
    want = []
    for k, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        found = plain_runs(words, 6, 4) if k != 7 else [(0, 2, 60_000)]
        gone = {i for s, q, n in found for i in range(s + q, s + n)}
        want.append((k % 290, found, " ".join(w for i, w in enumerate(words) if i not in gone)))
    assert got == sorted(want)
    assert runs.periodic_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        runs.periodic_runs(docs, repeats=1)


# --- Hard negatives ----------------------------------------------------------------


def plain_negatives(rows, anchor, positives=5, negatives_=5, band=(80, 100)):
    rows = sorted({(i, label, tuple(v)) for i, label, v in rows})
    out = []
    for a, label, v in rows:
        if not anchor(a):
            continue
        dot = lambda w: sum(x * y for x, y in zip(v, w))
        others = sorted((-dot(w), i, k) for i, k, w in rows if i != a)
        near = [(i, -s) for s, i, k in others if k == label][:positives]
        for p, score in near:
            hard = [(i, -s) for s, i, k in others if k != label
                    and band[0] * score <= -100 * s <= band[1] * score][:negatives_]
            out += [(a, p, r, i, score, s) for r, (i, s) in enumerate(hard, 1)]
    return sorted(out)


@pytest.mark.parametrize("numbers", [1 << 19, 200])
def test_negatives_match_brute_force(spark, monkeypatch, numbers):
    """One tree, and many small ones; a third of the rows share a vector."""
    monkeypatch.setattr(negatives, "TREE_NUMBERS", numbers)
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(12, 6)) * 60
    data = [(i, int(rng.integers(0, 3)), [int(x) for x in middle[i % 12] + rng.normal(size=6) * (5 + i % 40)])
            for i in range(400)]
    data += [(i, i % 3, [50, 20, 0, 0, 0, 7]) for i in range(400, 600)]
    data += data[::9] + [(20, 1, [9, 9, 9, 0, 0, 0]), (21, 2, [70, 5]), (22, 0, []), (700, 1, [0] * 6),
                         (705, 9, [1, 2, 3, 4, 5, 6])]
    rows = spark.createDataFrame(data, "vec_id long, label long, vector array<int>")
    got = negatives.mine(rows, rows.filter("vec_id % 5 = 0"))
    assert sorted(tuple(r) for r in got.collect()) == plain_negatives(data, lambda i: i % 5 == 0)


def test_rows_that_take_no_part(spark, rows):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, -0.001], 0, 3), (2, None, 0, 3), (3, [None, 1.0], 0, 3), (4, [nan, 1.0], 0, 3),
            (5, [inf, 1.0], 0, 3), (6, [1.0, 2.0], None, 3), (None, [1.0], 0, 3), (7, [1e30, 0.0], 0, 3),
            (8, [], 1, 3), (9, [0.999, 2.0], 2, 3)]
    df = spark.createDataFrame(data, "vec_id long, e array<float>, label int, vector int")
    got = negatives.whole_vectors(df, "vec_id", "e", "label")
    assert rows(got) == [(1, 0, [256, -1]), (8, 1, []), (9, 2, [255, 512])]
    none = got.limit(0)
    assert negatives.mine(none, none).collect() == []
    assert negatives.mine(got, none).collect() == []


def test_tree_bounds_cover_their_members():
    rng = np.random.default_rng(2)
    vectors = np.round(np.concatenate([rng.normal(size=(300, 4)) * 3 + c for c in (0, 40, -90)]))
    tree = negatives.CoverTree.build(vectors, rng.integers(0, 4, 900), [np.array([k]) for k in range(900)])
    longest = (vectors ** 2).sum(1).max()
    points = np.column_stack([tree.vectors, np.sqrt(longest - (tree.vectors ** 2).sum(1))])
    depth = 0

    def leaves(node):
        if tree.radius[node] < 0:
            return [node]
        return [x for k in range(tree.first[node], tree.last[node]) for x in leaves(k)]

    for node in np.flatnonzero(tree.radius >= 0):
        below = leaves(node)
        assert np.linalg.norm(points[below] - points[node], axis=1).max() <= tree.radius[node] + 1e-6
        depth += 1
    assert depth > 3 and sorted(tree.ids) == list(range(900))


# --- Token ids over many scripts -----------------------------------------------------

def test_word_tokens_equal_the_plain_tokenizer():
    """Random texts over many scripts, marks and punctuation, special tokens included."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from patronflow.llm import packing

    path = public_tokenizers.path("word_bpe_49k.json")
    plain, fast = Tokenizer.from_file(path), packing.WordTokens(path)
    letters = [chr(c) for a, b in (
        (0x41, 0x5B), (0x61, 0x7B), (0xC0, 0x250), (0x370, 0x530), (0x531, 0x590), (0x5D0, 0x5EB),
        (0x620, 0x660), (0x905, 0x960), (0x1E00, 0x2000), (0x2100, 0x2150), (0x3040, 0x3100),
        (0x4E00, 0x4E40), (0xAC00, 0xAC20), (0x10400, 0x10450), (0xFF21, 0xFF5B)) for c in range(a, b)]
    marks = [chr(c) for c in range(0x300, 0x345)] + ["‍", "ͅ", "़"]
    others = list(".,;:!?|*#$%&'\"()-_/<>[]{}@^~`0123456789 \u0085\x0b\x0c\x1c\n\t\r") + [
        "'s", "'ll", "İ", "İ!!", "Σ", "ΑΣ", "ẞ", "ŉ", "ǰ", "K",
        "Å", "<|endoftext|>", "<|ENDOFTEXT|>", "</w>"]
    rng = random.Random(8)
    texts = ["İ!!", "TÜRKÇE BİLGİ. EVİ, GELDİ!", "ढ़! फ़.", "", None]
    for _ in range(12_000):
        texts.append("".join(rng.choice(letters) if x < 0.55 else rng.choice(marks) if x < 0.62
                             else " " if x < 0.75 else rng.choice(others)
                             for x in (rng.random() for _ in range(rng.randint(0, 25)))))
    for at in range(0, len(texts), 500):
        part = texts[at:at + 500]
        want = [e.ids for e in plain.encode_batch([t or "" for t in part], add_special_tokens=False)]
        got = [ids.tolist() for ids in fast.batch(part)]
        assert got == want, [(t, g, w) for t, g, w in zip(part, got, want) if g != w][:3]


# --- Language filters and one document of each group ---------------------------------

def test_filters_hold_what_the_sets_hold():
    """Bit-sliced lookups against plain sets, over more than one word of languages."""
    from patronflow.llm import langid

    rng = np.random.default_rng(3)
    for count in (3, 8, 70):
        sets = {f"l{k:02}": np.unique(rng.integers(0, 5000, 600)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                for k in range(count)}
        model = langid.Model.build(sets, {}, hashes=4)
        asked = np.arange(5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        mask, width = model.lookup(asked), 8 * model.slices.dtype.itemsize
        assert model.slices.shape[1] == -(-count // width)
        for k, name in enumerate(model.languages):
            got = (mask[:, k // width] >> mask.dtype.type(k % width)) & mask.dtype.type(1)
            true = np.isin(asked, sets[name])
            assert got[true].all()
            wrong = got[~true].mean()
            assert wrong <= 4 * model.false_positive[k] + 0.002


def invented(rng, k, words=40):
    letters = [chr(0x400 + (7 * k + j) % 60) + chr(0x561 + (5 * k + j) % 38) for j in range(8)]
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 4))) for _ in range(words))


def test_seventy_languages(spark):
    from patronflow.llm import langid

    rng = random.Random(6)
    rows = [(70 * n + k, invented(rng, k), f"l{k}") for n in range(12) for k in range(70)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.held_out, r.lang_pred) for r in langid.identify(docs).collect()}
    held = [(i, lang) for i, _, lang in rows if got[i][0]]
    assert len(held) > 150
    assert sum(got[i][1] == lang for i, lang in held) >= 0.95 * len(held)


def test_unlabelled_and_foreign_documents(spark):
    from patronflow.llm import langid

    rng = random.Random(7)
    rows = [(n, invented(rng, n % 3), f"l{n % 3}" if n % 5 else None, n) for n in range(90)]
    odd = [(100, "中文文本在这里写了很多字符用于测试语言识别", None, 0), (101, "qxzv jjkw zzqp vvkx", None, 0),
           (102, None, "l0", 0), (103, "", "l1", 0), (104, "123 !", "l1", 0)]
    schema = "doc_id long, text string, lang string, lang_pred int"
    docs = spark.createDataFrame(rows + odd, schema)
    kept = langid.keep_known(docs, key=["doc_id"])
    assert kept.columns == docs.columns
    got = {r.doc_id: r.lang for r in kept.collect()}
    assert got == {n: f"l{n % 3}" for n in range(90)}
    unlabelled = docs.withColumn("lang", docs["lang"].substr(9, 1)).replace("", None, ["lang"])
    assert {r.doc_id for r in langid.keep_known(unlabelled).collect()} == {*range(90), 100, 101}
    assert {(r.lang_pred, r.score) for r in langid.identify(unlabelled).collect()} == {("und", 0.0)}
    assert langid.keep_known(docs.limit(0)).collect() == []


def test_a_copied_text_does_not_break_the_sample_bound(spark):
    from patronflow.llm import langid

    docs = spark.range(4000).selectExpr("id AS doc_id", "'the same text' AS text", "'en' AS lang")
    sample, sizes = langid.labelled_sample(docs, key=["doc_id"], most_rows=400)
    assert sizes == {"en": 4000} and 250 < sample.count() < 550


def test_another_text_under_a_dropped_id_stays(spark):
    from patronflow.llm import neardup

    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    docs = spark.createDataFrame([(3, a, 1), (5, a, 2), (5, b, 3), (6, c, 4), (None, a, 5), (None, b, 6),
                                  (None, c + " z", 7), (None, None, 8), (6, c, 9), (9, c + " z", 10)],
                                 "doc_id long, text string, near_id int")
    got = sorted(r.near_id for r in neardup.keep_one(docs).collect())
    # Row 7 equals row 10, which goes for row 4.
    assert got == [1, 3, 4, 8, 9]
