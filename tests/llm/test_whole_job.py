"""Places where an operator once did less than the whole job."""

import random

import numpy as np

from patronflow.llm import neardup, pii, quality


def test_cut_regions_are_searched_again(spark):
    """One region of 3,000 classes is cut (by its third minimum or by partition
    borders); all its classes are named, though none is crowded."""
    def signature(k):
        values = np.random.default_rng(k).integers(0, 1 << 16, neardup.HASHES)
        values[:3] = [7, 7, k // 10] if k < 3000 else [9, 9, k]
        return values.astype(">u2").tobytes()

    def key(k):
        return k.to_bytes(16, "big")

    classes = spark.createDataFrame([(key(k), k, 100, signature(k)) for k in range(3050)],
                                    "class binary, root long, n_shingles long, signature binary")
    labels = neardup._labels(classes, "n_shingles").filter("tree = 0").coalesce(1)
    found = neardup._candidates(labels, 2, 80)
    assert found.filter("a IS NOT NULL").count() == 0
    got = {bytes(r[0]) for r in neardup._crowded(labels, found).collect()}
    assert {key(k) for k in range(3000)} <= got


def test_search_by_rare_shingles_misses_no_pair(spark):
    """Texts over one template (similarity 0.65) with partners from 0.7 to 0.9."""
    rng = random.Random(5)
    texts = []
    for k in range(60):
        own = [f"w{rng.randrange(10 ** 6)}" for _ in range(25)]
        texts.append([f"t{j}" for j in range(100)] + own)
        texts.append([f"t{j}" for j in range(100)] + own[:k % 25] + [f"v{k}x{j}" for j in range(k % 25, 25)])
    sets = [set(zip(t, t[1:])) for t in texts]
    alike = {(a, b) for b in range(len(sets)) for a in range(b)
             if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    rows = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "id long, text string")
    active = neardup.describe(rows, "text", 2).selectExpr("id", "class", "signature", "id AS root")
    number = {bytes(r["class"]): r["id"] for r in active.collect()}
    named = active.join(rows, "id").select("class", "text")
    got = {tuple(sorted((number[bytes(r.a)], number[bytes(r.b)])))
           for r in neardup._rare_pairs(active, named, 2, 80).collect()}
    assert alike and alike <= got
    assert len(got) < 3 * len(alike)


def test_more_entities_than_one_space_of_surrogates(spark):
    """More titled names than three syllables make, all ends of a short phone
    number, and a secret without a letter, whose surrogate would be itself."""
    greek = "αβγδεζηθικ"
    rows = [("name:m", "α" + "".join(greek[int(c)] for c in f"{k:04d}")) for k in range(1500)]
    rows += [("name:f", "β" + "".join(greek[int(c)] for c in f"{k:04d}")) for k in range(500)]
    rows += [("phone", f"1{k:03d}") for k in range(1000)]
    rows += [("secret", "________"), ("email", "______@a.com"), ("ip", "9.9.9.9")]
    done = pii.assign(spark.createDataFrame(rows, "kind string, entity string"), b"k").collect()
    assert len(done) == len(rows)
    real = {(k[:4], e) for k, e in rows}
    new = {(r.kind[:4], r.new) for r in done}
    assert len(new) == len(rows) and not new & real
    assert max(r.turn for r in done) < 12
    longer = next(r for r in done if r.kind == "phone" and len(r.new) > 4)
    mention = f"({longer.entity[:2]}) {longer.entity[2:]}"
    assert pii.canonical("phone", pii.render("phone", mention, longer.new)) == longer.new


def test_limits_follow_the_source(spark):
    """Repeated lines up to 40 per mille in one source, 240 in the other, and
    one document of 150 in each: out of the ordinary in the first alone."""
    rows = [(k, source, 1000, 5000, 0, (k * top) // 300, 0, 1000)
            for source, top in (("calm", 40), ("noisy", 240)) for k in range(300)]
    rows += [(900, source, 1000, 5000, 0, 150, 0, 1000) for source in ("calm", "noisy")]
    measured = spark.createDataFrame(rows, "id long, source string, n_words long, word_chars long, "
                                     "n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long")
    measured = measured.selectExpr("*", "'en' AS lang")
    ends = quality.limits(quality.sketches(measured, "lang", "source"))
    kept = {r.source: r.kept for r in quality.with_verdict(measured, ends, "lang", "source")
            .filter("id = 900").collect()}
    assert kept == {"calm": False, "noisy": True}
    share = quality.with_verdict(measured, ends, "lang", "source").filter("kept").count() / len(rows)
    assert share > 0.97


def test_every_labelled_row_is_learned(spark):
    """A few labelled texts, each in letters of its own, among more rows than a sample of
    20,000 takes: all stay, as does an unlabelled text in the letters of each."""
    from patronflow.llm import langid

    def text(k, seed):
        rng = random.Random(seed)
        return " ".join("".join(chr(0x4E00 + 4 * k + rng.randrange(4)) for _ in range(4)) for _ in range(40))

    odd = [(k + 100 * n, text(k, k), None if n else "en") for n in range(2) for k in range(40)]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string").union(
        spark.range(1000, 41_000).selectExpr("id", "'the same text in plain words'", "'en'"))
    kept = langid.keep_known(docs, key=["doc_id"])
    assert kept.count() == 40_080
    assert {(r.doc_id, r.lang) for r in kept.filter("doc_id < 1000").collect()} == {(i, "en") for i, _, _ in odd}


def test_near_duplicates_write_few_files(spark, tmp_path, monkeypatch):
    """Small tables between the steps are not spread over all shuffle partitions, and the
    components stay those of brute force."""
    from patronflow.llm import common

    made = iter(range(10**6))
    monkeypatch.setattr(common, "shared_folder", lambda _: str(tmp_path / str(next(made))))
    monkeypatch.setattr(neardup, "REGION", 8)  # regions are cut, so that every round has work
    rng = random.Random(7)
    rows = []
    for k in range(40):
        words = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        for n in range(5):
            rows.append((len(rows), k, " ".join([*words[:58], f"x{n}", f"y{k}"])))
    docs = spark.createDataFrame(rows, "doc_id long, of long, text string")
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                           "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "30")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        found = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, width=2).collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert found == {i: 5 * k for i, k, _ in rows}
    files = [len(list(folder.glob("part-*"))) for folder in tmp_path.iterdir()]
    assert len(files) > 20 and max(files) <= spark.sparkContext.defaultParallelism


def _few(spark, tmp_path, monkeypatch, run):
    """Files of each stored table and of the result, with 30 input and shuffle partitions."""
    from patronflow.llm import common

    made = iter(range(10**6))
    monkeypatch.setattr(common, "shared_folder", lambda _: str(tmp_path / str(next(made))))
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                           "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "30")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        rows = run().collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    return rows, [len(list(folder.glob("part-*"))) for folder in tmp_path.iterdir()]


def test_language_and_pii_write_few_files(spark, tmp_path, monkeypatch):
    """Tables between their steps are not spread over all partitions of small input."""
    from patronflow.llm import langid

    rows = [(k, f"mail user{k}@site{k}.com or call the people of the town {k}", "en") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    wide = docs.repartition(30 * spark.sparkContext.defaultParallelism)
    kept, files = _few(spark, tmp_path / "lang", monkeypatch, lambda: langid.keep_known(wide, key=["doc_id"]))
    assert {r.doc_id for r in kept} == set(range(600))
    assert files and max(files) <= 4 * spark.sparkContext.defaultParallelism
    done, files = _few(spark, tmp_path / "pii", monkeypatch, lambda: pii.pseudonymize(docs, b"k"))
    assert len({r.text for r in done}) == 600 and not {r.text for r in done} & {r[1] for r in rows}
    assert files and max(files) <= spark.sparkContext.defaultParallelism


def test_likely_rows_hold_all_that_are_wanted(spark):
    """All wanted keys pass, of the others few; NULL keys, repeated rows and columns of any name stay right."""
    from patronflow.llm.common import likely

    rows = spark.range(20_000).selectExpr("id", "id * 2 AS word", "'x' AS bits").union(
        spark.createDataFrame([(None, 1, "n"), (5, 9, "again")], "id long, word long, bits string"))
    wanted = spark.range(0, 1000).selectExpr("id").union(spark.createDataFrame([(None,), (7,)], "id long"))
    got = likely(rows, wanted, "id")
    assert got.columns == rows.columns
    ids = [r.id for r in got.collect()]
    assert len(ids) == len(set(ids)) + 1 and set(range(1000)) <= set(ids) and len(ids) < 1200
    assert likely(rows, wanted.limit(0), "id").count() == 0


def test_only_texts_with_candidates_are_exchanged(spark, monkeypatch):
    """Before the join of texts by id, nearly all texts that no candidate needs are gone."""
    rows = spark.range(5000).selectExpr("id", "concat_ws(' ', transform(sequence(1, 20), x -> hash(id, x))) AS text")
    classes = neardup.describe(rows, "text", 2).selectExpr("class", "id AS low")
    joined = []
    plain = neardup._texts_of
    monkeypatch.setattr(neardup, "_texts_of", lambda named, ids, width: (
        joined.append(named.count()), plain(named, ids, width))[1])
    found = neardup._with_texts(None, classes.filter("low < 50").select("class"), rows, classes, 2, 2)
    assert found.count() == 50
    assert 50 <= joined[0] < 100
