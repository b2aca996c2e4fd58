"""Every operator against a brute-force version on a small fixture with odd rows."""

import base64
import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from patronflow.llm import (brown, langid, mixing, neardup, packing, pii, quality, tokencount, warc,
                            winnow)

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{k % 97} item{k % 31}" for k in range(30000))
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    """The smallest documents and rows that are missing, empty, blank, long,
    repeated or tied, with columns named like the operators' own."""
    base = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    odd = [(900001, None, None, None, None), (900002, "", "en", "src0", 0),
           (900003, " \t\n", "en", "src0", 3), (900004, "one", "en", None, 3),
           (900005, LONG, "en", "src0", len(LONG)), (900006, LONG, "en", "src0", len(LONG)),
           (900007, "x" * 50_000, None, "src0", 50_000), (None, "no id here at all", "en", "src1", 17),
           (900008, "12 34 !!", "de", "src1", 8), (900008, "12 34 !!", "de", "src1", 8)]
    rows = base.unionByName(spark.createDataFrame(odd, base.schema))
    return rows.selectExpr("*", "'a' AS root", "1 AS id", "'b' AS epoch", "'c' AS lang_pred").cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [r.asDict() for r in docs.collect()]


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, docs, rows, nothing, width):
    sets = []
    for r in rows:
        w = words(lower(r["text"]))
        sets.append({tuple(w[k:k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    known = [k for k in range(len(rows)) if rows[k]["doc_id"] is not None]
    low = {k: rows[k]["doc_id"] for k in known}
    links = [(a, b) for a in known for b in known if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while True:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if before == low:
            break
    got = neardup.near_duplicates(docs, width=width).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id) == sorted(
        (rows[k]["doc_id"], len(sets[k]), low[k], low[k] == rows[k]["doc_id"]) for k in known
        if rows[k]["doc_id"])
    assert neardup.near_duplicates(nothing, width=width).count() == 0
    assert neardup.keep_one(docs).columns == docs.columns


def test_region_depth_adapts():
    rows = np.array([[0, 1, k // 3000, k // 500] for k in range(6000)], dtype=np.uint16)
    found = list(neardup.regions(rows, 2))
    assert all(b - a <= neardup.REGION for a, b in found)
    assert {k for a, b in found for k in range(a, b)} == set(range(6000))


def test_last_round_takes_all_alike_neighbours():
    n = 300
    labels = np.ones((n, neardup.LABEL), np.uint16)
    signatures = np.ones((n, neardup.HASHES), np.uint16)
    signatures[0, :neardup.HASHES - neardup.ALIKE + 1] = 7  # one minimum short of alike
    sizes, roots = np.full(n, 100), np.arange(n)
    sizes[1] = 79  # too small for 0.8 of the others
    left, right, full = neardup.region_pairs(labels, roots, None, signatures, sizes)
    pairs = {(min(a, b), max(a, b)) for a, b in zip(left.tolist(), right.tolist(), strict=True)}
    assert not len(full)
    assert pairs == {(a, b) for a in range(2, n) for b in range(a + 1, n)}
    _, _, full = neardup.region_pairs(labels, roots, 8, signatures, sizes)
    assert len(full)
    roots[:] = 5  # one component: nothing left to link
    assert not len(neardup.region_pairs(labels, roots, None, signatures, sizes)[0])


def test_warc_round_trip(spark, nothing):
    pages = spark.createDataFrame(
        [(1, "http://a", "x"), (2, "http://b\r\nWARC-Type: x", "x"), (3, None, None), (4, "", ""),
         (None, "c", "x"), (5, "d", "é" * 70_000)], "page_id long, url string, html string")
    first = {"x": 1, "": 3, "é" * 70_000: 5}
    got = {r.page_id: r for r in warc.archive_round_trip(pages).collect()}
    for r in pages.collect():
        body = (r.html or "").encode()
        g = got[r.page_id]
        assert g.payload_bytes == len(body)
        assert g.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        low = first[r.html or ""]
        assert (g.record_type, g.refers_to) == (("response", None) if low == r.page_id else ("revisit", low))
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_broken_archives():
    press = warc._compressor(b"")
    good = warc.record(1, "u", b"body", None, False)
    head = warc.dictionary_frame(b"")
    assert [d for _, d in warc.frames(head + press.compress(good))] == [good]
    bad = [b"", press.compress(good), head + press.compress(good)[:-4], head + b"12345678",
           head + struct.pack("<II", 0x184D2A50, 99)]
    for data in bad:
        with pytest.raises(warc.BadArchive):
            list(warc.frames(data))
    for data in (good[:-1], good.replace(b"WARC-Date", b"X-Date"), good.replace(b"WARC/1.1", b"WARC/9"),
                 good + b"x"):
        with pytest.raises(warc.BadArchive):
            warc.parse(data)
    with pytest.raises(warc.BadArchive):
        warc.payload_of(*warc.parse(good.replace(b"body", b"bodz")))


def test_language(docs, rows, nothing):
    got = {(r.doc_id, r.held_out): r for r in langid.identify(docs).collect()}
    right = total = 0
    for r in rows:
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        g = got[r["doc_id"], held]
        if not re.search(r"[^\W\d_]", r["text"] or ""):
            assert (g.lang_pred, g.score) == ("und", 0.0)
        elif held and (r["doc_id"] or 0) < 900000:
            total += 1
            right += g.lang_pred == r["lang"]
        assert 0 <= g.score <= 1
    assert right >= 0.95 * total
    assert langid.identify(nothing).count() == 0
    assert langid.keep_known(docs).columns == docs.columns


@pytest.mark.parametrize("seed", range(8))
def test_nearest_pairs_leave_nothing_out_unmarked(seed):
    """Every agreeing pair of different components is taken, or one of its rows is marked;
    a component that holds most of the region is not paired with itself."""
    rng = np.random.default_rng(seed)
    n, most = 300, 2
    base = rng.integers(0, 3, neardup.LABEL)
    labels = np.where(rng.random((n, neardup.LABEL)) < rng.choice([0.2, 0.7]), rng.integers(0, 9, (n, neardup.LABEL)), base)
    labels = labels[np.lexsort(labels.T[::-1])]
    roots = np.arange(n) if seed % 2 else np.where(rng.random(n) < 0.8, 1000, np.arange(n))
    left, right, full = neardup.nearest_pairs(labels, roots, most)
    got = {(min(a, b), max(a, b)) for a, b in zip(left.tolist(), right.tolist())}
    marked = set(full.tolist())
    for a in range(n):
        for b in range(a + 1, n):
            agree = (labels[a] == labels[b]).sum() >= neardup.LABEL // 2
            if agree and roots[a] != roots[b]:
                assert (a, b) in got or a in marked or b in marked
            else:
                assert (a, b) not in got
    assert len(got) <= 2 * most * (roots != 1000).sum()


def test_class_model(docs, rows, nothing):
    held = lambda r: r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2
    counts = Counter()
    for r in rows:
        if not held(r):
            counts.update(words(lower(r["text"])))
            counts[None] += 1
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in brown.score(docs).collect()}
    for r in rows:
        t = [*words(lower(r["text"])), None]
        g = got[r["doc_id"]]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (
            held(r), len(t), sum(counts[w] > 0 for w in t), n)
        assert g.base_score == pytest.approx(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
        assert g.score < 0
    assert brown.score(nothing).count() == 0


def test_exchange_finds_alternating_classes():
    table = np.zeros((7, 7))
    for a in (1, 2, 3):
        for b in (4, 5, 6):
            table[a, b] = table[b, a] = 50
    table[0, 1] = table[4, 0] = 1
    of = brown.exchange(table, classes=3)
    assert len(set(of[1:4])) == 1 and len(set(of[4:])) == 1 and of[1] != of[4] and of[0] == 0


def test_words_of_any_number_are_moved(spark, docs, rows, monkeypatch):
    """Against plain counts: the table after exchange, probabilities that add up, every score."""
    monkeypatch.setattr(brown, "FREQUENT", 20)
    monkeypatch.setattr(brown, "ENDINGS", 15)
    monkeypatch.setattr(brown, "LEAST", 4)
    fitted = []
    fit = brown.fit
    monkeypatch.setattr(brown, "fit", lambda *a: fitted.append(fit(*a)) or fitted[-1])
    held = lambda r: r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2
    got = {r.doc_id: r.score for r in brown.score(docs).collect()}
    model, classes = fitted[0]
    moved = {r["word"]: r["class"] for r in classes.collect()}

    texts = [words(lower(r["text"])) for r in rows]
    counts = Counter(w for r, t in zip(rows, texts) if not held(r) for w in t)
    import pyarrow as pa
    every = sorted({w for t in texts for w in t})
    found = brown.Words(pa.array(every))
    endings = brown.ending_codes(found)
    hashes = dict(zip(every, found.hash.view(np.int64).tolist()))
    history = dict(zip(every, model.histories(found.hash, endings).tolist()))
    unit = dict(zip(every, model.units.of_endings(endings).tolist()))
    top = set(sorted(counts, key=lambda w: (-counts[w], hashes[w]))[:20])
    assert {hashes[w] for w in counts if counts[w] >= 4 or w in top} == set(moved) and len(moved) > 40
    of = {w: moved.get(hashes[w], int(model.of[unit[w]])) for w in every}

    size = len(model.mass)
    table, seeds = np.zeros((size, size)), np.zeros((size, size))
    for r, t in zip(rows, texts):
        if not held(r):
            before = 0
            for w in [*t, None]:
                table[before, of[w] if w else 0] += 1
                seeds[before, history[w] if w else 0] += 1
                before = history[w] if w else 0
    assert brown.likelihood(table) > brown.likelihood(seeds)
    rare = [w for w in counts if hashes[w] not in moved]
    mass = np.zeros(size)
    for w, n in counts.items():
        mass[of[w]] += n
    mass[0] += sum(not held(r) for r in rows)
    for u in [0, *range(1 + 20, model.units.size)]:
        mass[model.of[u]] += 1
    assert np.allclose(np.maximum(mass, 1), model.mass)
    follow = np.log10((table + brown.SMOOTH * np.maximum(mass / mass.sum(), 1e-12))
                      / (table.sum(axis=1, keepdims=True) + brown.SMOOTH))
    r_, v_ = Counter(), Counter()
    for w in rare:
        r_[unit[w]] += counts[w]
        v_[unit[w]] += 1

    def inside(w):
        if hashes[w] in moved:
            return counts[w] / mass[of[w]]
        u = unit[w]
        return (r_[u] + 1) / mass[of[w]] * (counts[w] + 1) / (r_[u] + v_[u] + 1)

    total = np.zeros(size)
    for w in counts:
        total[of[w]] += inside(w)
    for u in range(1 + 20, model.units.size):  # one word never seen in each unit
        total[model.of[u]] += (r_[u] + 1) / mass[model.of[u]] / (r_[u] + v_[u] + 1)
    assert np.allclose(total[1:][mass[1:] > 0], 1) and np.allclose((10 ** follow).sum(axis=1), 1)
    for r, t in zip(rows, texts):
        before, score = 0, 0.0
        for w in t:
            score += follow[before, of[w]] + np.log10(inside(w))
            before = history[w]
        assert got[r["doc_id"]] == pytest.approx(score + follow[before, 0], rel=1e-9)


def test_improve_finds_the_class_of_every_word(spark):
    """Words that follow one of two histories, seeded at random; a class each is best."""
    rows = [(k, 30, 1 + k * 7 % 3 % 2, [(1 + k % 2, 30)]) for k in range(5000)]
    found = spark.createDataFrame(rows, "word long, n long, class int, hist array<struct<before: int, n: long>>")
    table = np.zeros((3, 3))
    for _, n, c, hist in rows:
        table[hist[0][0], c] += n
    done, after = brown.improve(found, table)
    assert len({(r.word % 2, r["class"]) for r in done.collect()}) == 2
    assert after.sum() == table.sum() and (after > 0).sum() == 2


def test_quality(docs, rows, nothing):
    got = Counter()
    for r in quality.judge(docs).collect():
        got[r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
            r.base_failed] += 1
        assert not (r.base_failed and r.kept)
    want = Counter()
    for r in rows:
        w, text = words(r["text"]), r["text"] or ""
        runs = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if runs[tuple(w[k:k + 5])] > 1 for j in range(5)}
        lines = [x for x in text.split("\n") if words(x)]
        want[r["doc_id"], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
             len(lines) - len(set(lines)), len(covered),
             len(w) < 10 or 100 * len(covered) > 20 * len(w)] += 1
    assert got == want
    assert quality.judge(nothing).count() == 0


def test_sketch_bins(spark):
    values = [0, 1, 31, 32, 33, 1000, 12345, 10 ** 9]
    got = spark.createDataFrame([(v,) for v in values], "v long").select(
        "v", quality.value_of(quality.bin_of(quality.F.col("v"))).alias("low")).collect()
    assert all(r.low <= r.v <= r.low * 17 / 16 + 1e-9 for r in got)


def _winnow(text):
    """Units, and the selected (hash, place) pairs, by plain loops."""
    import regex
    import xxhash

    spaceless = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"
                 "\U00020000-\U000323af")
    units = [u for word in re.findall(r"[^\x20\x09-\x0D]+", text or "")
             for run in regex.findall(f"[{spaceless}]|[^{spaceless}]+", word)
             for u in ([run] if len(run) <= winnow.LONG_WORD else run)]
    hashes = [xxhash.xxh64(u.encode(), seed=42).intdigest() for u in units]
    full = (1 << 64) - 1
    grams = []
    for i in range(max(len(units) - winnow.K + 1, 1 if units else 0)):
        value = 0
        for k, h in enumerate((hashes + [0] * winnow.K)[i:i + winnow.K]):
            by = winnow.K - 1 - k
            value ^= ((h << by) | (h >> (64 - by))) & full
        grams.append((value - (1 << 64) if value >> 63 else value) >> 31)
    picked = []
    for i in range(max(len(grams) - winnow.W + 1, 1 if grams else 0)):
        window = grams[i:i + winnow.W]
        least = min(window)
        at = max(k for k, g in enumerate(window) if g == least) + i
        if (least, at) not in picked[-1:]:
            picked.append((least, at))
    return units, picked


def _alike(one, other):
    a, b = ({h for h, _ in _winnow(t)[1]} for t in (one, other))
    return len(a & b) / len(a | b) if a | b else 1.0


def test_winnowing(spark, docs, rows, nothing):
    order = sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    got = {}
    for r in winnow.fingerprints(docs).collect():
        got[r.doc_id] = r
    prints = {}
    for k, r in enumerate(order):
        text, other = r["text"] or "", order[(k + 1) % len(order)]["text"] or ""
        cut = len(text) // 4
        edited = text[:len(text) - cut] + other[:cut]
        g = got[r["doc_id"]]
        if sum(x["doc_id"] == r["doc_id"] for x in rows) == 1:
            assert (g.n_chars, g.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            if len(text) < 3000 and len(other) < 3000:
                assert g.near_edited == pytest.approx(_alike(text, edited))
                assert g.near_next == pytest.approx(_alike(text, other))
        assert prints.setdefault(text, g.fingerprint) == g.fingerprint
        assert 0 <= g.near_edited <= 1 and 0 <= g.near_next <= 1
    assert winnow.fingerprints(nothing).count() == 0
    # selection: the rightmost minimum of every window
    odd = ["", " ", "one", "a b", "a a a a a a a a a a", "x" * 100, "\U0001f600 " * 9, "ab " * 5 + "y" * 33 + " z" * 5,
           "\u4e2d\u6587abc\u0e44\u0e17\u0e22 w " * 4, "q" * 32 + " " + "r" * 33 + "\u3042" * 3]
    some = docs.filter("length(text) between 1 and 3000").select("text").union(
        spark.createDataFrame([(t,) for t in odd], "text string"))
    packed = winnow.with_fingerprint(some, "text", "p").select(
        "text", winnow.positions_of("p").alias("at"), F.transform("p", lambda x: F.shiftright(x, 31)).alias("hash"))
    for r in packed.collect():
        assert list(zip(r["hash"], r["at"])) == _winnow(r.text)[1]


def test_spaceless_text_keeps_its_units(spark):
    """Three quarters shared: whatever follows, the shared part has the same units."""
    rng = random.Random(4)
    chinese = "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(900))
    token = "".join(rng.choice("abcdefghijklmnop") for _ in range(900))
    prose = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400))
    docs = spark.createDataFrame([(1, chinese), (2, prose), (3, token), (4, prose)], "doc_id long, text string")
    near = {r.doc_id: r.near_edited for r in winnow.fingerprints(docs).collect()}
    assert near[1] >= 0.6 and near[3] >= 0.6


def test_packing(docs, rows, nothing):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    got = packing.pack_documents(docs, path).collect()
    want = Counter()
    for r in rows:
        ids = np.array([*plain.encode(r["text"] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        for at in range(0, len(ids), 4096):
            part = ids[at:at + 4096]
            want[r["doc_id"], at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack_documents(nothing, path).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.choice([7, 16, 30]))
    lengths = rng.integers(1, size + 1, rng.integers(0, 80)).tolist()
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=rooms.__getitem__)] -= n
        else:
            rooms.append(size - n)
    place = packing._place(packing.plan(dict(Counter(lengths)), size))
    cells = set()
    for length, count in Counter(lengths).items():
        for rank in range(count):
            at = int(np.searchsorted(place["key"], (length << 48) + rank, side="right")) - 1
            step, deep = divmod(rank - place["rank"][at], place["each"][at])
            for z in range(length):
                cell = place["window"][at] + step, place["offset"][at] + deep * length + z
                assert cell not in cells and cell[1] < size
                cells.add(cell)
    assert sorted(size - n for n in Counter(w for w, _ in cells).values()) == sorted(rooms)


def test_surrogates(docs, nothing):
    key = b"k"
    text = ('Mail ann.lee@corp.example.com or ANN.LEE@CORP.EXAMPLE.COM, +1 (045) 555-3286, card 4539 1488 0343 6467 '
            'at 128.212.154.77; Mrs. Clara Schmidt met Frau Schmidt. api_key = "abcDEF123456"')
    new, n = pii.replace(text, key, lambda k, e: 0)
    assert n == 8 and pii.replace(text, key, lambda k, e: 0)[0] == new
    for part in ("ann.lee", "555-3286", "4539", "128.212", "Clara", "abcDEF"):
        assert part not in new
    mails = re.findall(r"\S+@[^\s,]+", new)
    assert mails[0].lower() == mails[1].lower() and mails[1].isupper()
    card = re.search(r"card ([\d ]+) at", new)[1]
    assert re.fullmatch(r"\d{4} \d{4} \d{4} \d{4}", card) and pii.luhn(card.replace(" ", ""))
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", new)
    clean = "Nothing to see in 2 lines, 20 000 000 of them.\nVersion 1.2.3.4.5"
    assert pii.replace(clean, key, lambda k, e: 0) == (clean, 0)
    out = pii.pseudonymize(docs, key, count="n")
    assert out.columns == [*docs.columns, "n"] and out.count() == docs.count()
    assert pii.pseudonymize(nothing, key).count() == 0


def test_surrogates_stay_distinct(spark, monkeypatch):
    """A tiny space forces conflicts; the mapping must still be one to one and
    avoid real entities, and both ways of handing it out must agree."""
    def tiny(key, kind, entity, turn=0):
        draw = pii._stream(key, kind, entity, turn)
        return f"10.0.0.{next(draw) % (8 if turn == 0 else 60000)}"

    rows = [(k, f"at 9.9.9.{k} and 10.0.0.3 and 9.9.9.{k}") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    real = pii.surrogate
    monkeypatch.setattr(pii, "surrogate", tiny)
    found = pii.entities(docs)
    mapping = {r.entity: pii.surrogate(b"k", r.kind, r.entity, 0) for r in found.collect()}
    assert len(set(mapping.values())) < len(mapping)
    monkeypatch.setattr(pii, "surrogate", real)
    done = pii.assign(found, b"k").collect()
    assert len({r.new for r in done}) == len(done) == 31
    assert not {r.new for r in done} & {r.entity for r in done}
    one = pii.pseudonymize(docs, b"k").orderBy("doc_id").collect()
    monkeypatch.setattr(pii, "BROADCAST_ROWS", -1)
    assert pii.pseudonymize(docs, b"k").orderBy("doc_id").collect() == one


def test_shortages_go_to_siblings_first():
    capacity = {("a", "x"): 10, ("a", "y"): 1000, ("b", "z"): 1000}
    assert mixing.budgets(capacity, 400, lambda p: 1.0) == {("a", "x"): 10, ("a", "y"): 190, ("b", "z"): 200}
    capacity[("a", "y")] = 50
    assert mixing.budgets(capacity, 400, lambda p: 1.0) == {("a", "x"): 10, ("a", "y"): 50, ("b", "z"): 340}
    assert mixing.budgets({("a", "x"): 5}, 400, lambda p: 1.0) == {("a", "x"): 5}
    assert mixing.budgets({}, 5, lambda p: 1.0) == {}


def test_mixing(spark, docs, nothing):
    out = mixing.mix(docs, ["lang", "source"], lambda p: 1.0, 3000, seed=3, epochs=3)
    assert out.columns == [*docs.columns, "epoch_"]
    got = Counter(tuple(r[c] for c in ("doc_id", "text", "epoch_")) for r in out.collect())
    tree = mixing.plan(docs, ["lang", "source"], lambda p: 1.0, 3000, seed=3, epochs=3).collect()
    leaves = {}
    key = docs.select("doc_id", "text", "lang", "source", mixing.word_count("text").alias("n"))
    for t in tree:
        leaves[t.lang, t.source] = t
    rows = key.crossJoin(spark.range(3).withColumnRenamed("id", "e")).selectExpr(
        "*", "xxhash64(cast(3 as int), e, doc_id, xxhash64(text)) AS k").collect()
    want = Counter()
    for leaf, t in leaves.items():
        left = t.budget
        for e in range(3):
            own = sorted((r for r in rows if (r.lang, r.source) == leaf and r.e == e), key=lambda r: r.k)
            used = 0
            for k in sorted({r.k for r in own}):
                part = [r for r in own if r.k == k]
                if used < left and t.leaf_tokens:
                    for r in part:
                        want[r.doc_id, r.text, e] += 1
                used += sum(r.n for r in part)
            left -= used
    assert got == want
    assert mixing.mix(nothing, ["lang"], lambda p: 1.0, 0.5).count() == 0


def test_token_counts(docs, rows, nothing):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = tokencount.vocabulary(path)

    def plain(word):
        word = tokencount.BEGIN + word
        best = [(0.0, 0)]
        for j in range(1, len(word) + 1):
            top = (best[j - 1][0] + model.unknown, best[j - 1][1] + 1)
            for i in range(max(0, j - model.longest), j):
                if word[i:j] in model.scores and best[i][0] + model.scores[word[i:j]] > top[0]:
                    top = (best[i][0] + model.scores[word[i:j]], best[i][1] + 1)
            best.append(top)
        return best[-1][1]

    seen = {}
    want = Counter()
    for r in rows:
        w = words(r["text"])
        for x in w:
            if x not in seen:
                seen[x] = plain(x)
        want[r["doc_id"], len(w), len(set(w)), sum(seen[x] for x in w)] += 1
    got = Counter(tuple(r) for r in tokencount.count_tokens(docs, path).collect())
    assert got == want
    assert tokencount.count_tokens(nothing, path).count() == 0


def test_pipeline(spark, docs, nothing):
    import corpus_pipeline

    now = docs
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, nothing, SF)
        assert empty.count() == 0
        before = now
        now = stage(spark, now, SF).cache()
        if name != "packing":
            assert now.columns == before.columns == empty.columns
            assert now.count() <= before.count()
    assert now.count() > 0
