"""Ranked search, licence scan and resampling against brute force, ties, odd rows and round trips."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tabulyst.llm import licenses, oracles, ranking, resampling
from tabulyst.llm.textbytes import ALNUM, split_words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def terms(text):
    return TERM.findall(lowered(text))


def ranked(docs, items, best=20):
    """Rows (item, rank, doc, score) by the definition."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    full = [c for _, c in held if c]
    n, total = len(full), sum(sum(c.values()) for c in full)
    df = Counter(t for c in full for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in held:
            size = sum(c.values())
            m = 75 + (25 * size * n) // total if total else 0
            score = sum(int(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, doc is not None, doc if doc is not None else 0, doc))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(found, key=lambda x: x[:3])[:best], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["É", "straße", "日本", "K9", "a" * 300]
    docs = [(i, " ".join(draw.choices(words, weights=[1 / (1 + j) for j in range(len(words))], k=draw.choice([1, 5, 40, 200])))) for i in range(300)]
    docs += [(1000 + i, "W1, w2; w3!") for i in range(60)] + [(2000, None), (2001, ""), (2002, "?!"), (None, "w1 w2 w3"), (5, docs[5][1])]
    items = [(f"q{i}", " ".join(draw.choices(words, k=draw.choice([1, 3, 30])))) for i in range(40)]
    items += [("ties", "w1 w2 w3 w3"), ("none", None), ("blank", "  "), ("new", "unseen"), ("twice", "w4 W4"), ("twice", "w4 W4"), (None, "w5")]
    return docs, items


def frames(spark, corpus):
    docs, items = corpus
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(9), spark.createDataFrame(items, "item_id string, text string")


def rows(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def test_search_is_brute_force(spark, corpus):
    assert rows(ranking.search(*frames(spark, corpus))) == ranked(*corpus)


@pytest.mark.parametrize("name,value", [("QUERIES", 3), ("TERMS", 2), ("EXACT", 10**11), ("EXACT", 10**7), ("DOCUMENTS", 7), ("BLOCK_CHARS", 200), ("SALTS", 1)])
def test_tiles_change_nothing(spark, corpus, monkeypatch, name, value):
    docs, items = frames(spark, corpus)
    monkeypatch.setattr(ranking, name, value)
    assert rows(ranking.search(docs, items, best=7)) == ranked(*corpus, best=7)


def test_partial_sums_are_exact():
    """Weights near the bound: tiles hold sums that float64 can't, if added at once."""
    n = 40
    block = ranking.Block(["a"], np.array([1]), np.arange(n, dtype=np.uint64), np.zeros(n, np.int64), np.arange(n), np.full(n, 10**5 - 1, np.int64))
    weight = np.full(n, 20_011, np.int64)
    tiles = ranking.Tiles(block, weight).tiles
    assert len(tiles[0][2]) > 1
    impact = np.full(n, 999_983, np.int64)
    found = ranking.Tiles.scores(*tiles[0][2:], 1, 1, np.zeros(n, np.int64), np.arange(n), impact)
    assert int(found[0, 0]) == n * (10**5 - 1) * 20_011 * 999_983


def test_search_of_odd_rows(spark, messy, none, corpus):
    _, items = frames(spark, corpus)
    ask = spark.createDataFrame([("dog", "Dog katze", 1)], "item_id string, text string, x int").toDF("item_id", "text", "TEXT")
    found = rows(ranking.search(messy, ask))
    plain = [(r[0], r[1]) for r in messy.collect()]
    assert found == ranked(plain, [("dog", "Dog katze")])
    assert {x[2] for x in found} == {1, 6, 7, 8, None}
    assert ranking.search(none, items).count() == 0
    assert ranking.search(messy, items.limit(0)).count() == 0
    texts = [(None if i is None else f"s{i}", t) for i, t in plain]
    named = ranking.search(spark.createDataFrame(texts, "doc_id string, text string"), ask)
    assert [(r["doc_id"], r["score"]) for r in named.orderBy("rank").collect()] == [x[2:] for x in sorted(ranked(texts, [("dog", "Dog katze")]), key=lambda x: x[1])]


def own_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def drawn(docs, target, longest=1, buckets=10_000):
    def found(text):
        w = own_words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    own, other = Counter(b for _, t in docs for b in found(t)), Counter(b for t in target for b in found(t))
    s, t = sum(own.values()), sum(other.values())
    gain = [math.floor(1000 * math.log((other[b] + 1) * (s + buckets) / ((own[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out = []
    for doc, text in docs:
        f = found(text)
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(own_words(text))])
    able = sorted((x for x in out if x[5] >= 20), key=lambda x: (-x[3], x[0] is not None, x[0] or 0, x[1]))
    for r, x in enumerate(able[: 10 * len(able) // 100], 1):
        x[4] = r
    return sorted((tuple(x[:5]) for x in out), key=str)


@pytest.mark.parametrize("longest,buckets", [(1, 10_000), (3, 500)])
def test_resampling_is_brute_force(spark, corpus, longest, buckets):
    docs, items = frames(spark, corpus)
    found = resampling.resample(docs, items, longest=longest, buckets=buckets)
    got = sorted((tuple(r[x] for x in ("doc_id", "n_features", "weight", "score", "rank")) for r in found.collect()), key=str)
    assert got == drawn(corpus[0], [t for _, t in corpus[1]], longest, buckets)
    assert resampling.sample(docs, items, longest=longest, buckets=buckets).count() >= sum(x[4] is not None for x in got)


def test_checksums_of_words():
    text = "a bb ccc " + "d" * 63 + " " + "e" * 64 + " " + "f" * 65 + " " + "g" * 5000 + " Ä日"
    data = np.frombuffer(text.encode(), np.uint8)
    words = split_words(data, np.array([0, len(data)]), ALNUM)
    _, found = resampling.features(words, 2, 1 << 31)
    own = text.split()
    assert found.tolist() == [zlib.crc32(x.encode()) % (1 << 31) for x in [*own, *(f"{a} {b}" for a, b in zip(own, own[1:]))]]


def test_planes_are_sums():
    draw = np.random.default_rng(1)
    gain = draw.integers(-20_000, 20_000, 777)
    row, bucket = np.sort(draw.integers(0, 1100, 60_000)), draw.integers(0, 777, 60_000)
    bucket[:20_000] = 5  # counts of many bits
    expected = np.zeros(1200, np.int64)
    np.add.at(expected, row, gain[bucket])
    assert (resampling.GainPlanes(gain).weights(1200, row, bucket) == expected).all()


def test_resampling_of_odd_rows(spark, messy, none):
    target = spark.createDataFrame([("the dog",), (None,)], "text string")
    found = {(r["doc_id"], r["n_features"]): r for r in resampling.resample(messy, target).collect()}
    plain = [(r[0], r[1]) for r in messy.collect()]
    assert sorted((tuple(r[x] for x in ("doc_id", "n_features", "weight", "score", "rank")) for r in resampling.resample(messy, target).collect()), key=str) == drawn(plain, ["the dog"])
    assert found[(2, 0)]["weight"] == found[(3, 0)]["weight"] == 0 and found[(2, 0)]["rank"] is None
    assert resampling.resample(none, target).count() == 0
    assert resampling.resample(messy, target.limit(0)).count() == messy.count()


def scanned(df, **options):
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    return sorted((tuple(r[x] for x in columns) for r in licenses.scan(df, **options).collect()), key=str)


def based(text):
    w = own_words(text)
    found = [(i, label) for phrase, label in licenses.BASE for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in found]
    return len(w), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


FULL = {label: text for label, text, _ in licenses.TEMPLATES}
CASES = [
    (1, "Foo. Released under the MIT License, and the mit\n\nlicense; Apache-License."),
    (2, "GNU General\tPublic License v3 or MIT licenses, mit"),
    (3, FULL["bsd"].upper()),
    (4, "x = 1\n# " + FULL["unlicense"].replace(" ", "\n# ", 4)),
    (5, "Licensed under CC BY-NC 4.0."),
    (6, "license mit public general, by cc 4 0"),
    (7, "redistribution and use in source and binary forms is not said here; binary source forms"),
    (8, "ACME LICENSE K Kelvin MIT LiCENSE İ mit license"),
    (9, " ".join([FULL["mit"], "noise " * 5000, FULL["isc"]])),
    (10, None), (11, ""), (12, "?!"), (None, "mit license"), (1, "again MIT license"),
]


def test_base_places_and_templates(spark):
    found = scanned(spark.createDataFrame(CASES, "doc_id long, text string").repartition(3))
    assert sorted((x[0], *x[1:6]) for x in found if x[0] not in (None, 1)) == sorted((i, *based(t)) for i, t in CASES if i not in (None, 1))
    labels = {x[0]: x[6] for x in found if x[0] != 1}
    assert (labels[3], labels[4], labels[5], labels[6], labels[7], labels[9]) == ("bsd", "unlicense", "cc-by-nc", "", "", "isc,mit")
    scores = {x[0]: x[7] for x in found}
    assert scores[3] == scores[5] == 1.0 and scores[6] == scores[10] == 0.0 and all(0 <= x[7] <= 1 for x in found)


def test_licences_match_sql(spark):
    database = duckdb.connect()
    database.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    database.executemany("INSERT INTO documents VALUES (?, ?)", CASES)
    names = [x[0] for x in database.execute(oracles.LICENSES).description]
    expected = sorted((tuple(dict(zip(names, r))[x] for x in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")) for r in database.execute(oracles.LICENSES).fetchall()), key=str)
    assert scanned(spark.createDataFrame(CASES, "doc_id long, text string")) == expected


def test_licences_of_odd_rows(spark, messy, none):
    found = scanned(messy)
    assert len(found) == messy.count() and scanned(none) == []
    assert all(x[2:] == (0, None, None, "", "", 0.0) for x in found)
    assert {x[1] for x in found if x[0] in (2, 3, 4, 5)} == {0}
    with pytest.raises(ValueError, match="lower-case words"):
        licenses.scan(messy, templates=(("x", "Not Lower", ("x",)),))


def test_own_templates_and_phrases(spark):
    own = (("house", "for use inside acme only", ("acme only",)),)
    df = spark.createDataFrame([(1, "This is FOR USE inside Acme only!"), (2, "acme only"), (3, "use inside acme")], "doc_id long, text string")
    assert [(x[0], x[2], x[5], x[6]) for x in scanned(df, templates=own, base=(("inside acme", "in"),))] == [(1, 1, "in", "house,in"), (2, 0, "", ""), (3, 1, "in", "in")]
