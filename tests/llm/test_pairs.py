"""Jaccard join and its components against brute force."""

import random
import re

import corpus_pipeline
import pytest

from tabulyst.llm import jaccard
from tabulyst.llm.components import components
from tabulyst.llm.frames import Stages


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(4, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def roots_of(nodes, links):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def brute(rows):
    sets = [shingles(text) for _, text in rows]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    rank = {i: r for r, i in enumerate(order)}
    links = [
        (rank[i], rank[j]) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    ]
    root = roots_of(range(len(rows)), links)
    return sorted(((rows[i][0], len(sets[i]), rows[order[root[rank[i]]]][0]) for i in range(len(rows))), key=str)


def answer(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(df).collect()), key=str)


@pytest.fixture(scope="module")
def copies():
    """Families of near copies around the threshold, chains, common passages, exact copies and repeats."""
    draw = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    common = " ".join(draw.choices(words, k=30))
    rows, n = [], 0
    for size in (3, 8, 40, 120):
        for _ in range(3):
            text = draw.choices(words, k=size)
            for step in range(12):
                rows.append((n, " ".join(text) + (" " + common if step % 3 == 0 else "")))
                n += 1
                if step % 4 != 3:  # a chain: each changes one word of the one before
                    text = text[:]
                    text[draw.randrange(size)] = draw.choice(words)
    rows += [(n + i, common.upper()) for i in range(5)] + [(n + 9, ""), (n + 10, None), (None, common), (0, rows[0][1])]
    return rows


def test_jaccard_is_brute_force(spark, copies):
    assert answer(spark.createDataFrame(copies, "doc_id long, text string").repartition(7)) == brute(copies)


@pytest.mark.parametrize("frequent,pairs", [(2, 0), (1, 20), (10**6, 1)])
def test_order_and_rounds_change_nothing(spark, copies, monkeypatch, frequent, pairs):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "REST_PAIRS", pairs)
    assert answer(spark.createDataFrame(copies, "doc_id long, text string").repartition(3)) == brute(copies)


def test_messy_rows(messy, none):
    rows = [(r[0], r[1]) for r in messy.collect()]
    assert answer(messy) == brute(rows)
    assert answer(none) == []
    kept = sorted((r[0] for r in jaccard.keep_first(messy).collect()), key=str)
    assert kept == sorted([1, 2, 3, 4, 5, 6, 6, 7, 9, None], key=str)
    assert jaccard.keep_first(messy).columns == messy.columns


def test_components_of_long_paths(spark):
    draw = random.Random(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100) for i in range(1, 30)] + [(7, 7), (None, 3)]
    links += [tuple(draw.sample(range(200, 260), 2)) for _ in range(35)]
    found = components(spark.createDataFrame(links, "a long, b long"), Stages(spark)).collect()
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert {r["node"]: r["root"] for r in found} == roots_of({x for link in real for x in link}, real)
    assert components(spark.createDataFrame([], "a long, b long"), Stages(spark)).count() == 0


def test_pipeline_stage_links_from_four_fifths_of_five_words(spark):
    draw = random.Random(11)

    def fresh(k):
        return [f"v{draw.randrange(10**9)}" for _ in range(k)]

    rows, n = [], 0
    for size in (40, 104, 204):
        text = fresh(size)
        whole = size - 4  # shingles of five words
        for similarity in (0.78, 0.799, 0.80, 0.81, 0.83, 0.86):
            own = [x + f"s{n}" for x in text]
            rows += [(n, " ".join(own)), (n + 1, " ".join(own + fresh(round(whole / similarity) - whole)))]
            n += 2
    for _ in range(20):  # chains of changed words around the threshold
        text = draw.choices([f"w{i}" for i in range(300)], k=90)
        for _ in range(4):
            rows.append((n, " ".join(text)))
            text, n = text[:], n + 1
            for at in draw.sample(range(90), 2):
                text[at] = draw.choice(["a", "b", "c"])
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (text.split() for _, text in rows)]
    alike = [(i, j, len(sets[i] & sets[j]) / len(sets[i] | sets[j])) for i in range(len(rows)) for j in range(i)]
    root = roots_of(range(len(rows)), [(i, j) for i, j, x in alike if x >= 0.8])
    for low, high in ((0.80, 0.82), (0.82, 0.84)):
        assert sum(low <= x < high for _, _, x in alike) >= 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = {r["doc_id"] for r in corpus_pipeline.one_of_each_component(spark, docs, "").collect()}
    assert kept == {i for i in root if root[i] == i}
    found = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs).collect()}
    assert found == {i: c for i, _, c in brute(rows)}  # the defaults stay
