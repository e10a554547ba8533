"""Cores that SQL can't express, against plain loops by their definitions."""

import math
import random

import numpy as np
import pytest

from tabulyst.llm import fingerprint, html, language, toxicity
from tabulyst.llm.textbytes import mix


def one_mixture(likely):
    """(shares, log likelihood) of one document by forward selection and long expectation-maximisation."""
    n, k = len(likely), len(likely[0])

    def value(share):
        return sum(math.log(sum(s * math.exp(x - max(row)) for s, x in zip(share, row))) for row in likely)

    best = max(range(k), key=lambda j: sum(row[j] for row in likely))
    share = [float(j == best) for j in range(k)]
    reached = value(share)
    while True:
        slope = []
        for j in range(k):
            if share[j]:
                slope.append(-math.inf)
            else:
                slope.append(sum(math.exp(row[j] - max(row)) / max(1e-300, sum(s * math.exp(x - max(row)) for s, x in zip(share, row))) for row in likely))
        new = max(range(k), key=lambda j: slope[j])
        if slope[new] <= n:
            return share, reached
        trial = [0.8 * s for s in share]
        trial[new] = 0.2
        for _ in range(400):
            sums = [0.0] * k
            for row in likely:
                joint = [s * math.exp(x - max(row)) for s, x in zip(trial, row)]
                for j in range(k):
                    sums[j] += joint[j] / sum(joint)
            trial = [x / n for x in sums]
        if value(trial) - reached <= 0.5 * math.log(max(n, 2)):
            return share, reached
        share, reached = trial, value(trial)


def test_mixtures_are_brute_force(monkeypatch):
    monkeypatch.setattr(language, "TOLERANCE", 1e-7)
    draw = np.random.default_rng(5)
    rows, sizes = [], [1, 2, 5, 20, 60, 60, 60, 90, 0, 40]
    for i, n in enumerate(sizes):
        of = draw.choice(5, n, p=np.roll([0.55, 0.35, 0.1, 0, 0], i) if i % 2 else np.eye(5)[i % 5])
        rows.append(draw.normal(-9, 1.0, (n, 5)) + 4 * np.eye(5)[of])
    shares, value = language.mixtures(np.concatenate(rows), np.cumsum([0, *sizes]))
    for i, n in enumerate(sizes):
        if n:
            expected, reached = one_mixture(rows[i].tolist())
            assert (shares[i] > 0).tolist() == [x > 0 for x in expected]
            assert shares[i] == pytest.approx(expected, abs=2e-3) and value[i] == pytest.approx(reached, abs=1e-2)
        else:
            assert shares[i].sum() == 0


PAGES = [
    "<html><body><div><ul><li><a>one</a></li><li><a>two words</a></li></ul></div><div><p>long text here, of some words</p><p>more <b>bold</b> text <a>link</a></p></div></body></html>",
    "<body>loose text<div>a<div>b<div>c</div></div></div><p>x<p>y<a>all of it</a></body>",
    "<div></div>",
    "",
]


@pytest.mark.parametrize("text", PAGES)
def test_densities_are_brute_force(text):
    page = html.Page(text)
    n = len(page.parent)
    below = [[j for j in range(1, n) if page.parent[j] == i and not page.noise[j]] for i in range(n)]

    def under_link(i):
        return i > 0 and (page.name[i] == "a" or under_link(page.parent[i]))

    def sums(i):
        """Characters, tags, link characters and link tags below a node."""
        own = sum(len(" ".join(t.split())) for node, t in page.events if node == i and t)
        total = [own, 0, own if under_link(i) else 0, 0]
        for j in below[i]:
            total = [a + b for a, b in zip(total, sums(j))]
            total[1] += 1
            total[3] += page.name[j] == "a"
        return total

    density, child_sums, body = html._densities(page)
    c_body, _, l_body, _ = sums(body)
    for i in range(n):
        if page.noise[i]:
            continue
        c, t, lc, lt = sums(i)
        expected = 0.0
        if c:
            log_base = math.log(c / max(c - lc, 1) * max(lc, 1) + l_body / c_body * c + math.e)
            expected = c / max(t, 1) * math.log(c / max(lc, 1) * max(t, 1) / max(lt, 1)) / math.log(log_base)
        assert density[i] == pytest.approx(expected)
        own = sum(len(" ".join(t.split())) for node, t in page.events if node == i and t)
        assert child_sums[i] == pytest.approx(own + sum(density[j] for j in below[i]))


@pytest.mark.parametrize("text", [b"", b"abc", b"the quick brown fox", bytes(random.Random(2).choices(b"ab ", k=300))])
def test_sketches_are_the_least_kmers_in_text_order(text):
    kmers = fingerprint.numbered_kmers(np.frombuffer(text, np.uint8))
    found = fingerprint.sketches(kmers)
    for i, seed in enumerate(fingerprint._SEEDS.tolist()):
        ranked = sorted(range(len(kmers)), key=lambda p: (((int(kmers[p]) >> 32) * seed) % 2**32, p))
        places = sorted((ranked + ranked[:1] * fingerprint.TUPLE)[: fingerprint.TUPLE])
        out = np.zeros(1, np.uint64)
        for j, p in enumerate(places):
            out = mix(out * fingerprint._PLACES[j] + kmers[p : p + 1])
        assert int(found[i]) == int(out[0]) >> 32


def test_lexicon_is_brute_force(spark):
    draw = random.Random(4)
    rows = []
    for i in range(400):
        words = draw.choices([f"w{j}" for j in range(50)], k=12)
        toxic = i % 8 == 0
        if toxic:
            words += draw.sample(["vile", "scum", "rot"], 2)
        elif i % 40 == 1:
            words.append("rot")
        rows.append((" ".join(words), float(toxic)))
    entry, z = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label double"))
    got = dict(zip(entry.tolist(), z.tolist()))
    for word in ["vile", "scum", "rot", *(f"w{j}" for j in range(50))]:
        k1, k0 = (sum(word in t.split() for t, y in rows if y == label) for label in (1, 0))
        n1, n0 = 50, 350

        def part(k, n, p):
            return (k * math.log(p) if k else 0) + ((n - k) * math.log(1 - p) if n - k else 0)

        common = (k1 + k0) / (n1 + n0)
        ratio = 2 * (part(k1, n1, k1 / n1) + part(k0, n0, k0 / n0) - part(k1, n1, common) - part(k0, n0, common))
        root = math.copysign(math.sqrt(max(0, ratio)), k1 / n1 - k0 / n0)
        name = toxicity._word_hash(word)
        assert (name in got) == (k1 >= toxicity.LEAST_DOCUMENTS and root >= toxicity.LEAST_Z)
        assert name not in got or got[name] == pytest.approx(root, rel=1e-6)


def test_fifty_labels_teach_toxicity(spark):
    """Few toxic labels: the folds leave none of lexicon, trees and calibration without them."""
    draw = random.Random(6)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "pe") for b in ("ran", "sel", "tor", "vim", "zed")]
    rows = []
    for i in range(900):
        text = draw.choices(words, k=draw.randrange(20, 60))
        toxic = i % 9 == 0
        for _ in range(3 * toxic):
            text.insert(draw.randrange(len(text)), draw.choice(["grobnak", "flurgid", "snarvle", "you"]))
        rows.append((i, " ".join(text), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    taught = docs.where("doc_id < 450").select("doc_id", "toxic")
    found = toxicity.score(docs, toxicity.fit(docs, taught)).where("doc_id >= 450").collect()
    caught = {label: np.mean([r["predicted"] for r in found if rows[r["doc_id"]][2] == label]) for label in (0, 1)}
    assert caught[1] > 0.85 and caught[0] < 0.02
