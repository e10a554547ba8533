"""Language, toxicity and quality: held-out accuracy on the given tables, and defined results for odd rows."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulyst.llm import language, quality, queries, toxicity
from tabulyst.llm.frames import crc_class

TABLES = "/root/testdata/sf0.01"


def auc(rows, label):
    order = np.argsort([r["score"] for r in rows], kind="stable")
    ranks = np.empty(len(rows))
    scores = np.array([r["score"] for r in rows])[order]
    first = np.searchsorted(scores, scores, "left")
    last = np.searchsorted(scores, scores, "right")
    ranks[order] = (first + last + 1) / 2
    one = np.array([r[label] for r in rows]) == 1
    return (ranks[one].sum() - one.sum() * (one.sum() + 1) / 2) / (one.sum() * (~one).sum())


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(os.path.join(TABLES, "documents.parquet"))
    return language.fit(language.training_rows(docs))


def test_language_of_held_out_documents(spark, model):
    docs = spark.read.parquet(os.path.join(TABLES, "documents.parquet"))
    found = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(crc_class("doc_id", 5) == 0).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.97


def test_shares_of_mixed_documents(spark, model):
    docs = spark.read.parquet(os.path.join(TABLES, "documents.parquet")).where("n_chars between 1500 and 4000")
    one = {r["lang"]: r["text"] for r in docs.groupBy("lang").agg(F.min_by("text", "doc_id").alias("text")).collect()}
    mixed = spark.createDataFrame([(1, one["en"][:1200] + " " + one["de"][:1200]), (2, one["fr"][:1400] + " " + one["es"][:400])], "doc_id long, text string")
    found = {r["doc_id"]: r["mixture"] for r in language.identify(mixed, model).collect()}
    assert set(found[1]) == {"en", "de"} and abs(found[1]["en"] - 0.5) < 0.15
    assert set(found[2]) == {"fr", "es"} and found[2]["fr"] > 0.6


def test_language_of_messy_rows(messy, none, model):
    found = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(messy, model).collect()]
    assert len(found) == messy.count()
    by = {x[0]: x for x in found}
    for empty in (2, 3, 4, 5):
        assert by[empty][1:] == ("und", 0.0)
    assert by[7][1] == by[8][1] == by[None][1] == "de" and by[1][1] == "en"
    assert all(0 <= x[2] <= 1 for x in found)
    kept = language.keep_known(messy, model)
    least = {x[0] for x in found if x[2] >= 0.5}
    assert kept.columns == messy.columns and {r[0] for r in kept.collect()} == least >= {None, 1, 7, 8}
    unlearned = language.fit(none)
    assert {r["lang_pred"] for r in language.identify(messy, unlearned).collect()} == {"und"}
    assert language.identify(none, model).count() == 0


@pytest.mark.parametrize("name,label,least", [("op6_toxicity", "toxic", 0.75), ("op9_quality", "quality", 0.95)])
def test_held_out_labels(spark, name, label, least):
    found = queries.LLM_QUERIES[name](spark, TABLES)
    labels = spark.read.parquet(os.path.join(TABLES, "labels.parquet"))
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert found.count() == spark.read.parquet(os.path.join(TABLES, "documents.parquet")).count()
    assert auc(rows, label) > least
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


@pytest.mark.parametrize("kind", [toxicity, quality])
def test_scores_of_messy_rows(spark, messy, none, kind):
    labels = spark.createDataFrame([(1, 1, 0, "x"), (5, 0, 1, "x"), (7, None, None, "x"), (None, 1, 1, "x")], "doc_id long, quality int, toxic int, Doc_Id string")
    for given in (labels, labels.limit(0)):
        model = kind.fit(messy, given)
        rows = kind.score(messy, model).collect()
        assert len(rows) == messy.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert kind.score(none, model).count() == 0


def test_machine_is_the_sum_over_pairs():
    draw = np.random.default_rng(2)
    weights, factors = draw.normal(size=9), draw.normal(size=(9, 3))
    starts, index, values = np.array([0, 3, 3, 7]), np.array([0, 4, 8, 1, 2, 5, 6]), draw.normal(size=7)
    found = quality.Model(0.25, weights, factors).score(starts, index, values)
    for row in range(3):
        i, x = index[starts[row]:starts[row + 1]], values[starts[row]:starts[row + 1]]
        margin = 0.25 + weights[i] @ x + sum(factors[i[a]] @ factors[i[b]] * x[a] * x[b] for a in range(len(i)) for b in range(a))
        assert found[row] == pytest.approx(1 / (1 + np.exp(-margin)))


def test_toxicity_features():
    entry = np.array([toxicity._word_hash("idiot")], np.uint64)
    lexicon = toxicity.Lexicon(toxicity.HashSet(entry), np.array([5.0]))
    texts = ["you are an IDIOT!", "an 1d10t", "", "a calm day"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(x.encode()) for x in texts])))
    found = {n: c for n, c in zip(toxicity.FEATURES, toxicity.features(data, offsets, lexicon).T)}
    assert found["word_hits"].tolist() == [np.log(2), 0, 0, 0] and found["near_you"][0] == 25
    assert found["undone_hits"].tolist() == [0, np.log(2), 0, 0] and found["disguised_rate"][1] == 50
    assert found["capital_words"][0] == 0.25 and found["exclamation_rate"][2] == 0


def test_a_set_of_languages_ends_by_the_penalty_alone():
    k, each = 8, 60
    likely = np.full((k * each, k), -20.0)
    likely[np.arange(k * each), np.repeat(np.arange(k), each)] = -5.0
    shares, _ = language.mixtures(likely, np.array([0, k * each]))
    assert (shares[0] > 0).all() and abs(shares[0] - 1 / k).max() < 0.05
