"""Shared preparations, and searches solved from one matrix of products."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulyst.config import TrainConfig
from tabulyst.operators import linear, models, prepared
from tabulyst.operators.metrics import metric_aggregates
from tabulyst.operators.models import PriceModel, candidates
from tabulyst.operators.prepared import DesignStore, Preparation
from tabulyst.operators.select import assemble
from tabulyst.operators.split import kfold
from tabulyst.plans import train as job
from tabulyst.plans.listing import listing
from tabulyst.roles import ORDER_LISTING


@pytest.fixture(scope="module")
def rows(spark):
    frame = listing(spark, "/root/testdata/sf0.001").where("cast(id as int) < 400")
    return kfold(frame, "id", 2, 1).cache()


@pytest.fixture(scope="module")
def design(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=(300, 4)) * [1, 5, 0.1, 0] + [0, 3, 1e4, 7]
    y = x @ [1.0, -2.0, 3.0, 0] + 4 + draw.normal(size=300)
    frame = pd.DataFrame(x, columns=list("abcd")).assign(label=y)
    return x, y, assemble(spark.createDataFrame(frame).repartition(7), list("abcd"))


def test_moments_and_solutions(design):
    x, y, df = design
    found = linear.moments(df, 4, 300)
    z = (x - x.mean(0)) / np.where(x.std(0) > 1e-9, x.std(0), np.inf)
    yc = y - y.mean()
    assert found.gram == pytest.approx(z.T @ z / 300, abs=1e-9) and found.cross == pytest.approx(z.T @ yc / 300, abs=1e-9)
    settings = [(0.0, a / 300) for a in (0.1, 10.0, 100.0)] + [(a, 0.0) for a in (0.001, 0.1, 2.0)] + [(0.05, 0.2)]
    weights = linear.solve(found, settings)
    for (l1, l2), w in zip(settings, weights):
        slope = z.T @ (z @ w - yc) / 300 + l2 * w
        live = np.abs(w) > 0
        assert slope[live] == pytest.approx(-l1 * np.sign(w[live]), abs=1e-9)
        assert (np.abs(slope[~live]) <= l1 + 1e-9).all()
    guess = df.select(linear.predictions(found, weights).alias("p"), "label").collect()
    for i, w in enumerate(weights):
        assert sorted(r["p"][i] for r in guess) == pytest.approx(sorted(z @ w + y.mean()))


@pytest.mark.parametrize("family", ["ridge", "lasso", "elasticnet"])
def test_settings_at_once_equal_single_fits(spark, rows, family):
    model = PriceModel(ORDER_LISTING, family, cv_folds=2)
    settings = models.search_space(family)
    inside, held = rows.where("fold <> 0"), rows.where("fold = 0")
    found = model.settings_scores(settings, inside, held, metric_aggregates, DesignStore(), 0)
    for i in (0, len(settings) - 1):
        scored = model.with_params(settings[i]).fit(inside).predict(held)
        row = scored.agg(*metric_aggregates(F.col("label"), F.col("prediction"))).first()
        for m in ("mae", "rmse", "r2"):
            assert found[i][m] == pytest.approx(row[m], rel=1e-6)


def test_designs_are_made_once_and_go(spark, rows, monkeypatch):
    """Written designs follow folds and feature sets, not families; after the last use none is left."""
    made, gone = [], []
    fit, discard = Preparation.fit, prepared.discard
    monkeypatch.setattr(Preparation, "fit", lambda self, *a, **k: made.append(self.options["feature_set"]) or fit(self, *a, **k))
    monkeypatch.setattr(prepared, "discard", lambda df: gone.append(df.written_to) or discard(df))
    for families in (("ridge",), ("ridge", "lasso", "elasticnet", "voting")):
        made.clear()
        gone.clear()
        config = TrainConfig(models=families, feature_sets=("original", "engineered"), cv_folds=2, search_iterations=2, n_estimators=2)
        compared, store = candidates(ORDER_LISTING, config), DesignStore()
        job.expect(store, compared, config)
        scores = {}
        for name, model in compared.items():
            if job.drawn_settings(model.family, config):
                scores[name] = job.search(model, rows, config, store)[1]
            else:
                scores[name] = job.cross_validate(model, rows, 2, store=store)
        assert sorted(made) == ["engineered"] * 2 + ["original"] * 2
        # Also the rows of each fold and target, once each: raw for the baseline, log for the others.
        assert len(gone) == 4 + 4 and not store.made and not +store.uses
    alone = job.cross_validate(compared["voting__engineered__log"], rows, 2)
    for one, shared in zip(alone, scores["voting__engineered__log"]):
        assert one == pytest.approx(shared, rel=1e-9)


def test_stacks_share_the_designs_of_their_bases(spark, rows, monkeypatch):
    made, fit = [], Preparation.fit
    monkeypatch.setattr(Preparation, "fit", lambda self, *a, **k: made.append(1) or fit(self, *a, **k))
    PriceModel(ORDER_LISTING, "stacking", cv_folds=2, n_estimators=2).fit(rows.drop("fold"))
    assert len(made) == 3  # two inner folds and the whole


def test_tables_of_candidates_are_written_as_they_end(spark, rows, tmp_path, monkeypatch):
    config = TrainConfig(models=("ridge", "lasso"), feature_sets=("original",), cv_folds=2)
    cross_validate = job.cross_validate

    def broken(model, *args, **kwargs):
        if model.family == "lasso":
            raise InterruptedError
        return cross_validate(model, *args, **kwargs)

    monkeypatch.setattr(job, "cross_validate", broken)
    with pytest.raises(InterruptedError):
        job.train(spark, rows.drop("fold"), str(tmp_path / "run"), config, ORDER_LISTING)
    left = spark.read.parquet(str(tmp_path / "run/cv_folds_ridge__original__log"))
    assert left.count() == 6 and {r["metric"] for r in left.collect()} == {"mae", "rmse", "r2"}
