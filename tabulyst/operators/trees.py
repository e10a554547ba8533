"""Tree families: a bagged forest and boosted trees over a binned design, and two boosting settings of MLlib."""

from __future__ import annotations

from pyspark.ml.regression import GBTRegressor

from .boosting import DEPTH, LEAVES, Boosted
from .forest import CODES, Forest

MAX_DEPTH = 30  # deepest tree of the forest
# Depth, leaves and row sampling of the boosted families.
BOOSTED = {
    "gbt_shallow": {"maxDepth": 3, "subsamplingRate": 0.8},
    "gbt_mid": {"grow": "leafwise", "leaves": LEAVES},
    "gbt_deep": {"maxDepth": 6},
}
LEARNING_RATE = 0.05
BINS = 255  # cut points per column of the boosted families


def forest(seed: int, trees: int, min_leaf: int = 2, depth: int = MAX_DEPTH) -> Forest:
    return Forest(seed, trees, min_leaf, depth)


def boosted(family: str, seed: int, trees: int, **options) -> GBTRegressor | Boosted:
    """The family's estimator; with `grow` (leafwise or symmetric) one over exact histograms, else MLlib's depth-wise one."""
    settings = {"stepSize": LEARNING_RATE, **BOOSTED[family], **options}
    grow = settings.pop("grow", None)
    if grow is None:
        return GBTRegressor(maxIter=trees, seed=seed, maxBins=BINS, **settings)
    rate = settings.pop("stepSize")
    if grow == "symmetric":
        settings["depth"] = settings.pop("maxDepth", DEPTH)
    return Boosted(trees, rate, CODES, grow, **settings)
