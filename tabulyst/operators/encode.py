"""Target and one-hot encoding of categories.

Target encoding has two paths: training rows get the mean of the other folds, new rows the mean of
all training rows. Both come from one aggregate that holds, per category, the sums over all rows and
over the rows outside each fold, so no row's own label enters its value.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder as OneHotVectors, StringIndexer, StringIndexerModel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.lookup import MAP_KEYS, Lookup
from ..functions.text import col, finite
from ..scratch import materialize
from .quantile import column_medians

SMOOTHING = 10.0
ENCODED = "_encoded"


def learned_medians(df: DataFrame, columns, rows=None) -> dict[str, float]:
    cleaned = df.select(*[finite(col(c)).alias(c) for c in columns])
    return {c: 0.0 if m is None else m for c, m in column_medians(cleaned, columns, rows=rows).items()}


def smoothed(count: Column, total: Column, prior: Column, strength: float = SMOOTHING) -> Column:
    return (total + F.lit(strength) * prior) / (count + F.lit(strength))


def category_means(
    df: DataFrame, columns, label: str, fold: str | None, folds: int, strength: float = SMOOTHING
) -> tuple[DataFrame, list[float]]:
    """(column, key, value[1 + folds]) and the priors; slot 0 is the full map, slot f + 1 leaves f out."""
    y = col(label)
    outside = [F.lit(True)] + [col(fold) != f for f in range(folds)] if fold else [F.lit(True)]
    priors = df.agg(*[F.avg(F.when(o, y)).alias(f"p{i}") for i, o in enumerate(outside)]).first()
    priors = [float(p) if p is not None else 0.0 for p in priors]
    kept = [y.alias("_y")] + ([col(fold).alias("_f")] if fold else [])
    keys = ["_y"] + (["_f"] if fold else [])
    long = df.select(*kept, *map(col, columns)).unpivot(keys, list(map(col, columns)), "column", "key")
    picks = [F.lit(True)] + ([F.col("_f") != f for f in range(folds)] if fold else [])
    sums = long.groupBy("column", "key").agg(
        *[F.count_if(o).alias(f"n{i}") for i, o in enumerate(picks)],
        *[F.sum(F.when(o, F.col("_y")).otherwise(0.0)).alias(f"s{i}") for i, o in enumerate(picks)],
    )
    values = [
        smoothed(F.col(f"n{i}"), F.col(f"s{i}"), F.lit(p), strength) for i, p in enumerate(priors)
    ]
    return sums.select("column", "key", F.array(*values).alias("value")), priors


class TargetEncoder:
    """Frame encoder; `transform(train=True)` gives the cross-fitted values of the training rows."""

    def __init__(self, folds: int = 5, strength: float = SMOOTHING, map_keys: int = MAP_KEYS):
        self.folds = folds
        self.strength = strength
        self.map_keys = map_keys

    def fit(
        self, df, numeric, categorical, label: str, fold: str | None = None, rows=None, nullable=None
    ):
        """`nullable` names the numeric columns that can hold nulls, all of them by default."""
        self.numeric, self.categorical, self.fold = list(numeric), list(categorical), fold
        self.medians = learned_medians(df, numeric if nullable is None else nullable, rows)
        self.lookups, self.priors = {}, [0.0] * (self.folds + 1)
        if self.categorical:
            table, self.priors = category_means(
                df, self.categorical, label, fold, self.folds, self.strength
            )
            self.adopt(materialize(table))
        return self

    def adopt(self, table: DataFrame) -> None:
        """Take the written (column, key, value) table; small columns become map literals."""
        self.table = table
        sizes = {r["column"]: r["count"] for r in table.groupBy("column").count().collect()}
        small = [c for c in self.categorical if sizes.get(c, 0) <= self.map_keys]
        maps: dict[str, dict] = {c: {} for c in small}
        for row in table.where(F.col("column").isin(small)).collect():
            maps[row["column"]][row["key"]] = row["value"]
        for c in self.categorical:
            part = table.where(F.col("column") == c).select("key", "value")
            self.lookups[c] = Lookup(part, "array<double>", maps.get(c))

    @property
    def columns(self) -> list[str]:
        return self.numeric + [c + ENCODED for c in self.categorical]

    @property
    def inputs(self) -> list[str]:
        return self.columns

    def transform(self, df: DataFrame, train: bool = False) -> DataFrame:
        out = df
        if self.medians:
            out = out.withColumns(
                {c: F.coalesce(finite(col(c)), F.lit(float(m))) for c, m in self.medians.items()}
            )
        priors = F.array(*map(F.lit, self.priors))
        slot = col(self.fold) + 1 if train and self.fold else F.lit(0)

        def pick(values):
            return F.coalesce(F.get(values, slot), F.get(priors, slot))

        for c in self.categorical:
            out = self.lookups[c].attach(out, c, c + ENCODED, pick).drop(c)
        return out


class OneHotEncoder:
    """Sparse 0/1 vectors of the training categories; a new category gets zeros everywhere.

    Output columns are named by place, so category texts never become column names; `columns` names
    the slots of the assembled design.
    """

    def fit(self, df, numeric, categorical, label=None, fold=None, rows=None, nullable=None):
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.medians = learned_medians(df, numeric if nullable is None else nullable, rows)
        self.vocabulary: dict[str, list[str]] = {c: [] for c in self.categorical}
        if self.categorical:
            texts = df.select(*[col(c).cast("string").alias(n) for c, n in zip(self.categorical, self._names("_text"))])
            indexer = StringIndexer(
                inputCols=self._names("_text"), outputCols=self._names("_index"), stringOrderType="alphabetAsc",
                handleInvalid="skip",
            )
            self.vocabulary = dict(zip(self.categorical, map(list, indexer.fit(texts).labelsArray)))
        return self

    def _names(self, stem: str) -> list[str]:
        return [f"{stem}{i}" for i in range(len(self.categorical))]

    @property
    def columns(self) -> list[str]:
        return self.numeric + [f"{c}_{k}" for c in self.categorical for k in self.vocabulary[c]]

    @property
    def inputs(self) -> list[str]:
        """Columns of the transformed frame, numeric ones first, in the order of the slots."""
        known = [n for n, c in zip(self._names("_onehot"), self.categorical) if self.vocabulary[c]]
        return self.numeric + known

    def transform(self, df: DataFrame, train: bool = False) -> DataFrame:
        filled = {c: F.coalesce(finite(col(c)), F.lit(float(m))) for c, m in self.medians.items()}
        texts = {n: col(c).cast("string") for c, n in zip(self.categorical, self._names("_text"))}
        out = df.withColumns(filled | texts) if filled or texts else df
        known = [i for i, c in enumerate(self.categorical) if self.vocabulary[c]]
        if known:
            text, index, vector = ([f"{stem}{i}" for i in known] for stem in ("_text", "_index", "_onehot"))
            indexed = out
            for c, i, o in zip([self.categorical[i] for i in known], text, index):
                indexed = StringIndexerModel.from_labels(self.vocabulary[c], i, o, handleInvalid="keep").transform(indexed)
            # Sizes come from the index columns' metadata; the slot of unknown categories is the dropped last one.
            out = OneHotVectors(inputCols=index, outputCols=vector, dropLast=True).fit(indexed).transform(indexed)
        return out.drop(*self.categorical, *self._names("_text"), *self._names("_index"))
