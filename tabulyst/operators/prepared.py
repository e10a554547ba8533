"""Preparations shared by the fits that need the same one: learned once, written once, deleted after the last use."""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, functions as F

from ..functions.text import col
from ..roles import RELATIVE_SIZE, Roles
from ..scratch import discard, materialize
from . import linear
from .encode import OneHotEncoder, TargetEncoder
from .features import RoleFeatures
from .knn import PeerComparables
from .select import FeatureSelector, assemble


class DesignStore:
    """Written tables by key, each with the number of uses that are still to come."""

    def __init__(self) -> None:
        self.made: dict[tuple, object] = {}
        self.uses: Counter = Counter()
        self.written: Counter = Counter()
        self._locks: dict[tuple, threading.Lock] = {}
        self._lock = threading.Lock()

    def expect(self, keys: Iterable[tuple]) -> None:
        self.uses.update(keys)

    def get(self, key: tuple, make: Callable[[], object]):
        """What `make` gave for the key; folds fitted at the same time wait for it."""
        with self._lock:
            lock = self._locks.setdefault(key, threading.Lock())
        with lock:
            if key not in self.made:
                self.made[key] = make()
                self.written[key] += 1
            return self.made[key]

    def done(self, keys: Iterable[tuple]) -> None:
        """One use of each key is over; what no use is left for goes, with its tables."""
        with self._lock:
            for key in keys:
                self.uses[key] -= 1
                if self.uses[key] <= 0 and key in self.made:
                    gone = self.made.pop(key)
                    discard(gone.design if isinstance(gone, Preparation) else gone)


class Preparation:
    """Features, encoder and selection learned from training rows, and their design (_id, features, label)."""

    def __init__(self, roles: Roles, options: dict):
        self.roles, self.options, self.peer, self._moments = roles, options, None, None

    def fit(self, train: DataFrame, rows: int, target: str, inner: str, complete=None) -> Preparation:
        """`train` is cleaned: doubles and stripped texts, with the target and the inner fold."""
        o, roles = self.options, self.roles
        folds, staged = min(o["cv_folds"], rows), train
        if o["feature_set"] == "peer":
            crossed = PeerComparables(roles).fit_folds(train, roles.label, inner, folds)
            staged = materialize(crossed.transform(train, fold=inner))
            self.peer = PeerComparables(roles).fit(train, roles.label)
        self.features = RoleFeatures(roles, o["feature_set"], o["missing_policy"])
        prepared = self.features.fit(staged, rows, complete).transform(staged)
        numeric, categorical = self.features.numeric_columns(), self.features.categorical_columns()
        self.encoder = TargetEncoder(folds) if o["encoding"] == "target" else OneHotEncoder()
        nullable = [c for c in (RELATIVE_SIZE,) if c in numeric]
        self.encoder.fit(prepared, numeric, categorical, target, inner, rows, nullable)
        encoded = self.encoder.transform(prepared, train=True)
        self.design = materialize(
            assemble(encoded, self.encoder.inputs).select(
                col(roles.id).alias("_id"), "features", F.col(target).alias("label")
            )
        )
        self.selector = FeatureSelector(
            o["selection"], o["selection_iterations"], o["seed"], o["selection_trees"]
        ).fit(self.design, self.encoder.columns, "_id")
        return self

    def kept(self) -> DataFrame:
        """The design with the selected columns only."""
        return self.selector.transform(self.design)

    def moments(self, rows: int) -> linear.Moments:
        """Means, deviations and products of the kept columns, counted once."""
        if self._moments is None:
            self._moments = linear.moments(self.kept(), len(self.selector.kept), rows)
        return self._moments

    def transform(self, df: DataFrame) -> DataFrame:
        """`df` with its prepared features, encoded, selected and assembled."""
        asked = df if self.peer is None else self.peer.transform(df)
        encoded = self.encoder.transform(self.features.transform(asked))
        return self.selector.transform(assemble(encoded, self.encoder.inputs))
