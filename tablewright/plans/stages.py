"""Cleaner, transformer and row sums as stages of a ``pyspark.ml.Pipeline`` that can be saved, fitted or not."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from tablewright.operators.columns import row_sum
from tablewright.plans import cleaner, transformer

_KINDS = {"cleaner": (cleaner.Cleaner, cleaner.CleanerConfig, cleaner.CleanerModel),
          "transformer": (transformer.Transformer, transformer.TransformerConfig, transformer.TransformerModel)}


def _kind_of(thing, place: int) -> str:
    for kind, classes in _KINDS.items():
        if isinstance(thing, classes[place]):
            return kind
    raise ValueError(f"{type(thing).__name__} is neither a cleaner nor a transformer")


class _State(Params):
    """What a stage needs to be made again, as JSON."""

    kind = Param(Params._dummy(), "kind", "cleaner or transformer", TypeConverters.toString)
    state = Param(Params._dummy(), "state", "settings, and for a model what it learnt", TypeConverters.toString)


class StageModel(Model, _State, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted model of this package; ``fitted`` is the model itself."""

    def __init__(self, fitted=None):
        super().__init__()
        if fitted is not None:
            self._set(kind=_kind_of(fitted, 2), state=json.dumps(fitted.to_dict()))

    @property
    def fitted(self):
        return _KINDS[self.getOrDefault("kind")][2].from_dict(json.loads(self.getOrDefault("state")))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.transform(dataset)


class Stage(Estimator, _State, DefaultParamsReadable, DefaultParamsWritable):
    """``Stage(Cleaner(...))`` or ``Stage(Transformer(...))``."""

    def __init__(self, estimator=None):
        super().__init__()
        if estimator is not None:
            self._set(kind=_kind_of(estimator, 0), state=json.dumps(asdict(estimator.config)))

    @property
    def estimator(self):
        made, config, _ = _KINDS[self.getOrDefault("kind")]
        return made(config(**json.loads(self.getOrDefault("state"))))

    def _fit(self, dataset: DataFrame) -> StageModel:
        return StageModel(self.estimator.fit(dataset))


class RowSum(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Feature engineering stage: ``out`` = sum of the columns, missing as 0."""

    columns = Param(Params._dummy(), "columns", "columns to add up", TypeConverters.toListString)
    out = Param(Params._dummy(), "out", "name of the sum", TypeConverters.toString)

    def __init__(self, columns: Sequence[str] | None = None, out: str | None = None):
        super().__init__()
        if columns is not None:
            self._set(columns=list(columns), out=out)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return row_sum(dataset, self.getOrDefault("columns"), self.getOrDefault("out"))
