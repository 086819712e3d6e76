"""Pipeline stages Spark ML lacks: dummy columns, population scaler, calendar."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F


class _Dummies(Params):
    inputCols = Param(
        Params._dummy(), "inputCols", "text columns to encode", TypeConverters.toListString
    )
    handleInvalid = Param(
        Params._dummy(), "handleInvalid",
        "'keep': an unseen level gets all zeros; 'error': it fails the job",
        TypeConverters.toString,
    )
    numbered = Param(
        Params._dummy(), "numbered",
        "name columns by the number of the level, for levels that make no safe column name",
        TypeConverters.toBoolean,
    )

    def getInputCols(self) -> list[str]:
        return self.getOrDefault(self.inputCols)


class DummyEncoder(Estimator, _Dummies, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the sorted levels of each column.

    The model writes one 0/1 column ``<column>_<level>`` per level but the
    first, or ``<column>_<number>`` if ``numbered``: any text can be a level
    then, also a dot, a backtick, or one that differs from another by case. Because the levels are stored, scoring data never changes the
    width of the output.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, handleInvalid="keep", numbered=False):
        super().__init__()
        self._setDefault(handleInvalid="keep", numbered=False)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "DummyEncoderModel":
        cols = self.getInputCols()
        pairs = F.explode(
            F.array(*[
                F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v"))
                for c in cols
            ])
        )
        # the vocabulary is the width of the output, so the model holds all of it
        seen = (
            dataset.select(pairs.alias("p")).select("p.*").where("v IS NOT NULL")
            .distinct().collect()
        )
        levels = {c: sorted(r["v"] for r in seen if r["c"] == c) for c in cols}
        model = DummyEncoderModel(
            inputCols=cols,
            handleInvalid=self.getOrDefault(self.handleInvalid),
            numbered=self.getOrDefault(self.numbered),
            levels=json.dumps(levels),
        )
        return model


class DummyEncoderModel(Model, _Dummies, DefaultParamsReadable, DefaultParamsWritable):
    levels = Param(
        Params._dummy(), "levels", "JSON: column -> sorted levels", TypeConverters.toString
    )

    @keyword_only
    def __init__(self, *, inputCols=None, handleInvalid="keep", numbered=False, levels=None):
        super().__init__()
        self._setDefault(handleInvalid="keep", numbered=False)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def vocabulary(self) -> dict[str, list[str]]:
        return json.loads(self.getOrDefault(self.levels))

    def output_columns(self) -> list[str]:
        return [
            self._name(c, i, v) for c, vs in self.vocabulary().items() for i, v in enumerate(vs) if i
        ]

    def _name(self, column: str, i: int, level: str) -> str:
        return f"{column}_{i if self.getOrDefault(self.numbered) else level}"

    def setHandleInvalid(self, value: str) -> "DummyEncoderModel":
        return self._set(handleInvalid=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        strict = self.getOrDefault(self.handleInvalid) == "error"
        out = []
        for c, levels in self.vocabulary().items():
            text = F.col(f"`{c}`").cast("string")
            value = text
            if strict and levels:
                unseen = F.concat(F.lit(f"unseen level in {c}: "), F.coalesce(text, F.lit("null")))
                value = F.when(text.isin(levels), text).otherwise(
                    F.raise_error(unseen).cast("string")
                )
            out += [
                F.coalesce(value == v, F.lit(False)).cast("int").alias(self._name(c, i, v))
                for i, v in enumerate(levels) if i
            ]
        return dataset.select("*", *out)


class _Scaler(Params):
    inputCols = Param(
        Params._dummy(), "inputCols", "numeric columns to standardise",
        TypeConverters.toListString,
    )

    def getInputCols(self) -> list[str]:
        return self.getOrDefault(self.inputCols)


class PopulationScaler(Estimator, _Scaler, DefaultParamsReadable, DefaultParamsWritable):
    """Standardises named columns in place with the population deviation.

    All means and deviations come from one aggregate over the fit data.
    """

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "PopulationScalerModel":
        cols = self.getInputCols()
        row = dataset.agg(
            *[F.avg(f"`{c}`") for c in cols], *[F.stddev_pop(f"`{c}`") for c in cols]
        ).first()
        if row[0] is None:
            raise ValueError("no rows to fit the scaler on")
        return PopulationScalerModel(
            inputCols=cols,
            means=[float(v) for v in row[:len(cols)]],
            stds=[float(v) for v in row[len(cols):]],
        )


class PopulationScalerModel(Model, _Scaler, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "mean per column", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "deviation per column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, means=None, stds=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = zip(
            self.getInputCols(), self.getOrDefault(self.means), self.getOrDefault(self.stds)
        )
        return dataset.withColumns({
            # a constant column is only centred
            c: (F.col(f"`{c}`") - F.lit(mean)) / F.lit(std or 1.0) for c, mean, std in fitted
        })


class ExtraColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds SQL expressions to the columns already there."""

    expressions = Param(
        Params._dummy(), "expressions", "SQL expressions with aliases",
        TypeConverters.toListString,
    )

    @keyword_only
    def __init__(self, *, expressions=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select("*", *[F.expr(e) for e in self.getOrDefault(self.expressions)])
