"""A fitted linear pipeline written out as one SQL expression."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    MinMaxScalerModel,
    SQLTransformer,
    StandardScalerModel,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.regression import LinearRegressionModel

from .encoders import DummyEncoderModel, ExtraColumns, PopulationScalerModel


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _number(value: float) -> str:
    return f"cast('{float(value)!r}' AS double)"


class _Writer:
    """Keeps, for every column a stage has written, its expressions: one, or one per place of a vector."""

    def __init__(self, quote: str):
        self.quote = quote
        self.columns: dict[str, list[str]] = {}

    def read(self, name: str) -> list[str]:
        # a name no stage has written is a column of the data
        return self.columns.get(name) or [f"{self.quote}{name}{self.quote}"]

    def write(self, stage) -> None:
        match stage:
            case PipelineModel():
                for inner in stage.stages:
                    self.write(inner)
            case SQLTransformer() | ExtraColumns():
                pass        # their columns are those of the data the expression is applied to
            case StringIndexerModel():
                self._index(stage)
            case VectorAssembler():
                self.columns[stage.getOutputCol()] = [
                    e for c in stage.getInputCols() for e in self.read(c)]
            case MinMaxScalerModel():
                self._min_max(stage)
            case StandardScalerModel():
                self._standard(stage)
            case PopulationScalerModel():
                fitted = zip(
                    stage.getInputCols(), stage.getOrDefault(stage.means), stage.getOrDefault(stage.stds))
                for c, mean, std in fitted:
                    self.columns[c] = [f"({self.read(c)[0]} - {_number(mean)}) / {_number(std or 1.0)}"]
            case DummyEncoderModel():
                names = iter(stage.output_columns())
                for c, levels in stage.vocabulary().items():
                    for level in levels[1:]:
                        case = f"CASE WHEN {self.read(c)[0]} = {_text(level)} THEN 1 ELSE 0 END"
                        self.columns[next(names)] = [case]
            case LinearRegressionModel():
                places = self.read(stage.getFeaturesCol())
                if len(places) != len(stage.coefficients):
                    raise ValueError("the vector of the model is not made by the stages before it")
                # a coefficient of zero adds nothing; null must stay null, so its term stays too
                terms = [f"{_number(w)} * ({e})" for w, e in zip(stage.coefficients, places)]
                self.columns[stage.getPredictionCol()] = [" + ".join([_number(stage.intercept), *terms])]
            case _:
                raise TypeError(f"no SQL form for {type(stage).__name__}")

    def _index(self, stage: StringIndexerModel) -> None:
        cases = " ".join(f"WHEN {_text(v)} THEN {float(i)}" for i, v in enumerate(stage.labels))
        # 'keep' gives unseen levels a number of their own; otherwise they have no prediction
        other = f" ELSE {float(len(stage.labels))}" if stage.getHandleInvalid() == "keep" else ""
        source = self.read(stage.getInputCol())[0]
        self.columns[stage.getOutputCol()] = [f"CASE {source} {cases}{other} END" if cases else "NULL"]

    def _min_max(self, stage: MinMaxScalerModel) -> None:
        low, high = stage.getMin(), stage.getMax()
        self.columns[stage.getOutputCol()] = [
            f"({e} - {_number(a)}) / {_number(b - a)} * {_number(high - low)} + {_number(low)}" if b > a
            else _number((low + high) / 2)
            for e, a, b in zip(self.read(stage.getInputCol()), stage.originalMin, stage.originalMax)]

    def _standard(self, stage: StandardScalerModel) -> None:
        out = []
        for e, mean, std in zip(self.read(stage.getInputCol()), stage.mean, stage.std):
            if stage.getWithMean():
                e = f"({e} - {_number(mean)})"
            if stage.getWithStd():
                e = f"{e} / {_number(std)}" if std else f"{e} * 0"
            out.append(e)
        self.columns[stage.getOutputCol()] = out


def prediction_sql(model: PipelineModel, prediction: str = "prediction", quote: str = "`") -> str:
    """The prediction of a fitted linear pipeline over the columns its SQL stages make.

    Arithmetic and CASE only, so that other engines can run it; ``quote`` is their
    mark for names. Unknown stages are an error. A null input gives null.
    """
    writer = _Writer(quote)
    writer.write(model)
    return writer.read(prediction)[0]


def feature_statements(model: PipelineModel) -> list[str]:
    """The SQL statements of the pipeline's own SQL stages, in order, over ``__THIS__``."""
    out = []
    for stage in model.stages:
        if isinstance(stage, PipelineModel):
            out += feature_statements(stage)
        elif isinstance(stage, SQLTransformer):
            out.append(stage.getStatement())
        elif isinstance(stage, ExtraColumns):
            out.append(f"SELECT *, {', '.join(stage.getOrDefault(stage.expressions))} FROM __THIS__")
    return out
