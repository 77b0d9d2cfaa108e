"""ML pipeline stages around the column operators, for use in a PipelineModel."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from recmill.functions.columns import join_lines
from recmill.operators.enrich import enrich, explode_urls


class SelectColumns(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Keep the named columns."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select(*self.getInputCols())


class ExplodeUrls(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """One row per url of a search response."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol="url"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return explode_urls(dataset, self.getInputCol(), self.getOutputCol())


class JoinLines(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Text of an array of line structs."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return join_lines(dataset, self.getInputCol(), self.getOutputCol())


class Enrich(Transformer, HasInputCol, HasOutputCol):
    """A provider's response to one column. Holds a function, so it is not saved."""

    concurrency = Param(
        Params._dummy(), "concurrency", "most calls at once, 0 for no bound", TypeConverters.toInt
    )

    def __init__(self, provider: Callable, responseSchema: str, inputCol: str, outputCol: str, concurrency: int = 0):
        super().__init__()
        self.provider = provider
        self.responseSchema = responseSchema
        self._set(inputCol=inputCol, outputCol=outputCol, concurrency=concurrency)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        limit = self.getOrDefault(self.concurrency) or None
        return enrich(
            dataset, self.provider, self.getInputCol(), self.getOutputCol(), self.responseSchema, concurrency=limit
        )
