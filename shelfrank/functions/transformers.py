"""Response models as ``pyspark.ml`` transformers made of column expressions only.

They can be saved, loaded and chained in a ``PipelineModel``. Random ones hash the row key
(``userKeyColumn``, ``itemKeyColumn``), so a retry of a task repeats the same draws.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfrank.functions import chance, scalars
from shelfrank.functions.params import (
    HasConstant,
    HasIndex,
    HasItemKey,
    HasNoise,
    HasSeedLabel,
    HasUserKey,
    HasWeights,
)


class _Saved(DefaultParamsReadable, DefaultParamsWritable):
    """Parameters are all the state."""


class _ModelWriter(MLWriter):
    def __init__(self, model: "_SavedModel"):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model._save_data(path)


class _ModelReader(MLReader):
    def __init__(self, kind: type["_SavedModel"]):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind._load_data(self.sparkSession, path)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _SavedModel(MLReadable, MLWritable):
    """A fitted model is its parameters and what ``_save_data`` writes next to them."""

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)

    def _save_data(self, path: str) -> None:
        raise NotImplementedError

    @classmethod
    def _load_data(cls, spark: SparkSession, path: str):
        raise NotImplementedError


class ConstantResponse(Transformer, HasOutputCol, HasConstant, _Saved):
    @keyword_only
    def __init__(self, value: float = 1.0, outputCol: str = "response"):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(value=1.0, outputCol="response")

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), F.lit(self.getOrDefault(self.value)))


class NoiseResponse(Transformer, HasInputCol, HasOutputCol, HasNoise, HasSeedLabel, HasUserKey, HasItemKey, _Saved):
    """Normal noise, added to ``inputCol`` when one is set, alone otherwise."""

    @keyword_only
    def __init__(
        self,
        mu: float = 0.0,
        sigma: float = 1.0,
        outputCol: str = "response",
        clipNegative: bool = True,
        seed: int = 42,
        inputCol: str | None = None,
        userKeyColumn: str = "user_idx",
        itemKeyColumn: str = "item_idx",
        callNo: int = 0,
    ):
        super().__init__()
        self._setDefault(
            mu=0.0, sigma=1.0, outputCol="response", clipNegative=True, seed=42,
            userKeyColumn="user_idx", itemKeyColumn="item_idx", callNo=0,
        )
        self._set(**{name: value for name, value in self._input_kwargs.items() if value is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        draw = chance.normal(self.seedLabel(), self.getUserKeyColumn(), self.getItemKeyColumn())
        value = F.lit(self.getOrDefault(self.mu)) + F.lit(self.getOrDefault(self.sigma)) * draw
        if self.isSet(self.inputCol):
            value = F.col(self.getInputCol()) + value
        if self.getOrDefault(self.clipNegative):
            value = F.greatest(value, F.lit(0.0))
        return df.withColumn(self.getOutputCol(), value)


class BernoulliResponse(Transformer, HasInputCol, HasOutputCol, HasSeedLabel, HasUserKey, HasItemKey, _Saved):
    """1 when a uniform draw is at most the probability in ``inputCol``."""

    @keyword_only
    def __init__(
        self,
        inputCol: str = "probability",
        outputCol: str = "response",
        seed: int = 42,
        userKeyColumn: str = "user_idx",
        itemKeyColumn: str = "item_idx",
        callNo: int = 0,
    ):
        super().__init__()
        self._setDefault(
            inputCol="probability", outputCol="response", seed=42,
            userKeyColumn="user_idx", itemKeyColumn="item_idx", callNo=0,
        )
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        draw = chance.uniform(f"{self.seedLabel()}b", self.getUserKeyColumn(), self.getItemKeyColumn())
        return df.withColumn(self.getOutputCol(), F.when(draw <= F.col(self.getInputCol()), 1).otherwise(0))


class RevenueResponse(Transformer, HasInputCol, HasOutputCol, _Saved):
    priceCol = Param(Params._dummy(), "priceCol", "price column", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCol: str = "response", outputCol: str = "revenue", priceCol: str = "price"):
        super().__init__()
        self._setDefault(inputCol="response", outputCol="revenue", priceCol="price")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        amount = F.col(self.getInputCol()) * F.col(self.getOrDefault(self.priceCol))
        return df.withColumn(self.getOutputCol(), amount)


class ParametricResponse(Transformer, HasInputCols, HasOutputCol, HasWeights, _Saved):
    """Weighted sum of response columns."""

    @keyword_only
    def __init__(self, inputCols: list[str] | None = None, outputCol: str = "response", weights: list[float] | None = None):
        super().__init__()
        self._setDefault(outputCol="response")
        self._set(**{name: value for name, value in self._input_kwargs.items() if value is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        total = F.lit(0.0)
        for name, weight in zip(self.getInputCols(), self.getWeights(), strict=True):
            total = total + F.col(name) * F.lit(weight)
        return df.withColumn(self.getOutputCol(), total)


class AngularSimilarity(Transformer, HasInputCols, HasOutputCol, _Saved):
    @keyword_only
    def __init__(self, inputCols: list[str] | None = None, outputCol: str = "similarity"):
        super().__init__()
        self._setDefault(outputCol="similarity")
        self._set(**{name: value for name, value in self._input_kwargs.items() if value is not None})
        if inputCols is not None and len(inputCols) != 2:
            raise ValueError("two input columns are needed")

    def _transform(self, df: DataFrame) -> DataFrame:
        left, right = self.getInputCols()
        return df.withColumn(self.getOutputCol(), scalars.angular(left, right))


class VectorElement(Transformer, HasInputCol, HasOutputCol, HasIndex, _Saved):
    @keyword_only
    def __init__(self, inputCol: str = "vec", outputCol: str = "element", index: int = 0):
        super().__init__()
        self._setDefault(inputCol="vec", outputCol="element", index=0)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        source = F.col(self.getInputCol())
        if df.schema[self.getInputCol()].dataType.typeName() != "array":
            from pyspark.ml.functions import vector_to_array

            source = vector_to_array(source)
        return df.withColumn(self.getOutputCol(), scalars.element(source, self.getOrDefault(self.index)))


class RandomItemSelector(Estimator, HasUserKey, HasItemKey, HasSeedLabel, _Saved):
    """``fit`` a catalogue, ``transform`` users into user-item pairs with k random items."""

    k = Param(Params._dummy(), "k", "items per user", TypeConverters.toInt)

    @keyword_only
    def __init__(self, k: int = 5, userKeyColumn: str = "user_idx", itemKeyColumn: str = "item_idx", seed: int = 42):
        super().__init__()
        self._setDefault(k=5, userKeyColumn="user_idx", itemKeyColumn="item_idx", seed=42, callNo=0)
        self._set(**self._input_kwargs)

    def _fit(self, items: DataFrame) -> "RandomItemSelectorModel":
        if self.getItemKeyColumn() not in items.columns:
            raise ValueError(f"no column {self.getItemKeyColumn()}")
        return self._copyValues(RandomItemSelectorModel(items))


class RandomItemSelectorModel(Model, HasUserKey, HasItemKey, HasSeedLabel, _SavedModel):
    k = Param(Params._dummy(), "k", "items per user", TypeConverters.toInt)

    def __init__(self, items: DataFrame):
        super().__init__()
        self.items = items

    def _save_data(self, path: str) -> None:
        self.items.write.parquet(f"{path}/items")

    @classmethod
    def _load_data(cls, spark: SparkSession, path: str) -> "RandomItemSelectorModel":
        return cls(spark.read.parquet(f"{path}/items"))

    def _transform(self, users: DataFrame) -> DataFrame:
        from shelfrank.operators.sampling import users_with_random_items

        if self.getUserKeyColumn() not in users.columns:
            raise ValueError(f"no column {self.getUserKeyColumn()}")
        user_key, item_key = self.getUserKeyColumn(), self.getItemKeyColumn()
        pairs = users_with_random_items(
            users.withColumnRenamed(user_key, "user_idx"),
            self.items.withColumnRenamed(item_key, "item_idx"),
            self.getOrDefault(self.k),
            self.getSeed(),
        )
        return pairs.withColumnsRenamed({"user_idx": user_key, "item_idx": item_key})


class LatentFeatures(Estimator, HasInputCols, HasOutputCol, _Saved):
    """Principal components of numeric columns, returned as one column each."""

    k = Param(Params._dummy(), "k", "number of components", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCols: list[str] | None = None, outputCol: str = "latent", k: int = 8):
        super().__init__()
        self._setDefault(outputCol="latent", k=8)
        self._set(**{name: value for name, value in self._input_kwargs.items() if value is not None})

    def _fit(self, df: DataFrame) -> "LatentFeaturesModel":
        from pyspark.ml import Pipeline
        from pyspark.ml.feature import PCA, VectorAssembler

        pipeline = Pipeline(
            stages=[
                VectorAssembler(inputCols=self.getInputCols(), outputCol="__features"),
                PCA(k=self.getOrDefault(self.k), inputCol="__features", outputCol="__latent"),
            ]
        ).fit(df)
        return self._copyValues(LatentFeaturesModel(pipeline))


class LatentFeaturesModel(Model, HasInputCols, HasOutputCol, _SavedModel):
    k = Param(Params._dummy(), "k", "number of components", TypeConverters.toInt)

    def __init__(self, pipeline):
        super().__init__()
        self.pipeline = pipeline

    def _save_data(self, path: str) -> None:
        self.pipeline.save(f"{path}/pipeline")

    @classmethod
    def _load_data(cls, spark: SparkSession, path: str) -> "LatentFeaturesModel":
        from pyspark.ml import PipelineModel

        return cls(PipelineModel.load(f"{path}/pipeline"))

    def _transform(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        kept = [c for c in df.columns if c not in self.getInputCols()]
        coordinates = vector_to_array("__latent")
        return self.pipeline.transform(df).select(
            *kept,
            *[
                F.get(coordinates, F.lit(i)).cast("float").alias(f"{self.getOutputCol()}_{i}")
                for i in range(self.getOrDefault(self.k))
            ],
        )
