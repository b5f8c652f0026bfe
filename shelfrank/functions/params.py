"""Shared ``pyspark.ml`` parameters of the transformers."""

from __future__ import annotations

from pyspark.ml.param import Param, Params, TypeConverters


class HasUserKey(Params):
    userKeyColumn = Param(Params._dummy(), "userKeyColumn", "user id column", TypeConverters.toString)

    def getUserKeyColumn(self) -> str:
        return self.getOrDefault(self.userKeyColumn)

    def setUserKeyColumn(self, value: str):
        return self._set(userKeyColumn=value)


class HasItemKey(Params):
    itemKeyColumn = Param(Params._dummy(), "itemKeyColumn", "item id column", TypeConverters.toString)

    def getItemKeyColumn(self) -> str:
        return self.getOrDefault(self.itemKeyColumn)

    def setItemKeyColumn(self, value: str):
        return self._set(itemKeyColumn=value)


class HasSeedLabel(Params):
    """Seed plus the number of the call, so that repeated calls can differ on purpose."""

    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)
    callNo = Param(Params._dummy(), "callNo", "number of the call", TypeConverters.toInt)

    def getSeed(self) -> int:
        return self.getOrDefault(self.seed)

    def setSeed(self, value: int):
        return self._set(seed=value)

    def setCallNo(self, value: int):
        return self._set(callNo=value)

    def seedLabel(self) -> str:
        return f"{self.getOrDefault(self.seed)}#{self.getOrDefault(self.callNo)}"


class HasWeights(Params):
    weights = Param(Params._dummy(), "weights", "one weight per input", TypeConverters.toListFloat)

    def getWeights(self) -> list[float]:
        return self.getOrDefault(self.weights)

    def setWeights(self, value: list[float]):
        return self._set(weights=value)


class HasNoise(Params):
    mu = Param(Params._dummy(), "mu", "mean of the noise", TypeConverters.toFloat)
    sigma = Param(Params._dummy(), "sigma", "standard deviation of the noise", TypeConverters.toFloat)
    clipNegative = Param(Params._dummy(), "clipNegative", "raise negatives to 0", TypeConverters.toBoolean)


class HasConstant(Params):
    value = Param(Params._dummy(), "value", "constant", TypeConverters.toFloat)


class HasIndex(Params):
    index = Param(Params._dummy(), "index", "zero-based position", TypeConverters.toInt)
