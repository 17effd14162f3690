"""Shared base of the fitted stages: state is a small JSON document kept as an ML Param."""

from __future__ import annotations

import json
from typing import Any

from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable


class FittedStage(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Model whose whole state survives ``write().save()`` and ``load()`` via its metadata."""

    state = Param(Params._dummy(), "state", "fitted state as JSON", TypeConverters.toString)

    def __init__(self, state: dict[str, Any] | None = None):
        super().__init__()
        if state is not None:
            self._set(state=json.dumps(state))

    @property
    def fitted(self) -> dict[str, Any]:
        if not self.isDefined(self.state):
            raise ValueError(f"{type(self).__name__} is not fitted; call fit() first")
        return json.loads(self.getOrDefault(self.state))
