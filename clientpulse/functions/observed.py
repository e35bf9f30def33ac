"""Sums taken while rows pass by on their way into a table, so that they cost no second scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import types as T


@dataclass(frozen=True)
class Watched:
    """Rows with aggregates attached; ``summary`` is there once an action has read all of them."""

    rows: DataFrame
    _observation: Observation
    _schema: T.StructType

    def summary(self) -> DataFrame:
        """The aggregates as one row. Waits for the first action on ``rows``."""
        found = self._observation.get
        return self.rows.sparkSession.createDataFrame([tuple(found[f.name] for f in self._schema.fields)], self._schema)


def watched(df: DataFrame, columns: Sequence[Column]) -> Watched:
    """``df`` with named aggregates of its rows, taken by the next action."""
    observation = Observation()
    return Watched(df.observe(observation, *columns), observation, df.agg(*columns).schema)
