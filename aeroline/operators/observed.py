"""Rows counted by the action that writes them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class Counted:
    """Counts of the rows that a batch action writes; ready when it has run."""

    def __init__(self) -> None:
        self.observation = Observation()

    def of(self, df: DataFrame) -> DataFrame:
        return df.observe(self.observation, F.count(F.lit(1)).alias("rows"))
