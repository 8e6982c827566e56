"""Intermediate tables of one call, removed when its result is stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from campuslens.session import remove, scratch_path, stage


class Workspace:
    """A folder of staged tables in the shared checkpoint location.

    ``result`` stores a call's (small) result beside the folder and deletes
    the folder, so that a run leaves only results behind.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.root, self.made = spark, name, scratch_path(spark, name), 0

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        return stage(df, path=f"{self.root}/{self.made}-{name}")

    def result(self, df: DataFrame) -> DataFrame:
        out = stage(df, f"{self.name}-result")
        remove(self.spark, self.root)
        return out

    def drop(self) -> None:
        """Delete the folder of a call that keeps none of its tables."""
        remove(self.spark, self.root)
