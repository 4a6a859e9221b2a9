"""Named datasets: how to load one, its task and its target column."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Dataset:
    """A loaded table with its task and target."""

    name: str
    frame: DataFrame
    task: str
    target: str

    def __post_init__(self) -> None:
        if self.target not in self.frame.columns:
            raise ValueError(f"target column {self.target} is not in the table")

    @property
    def features_df(self) -> DataFrame:
        return self.frame.drop(self.target)

    @property
    def target_df(self) -> DataFrame:
        return self.frame.select(self.target)


Loader = Callable[[SparkSession], DataFrame]


class DatasetRegistry:
    """Name -> (loader, task, target)."""

    def __init__(self) -> None:
        self._entries: dict[str, tuple[Loader, str, str]] = {}

    def register(self, name: str, loader: Loader, task: str, target: str) -> None:
        if task not in ("classification", "regression"):
            raise ValueError(f"unknown task: {task}")
        self._entries[name] = (loader, task, target)

    def names(self) -> list[str]:
        return sorted(self._entries)

    def load(self, spark: SparkSession, name: str) -> Dataset:
        if name not in self._entries:
            raise ValueError(f"unknown dataset: {name}; known: {', '.join(self.names())}")
        loader, task, target = self._entries[name]
        return Dataset(name, loader(spark), task, target)
