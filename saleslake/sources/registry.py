"""Logical source names and the tables behind them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from saleslake.operators.quality import FreshnessRule


@dataclass(frozen=True)
class Source:
    """A table known to the models. ``identifier`` is its physical name when that differs."""

    group: str
    name: str
    namespace: str
    identifier: str | None = None
    loaded_at_field: str | None = None
    freshness: FreshnessRule | None = None

    @property
    def table(self) -> str:
        return f"{self.namespace}.{self.identifier or self.name}"


@dataclass
class Registry:
    """Sources by group and name; a group may carry a default freshness rule."""

    sources: dict[tuple[str, str], Source] = field(default_factory=dict)
    group_freshness: dict[str, FreshnessRule] = field(default_factory=dict)

    def add(self, source: Source) -> None:
        self.sources[(source.group, source.name)] = source

    def get(self, group: str, name: str) -> Source:
        try:
            return self.sources[(group, name)]
        except KeyError:
            known = sorted(n for g, n in self.sources if g == group)
            raise LookupError(f"no source {name!r} in {group!r}; known: {known}") from None

    def read(self, spark: SparkSession, group: str, name: str) -> DataFrame:
        return spark.table(self.get(group, name).table)

    def freshness_of(self, group: str, name: str) -> FreshnessRule | None:
        """The table's own rule, or else the default of its group."""
        return self.get(group, name).freshness or self.group_freshness.get(group)
