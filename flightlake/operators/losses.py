"""Loss accounting on the job itself (F5): what was read, planned and rejected, by reason.

Counts are observed where the rows pass in the jobs that run anyway, so nothing is scanned
a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession

SCHEMA = "stage string, reason string, n long"


class Losses:
    """Named counts of a job's stages.  A stage's counts are known once a job over its rows has run."""

    def __init__(self) -> None:
        self._stages: dict[str, Observation] = {}

    def watch(self, rows: DataFrame, stage: str, **counts: Column) -> DataFrame:
        """``rows`` as they are; the first job over them fills in ``counts`` (aggregates)."""
        self._stages[stage] = Observation(stage)
        return rows.observe(self._stages[stage], *[c.alias(reason) for reason, c in counts.items()])

    def counts(self) -> dict[tuple[str, str], int]:
        return {(stage, reason): int(n) for stage, seen in self._stages.items() for reason, n in seen.get.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(*k, n) for k, n in self.counts().items()], SCHEMA).coalesce(1)
