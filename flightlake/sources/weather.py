"""Hourly weather payloads (S6, S7) -> long fact table ``(cell, ts_hour, metrics)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.functions.geo import grid_cell
from flightlake.schemas import WEATHER_METRICS, WEATHER_PAYLOAD
from flightlake.sources.pulls import issue_time, pull_number


def read_weather(spark: SparkSession, path: str, resolution_deg: float = 0.25,
                 multiline: bool = True) -> DataFrame:
    """Landed responses of observed weather (parallel hourly arrays), one row per cell and hour.

    Of several pulls (``sources.pulls.pull_number``) the newest one wins.
    """
    return latest_pull(unpivot_hours(_located(spark, path, resolution_deg, multiline), keep=("cell", "pull")))


def read_forecast(spark: SparkSession, path: str, resolution_deg: float = 0.25,
                  multiline: bool = True) -> DataFrame:
    """Landed forecast responses, one row per cell, valid hour and issue (``sources.pulls.issue_time``)."""
    located = _located(spark, path, resolution_deg, multiline, issue=issue_time())
    return latest_pull(unpivot_hours(located, keep=("cell", "pull", "issue")), keys=("cell", "ts_hour", "issue"))


def _located(spark: SparkSession, path: str, resolution_deg: float, multiline: bool, **more) -> DataFrame:
    # folders named pull= and issue= are times, not columns of the payload: read them from the file's path
    raw = spark.read.schema(WEATHER_PAYLOAD).option("multiLine", multiline).option("recursiveFileLookup", True).json(path)
    return raw.withColumns({"cell": grid_cell("latitude", "longitude", resolution_deg), "pull": pull_number()} | more)


def latest_pull(rows: DataFrame, keys: Sequence[str] = ("cell", "ts_hour"),
                metrics: Sequence[str] = WEATHER_METRICS, pull: str = "pull") -> DataFrame:
    """One row per ``keys``: the values of the newest pull, with its ``pull``.

    ``pull`` is a number that grows from pull to pull.  Rows of one pull that share
    the keys are the same hour landed twice, or points of one cell; each metric then
    takes its largest value (a decision: it makes the result unique).  Both
    orderings are numbers, so this is a hash aggregate with a partial step.
    """
    newest = rows.groupBy(*keys, pull).agg(*[F.max(m).alias(m) for m in metrics])
    return newest.groupBy(*keys).agg(*[F.max_by(m, pull).alias(m) for m in metrics], F.max(pull).alias(pull))


def unpivot_hours(df: DataFrame, keep: Sequence[str] = ("cell",),
                  metrics: Sequence[str] = WEATHER_METRICS, hourly: str = "hourly") -> DataFrame:
    """Parallel arrays ``hourly.time`` + ``hourly.<metric>`` -> one row per hour.

    Adds ``hour_index`` (position in the series, the forecast row number) and
    ``ts_hour`` (epoch of the hour).  Arrays are zipped by position.
    """
    zipped = F.arrays_zip(F.col(f"{hourly}.time").alias("ts_hour"),
                          *[F.col(f"{hourly}.{m}").alias(m) for m in metrics])
    return (df.select(*keep, F.posexplode(zipped).alias("hour_index", "_h"))
            .select(*keep, "hour_index", "_h.*"))
