"""Flight-schedule payloads (S1): envelope ``{pagination, data: [...]}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.schemas import SCHEDULE_COLUMNS, SCHEDULE_ENVELOPE
from flightlake.sources.pulls import newest_nonempty, pull_name


def read_schedule_envelopes(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Landed schedule files, one envelope per file (or per line), with the ``pull`` they belong to.

    Text that is no JSON gives a row without records that holds it in ``broken`` (see ``operators.losses``).
    """
    schema = T.StructType([*SCHEDULE_ENVELOPE.fields, T.StructField("broken", T.StringType())])
    return (spark.read.schema(schema).option("multiLine", multiline).option("columnNameOfCorruptRecord", "broken").json(path)
            .withColumn("pull", pull_name()))


def parse_schedule_text(df: DataFrame, text_col: str = "payload") -> DataFrame:
    """Envelope JSON text in a column -> envelope struct columns ``pagination, data``."""
    env = F.from_json(F.col(text_col), SCHEDULE_ENVELOPE)
    return df.select(env.alias("_env")).select("_env.*")


def explode_records(envelopes: DataFrame) -> DataFrame:
    """One row per schedule record; the page's pagination (and pull, if known) is kept."""
    keep = ["pagination", *(c for c in ("pull",) if c in envelopes.columns)]
    return envelopes.select(*keep, F.explode("data").alias("_r")).select(*keep, "_r.*")


def read_schedule(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Landed envelopes -> one row per record with the nested record schema (all pulls)."""
    return explode_records(read_schedule_envelopes(spark, path, multiline)).drop("pagination")


def read_newest_schedule(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """The records of the newest non-empty pull: what the planner plans."""
    return explode_records(newest_nonempty(read_schedule_envelopes(spark, path, multiline))).drop("pagination")


def flat_schedule(records: DataFrame) -> DataFrame:
    """The 18-column planner table."""
    from flightlake.operators.flatten import flatten_by_map
    return flatten_by_map(records, SCHEDULE_COLUMNS)


def scheduled_only(df: DataFrame, statuses=("scheduled",), status_col: str = "flight_status"
                   ) -> DataFrame:
    """Source-side predicate: keep the requested statuses (F8, pushable)."""
    return df.filter(F.col(status_col).isin(list(statuses)))


def drop_null_status(df: DataFrame, status_col: str = "flight_status") -> DataFrame:
    """drop rows without a status."""
    return df.na.drop(subset=[status_col])


def nonempty(envelopes: DataFrame) -> Column:
    return F.size(F.col("data")) > 0
