"""Flight-detail payloads (S4) and their position trails."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.operators.flatten import flatten_by_map
from flightlake.schemas import DETAIL_COLUMNS, FLIGHT_DETAIL


def read_flight_detail(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    return spark.read.schema(FLIGHT_DETAIL).option("multiLine", multiline).json(path)


def parse_detail_text(df: DataFrame, text_col: str = "payload", keep=()) -> DataFrame:
    return df.select(*keep, F.from_json(F.col(text_col), FLIGHT_DETAIL).alias("_d")) \
        .select(*keep, "_d.*")


def detail_flat(details: DataFrame) -> DataFrame:
    """The 25 named detail fields (P7); a missing branch yields nulls."""
    return flatten_by_map(details, DETAIL_COLUMNS)


def trail_rows(details: DataFrame, payload_seq: str | None = None) -> DataFrame:
    """One row per trail fix with ``flight_id``, ``pos`` (0 = newest) and ``ts`` renamed ``time``.

    ``payload_seq`` names a column ordering several payloads of one flight
    (newer payload = larger); without it all payloads rank equal.
    """
    seq = F.col(payload_seq).cast("long") if payload_seq else F.lit(0).cast("long")
    return (details.select(F.col("identification.id").alias("flight_id"),
                           seq.alias("payload_seq"),
                           F.posexplode("trail").alias("pos", "_f"))
            .select("flight_id", "payload_seq", "pos", "_f.lat", "_f.lng", "_f.alt", "_f.spd",
                    F.col("_f.ts").alias("time"), "_f.hd"))
