"""Airport-board payloads (S3): arrivals and departures of one airport page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.operators.flatten import flatten_keys
from flightlake.operators.snapshot import newest_complete_pull
from flightlake.schemas import BOARD_KEYS, BOARD_PAYLOAD
from flightlake.session import materialize
from flightlake.sources.pulls import pull_name


def read_board(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Landed board pages of all pulls, with the ``pull`` they belong to."""
    return spark.read.schema(BOARD_PAYLOAD).option("multiLine", multiline).json(path).withColumn("pull", pull_name())


def newest_board(payload: DataFrame, total: str | None = None) -> DataFrame:
    """The pages of each airport's newest complete pull (``operators.snapshot.newest_complete_pull``).

    Pages are read and parsed once: what is parsed is written with the numbers the choice needs.
    """
    sched = "airport.pluginData.schedule"
    held = [F.greatest(F.size(f"{sched}.{d}.data"), F.lit(0)) for d in ("arrivals", "departures")]
    pages = payload.withColumns({"_code": F.col("airport.code"), "_page": F.col("airport.page"), "_held": held[0] + held[1]})
    pages = materialize(pages, "board-pages")
    return newest_complete_pull(pages, "_code", "_page", "pull", "_held", total).drop("_code", "_page", "_held")


def parse_board_text(df: DataFrame, text_col: str = "payload") -> DataFrame:
    return df.select(F.from_json(F.col(text_col), BOARD_PAYLOAD).alias("_b")).select("_b.*")


def board_entries(payload: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Union-all of departures then arrivals, one row per board entry (S3, P3, U1), with the payload's columns ``keep``.

    Both directions come out of a single scan of the payload: the two lists
    are tagged with their ``Flight_type`` and exploded together, which is the
    by-name union of the two exploded directions without reading twice.
    ``page``/``idx`` keep the board order (page, then position in the list).
    """
    sched = "airport.pluginData.schedule"
    directions = F.array(
        F.struct(F.lit("departures").alias("Flight_type"), F.col(f"{sched}.departures.data").alias("d")),
        F.struct(F.lit("arrivals").alias("Flight_type"), F.col(f"{sched}.arrivals.data").alias("d")),
    )
    per_dir = payload.select(F.col("airport.code").alias("airport_code"),
                             F.col("airport.page").alias("page"),
                             *keep, F.inline(directions))
    return (per_dir.select("airport_code", "page", *keep, "Flight_type",
                           F.posexplode(F.col("d")).alias("idx", "_e"))
            .select("airport_code", "page", *keep, "idx", "Flight_type", F.col("_e.flight").alias("flight")))


def board_rows(payload: DataFrame, keys=BOARD_KEYS) -> DataFrame:
    """Board entries with the dotted keys flattened to ``flight_*`` columns."""
    entries = board_entries(payload)
    return flatten_keys(entries, keys, keep=("airport_code", "page", "idx", "Flight_type"))
