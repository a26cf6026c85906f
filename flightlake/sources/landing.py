"""One-time conversion of landed JSON payloads into query-ready parquet tables.

Parsing nested JSON is the most expensive step of every job and JSON scans
cannot prune nested fields; converting once lets later planner runs read
narrow, typed, partitioned parquet with pushdown and partition pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.functions.geo import cell_place, grid_columns
from flightlake.functions.text import normalize_strings
from flightlake.functions.timefn import SECONDS_PER_DAY, iso_to_epoch
from flightlake.operators.flatten import flatten_by_map
from flightlake.operators.places import GRID_COLUMNS, PLACE_COLUMN
from flightlake.schemas import SCHEDULE_COLUMNS
from flightlake.sources.schedule import read_schedule
from flightlake.sources.versions import Version, land
from flightlake.sources.weather import latest_pull, read_forecast, read_weather


# Most files of a partition that one landing writes.
FILES_PER_DAY = 4

# Row groups of weather files: small ones, as a plan reads those of its places only.
ROW_GROUP_BYTES = 16 << 20


def schedule_table(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Flat, whitespace-cleaned schedule with UTC epochs of both scheduled times."""
    flat = normalize_strings(flatten_by_map(records, SCHEDULE_COLUMNS | {c: c for c in keep}))
    return flat.withColumns({"departure_epoch": iso_to_epoch("departure_scheduled"),
                             "arrival_epoch": iso_to_epoch("arrival_scheduled")})


def land_schedule(spark: SparkSession, json_path: str, out_path: str,
                  mode: str = "append", multiline: bool = True) -> None:
    """Landed schedule envelopes -> parquet partitioned by ``pull`` and ``flight_date``.

    ``multiline=False`` for files holding one envelope per line.
    """
    records = read_schedule(spark, json_path, multiline)
    table = schedule_table(records, keep=("pull",))
    # One task per date and slice of its flights: files follow the data, not the tasks.
    spread = F.pmod(F.xxhash64("flight_number", "flight_iata", "departure_epoch"), F.lit(FILES_PER_DAY))
    _replace_partitions(table.repartition("flight_date", spread), out_path, ("pull", "flight_date"), mode)


def land_weather(spark: SparkSession, json_path: str, out_path: str,
                 resolution_deg: float = 0.25, mode: str = "append") -> Version:
    """Landed weather responses -> the next version of a table of hourly facts by UTC ``day``.

    Of an hour that is landed already the newest pull's values stay.  The ``day`` column is
    the one the risk scoring bounds when it prunes the scan to the planned time range, and
    ``place`` (the cell's place on the Morton curve) the one it bounds to the planned places.
    """
    rows = _placed(_by_day(read_weather(spark, json_path, resolution_deg)), resolution_deg)

    def newest(new: DataFrame, old: DataFrame) -> DataFrame:
        return latest_pull(new.unionByName(old), keys=("cell", "ts_hour", "day", PLACE_COLUMN)).select(*new.columns)

    return land(spark, out_path, rows, "day", newest, _cells_together, fresh=mode == "overwrite",
                row_group_bytes=ROW_GROUP_BYTES)


def land_forecast(spark: SparkSession, json_path: str, out_path: str, resolution_deg: float = 0.25) -> Version:
    """Landed forecast responses -> the next version of a table ``(cell, ts_hour, issue, metrics)`` by valid ``day``.

    Issues are added, none replaces another: a plan takes the newest one not after its time
    (``operators.weather_risk.forecast_lookup``).  Of an issue landed again the newest pull counts.
    """
    rows = _placed(_by_day(read_forecast(spark, json_path, resolution_deg)), resolution_deg)
    return land(spark, out_path, rows, "day", None, _cells_together, row_group_bytes=ROW_GROUP_BYTES)


def _by_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("day", F.floor(F.col("ts_hour") / F.lit(SECONDS_PER_DAY)))


def _placed(rows: DataFrame, resolution_deg: float) -> DataFrame:
    """Add ``place``; its metadata tell readers the width of the grid it was made for."""
    n_lon = grid_columns(resolution_deg)
    return rows.withColumn(PLACE_COLUMN, cell_place("cell", n_lon).alias(PLACE_COLUMN, metadata={GRID_COLUMNS: n_lon}))


def _cells_together(rows: DataFrame) -> DataFrame:
    """A day's rows in a few files, each a stretch of the Morton curve in order: a row group holds a compact region."""
    order = ["day", PLACE_COLUMN, "cell", "ts_hour"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def _replace_partitions(rows: DataFrame, path: str, by: tuple[str, ...], mode: str) -> None:
    """Write partitions; with ``append`` only those that ``rows`` holds are replaced, so a re-run adds nothing."""
    writer = rows.write.mode("overwrite").partitionBy(*by)
    if mode == "append":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
