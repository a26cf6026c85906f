"""Periodic planner refresh as a Structured Streaming job.

Schedule envelopes land as files in a folder.  A file-source stream picks up
each new file exactly once (the checkpoint records what was read).  Of a
micro-batch the newest non-empty pull is planned (see ``sources.pulls``) and
written to a versioned output folder, then a marker of that version is written.
Markers are never changed or removed: the current plan is the one with the
greatest complete marker, at every moment.  Batches whose envelopes are all
empty are skipped, so the last good plan stays current.  Run it on a schedule
with ``trigger(availableNow=True)``: each run drains what has landed and stops.

Weather given as the path of a versioned table (``sources.versions``) is resolved again
for every batch: the versions and the time of the plan are written first (``_inputs``),
so a batch that is run again after a failure plans from the same rows, and the marker
says what its plan was made of.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flightlake.plans import planner
from flightlake.schemas import SCHEDULE_ENVELOPE
from flightlake.session import run_folder
from flightlake.sources.pulls import newest_nonempty, pull_name
from flightlake.sources.schedule import explode_records, flat_schedule
from flightlake.sources.versions import read_version, version_numbers

MARKERS, INPUTS = "_versions", "_inputs"
_MARKER = "path string, epoch long, observed_version long, forecast_version long, as_of long"


def plan_snapshot(envelopes: DataFrame, unique_airports: DataFrame, observed: DataFrame,
                  forecast: DataFrame, cell_fn: Callable[[Column, Column], Column],
                  past_days: int = 90, statuses: Sequence[str] | None = ("scheduled",),
                  segments: int | str = 3, **plan_options) -> DataFrame:
    """Planner output (Q1 rows) for the non-empty envelopes of one pull.

    ``plan_options`` go to ``planner.plan_waypoints`` (``hour_anchor``,
    ``nan_policy``, ``invert``, ``keep``, ...).
    """
    good = newest_nonempty(envelopes) if "pull" in envelopes.columns else envelopes.filter(F.size("data") > 0)
    schedule = flat_schedule(explode_records(good))
    legs = planner.leg_metrics(planner.prepare_schedule(schedule, statuses), unique_airports,
                               segments=segments)
    return planner.plan_waypoints(legs, observed, forecast, cell_fn=cell_fn, past_days=past_days,
                                  **plan_options)


def _stored(spark: SparkSession, path: str, schema: str):
    """The one row of a small JSON table, or None if it is missing or was not finished."""
    try:
        return spark.read.schema(schema).json(path).first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _pinned(spark: SparkSession, out_dir: str, epoch_id: int, sources: dict, now: Callable[[], float]):
    """The input versions and time of an epoch: those written when it was first tried, or else the newest, written now."""
    path = f"{out_dir}/{INPUTS}/epoch={epoch_id:08d}"
    found = _stored(spark, path, _MARKER)
    if found is None:
        newest = {f"{name}_version": max(version_numbers(spark, at), default=None) if isinstance(at, str) else None
                  for name, at in sources.items()}
        row = (None, int(epoch_id), newest["observed_version"], newest["forecast_version"], int(now()))
        spark.createDataFrame([row], _MARKER).coalesce(1).write.mode("overwrite").json(path)
        found = _stored(spark, path, _MARKER)
    return found


def plan_epoch(batch: DataFrame, epoch_id: int, out_dir: str, unique_airports: DataFrame, observed: DataFrame | str,
               forecast: DataFrame | str, now: Callable[[], float] = time.time, **snapshot_options) -> None:
    """Plan one micro-batch and mark it; an epoch that is marked, or whose pulls are empty, is left alone."""
    if batch.filter(F.size("data") > 0).isEmpty():
        return  # empty pull: keep the last good plan
    session = batch.sparkSession
    marker = f"{out_dir}/{MARKERS}/epoch={epoch_id:08d}"
    if _stored(session, marker, _MARKER) is not None:
        return  # planned and marked before: readers may use it
    pins = _pinned(session, out_dir, epoch_id, {"observed": observed, "forecast": forecast}, now)
    version = f"{out_dir}/v{epoch_id:08d}"
    with run_folder(session):
        seen = read_version(session, observed, pins["observed_version"]) if isinstance(observed, str) else observed
        ahead = read_version(session, forecast, pins["forecast_version"]) if isinstance(forecast, str) else forecast
        plan = plan_snapshot(batch, unique_airports, seen, ahead, as_of=pins["as_of"], **snapshot_options)
        # Re-running an epoch after a failure rewrites the same version from the same inputs.
        plan.write.mode("overwrite").parquet(version)
    row = (version, int(epoch_id), pins["observed_version"], pins["forecast_version"], pins["as_of"])
    session.createDataFrame([row], _MARKER).coalesce(1).write.mode("overwrite").json(marker)


def start_refresh(spark: SparkSession, landing_dir: str, out_dir: str, checkpoint_location: str,
                  unique_airports: DataFrame, observed: DataFrame | str, forecast: DataFrame | str,
                  cell_fn: Callable[[Column, Column], Column] = planner.default_cell,
                  past_days: int = 90, statuses: Sequence[str] | None = ("scheduled",),
                  available_now: bool = True, processing_time: str | None = None,
                  segments: int | str = 3, now: Callable[[], float] = time.time, **plan_options) -> StreamingQuery:
    """Start the refresh stream; returns the running query.

    ``observed`` and ``forecast`` are tables, or paths of versioned tables, of which every
    batch takes the newest version.  Planner options (``segments``, ``hour_anchor``,
    ``nan_policy``, ``invert``, ...) are the same as for the batch planner.
    """
    envelopes = (spark.readStream.schema(SCHEDULE_ENVELOPE).option("multiLine", True)
                 .json(landing_dir).withColumn("pull", pull_name()))

    def plan_batch(batch: DataFrame, epoch_id: int) -> None:
        plan_epoch(batch, epoch_id, out_dir, unique_airports, observed, forecast, now, cell_fn=cell_fn,
                   past_days=past_days, statuses=statuses, segments=segments, **plan_options)

    writer = (envelopes.writeStream.foreachBatch(plan_batch)
              .option("checkpointLocation", checkpoint_location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def read_current_plan(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The plan of the greatest complete marker, or None before the first good refresh.

    Only a missing marker folder means "no plan"; any other error is raised.
    """
    try:
        markers = spark.read.schema(_MARKER).json(f"{out_dir}/{MARKERS}/*")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    newest = markers.agg(F.max_by("path", "epoch").alias("path")).first()
    return spark.read.parquet(newest["path"]) if newest and newest["path"] else None
