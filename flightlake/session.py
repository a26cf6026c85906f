"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the engine depends on for correct results (UTC wall clock for
# epoch <-> text conversions) and for scale (AQE re-planning, skew splits).
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ui.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "flightlake", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the engine defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may hand back an existing session: pin the zone anyway.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001 - Spark Connect
        pass
    return spark


_LOCAL_CKPT: str | None = None


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (a shared filesystem path).
    Only when it is unset (local tests) do we create one under the system temp
    folder, so lineage cuts still work in single-machine runs.
    """
    global _LOCAL_CKPT
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext on the client
        sc = None
    if not configured:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        # "local-cluster" has executors of their own: it needs the setting like any cluster.
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster "
                             f"(master {master!r}); a machine-local folder would be lost "
                             "with its executor")
        if _LOCAL_CKPT is None:
            _LOCAL_CKPT = tempfile.mkdtemp(prefix="flightlake-ckpt-")
        configured = _LOCAL_CKPT
        try:
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:  # noqa: BLE001 - core conf not settable at run time
            pass
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


_RUN: list[str] = []


def table_path(spark: SparkSession, name: str) -> str:
    """A location for an intermediate table inside the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), *_RUN, name)


@contextmanager
def run_folder(spark: SparkSession):
    """Intermediates written inside the block go to a folder of their own, removed at its end.

    For jobs that finish inside the block (the commands, a refresh batch).
    """
    _RUN.append(f"run-{uuid.uuid4().hex}")
    path = os.path.join(checkpoint_dir(spark), *_RUN)
    try:
        yield path
    finally:
        _RUN.pop()
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def materialize(df, name: str):
    """Write ``df`` as a parquet table under the shared checkpoint folder and read it back.

    Used where one intermediate feeds two branches of a plan (so it is computed
    once) and to cut long lineages: a lost executor then recomputes from the
    written table, not from the sources.
    """
    spark = df.sparkSession
    path = table_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
