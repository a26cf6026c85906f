"""Planner output sink and re-read (S8, S9), trail JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.schemas import PATH


def _json_encoded(df: DataFrame) -> DataFrame:
    """Complex columns as JSON text (for text formats such as CSV)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            out.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def write_plan(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
               partition_by: tuple[str, ...] = ()) -> None:
    """Distributed write of the planner table; CSV stores lists as JSON text."""
    writer_df = _json_encoded(df) if fmt == "csv" else df
    writer = writer_df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", "true").option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def read_plan(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
              json_columns: dict[str, T.DataType] | None = None) -> DataFrame:
    """Re-read a planner table; CSV JSON-text columns are decoded with ``from_json``."""
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    json_columns = json_columns or {"flight_path": PATH}
    text_schema = T.StructType([
        T.StructField(f.name, T.StringType() if f.name in json_columns else f.dataType, True)
        for f in schema.fields])
    df = spark.read.schema(text_schema).option("header", "true").option("escape", '"').csv(path)
    return df.withColumns({c: F.from_json(F.col(c), t) for c, t in json_columns.items()})


def decode_path(text) -> F.Column:
    """Path JSON text -> ``array<struct<idx,lat,lon,t>>``."""
    return F.from_json(text if isinstance(text, F.Column) else F.col(text), PATH)


def encode_path(path) -> F.Column:
    return F.to_json(path if isinstance(path, F.Column) else F.col(path))


def trail_json(trail: DataFrame, fields=("lat", "lng", "alt", "spd", "time", "hd")) -> F.Column:
    """One JSON object per fix (the JSON-lines form of a sampled trail)."""
    return F.to_json(F.struct(*[F.col(f) for f in fields]))
