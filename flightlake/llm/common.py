"""Small Spark helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.session import table_path

#: The word pattern of the text contracts, for Java regular expressions (fixed value).
SEPARATOR_RUN = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: Row groups of intermediate tables: rows may hold packed megabytes, and a writer buffers a group.
ROW_GROUP_BYTES = 16 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = table_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remainder(column: Column | str, modulus: int) -> Column:
    """crc32 of the value as text, modulo ``modulus`` (null counts as the empty text)."""
    c = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def fresh(name: str, df: DataFrame) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def shards_for(total_bytes: float, per_shard: float, least: int = 1) -> int:
    """Number of hash shards so that each holds about ``per_shard`` bytes."""
    return max(least, int(-(-total_bytes // per_shard)))
