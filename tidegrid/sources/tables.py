"""Scans: driver tables, observations with missing values as NULL, checked selections; and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import no_nan

EPOCH = "2024-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical long table (id, k, track, ts, day, v): one row an observation, NaN as NULL."""
    day = F.datediff(F.to_date("ts"), F.lit(EPOCH).cast("date"))
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("user_id").alias("k"), F.col("event_type").alias("track"), "ts", day.alias("day"), no_nan(F.col("value")).alias("v"))


def scan_with_schema(spark: SparkSession, path: str, schema: str, kind: str = "csv") -> DataFrame:
    """Text tables by an explicit schema; columns that came later are NULL in older files."""
    reader = spark.read.schema(schema)
    return (reader.option("header", True).csv(path) if kind == "csv" else reader.option("mode", "PERMISSIVE").json(path)).select(*[c.split()[0] for c in schema.split(",")])


def union_by_name(frames: dict[str, DataFrame], source: str = "source") -> DataFrame:
    """Deliveries with unlike columns in one table, each row with the name of its delivery."""
    out = None
    for name, df in frames.items():
        own = df.withColumn(source, F.lit(name))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def require(df: DataFrame, wanted: DataFrame, on: str) -> DataFrame:
    """Rows whose key is wanted; a wanted key without rows raises and is named."""
    missing = wanted.select(on).distinct().join(df.select(on).distinct(), on, "left_anti").limit(5).collect()
    if missing:
        raise ValueError(f"listed but absent: {[r[0] for r in missing]}")
    return df.join(wanted.select(on).distinct(), on, "left_semi")


def write_partitioned(df: DataFrame, path: str, *by: str, mode: str = "error") -> None:
    """Parquet by partition columns, one set of files for each."""
    df.repartition(*by).write.mode(mode).partitionBy(*by).parquet(path)


def parse_pipe_table(lines: DataFrame, columns: list[str], text: str = "value") -> DataFrame:
    """Rows of a Markdown table: lines that start with a bar, without the ruler."""
    rows = lines.where(F.trim(text).startswith("|") & ~F.col(text).rlike(r"^\s*\|[\s:|-]+\|\s*$"))
    cells = F.split(F.regexp_replace(F.trim(text), r"^\||\|$", ""), r"\|")
    return rows.select(*[F.trim(F.get(cells, F.lit(i))).alias(c) for i, c in enumerate(columns)])
