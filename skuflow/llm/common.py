"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skuflow.config import scratch_path


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` as a table under the shared checkpoint folder: later readers start
    from the files, so a lost executor never recomputes what came before. With
    ``keep`` it outlives the innermost scratch scope."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}", keep)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(value: Column, alias: str) -> Column:
    """``value`` behind a one-row Generate, so the optimiser never copies the
    expression into its users (a lambda would evaluate it per element)."""
    return F.explode(F.array(value)).alias(alias)


def row_key(*cols: str) -> list[Column]:
    """Columns that name a row by its content: rows equal in them are interchangeable."""
    return [F.xxhash64(*[F.col(c) for c in cols]).alias("_k1"),
            F.xxhash64(F.lit("second"), *[F.col(c) for c in cols]).alias("_k2")]


def batches(rows: list, size: int) -> Iterator[list]:
    for i in range(0, len(rows), size):
        yield rows[i:i + size]
