"""Reading the given parquet tables (column-pruned, filters pushed to the scan)."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from feedloom.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A scan that lists its files anew, so files added to a table are seen."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def cut(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: whoever uses the result
    several times evaluates its plan once."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Spark's own switch: a finished query's shuffle files leave the disks
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a query in here has shuffled is dropped when it ends: steps that run one after the
    other need the disk of the largest of them, not of all."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
