"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cabrank.sources import storage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """The frame computed once and kept in the folder of spark.checkpoint.dir, which every executor can read.

    Only a local session without that setting, as in tests, gets a folder of its own.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(storage.shared_folder(spark))
    return df.checkpoint()


def spare(df: DataFrame, *names: str) -> list[str]:
    """Column names for interim use that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def text_of(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
