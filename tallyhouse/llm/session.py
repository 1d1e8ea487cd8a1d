"""Session settings and tables of the corpus queries."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import prepare_session, scratch_folder

# Rows of an Arrow batch end at this size, so that very long texts do not meet in one batch.
ARROW_BATCH_BYTES = "8m"
ARROW_BATCH_ROWS = "4000"


def prepare(spark: SparkSession) -> SparkSession:
    """Library settings plus the bounds of an Arrow batch."""
    prepare_session(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_BATCH_ROWS)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back, which cuts its lineage.

    Shuffle files of finished steps are removed when the driver collects its garbage, so that is asked for here.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, purpose)
    df.write.parquet(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def others(df: DataFrame, *added: str) -> DataFrame:
    """The frame without columns that have the name of an added one; the added column replaces them."""
    names = {name.lower() for name in added}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names])


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
