"""One representative location per zip prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.operators.cleaning import CleaningError, normalised_zip
from tallyhouse.session import scratch_folder

ZIP = "geolocation_zip_code_prefix"
REQUIRED = (ZIP, "geolocation_lat", "geolocation_lng", "geolocation_city", "geolocation_state")

def weighted_values(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(group_key, axis, value, n): how often each value of each column occurs per key; nulls are left out."""
    long = df.select(
        F.col(key).alias("group_key"),
        F.inline(F.array(*[F.struct(F.lit(c).alias("axis"), F.col(c).cast("double").alias("value")) for c in columns])),
    )
    return long.filter(F.col("value").isNotNull()).groupBy("group_key", "axis", "value").agg(F.count("*").alias("n"))


def middle_spans(ordered: DataFrame) -> DataFrame:
    """Per group the parts (ranges of values) that hold a middle rank, and how many values lie before them."""
    group = ["group_key", "axis"]
    spans = ordered.groupBy("part", *group).agg(F.sum("n").alias("held"))
    before = W.partitionBy(*group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("held").over(W.partitionBy(*group))
    placed = spans.withColumns(
        {
            "before": F.coalesce(F.sum("held").over(before), F.lit(0)),
            "lower": F.floor((total + 1) / 2),
            "upper": F.floor(total / 2) + 1,
        }
    )
    return placed.filter(_holds_middle(F.col("before"), F.col("before") + F.col("held")))


def _holds_middle(before: Column, through: Column) -> Column:
    inside = F.lit(False)
    for rank in ("lower", "upper"):
        inside = inside | ((F.col(rank) > before) & (F.col(rank) <= through))
    return inside


def exact_group_median(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Exact medians of several columns per key, by a distributed prefix sum.

    Equal values are counted first. The counted values are dealt by range of (key, column, value) and stored, so a key with
    any share of the rows lies in several parts, in order. Totals per part, summed up over the few parts of a key,
    tell which part holds the middle rank; only that one is ordered further. Nulls are ignored; a key without any
    value is absent from the result.
    """
    spark = df.sparkSession
    group = ["group_key", "axis"]
    dealt = weighted_values(df, key, columns).repartitionByRange(*group, "value").withColumn("part", F.spark_partition_id())
    path = scratch_folder(spark, "median")
    dealt.write.parquet(path)
    ordered = spark.read.schema(dealt.schema).parquet(path)
    inside = ordered.join(middle_spans(ordered).drop("held"), ["part", *group])
    running = F.sum("n").over(W.partitionBy("part", *group).orderBy("value"))
    placed = inside.withColumn("through", F.col("before") + running)
    picked = placed.filter(_holds_middle(F.col("through") - F.col("n"), F.col("through")))
    medians = []
    for column in columns:
        value = F.when(F.col("axis") == column, F.col("value"))
        medians.append(((F.min(value) + F.max(value)) / 2).alias(column))
    return picked.groupBy(F.col("group_key").alias(key)).agg(*medians)


def representative_places(geolocation: DataFrame) -> DataFrame:
    """Most frequent (city, state) per zip; ties by state, then city, nulls last.

    The rank filter also runs before the shuffle, so at most one candidate per zip and task moves.
    """
    pairs = geolocation.groupBy(ZIP, "geolocation_city", "geolocation_state").agg(F.count("*").alias("n"))
    order = W.partitionBy(ZIP).orderBy(
        F.desc("n"), F.asc_nulls_last("geolocation_state"), F.asc_nulls_last("geolocation_city")
    )
    return (
        pairs.filter(F.col(ZIP).isNotNull())
        .withColumn("position", F.row_number().over(order))
        .filter(F.col("position") == 1)
        .select(ZIP, F.col("geolocation_city").alias("city"), F.col("geolocation_state").alias("state"))
    )


def build_geolocation_lookup(cleaned: DataFrame, source: DataFrame) -> DataFrame:
    """One row per zip prefix: median position, observation and variant counts, representative place."""
    missing = sorted(set(REQUIRED) - set(cleaned.columns))
    if missing:
        raise CleaningError(f"The geolocation lookup needs the columns {', '.join(missing)}.")
    if ZIP not in source.columns:
        raise CleaningError(f"The source geolocation lacks the column {ZIP}.")
    known = cleaned.filter(F.col(ZIP).isNotNull())
    # Counted from (zip, city, state) groups, which are already few.
    variants = (
        known.groupBy(ZIP, "geolocation_city", "geolocation_state")
        .agg(F.count("*").alias("n"))
        .groupBy(ZIP)
        .agg(
            F.sum("n").alias("unique_observation_count"),
            F.count_distinct("geolocation_city").alias("city_variant_count"),
            F.count_distinct("geolocation_state").alias("state_variant_count"),
        )
    )
    medians = exact_group_median(known, ZIP, ["geolocation_lat", "geolocation_lng"])
    source_counts = normalised_zip(source, ZIP).groupBy(ZIP).agg(F.count("*").alias("source_observation_count"))
    if dict(cleaned.dtypes)[ZIP] != "double":
        source_counts = source_counts.withColumn(ZIP, F.col(ZIP).cast(dict(cleaned.dtypes)[ZIP]))
    return (
        variants.join(medians, ZIP, "left")
        .join(representative_places(known), ZIP)
        .join(source_counts, ZIP, "left")
        .select(
            F.col(ZIP).alias("zip_code_prefix"),
            F.col("geolocation_lat").alias("latitude"),
            F.col("geolocation_lng").alias("longitude"),
            "unique_observation_count",
            "city_variant_count",
            "state_variant_count",
            "city",
            "state",
            "source_observation_count",
            (F.col("state_variant_count") > 1).alias("dq_multiple_state_codes"),
        )
        .orderBy("zip_code_prefix")
    )
