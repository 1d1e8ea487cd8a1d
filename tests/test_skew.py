from __future__ import annotations

from statistics import median

from pyspark.sql import functions as F

from tallyhouse.operators.skew import HOT_PARTS, hot_keys, join_dimension, with_spread_key


def lines(spark):
    """One product is on half of 40,000 lines; the others have a few each."""
    return spark.range(40_000).selectExpr("concat('o', id) AS order_id", "if(id % 2 = 0, 'hot', concat('p', id % 8001)) AS product_id", "id AS amount")


def products(spark):
    return spark.range(7_000).selectExpr("concat('p', id) AS product_id", "if(id % 7 = 0, NULL, concat('c', id % 9)) AS category").unionByName(
        spark.createDataFrame([("hot", "warm")], "product_id string, category string")
    )


def test_hot_keys_are_found_and_few(spark):
    assert [r.product_id for r in hot_keys(lines(spark), "product_id").collect()] == ["hot"]
    assert hot_keys(lines(spark).limit(0), "product_id").count() == 0
    even = spark.range(10_000).selectExpr("id % 5000 AS k")
    assert hot_keys(even, "k").count() == 0
    few = spark.range(10_000).selectExpr("id % 150 AS k")
    assert hot_keys(few, "k").count() == 150 <= HOT_PARTS


def test_join_equals_a_plain_join(spark):
    found = join_dimension(lines(spark), products(spark), "product_id", "category", "order_id")
    plain = lines(spark).join(products(spark), "product_id")
    assert sorted(found.columns) == sorted(plain.columns)
    columns = plain.columns
    assert found.select(columns).exceptAll(plain).count() == plain.exceptAll(found.select(columns)).count() == 0
    nulls = spark.createDataFrame([("o", None, 1)], "order_id string, product_id string, amount long")
    assert join_dimension(nulls, products(spark), "product_id", "category", "order_id").count() == 0


def test_no_task_of_the_shuffle_join_gets_much_more_than_another(spark):
    hot = spark.createDataFrame([("hot", ("warm",))], "product_id string, hot struct<value string>")
    dealt = with_spread_key(lines(spark), hot, "product_id", "order_id").repartition(16, "spread_key")
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 4 * median(sizes)
    plain = [r["count"] for r in lines(spark).repartition(16, "product_id").groupBy(F.spark_partition_id()).count().collect()]
    assert max(plain) > 4 * median(plain)
