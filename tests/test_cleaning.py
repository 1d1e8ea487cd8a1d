from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F
from conftest import rows

from tallyhouse.contracts import MARKETPLACE
from tallyhouse.functions.text import strip_text
from tallyhouse.operators import cleaning as C
from tallyhouse.operators.geolocation import (
    build_geolocation_lookup,
    exact_group_median,
    middle_spans,
    representative_places,
    weighted_values,
)

ORDER = "order_id string, customer_id string, order_status string, order_purchase_timestamp string, " \
    "order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string, " \
    "order_estimated_delivery_date string"
GEO = "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, geolocation_city string, " \
    "geolocation_state string"
PRODUCT = ", ".join(f"{name} string" for name in MARKETPLACE.sources["products"].columns)


def test_order_timestamps_are_parsed_and_sequences_flagged(spark):
    frame = spark.createDataFrame(
        [("order-1", "customer-1", " DELIVERED ", "2024-01-02 12:00:00", "2024-01-02 13:00:00",
          "2024-01-01 12:00:00", "2024-01-03 12:00:00", "2024-01-04")],
        ORDER,
    )
    row = C.clean_source_table(frame, "orders").frame.first()
    assert row.order_status == "delivered"
    assert row.order_purchase_timestamp == dt.datetime(2024, 1, 2, 12)
    assert row.order_estimated_delivery_date == dt.datetime(2024, 1, 4)
    assert row.dq_purchase_after_carrier_handoff and row.dq_approval_after_carrier_handoff
    assert not row.dq_carrier_handoff_after_customer_delivery
    assert row.dq_has_timestamp_sequence_issue


def test_unparseable_timestamps_become_null_with_a_flag(spark):
    values = ["not-a-date", "", None, "2024-02-30", "2024-02-29 01:02:03", " 2024-01-01 "]
    frame = spark.createDataFrame([(v,) for v in values], "at string")
    parsed = C.parse_timestamps(strip_text(frame), ["at"], "t.csv")
    flags = [(r["at"] is None, r["dq_invalid_at"]) for r in parsed.collect()]
    assert flags == [(True, True), (True, False), (True, False), (True, True), (False, False), (False, False)]


def test_white_space_of_any_kind_is_stripped(spark):
    frame = spark.createDataFrame([("  a b　\t",), ("  ",), ("x",)], "t string")
    assert rows(strip_text(frame), "t") == ["a b", None, "x"]


def test_unconvertible_numbers_stop_the_run_with_their_count(spark):
    frame = spark.createDataFrame([("1",), ("x",), (None,), ("y",)], "n string")
    with pytest.raises(C.CleaningError, match="holds 2 value"):
        C.coerce_numeric(frame, ["n"], "t.csv")
    with pytest.raises(C.CleaningError, match="lacks the numeric column 'm'"):
        C.coerce_numeric(frame, ["m"], "t.csv")
    assert rows(C.coerce_numeric(frame, ["n"], "t.csv", strict=False), "n") == [1.0, None, None, None]


def test_missing_score_is_out_of_range(spark):
    frame = spark.createDataFrame([(1.0,), (5.0,), (6.0,), (0.0,), (None,)], "review_score double")
    flags = rows(C.add_review_range_flag(frame), "dq_review_score_out_of_range")
    assert flags == [False, False, True, True, True]


def test_untranslated_product_keeps_its_name_with_a_flag(spark):
    products = spark.createDataFrame(
        [("p1", "categoria_sem_traducao", "10", "20", "1", "100", "10", "5", "8"),
         ("p2", " categoria_conhecida ", "10", "20", "1", "100", "10", "5", "8"),
         ("p3", None, "10", "20", "1", "100", "10", "5", "8")],
        PRODUCT,
    )
    translation = spark.createDataFrame(
        [("categoria_conhecida", "known_category")],
        "product_category_name string, product_category_name_english string",
    )
    cleaned = C.clean_source_table(products, "products", translation).frame
    assert "product_name_length" in cleaned.columns and "product_name_lenght" not in cleaned.columns
    found = {r.product_id: r for r in cleaned.collect()}
    assert found["p1"].product_category_name_english == "categoria_sem_traducao"
    assert found["p1"].dq_category_translation_missing
    assert found["p2"].product_category_name_english == "known_category"
    assert found["p3"].product_category_name_english == "unknown" and found["p3"].dq_category_missing
    promoted = C.promote_untranslated(translation, cleaned)
    assert [tuple(r) for r in promoted.collect()] == [
        ("categoria_conhecida", "known_category", False),
        ("categoria_sem_traducao", "categoria_sem_traducao", True),
    ]
    with pytest.raises(C.CleaningError):
        C.clean_source_table(products, "products")


def test_geolocation_is_deduplicated_and_looked_up(spark):
    source = spark.createDataFrame(
        [(1000, -23.0, -46.0, "sao paulo", "SP"), (1000, -23.0, -46.0, "sao paulo", "SP"),
         (1000, -24.0, -47.0, "são paulo", "SP")],
        GEO,
    )
    cleaned = C.clean_source_table(source, "geolocation").frame
    assert cleaned.count() == 2
    row = build_geolocation_lookup(cleaned, source).first()
    assert (row.source_observation_count, row.unique_observation_count, row.city) == (3, 2, "sao paulo")
    assert (row.latitude, row.longitude) == (-23.5, -46.5)
    assert not row.dq_multiple_state_codes
    with pytest.raises(C.CleaningError, match="needs the columns geolocation_city"):
        build_geolocation_lookup(cleaned.drop("geolocation_city"), source)


def test_frequent_place_prefers_state_then_city_and_nulls_last(spark):
    data = [(1, 0.0, 0.0, "b", "X"), (1, 0.0, 1.0, "a", "Y"), (2, 0.0, 0.0, None, None), (2, 0.0, 1.0, "c", "Z")]
    places = {r[0]: (r.city, r.state) for r in representative_places(spark.createDataFrame(data, GEO)).collect()}
    assert places == {1: ("b", "X"), 2: ("c", "Z")}


def test_median_equals_brute_force_for_hot_and_small_groups(spark):
    random.seed(7)
    data = []
    for key, size in ((1, 3001), (2, 1), (3, 2), (4, 40), (5, 7)):
        for _ in range(size):
            x = random.choice([random.uniform(-90, 90), random.uniform(-23.1, -23.0), -23.05, 1e9, -1e9])
            y = None if random.random() < 0.1 else random.gauss(-46.6, 1e-8)
            data.append((key, x, y))
    data.append((6, None, None))
    df = spark.createDataFrame(data, "k int, x double, y double")
    found = {r.k: (r.x, r.y) for r in exact_group_median(df, "k", ["x", "y"]).collect()}
    for key in range(1, 6):
        for i, column in ((1, 0), (2, 1)):
            values = [row[i] for row in data if row[0] == key and row[i] is not None]
            assert found[key][column] == (statistics.median(values) if values else None)
    assert 6 not in found


def test_translation_names_must_be_unique_after_stripping(spark):
    products = spark.createDataFrame([("p", "perf")], "product_id string, product_category_name string")
    names = spark.createDataFrame([("perf", "a"), (" perf", "b")], "product_category_name string, product_category_name_english string")
    with pytest.raises(C.CleaningError, match="perf"):
        C.translate_categories(products, names)


def test_layouts_are_voted_by_column(spark):
    frame = spark.createDataFrame(
        [
            ("2017-01-01 10:00", "31/12/2016", "12/31/2016 08:30", "2017/01/02", "2017-01-01 10:00:00.123456789"),
            ("2017-01-02", "01/02/2017 09:15:30", "01/02/2017", "bad", None),
            ("02/01/2017", "2017-02-01", None, "2017/13/01", "2017-02-30"),
        ],
        "a string, b string, c string, d string, e string",
    )
    layouts = C.timestamp_layouts(frame, list("abcde"), "t.csv")
    assert layouts == {"a": "yyyy-MM-dd", "b": "dd/MM/yyyy", "c": "MM/dd/yyyy", "d": "yyyy/MM/dd", "e": "yyyy-MM-dd"}
    found = C.parse_timestamps(frame, list("abcde"), "t.csv", layouts).collect()
    assert [r.a for r in found] == [dt.datetime(2017, 1, 1, 10), dt.datetime(2017, 1, 2), None]
    assert [r.b for r in found] == [dt.datetime(2016, 12, 31), dt.datetime(2017, 2, 1, 9, 15, 30), None]
    assert [r.c for r in found] == [dt.datetime(2016, 12, 31, 8, 30), dt.datetime(2017, 1, 2), None]
    assert [r.d for r in found] == [dt.datetime(2017, 1, 2), None, None]
    assert [r.e for r in found] == [dt.datetime(2017, 1, 1, 10, 0, 0, 123456), None, None]
    assert [r.dq_invalid_b for r in found] == [False, False, True]


def test_a_column_of_two_readings_raises(spark):
    frame = spark.createDataFrame([("01/02/2017",), ("03/04/2017",)], "at string")
    with pytest.raises(C.CleaningError, match="dd/MM/yyyy and MM/dd/yyyy alike"):
        C.timestamp_layouts(frame, ["at"], "t.csv")
    assert C.timestamp_layouts(frame.limit(0), ["at"], "t.csv") == {"at": "yyyy-MM-dd"}


def test_median_of_a_hot_key_is_dealt_over_parts(spark):
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 500)) AS k", "cast(pmod(hash(id), 9973) as double) AS x")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = {r.k: r.x for r in exact_group_median(df, "k", ["x"]).collect()}
        counted = weighted_values(df, "k", ["x"])
        dealt = counted.repartitionByRange("group_key", "axis", "value").withColumn("part", F.spark_partition_id())
        parts = dealt.groupBy("group_key").agg(F.countDistinct("part").alias("n")).filter("group_key = 'hot'").first().n
        spans = middle_spans(dealt).filter("group_key = 'hot'").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert found == {r.k: r.x for r in df.groupBy("k").agg(F.median("x").alias("x")).collect()}
    assert parts > 1 and spans <= 2
