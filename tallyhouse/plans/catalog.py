"""Every registered query: inventory key -> query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.contracts import MARKETPLACE, STATUS_RULE, ModelTable, declared_row_rules
from tallyhouse.functions.fingerprint import table_fingerprint
from tallyhouse.functions import sql
from tallyhouse.functions.rules import union_all, unpivot_row
from tallyhouse.functions.text import strip_text
from tallyhouse.operators import analyses as A
from tallyhouse.operators import cleaning as C
from tallyhouse.operators import domains as D
from tallyhouse.operators import insights as E
from tallyhouse.operators import integrity as I
from tallyhouse.operators import profile as P
from tallyhouse.operators import quality as Q
from tallyhouse.operators import stages as S
from tallyhouse.operators.geolocation import build_geolocation_lookup
from tallyhouse.oracle import analyses as analyses_oracle
from tallyhouse.oracle import cleaning as cleaning_oracle
from tallyhouse.oracle import insights as insights_oracle
from tallyhouse.oracle import profile as profile_oracle
from tallyhouse.oracle import quality as quality_oracle
from tallyhouse.oracle import runs as runs_oracle
from tallyhouse.plans import analytics as analytics_plan
from tallyhouse.plans import audit as audit_plan
from tallyhouse.plans import cleaning as clean_plan
from tallyhouse.plans import publish as publish_plan
from tallyhouse.session import prepare_session, released_shuffles, scratch_folder
from tallyhouse.sources import csv as source
from tallyhouse.sources import sinks
from tallyhouse.sources.processed import read_extracts, read_processed, read_processed_table
from tallyhouse.sources.testbed import GOOD_SOURCES, TABLE_SCHEMAS, Query, Testbed, with_views

CATALOG: dict[str, Query] = {}


def register(key: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        if key in CATALOG:
            raise ValueError(f"Query key registered twice: {key}")
        CATALOG[key] = query
        return query

    return add


def plain_values(df: DataFrame) -> DataFrame:
    """Exact types turned into ones that any client compares alike: decimals to double, dates to text."""
    replacements = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            replacements[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            replacements[f.name] = F.col(f.name).cast("string")
    return df.withColumns(replacements) if replacements else df


def catalog_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: plain_values(query(Testbed(prepare_session(spark), folder)))

    return {key: bind(query) for key, query in CATALOG.items()}


def catalog_oracle() -> dict[str, str]:
    parts = [analyses_oracle, quality_oracle, cleaning_oracle, profile_oracle, insights_oracle, runs_oracle]
    views = {name: text for part in parts for name, text in getattr(part, "STAGE_VIEWS", {}).items()}
    return {key: with_views(text, views) for part in parts for key, text in part.STATEMENTS.items()}


# Stages.


@register("stg_01_review_by_order")
def _(tb: Testbed) -> DataFrame:
    return S.review_by_order(tb["mk_reviews"])


@register("stg_02_order_value")
def _(tb: Testbed) -> DataFrame:
    return S.order_value(tb["mk_items"])


@register("stg_03_order_metrics")
def _(tb: Testbed) -> DataFrame:
    return S.order_metrics(tb["mk_orders"], tb["mk_customers"], tb["mk_items"], tb["mk_reviews"])


@register("stg_04_delivered_customer_orders")
def _(tb: Testbed) -> DataFrame:
    return S.delivered_customer_orders(tb["mk_orders"], tb["mk_customers"])


@register("stg_05_category_order")
def _(tb: Testbed) -> DataFrame:
    reviews = S.review_by_order(tb["mk_reviews"])
    return S.category_order(tb["mk_items"], tb["mk_orders"], tb["mk_model_products"], reviews)


@register("stg_06_seller_order")
def _(tb: Testbed) -> DataFrame:
    return S.seller_order(tb["mk_items"], tb["mk_orders"], S.review_by_order(tb["mk_reviews"]))


@register("stg_07_cohorted_activity")
def _(tb: Testbed) -> DataFrame:
    return S.cohorted_activity(tb["mk_orders"], tb["mk_customers"])


# Analyses.

for _position, (_name, _analysis) in enumerate(A.ANALYSES.items(), start=1):
    register(f"ana_{_position:02d}_{_name}")(lambda tb, analysis=_analysis: analysis(tb.marketplace()))


# Contract checks.


def drifted_sources(tb: Testbed) -> dict[str, DataFrame]:
    """Typed sources with one table gone, one column gone and one column too many."""
    tables = tb.typed_sources()
    tables.pop("sellers")
    tables["customers"] = tables["customers"].drop("customer_state")
    tables["geolocation"] = tables["geolocation"].withColumn("note", F.lit("extra"))
    return tables


@register("con_02_key_checks")
def _(tb: Testbed) -> DataFrame:
    return Q.key_checks(tb.spark, tb.typed_sources())


@register("con_02_repeated_line_key")
def _(tb: Testbed) -> DataFrame:
    return Q.key_statistics(tb["lineitem"], ("l_orderkey", "l_linenumber"))


@register("con_03_reference_checks")
def _(tb: Testbed) -> DataFrame:
    return Q.reference_checks(tb.spark, tb.typed_sources())


@register("con_04_allowed_values")
def _(tb: Testbed) -> DataFrame:
    return Q.allowed_value_check(tb["pl_orders"], STATUS_RULE)


@register("con_04_disallowed_values")
def _(tb: Testbed) -> DataFrame:
    return Q.disallowed_values(tb["pl_orders"], STATUS_RULE)


@register("con_05_time_order")
def _(tb: Testbed) -> DataFrame:
    tables = tb.typed_sources()
    reports = [
        Q.time_order_check(tables[name], [rule for rule in MARKETPLACE.precedences if rule.table == name])
        for name in ("orders", "order_reviews")
    ]
    return reports[0].unionByName(reports[1])


@register("con_06_report_bundle")
def _(tb: Testbed) -> DataFrame:
    return P.status_counts(Q.relational_quality_reports(tb.spark, tb.typed_sources()))


# Cleaning.


def cleaned(tb: Testbed, table: str) -> DataFrame:
    raw = tb.raw_sources()
    return C.clean_source_table(
        raw[table], table, raw["product_category_name_translation"], strict=False
    ).frame


def cleaned_model(tb: Testbed) -> dict[str, DataFrame]:
    """The cleaned tables under their published names."""
    raw = tb.raw_sources()
    model = {
        name: cleaned(tb, name)
        for name in ("customers", "products", "sellers", "orders", "order_items", "order_payments", "order_reviews")
    }
    model["geolocation_observations"] = cleaned(tb, "geolocation")
    model["geolocation_lookup"] = build_geolocation_lookup(model["geolocation_observations"], raw["geolocation"])
    model["product_categories"] = C.promote_untranslated(
        cleaned(tb, "product_category_name_translation"), model["products"]
    )
    return model


@register("cln_01_strip_text")
def _(tb: Testbed) -> DataFrame:
    return strip_text(tb["raw_customers"])


@register("cln_02_numeric_violations")
def _(tb: Testbed) -> DataFrame:
    return C.numeric_violations(tb["raw_items"], ["order_item_id", "price", "freight_value", "shipping_limit_date"])


@register("cln_02_coerce_numeric")
def _(tb: Testbed) -> DataFrame:
    return C.coerce_numeric(tb["raw_items"], ["order_item_id", "price", "freight_value"], "order_items.csv")


@register("cln_03_parse_timestamps")
def _(tb: Testbed) -> DataFrame:
    times = MARKETPLACE.sources["orders"].of_kind("timestamp")
    stamped = strip_text(tb["raw_orders"]).select("order_id", *times)
    return C.parse_timestamps(stamped, times, "orders.csv")


@register("cln_04_sequence_flags")
def _(tb: Testbed) -> DataFrame:
    flagged = C.add_sequence_flags(tb["mk_orders"])
    return flagged.select("order_id", *[name for name in flagged.columns if name.startswith("dq_")])


@register("cln_05_lower_values")
def _(tb: Testbed) -> DataFrame:
    lowered = C.lower_values(strip_text(tb["raw_orders"]), "order_status")
    return lowered.groupBy("order_status").agg(F.count("*").alias("orders"))


@register("cln_05_lower_payment_type")
def _(tb: Testbed) -> DataFrame:
    lowered = C.lower_values(strip_text(tb["raw_payments"]), "payment_type")
    return lowered.groupBy("payment_type").agg(F.count("*").alias("payments"))


@register("cln_06_item_flags")
def _(tb: Testbed) -> DataFrame:
    flags = cleaned(tb, "order_items").groupBy("dq_negative_price", "dq_negative_freight_value")
    return flags.agg(F.count("*").alias("items"))


@register("cln_07_payment_flags")
def _(tb: Testbed) -> DataFrame:
    flags = cleaned(tb, "order_payments").groupBy("dq_negative_payment_value", "dq_negative_payment_installments")
    return flags.agg(F.count("*").alias("payments"))


@register("cln_08_review_flag")
def _(tb: Testbed) -> DataFrame:
    flags = cleaned(tb, "order_reviews").groupBy("review_score", "dq_review_score_out_of_range")
    return flags.agg(F.count("*").alias("reviews"))


@register("cln_09_translate_categories")
def _(tb: Testbed) -> DataFrame:
    products = strip_text(tb["raw_products"]).select("product_id", "product_category_name")
    return C.translate_categories(products, tb["raw_translation"])


@register("cln_10_correct_product_columns")
def _(tb: Testbed) -> DataFrame:
    return cleaned(tb, "products").select("product_id", "product_name_length", "product_description_length")


@register("cln_11_remove_exact_duplicates")
def _(tb: Testbed) -> DataFrame:
    return cleaned(tb, "geolocation")


@register("cln_12_geolocation_lookup")
def _(tb: Testbed) -> DataFrame:
    return build_geolocation_lookup(cleaned(tb, "geolocation"), tb["raw_geo"])


@register("cln_13_promote_untranslated")
def _(tb: Testbed) -> DataFrame:
    return C.promote_untranslated(cleaned(tb, "product_category_name_translation"), cleaned(tb, "products"))


for _name in MARKETPLACE.sources:
    register(f"cln_14_clean_{_name}")(lambda tb, table=_name: cleaned(tb, table))


# Integrity checks over published tables with planted defects.


def published_with_defects(tb: Testbed) -> dict[str, DataFrame]:
    model = cleaned_model(tb)
    key = lambda column: F.col(column).cast("bigint")
    customers, orders = model["customers"], model["orders"]
    model["customers"] = customers.filter(key("customer_id") % 40 != 0).unionByName(
        customers.filter(key("customer_id") % 71 == 0)
    )
    model["orders"] = orders.filter(key("order_id") % 67 != 0).withColumn(
        "customer_id", F.when(key("order_id") % 211 != 0, F.col("customer_id"))
    )
    model["products"] = model["products"].filter(key("product_id") % 59 != 0)
    model["sellers"] = model["sellers"].filter(key("seller_id") % 43 != 0)
    model["product_categories"] = model["product_categories"].filter(F.col("product_category_name") != "economy")
    return model


for _position, _name in enumerate(I.KEY_RULES, start=1):
    register(f"chk_{_position:02d}_{_name}")(
        lambda tb, name=_name: I.key_rule_counts(published_with_defects(tb), [name])
    )


for _position, _name in enumerate(I.ROW_CHECKS, start=9):
    register(f"chk_{_position:02d}_{_name}")(
        lambda tb, name=_name: I.row_checks(published_with_defects(tb), [name])
    )


@register("chk_15_integrity_report")
def _(tb: Testbed) -> DataFrame:
    return I.integrity_checks(published_with_defects(tb))


# Profiling of every given table and of text tables with planted problems.


def audit(tb: Testbed) -> P.Audit:
    return P.audit_tables({name: tb[name] for name in profile_oracle.PROFILED})


def measured(tb: Testbed, measure: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """One measure of every profiled table."""
    return union_all(measure(tb[name], name) for name in profile_oracle.PROFILED)


def drift_reports(tb: Testbed) -> dict[str, DataFrame]:
    reports = Q.relational_quality_reports(tb.spark, tb.typed_sources())
    reports["schema_checks"] = Q.schema_checks(tb.spark, drifted_sources(tb))
    return reports


@register("prf_01_shapes")
def _(tb: Testbed) -> DataFrame:
    return P.shapes(audit(tb))


@register("prf_02_duplicate_rows")
def _(tb: Testbed) -> DataFrame:
    return measured(tb, P.duplicate_rows)


@register("prf_03_missing_values")
def _(tb: Testbed) -> DataFrame:
    return measured(tb, P.column_statistics).select("file_name", "column_name", "missing_values")


@register("prf_04_inferred_types")
def _(tb: Testbed) -> DataFrame:
    return measured(tb, P.column_statistics).select("file_name", "column_name", "inferred_type")


@register("prf_05_candidate_keys")
def _(tb: Testbed) -> DataFrame:
    return audit(tb).keys


@register("prf_06_timestamp_problems")
def _(tb: Testbed) -> DataFrame:
    columns = measured(tb, P.column_statistics).filter(F.col("timestamp_values").isNotNull())
    return columns.select("file_name", "column_name", "timestamp_values", "invalid_timestamps")


@register("prf_06_invalid_examples")
def _(tb: Testbed) -> DataFrame:
    return measured(tb, P.invalid_timestamp_examples)


@register("prf_07_warnings")
def _(tb: Testbed) -> DataFrame:
    return P.warnings(audit(tb))


@register("prf_08_overview")
def _(tb: Testbed) -> DataFrame:
    return P.overview(audit(tb))


@register("prf_09_column_quality")
def _(tb: Testbed) -> DataFrame:
    return P.column_quality(audit(tb))


@register("prf_10_issue_register")
def _(tb: Testbed) -> DataFrame:
    return P.issue_register(audit(tb), {"broken.csv": "Could not read broken.csv."})


@register("prf_11_timestamp_issues")
def _(tb: Testbed) -> DataFrame:
    return P.timestamp_issues(audit(tb))


@register("prf_12_relational_issues")
def _(tb: Testbed) -> DataFrame:
    return P.relational_issues(drift_reports(tb))


@register("prf_13_status_counts")
def _(tb: Testbed) -> DataFrame:
    return P.status_counts(Q.relational_quality_reports(tb.spark, tb.typed_sources()))


@register("prf_13_audit_totals")
def _(tb: Testbed) -> DataFrame:
    return P.audit_totals(audit(tb), discovered=len(profile_oracle.PROFILED) + 1, load_errors=1)


@register("prf_14_flag_counts")
def _(tb: Testbed) -> DataFrame:
    return P.flag_counts(cleaned(tb, "orders"))


# Validation before publishing.


@register("ldc_02_timestamp_violations")
def _(tb: Testbed) -> DataFrame:
    times = {name: "timestamp" for name in MARKETPLACE.sources["orders"].of_kind("timestamp")}
    return D.type_violations(tb["raw_orders"], ModelTable("orders", "orders", times, ()))


@register("ldc_03_integer_violations")
def _(tb: Testbed) -> DataFrame:
    names = ("payment_sequential", "payment_installments", "payment_value", "payment_type")
    table = ModelTable("order_payments", "order_payments", dict.fromkeys(names, "integer"), ())
    return D.type_violations(tb["raw_integers"], table)


for _key, _ends in {
    "ldc_04_not_null": ".not_null",
    "ldc_05_max_length": ".max_length_32",
    "ldc_06_state_length": ".length_2",
    "ldc_07_allowed_statuses": ".allowed_values",
    "ldc_08_item_amounts": "order_items.%.nonnegative",
    "ldc_09_payment_amounts": "order_payments.%.nonnegative",
    "ldc_10_review_score": ".between_1_and_5",
    "ldc_11_coordinates": ".coordinate_bounds",
}.items():
    register(_key)(lambda tb, ends=_ends: D.row_rule_report(cleaned_model(tb), D.rules_like(ends)))


@register("ldc_12_domain_report")
def _(tb: Testbed) -> DataFrame:
    return D.validate_domains(cleaned_model(tb))


@register("ldc_13_uniqueness")
def _(tb: Testbed) -> DataFrame:
    return D.uniqueness_report(cleaned_model(tb))


@register("ldc_14_foreign_keys")
def _(tb: Testbed) -> DataFrame:
    return D.reference_report(cleaned_model(tb), MARKETPLACE.model_references)


@register("ldc_15_row_constraints")
def _(tb: Testbed) -> DataFrame:
    return D.row_rule_report(cleaned_model(tb), declared_row_rules())


@register("ldc_15_all_declared")
def _(tb: Testbed) -> DataFrame:
    return D.declared_constraints(cleaned_model(tb))


@register("val_01_processed_summary")
def _(tb: Testbed) -> DataFrame:
    return D.processed_summary(cleaned_model(tb))


# Takeaways.

FIRST_MONTH = date.fromisoformat(insights_oracle.FIRST)
LAST_MONTH = date.fromisoformat(insights_oracle.LAST)


def core(tb: Testbed) -> DataFrame:
    return E.core_window(A.monthly_performance(tb.marketplace()), FIRST_MONTH, LAST_MONTH)


@register("eda_01_kpi_cards")
def _(tb: Testbed) -> DataFrame:
    return E.kpi_cards(A.executive_summary(tb.marketplace()))


@register("eda_02_core_window")
def _(tb: Testbed) -> DataFrame:
    return core(tb)


@register("eda_03_top_categories")
def _(tb: Testbed) -> DataFrame:
    return E.top_by_gmv(A.category_performance(tb.marketplace()), "category_name")


@register("eda_04_top_states")
def _(tb: Testbed) -> DataFrame:
    return E.top_by_gmv(A.state_performance(tb.marketplace()), "customer_state")


@register("eda_05_cohort_matrix")
def _(tb: Testbed) -> DataFrame:
    return E.cohort_cells(E.cohort_matrix(A.monthly_customer_cohorts(tb.marketplace())))


@register("eda_06_peak_gmv_month")
def _(tb: Testbed) -> DataFrame:
    return E.peak_gmv_month(core(tb))


@register("eda_07_worst_on_time_month")
def _(tb: Testbed) -> DataFrame:
    return E.worst_on_time_month(core(tb))


def _share(tb: Testbed, analysis, name: str, count: int, alias: str) -> DataFrame:
    tables = tb.marketplace()
    return E.top_share(analysis(tables), A.executive_summary(tables), name, count, alias)


@register("eda_08_top_five_category_share")
def _(tb: Testbed) -> DataFrame:
    return _share(tb, A.category_performance, "category_name", 5, "top_five_category_share_pct")


@register("eda_09_top_three_state_share")
def _(tb: Testbed) -> DataFrame:
    return _share(tb, A.state_performance, "customer_state", 3, "top_three_state_share_pct")


@register("eda_10_very_late_band")
def _(tb: Testbed) -> DataFrame:
    return E.very_late_band(A.delivery_review_relationship(tb.marketplace()))


@register("eda_11_columns_with_gaps")
def _(tb: Testbed) -> DataFrame:
    return E.columns_with_gaps(audit(tb))


@register("eda_12_overview_by_rows")
def _(tb: Testbed) -> DataFrame:
    return E.overview_by_rows(audit(tb))


@register("eda_12_overview_by_duplicates")
def _(tb: Testbed) -> DataFrame:
    return E.overview_by_duplicates(audit(tb))


@register("eda_12_timestamps_by_problems")
def _(tb: Testbed) -> DataFrame:
    return E.timestamps_by_problems(audit(tb))


@register("eda_12_issues_by_file")
def _(tb: Testbed) -> DataFrame:
    return E.issues_by_file(P.relational_issues(drift_reports(tb)))


@register("eda_12_rules_by_status")
def _(tb: Testbed) -> DataFrame:
    return E.rules_by_status(Q.business_rule_checks(tb.spark, tb.typed_sources()))


@register("eda_13_slice_months")
def _(tb: Testbed) -> DataFrame:
    return E.slice_months(A.monthly_performance(tb.marketplace()), FIRST_MONTH, LAST_MONTH)


@register("eda_13_slice_states")
def _(tb: Testbed) -> DataFrame:
    return E.slice_states(A.state_performance(tb.marketplace()), ["BRAZIL", "FRANCE", "NATION_3"])


@register("eda_14_weighted_month_one_activity")
def _(tb: Testbed) -> DataFrame:
    return E.weighted_month_one_activity(A.monthly_customer_cohorts(tb.marketplace()))


@register("eda_15_top_ten_category_share")
def _(tb: Testbed) -> DataFrame:
    return _share(tb, A.category_performance, "category_name", 10, "top_ten_category_share_pct")


# Sources, sinks and whole runs. The test tables are written as CSV files to the scratch folder first.


def good_sources(tb: Testbed) -> dict[str, DataFrame]:
    return {table: tb[view] for table, view in GOOD_SOURCES.items()}


# The columns of the numbered lines that payments and reviews read.
LINES = ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate", "seq")


def written_sources(tb: Testbed) -> str:
    """A folder with the nine source files; as text they are some nine times the tables, so they are written as gzip."""
    folder = scratch_folder(tb.spark, "sources")
    # Payments and reviews number the lines of an order alike.
    with released_shuffles(tb.spark), tb.kept("mk_lines", *LINES):
        for table, df in good_sources(tb).items():
            sinks.write_csv(df, f"{folder}/archive/{MARKETPLACE.file_name(table)}", compression="gzip")
    return folder


def cleaning_run(tb: Testbed) -> tuple[str, clean_plan.CleaningRun]:
    folder, sources = scratch_folder(tb.spark, "run"), written_sources(tb)
    run = clean_plan.run_cleaning_pipeline(tb.spark, sources, f"{folder}/processed", f"{folder}/reports")
    sinks.discard(tb.spark, sources)
    return folder, run


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all(
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    )


@register("src_02_csv_scan")
def _(tb: Testbed) -> DataFrame:
    path = f"{scratch_folder(tb.spark, 'csv')}/raw_orders.csv"
    sinks.write_csv(tb["raw_orders"], path)
    return source.load_csv(tb.spark, path)


@register("src_02_csv_scan_multi_line")
def _(tb: Testbed) -> DataFrame:
    path = f"{scratch_folder(tb.spark, 'csv')}/documents.csv"
    sinks.write_csv(tb["documents"], path)
    return source.load_csv(tb.spark, path)


def text_facts(tables: dict[str, DataFrame]) -> DataFrame:
    """What the columns of text tables hold: filled values, least and greatest one, and characters in all."""
    frames = []
    for name, df in tables.items():
        columns = df.columns
        facts = [
            f"{fact}({sql.name(c)}) AS {fact}{i}" for i, c in enumerate(columns) for fact in ("count", "min", "max")
        ] + [f"sum(length({sql.name(c)})) AS size{i}" for i, c in enumerate(columns)]
        records = [
            {
                "table_name": sql.literal(name),
                "column_name": sql.literal(c),
                "row_count": "row_count",
                "filled_values": f"count{i}",
                "least_value": f"min{i}",
                "greatest_value": f"max{i}",
                "characters": f"size{i}",
            }
            for i, c in enumerate(columns)
        ]
        frames.append(unpivot_row(df.selectExpr("count(1) AS row_count", *facts), records))
    return union_all(frames)


@register("src_03_load_source_tables")
def _(tb: Testbed) -> DataFrame:
    return text_facts(source.load_source_tables(tb.spark, written_sources(tb)))


@register("src_04_audit_csv_directory")
def _(tb: Testbed) -> DataFrame:
    folder = scratch_folder(tb.spark, "csv")
    sinks.write_csv(tb["raw_orders"], f"{folder}/orders.csv")
    sinks.write_csv(tb["raw_reviews"], f"{folder}/order_reviews.csv")
    broken = tb["raw_sellers"].select(F.concat_ws(",", F.lit("more"), *tb["raw_sellers"].columns).alias("a,b"))
    broken.write.option("header", True).option("quote", "").csv(f"{folder}/sellers.csv")
    audit, _, errors = source.audit_csv_directory(tb.spark, folder, scratch_folder(tb.spark, "audit"))
    audited = P.shapes(audit).select("file_name", F.lit("audited").alias("outcome"), "row_count")
    rows = [(name, "load_error", None) for name in sorted(errors)]
    return audited.unionByName(tb.spark.createDataFrame(rows, "file_name string, outcome string, row_count bigint"))


@register("src_05_processed_scan")
def _(tb: Testbed) -> DataFrame:
    folder = scratch_folder(tb.spark, "processed")
    sinks.write_tables({"orders": cleaned(tb, "orders")}, folder, "csv")
    return read_processed_table(tb.spark, folder, MARKETPLACE.model["orders"], "csv")


@register("src_06_extract_scan")
def _(tb: Testbed) -> DataFrame:
    folder = scratch_folder(tb.spark, "extracts")
    analytics_plan.run_analytics_pipeline(tb.spark, tb.marketplace(), folder)
    return row_counts(read_extracts(tb.spark, folder))


@register("snk_01_processed_csv")
def _(tb: Testbed) -> DataFrame:
    path = f"{scratch_folder(tb.spark, 'csv')}/order_items.csv"
    sinks.write_csv(cleaned(tb, "order_items"), path)
    return D.typed_table(source.load_csv(tb.spark, path), MARKETPLACE.model["order_items"])


@register("snk_02_audit_report_set")
def _(tb: Testbed) -> DataFrame:
    reports, sources = scratch_folder(tb.spark, "reports"), written_sources(tb)
    audit_plan.run_data_quality_audit(tb.spark, sources, reports)
    sinks.discard(tb.spark, sources)
    names = [name for name in audit_plan.REPORTS if name != "audit_summary"]
    return row_counts({name: source.load_csv(tb.spark, f"{reports}/{name}.csv") for name in names})


@register("snk_03_publish_tables")
def _(tb: Testbed) -> DataFrame:
    folder, _ = cleaning_run(tb)
    tables = read_processed(tb.spark, f"{folder}/processed")
    counts, _ = publish_plan.load_processed_data(tb.spark, tables, f"{folder}/published")
    return counts


@register("snk_04_extract_sink")
def _(tb: Testbed) -> DataFrame:
    folder = scratch_folder(tb.spark, "extracts")
    analytics_plan.run_analytics_pipeline(tb.spark, tb.marketplace(), folder)
    return read_extracts(tb.spark, folder)["monthly_performance"]


@register("snk_05_file_digests")
def _(tb: Testbed) -> DataFrame:
    return sinks.file_digests(tb.spark, f"{tb.folder}/*.parquet").select("length", "sha256")


@register("snk_05_table_fingerprints")
def _(tb: Testbed) -> DataFrame:
    return union_all(
        table_fingerprint(tb[name]).select(F.lit(name).alias("table_name"), "row_count", "xor_digest", "sum_digest")
        for name in TABLE_SCHEMAS
    )


@register("snk_06_cleaning_lineage")
def _(tb: Testbed) -> DataFrame:
    raw = tb.raw_sources()
    model = cleaned_model(tb)
    outputs = {table.source: model[name] for name, table in MARKETPLACE.model.items()}
    return clean_plan.lineage_counts(raw, outputs)


@register("snk_07_analytics_lineage")
def _(tb: Testbed) -> DataFrame:
    tables = tb.marketplace()
    results = {name: analysis(tables) for name, analysis in A.ANALYSES.items()}
    return analytics_plan.analytics_lineage(results).select("query_name", "row_count", "columns", "query_sha256")


@register("snk_08_load_evidence")
def _(tb: Testbed) -> DataFrame:
    tables = published_with_defects(tb)
    counts = D.reconcile_counts(tables, tables).select("table_name", "loaded_rows", "status")
    return publish_plan.load_evidence(counts, I.integrity_checks(tables))


@register("cln_15_clean_all_source_tables")
def _(tb: Testbed) -> DataFrame:
    results = clean_plan.clean_all_source_tables(tb.spark, good_sources(tb))
    return row_counts({name: result.frame for name, result in results.items()})


@register("cln_16_cleaning_run")
def _(tb: Testbed) -> DataFrame:
    return cleaning_run(tb)[1].lineage


@register("val_02_row_count_reconciliation")
def _(tb: Testbed) -> DataFrame:
    prepared = {name: tb[view] for name, view in GOOD_SOURCES.items()}
    published = {**prepared, "customers": tb["pl_customers"]}
    return D.reconcile_counts(prepared, published)


@register("ana_11_result_contract")
def _(tb: Testbed) -> DataFrame:
    tables = tb.marketplace()
    frames = []
    for name, analysis in A.ANALYSES.items():
        result = analysis(tables)
        A.check_result(name, result.columns)
        frames.append(
            result.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("query_name"), (F.col("row_count") > 0).alias("has_rows")
            )
        )
    return union_all(frames)


@register("ana_12_analytics_run")
def _(tb: Testbed) -> DataFrame:
    lineage = analytics_plan.run_analytics_pipeline(
        tb.spark, tb.marketplace(), scratch_folder(tb.spark, "extracts"), "parquet"
    )
    return lineage.select("query_name", "row_count", "columns", "query_sha256")
