"""Expected results of sources, sinks and whole runs."""

from __future__ import annotations

from tallyhouse.contracts import MARKETPLACE, RESULT_COLUMNS
from tallyhouse.functions.lineage import closure_digest
from tallyhouse.functions.text import MISSING_TOKENS
from tallyhouse.operators.analyses import ANALYSES
from tallyhouse.oracle.cleaning import CLEANED, RAW, TIMES, as_text
from tallyhouse.oracle.quality import union
from tallyhouse.sources.testbed import GOOD_SOURCES

ANALYSIS_VIEWS = dict(
    zip(
        RESULT_COLUMNS,
        (
            "an_executive",
            "an_monthly",
            "an_category",
            "an_state",
            "an_payment",
            "an_status",
            "an_delivery",
            "an_frequency",
            "an_cohorts",
            "an_seller",
        ),
        strict=True,
    )
)


def token(column: str) -> str:
    tokens = ", ".join(f"'{text}'" for text in MISSING_TOKENS)
    return f"CASE WHEN {column} NOT IN ({tokens}) THEN {column} END AS {column}"


def counts(views: dict[str, str]) -> str:
    return union(f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {{{view}}}" for name, view in views.items())


def text_facts(views: dict[str, str]) -> str:
    parts = []
    for name, view in views.items():
        columns = MARKETPLACE.sources[name].columns
        read = f"(SELECT {', '.join(token(c) for c in columns)} FROM {{{view}}}) AS t"
        parts += [
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, COUNT(*) AS row_count, COUNT({c}) AS filled_values, "
            f"MIN({c}) AS least_value, MAX({c}) AS greatest_value, CAST(SUM(LENGTH({c})) AS BIGINT) AS characters FROM {read}"
            for c in columns
        ]
    return union(parts)


# Rows after cleaning the good sources: geolocation loses exact copies, categories gain the untranslated one.
GOOD_OUTPUT = {
    **GOOD_SOURCES,
    "geolocation": "cl_geo",
    "product_category_name_translation": "cl_translation",
    "geolocation_lookup": "cl_lookup",
}


def lineage(inputs: dict[str, str], outputs: dict[str, str]) -> str:
    parts = []
    for name, view in outputs.items():
        before = f"(SELECT COUNT(*) FROM {{{inputs[name]}}})" if name in inputs else "CAST(NULL AS BIGINT)"
        parts.append(
            f"SELECT '{name}' AS table_name, {before} AS input_rows, COUNT(*) AS output_rows FROM {{{view}}}"
        )
    return f"""
        SELECT table_name, input_rows, output_rows,
               CASE WHEN input_rows IS NOT NULL THEN GREATEST(input_rows - output_rows, 0) END AS rows_removed,
               CASE WHEN input_rows IS NOT NULL THEN GREATEST(output_rows - input_rows, 0) END AS rows_added
        FROM ({union(parts)}) AS counted"""


ANALYTICS_LINEAGE = union(
    f"SELECT '{name}' AS query_name, COUNT(*) AS row_count, '{', '.join(columns)}' AS columns, "
    f"'{closure_digest(ANALYSES[name])}' AS query_sha256 "
    f"FROM {{{ANALYSIS_VIEWS[name]}}}"
    for name, columns in RESULT_COLUMNS.items()
)

MODEL_SOURCES = {table.source: CLEANED[name] for name, table in MARKETPLACE.model.items()}

STATEMENTS = {
    "src_02_csv_scan": f"""
        SELECT {", ".join(token(c) for c in MARKETPLACE.sources["orders"].columns)} FROM {{raw_orders}}""",
    "src_02_csv_scan_multi_line": f"""
        SELECT {", ".join(token(c) for c in ("doc_id", "text", "lang", "source", "n_chars"))}
        FROM (SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars
              FROM documents) AS t""",
    "src_03_load_source_tables": text_facts(GOOD_SOURCES),
    "src_04_audit_csv_directory": """
        SELECT 'orders.csv' AS file_name, 'audited' AS outcome, COUNT(*) AS row_count FROM {raw_orders}
        UNION ALL SELECT 'order_reviews.csv', 'audited', COUNT(*) FROM {raw_reviews}
        UNION ALL SELECT 'sellers.csv', 'load_error', NULL""",
    "src_05_processed_scan": f"SELECT * {as_text(*TIMES)} FROM {{cl_orders}}",
    "src_06_extract_scan": counts(ANALYSIS_VIEWS),
    "snk_01_processed_csv": f"SELECT * {as_text('shipping_limit_date')} FROM {{cl_items}}",
    "snk_03_publish_tables": union(
        f"SELECT 'marketplace.{name}' AS table_name, COUNT(*) AS loaded_rows, 'passed' AS status "
        f"FROM {{{GOOD_OUTPUT[table.source]}}}"
        for name, table in MARKETPLACE.model.items()
    ),
    "snk_04_extract_sink": """
        SELECT * REPLACE (CAST(order_month AS VARCHAR) AS order_month) FROM {an_monthly}""",
    "snk_06_cleaning_lineage": lineage(RAW, MODEL_SOURCES),
    "snk_07_analytics_lineage": ANALYTICS_LINEAGE,
    "snk_08_load_evidence": """
        SELECT CAST(10 AS BIGINT) AS loaded_table_count, COUNT(*) AS quality_check_count,
               COUNT(*) FILTER (WHERE violation_count > 0 AND check_name NOT LIKE 'retained_%')
                   AS failed_quality_check_count FROM {ch_all}""",
    "cln_15_clean_all_source_tables": counts(GOOD_OUTPUT),
    "cln_16_cleaning_run": lineage(GOOD_SOURCES, GOOD_OUTPUT),
    "val_02_row_count_reconciliation": union(
        f"SELECT 'marketplace.{name}' AS table_name, COUNT(*) AS prepared_rows, "
        + (
            "(SELECT COUNT(*) FROM {pl_customers}) AS loaded_rows, 'failed' AS status"
            if name == "customers"
            else "COUNT(*) AS loaded_rows, 'passed' AS status"
        )
        + f" FROM {{{view}}}"
        for name, view in GOOD_SOURCES.items()
    ),
    "ana_11_result_contract": union(
        f"SELECT '{name}' AS query_name, COUNT(*) > 0 AS has_rows FROM {{{view}}}"
        for name, view in ANALYSIS_VIEWS.items()
    ),
    "ana_12_analytics_run": ANALYTICS_LINEAGE,
}
