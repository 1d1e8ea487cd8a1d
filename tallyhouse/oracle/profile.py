"""Expected results of the profiler."""

from __future__ import annotations

import re

from tallyhouse.contracts import MARKETPLACE
from tallyhouse.oracle.quality import percent, union
from tallyhouse.sources.testbed import TABLE_SCHEMAS

# The profiled tables: every given table, and text tables with planted problems.
PROFILED_TEXT = {
    "raw_orders": list(MARKETPLACE.sources["orders"].columns),
    "raw_items": list(MARKETPLACE.sources["order_items"].columns),
    "raw_reviews": list(MARKETPLACE.sources["order_reviews"].columns),
    "raw_customers": list(MARKETPLACE.sources["customers"].columns),
    "raw_geo": list(MARKETPLACE.sources["geolocation"].columns),
}
TYPED_TEXT = [
    ("order_id", "string"),
    ("is_large", "string"),
    ("total_text", "string"),
    ("maybe_custkey", "string"),
    ("nothing", "string"),
    ("order_priority", "string"),
    ("total_price", "double"),
    ("created_at", "string"),
]

SPACE = "' ' || chr(9) || chr(10) || chr(13)"
LAYOUT = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d{1,6})?)?$"


def fields(name: str) -> list[tuple[str, str]]:
    if name in PROFILED_TEXT:
        return [(column, "string") for column in PROFILED_TEXT[name]]
    if name == "raw_typed":
        return TYPED_TEXT
    return [tuple(part.strip().split(" ")) for part in TABLE_SCHEMAS[name].split(",")]


PROFILED = [*TABLE_SCHEMAS, *PROFILED_TEXT, "raw_typed"]


def text(column: str) -> str:
    return f"NULLIF(TRIM({column}, {SPACE}), '')"


def bad(column: str) -> str:
    value = text(column)
    return (
        f"({value} IS NOT NULL AND (NOT regexp_matches({value}, '{LAYOUT}') "
        f"OR TRY_CAST({value} AS TIMESTAMP) IS NULL))"
    )


def is_stamp(column: str, kind: str) -> bool:
    return kind == "string" and re.search(r"date|time|_at$", column, re.IGNORECASE) is not None


def column_row(table: str, position: int, column: str, kind: str) -> str:
    inferred = f"'{dict(int='int').get(kind, kind)}'"
    if kind == "string":
        inferred = (
            f"CASE WHEN COUNT({column}) = 0 THEN 'double' "
            rf"WHEN COUNT(*) FILTER (WHERE regexp_matches({column}, '^\s*[+-]?\d+\s*$') "
            rf"AND TRY_CAST(trim({column}) AS BIGINT) IS NOT NULL) = COUNT({column}) "
            "THEN 'bigint' "
            rf"WHEN COUNT(*) FILTER (WHERE regexp_matches({column}, "
            rf"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$')) = COUNT({column}) THEN 'double' "
            f"WHEN COUNT(*) FILTER (WHERE {column} IN ('True', 'False', 'TRUE', 'FALSE', 'true', 'false')) "
            f"= COUNT({column}) THEN 'boolean' ELSE 'string' END"
        )
    stamps = f"COUNT({text(column)})" if is_stamp(column, kind) else "CAST(NULL AS BIGINT)"
    broken = f"COUNT(*) FILTER (WHERE {bad(column)})" if is_stamp(column, kind) else "CAST(NULL AS BIGINT)"
    return f"""
        SELECT '{table}' AS file_name, {position} AS position, '{column}' AS column_name,
               {inferred} AS inferred_type, COUNT(*) AS row_count, COUNT(*) - COUNT({column}) AS missing_values,
               {stamps} AS timestamp_values, {broken} AS invalid_timestamps
        FROM {{{table}}}"""


def keys(table: str) -> list[str]:
    return [
        f"SELECT '{table}' AS file_name, '{c}' AS column_name, {i} AS position FROM {{{table}}} "
        f"HAVING COUNT({c}) = COUNT(*) AND COUNT(DISTINCT {c}) = COUNT(*) AND COUNT(*) > 0"
        for i, (c, _) in enumerate(fields(table), start=1)
        if re.search(r"^id$|_id$", c, re.IGNORECASE)
    ]


def examples(table: str) -> list[str]:
    return [
        f"SELECT '{table}' AS file_name, '{c}' AS column_name, "
        f"array_to_string(list_slice(list_sort(list(DISTINCT {text(c)})), 1, 5), ' | ') AS invalid_examples "
        f"FROM {{{table}}} WHERE {bad(c)} HAVING COUNT(*) > 0"
        for c, kind in fields(table)
        if is_stamp(c, kind)
    ]


STAGE_VIEWS = {
    "au_columns": union(
        column_row(table, i, column, kind)
        for table in PROFILED
        for i, (column, kind) in enumerate(fields(table), start=1)
    ),
    "au_duplicates": union(
        f"SELECT '{t}' AS file_name, COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {{{t}}}) AS d) "
        f"AS duplicate_rows FROM {{{t}}}"
        for t in PROFILED
    ),
    "au_keys": union(part for t in PROFILED for part in keys(t)),
    "au_examples": union(part for t in PROFILED for part in examples(t)),
    "au_facts": """
        SELECT c.file_name, c.row_count, c.column_count, c.gaps, c.invalid, d.duplicate_rows, k.names
        FROM (SELECT file_name, MAX(row_count) AS row_count, COUNT(*) AS column_count,
                     COUNT(*) FILTER (WHERE missing_values > 0) AS gaps,
                     CAST(COALESCE(SUM(invalid_timestamps), 0) AS BIGINT) AS invalid
              FROM {au_columns} GROUP BY file_name) AS c
        JOIN {au_duplicates} AS d ON d.file_name = c.file_name
        LEFT JOIN (SELECT file_name, string_agg(column_name, ', ' ORDER BY position) AS names
                   FROM {au_keys} GROUP BY file_name) AS k ON k.file_name = c.file_name""",
    "au_warnings": """
        SELECT file_name, 'The file contains no data rows.' AS message FROM {au_facts} WHERE row_count = 0
        UNION ALL SELECT file_name, format('Found {:,} fully duplicated row(s).', duplicate_rows)
        FROM {au_facts} WHERE duplicate_rows > 0
        UNION ALL SELECT file_name, format('Found missing values in {:,} column(s).', gaps)
        FROM {au_facts} WHERE gaps > 0
        UNION ALL SELECT file_name, format('Found {:,} unparseable value(s) in timestamp-like columns.', invalid)
        FROM {au_facts} WHERE invalid > 0
        UNION ALL SELECT file_name,
            'No single non-null, unique ID-like column was identified; verify the intended key grain.'
        FROM {au_facts} WHERE names IS NULL""",
    "au_overview": """
        SELECT f.file_name, f.row_count AS "rows", f.column_count AS "columns", f.duplicate_rows,
               f.gaps AS columns_with_missing, COALESCE(f.names, 'None identified') AS likely_primary_keys,
               (SELECT COUNT(*) FROM {au_warnings} AS w WHERE w.file_name = f.file_name) AS quality_warnings
        FROM {au_facts} AS f""",
    "au_quality": f"""
        SELECT c.file_name, c.column_name, c.inferred_type AS inferred_dtype, c.missing_values,
               {percent("c.missing_values", "c.row_count")} AS missing_percent,
               k.column_name IS NOT NULL AS likely_primary_key
        FROM {{au_columns}} AS c
        LEFT JOIN {{au_keys}} AS k ON k.file_name = c.file_name AND k.column_name = c.column_name""",
    "au_stamps": f"""
        SELECT c.file_name, c.column_name, c.timestamp_values AS non_null_values,
               c.invalid_timestamps AS invalid_values,
               {percent("c.invalid_timestamps", "c.timestamp_values")} AS invalid_percent,
               COALESCE(e.invalid_examples, '') AS invalid_examples
        FROM {{au_columns}} AS c
        LEFT JOIN {{au_examples}} AS e ON e.file_name = c.file_name AND e.column_name = c.column_name
        WHERE c.timestamp_values > 0""",
    "au_relational": """
        SELECT file_name, 'schema' AS issue_type,
               concat(file_name, ' returned status ''', status, '''.') AS message
        FROM {ch_schema} WHERE status <> 'passed'
        UNION ALL SELECT file_name, 'key', concat(primary_key, ' returned status ''', status, '''.')
        FROM {ch_keys} WHERE status <> 'passed'
        UNION ALL SELECT split_part(child_reference, ':', 1), 'relationship',
               concat(relationship, ' returned status ''', status, '''.')
        FROM {ch_references} WHERE status <> 'passed'
        UNION ALL SELECT file_name, 'business_rule', concat(rule_name, ' returned status ''', status, '''.')
        FROM {ch_rules} WHERE status <> 'passed'""",
}

STATEMENTS = {
    "prf_01_shapes": """
        SELECT file_name, MAX(row_count) AS row_count, COUNT(*) AS column_count,
               string_agg(column_name, ', ' ORDER BY position) AS column_names
        FROM {au_columns} GROUP BY file_name""",
    "prf_02_duplicate_rows": "SELECT * FROM {au_duplicates}",
    "prf_03_missing_values": "SELECT file_name, column_name, missing_values FROM {au_columns}",
    "prf_04_inferred_types": "SELECT file_name, column_name, inferred_type FROM {au_columns}",
    "prf_05_candidate_keys": "SELECT file_name, column_name FROM {au_keys}",
    "prf_06_timestamp_problems": """
        SELECT file_name, column_name, timestamp_values, invalid_timestamps FROM {au_columns}
        WHERE timestamp_values IS NOT NULL""",
    "prf_06_invalid_examples": "SELECT * FROM {au_examples}",
    "prf_07_warnings": "SELECT * FROM {au_warnings}",
    "prf_08_overview": "SELECT * FROM {au_overview}",
    "prf_09_column_quality": "SELECT * FROM {au_quality}",
    "prf_10_issue_register": """
        SELECT file_name, 'quality_warning' AS issue_type, message FROM {au_warnings}
        UNION ALL SELECT 'broken.csv', 'load_error', 'Could not read broken.csv.'""",
    "prf_11_timestamp_issues": "SELECT * FROM {au_stamps}",
    "prf_12_relational_issues": "SELECT * FROM {au_relational}",
    "prf_13_status_counts": "SELECT * FROM {ch_bundle}",
    "prf_13_audit_totals": """
        SELECT COUNT(*) + 1 AS discovered_file_count, COUNT(*) AS audited_file_count,
               CAST(1 AS BIGINT) AS load_error_count,
               CAST(SUM(row_count) AS BIGINT) AS total_rows_across_source_tables FROM {au_facts}""",
    "eda_11_columns_with_gaps": "SELECT * FROM {au_quality} WHERE missing_values > 0",
    "eda_12_overview_by_rows": "SELECT * FROM {au_overview}",
    "eda_12_overview_by_duplicates": """
        SELECT file_name, duplicate_rows, likely_primary_keys, quality_warnings FROM {au_overview}""",
    "eda_12_timestamps_by_problems": "SELECT * FROM {au_stamps}",
    "eda_12_issues_by_file": "SELECT * FROM {au_relational}",
    "eda_12_rules_by_status": "SELECT * FROM {ch_rules}",
}
