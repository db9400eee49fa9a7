"""Reports that stand in for the declared constraints: unique keys, foreign keys, coded domains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas


def duplicate_keys(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null reference has no parent."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def outside_domain(rows: DataFrame, table: str, column: str, allowed: tuple) -> DataFrame:
    """Values outside a coded domain and how often they occur; null passes, as in a CHECK constraint."""
    return rows.filter(~F.col(column).isin(*allowed)).groupBy(
        F.col(column).cast("string").alias("value")
    ).agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "value", "rows"
    )


# The coded columns and their domains.
DOMAINS = (
    ("affected_periods", "status", schemas.PERIOD_STATUSES),
    ("affected_periods", "month", tuple(range(1, 13))),
    ("news_keywords", "extractor_source", schemas.EXTRACTORS),
    ("news_keyword_processing", "status", schemas.MARKER_STATUSES),
    ("processing_runs", "run_type", schemas.RUN_TYPES),
    ("processing_runs", "status", schemas.RUN_STATUSES),
)


def domain_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """All violations of the coded domains in the given tables."""
    reports = [
        outside_domain(tables[table], table, column, allowed)
        for table, column, allowed in DOMAINS if table in tables
    ]
    return reduce(DataFrame.unionByName, reports)


# Declared constraints.  Unique keys besides ``schemas.KEYS``, references (child, column, parent, column), columns
# that may not be null.
MORE_KEYS = (("keyword_dictionary", ("canonical_keyword",)), ("source_aliases", ("alias",)))
REFERENCES = (
    ("affected_periods", "processing_run_id", "processing_runs", "run_id"),
    ("news_keyword_processing", "updated_from_run_id", "processing_runs", "run_id"),
    ("keyword_aliases", "normalized_keyword", "keyword_dictionary", "normalized_keyword"),
    ("news_keywords", "raw_noticia_id", "raw_news", "id"),
    ("news_keywords", "noticia_hash", "raw_news", "noticia_hash"),
    ("news_keyword_processing", "raw_noticia_id", "raw_news", "id"),
    ("source_keyword_stats", "source_media", "source_monthly_stats", "source_media"),
    ("monthly_keyword_stats", "month_start", "monthly_overview", "month_start"),
    ("daily_activity", "month_start", "monthly_overview", "month_start"),
    ("source_monthly_stats", "month_start", "monthly_overview", "month_start"),
)
REQUIRED = tuple((table, column) for table, key in schemas.KEYS.items() for column in key) + (
    ("raw_news", "titulo"), ("raw_news", "url_original"), ("raw_news", "fuente"), ("affected_periods", "status"),
    ("processing_runs", "status"), ("news_keywords", "occurrences"),
)


def _report(rows: DataFrame, table: str, rule: str, violations, example) -> DataFrame:
    return rows.agg(violations.alias("violations"), example.alias("example")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "violations", "example"
    )


def row_violations(rows: DataFrame, table: str) -> DataFrame:
    """Nulls and values outside their domain in all columns of a table, counted in one pass."""
    broken = {f"required {c}": F.col(c).isNull() for t, c in REQUIRED if t == table and c in rows.columns}
    broken |= {f"domain {c}": ~F.col(c).isin(*allowed) for t, c, allowed in DOMAINS if t == table and c in rows.columns}
    if not broken:
        return rows.sparkSession.createDataFrame([], "table_name string, rule string, violations bigint, example string")
    figures = [F.struct(
        F.lit(rule).alias("rule"), F.count_if(where).alias("violations"),
        F.min(F.when(where, F.col(rule.split()[1]).cast("string"))).alias("example"),
    ) for rule, where in broken.items()]
    return rows.agg(F.array(*figures).alias("figures")).select(F.inline("figures")).select(
        F.lit(table).alias("table_name"), "rule", "violations", "example"
    )


def key_violations(rows: DataFrame, table: str, key: tuple[str, ...]) -> DataFrame:
    """Keys on more than one row; keys with a null part never collide."""
    complete = rows.dropna(subset=list(key))
    name = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
    return _report(duplicate_keys(complete, key), table, f"unique {', '.join(key)}", F.count(F.lit(1)), F.min(name))


def reference_violations(child: DataFrame, table: str, column: str, parent: DataFrame, parent_table: str, parent_column: str) -> DataFrame:
    """Child rows whose reference has no parent.  Equal references meet once, so a frequent one moves one row a task."""
    found = child.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    lost = orphans(found, column, parent.select(parent_column).distinct(), parent_column)
    return _report(
        lost, table, f"reference {column} to {parent_table}.{parent_column}", F.coalesce(F.sum("rows"), F.lit(0)),
        F.min(F.col(column).cast("string")),
    )


def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """One row for each declared constraint on the given tables: how often it is broken, and the least value that does."""
    reports = [row_violations(rows, table) for table, rows in tables.items()]
    keys = [*schemas.KEYS.items(), *MORE_KEYS]
    reports += [key_violations(tables[t], t, key) for t, key in keys if t in tables and set(key) <= set(tables[t].columns)]
    reports += [
        reference_violations(tables[child], child, column, tables[parent], parent, other)
        for child, column, parent, other in REFERENCES
        if child in tables and parent in tables and column in tables[child].columns and other in tables[parent].columns
    ]
    return reduce(DataFrame.unionByName, reports)
