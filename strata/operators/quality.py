"""Running a rule suite over a DataFrame and shaping the outcome.

The suite is evaluated as ONE projection that adds an ``array<string>`` of
violated rule labels to every row: no row ids, no driver-side id lists, no
join back, no shuffle.  Splitting good from bad rows is two filters on that
column.  Per-rule counts are one global aggregate (partial per task, a
one-row exchange).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.rules import TABLE_LEVEL_ERROR, Suite

VIOLATIONS = "_dq_violations"


def annotate(df: DataFrame, suite: Suite, column: str = VIOLATIONS) -> DataFrame:
    """Add the array of violated row-rule labels (suite order)."""
    return df.withColumn(column, suite.violations())


def split(annotated: DataFrame, column: str = VIOLATIONS) -> tuple[DataFrame, DataFrame]:
    """(good rows without the column, bad rows with it)."""
    good = annotated.filter(F.size(column) == 0).drop(column)
    bad = annotated.filter(F.size(column) > 0)
    return good, bad


def violated_rules_text(column: str = VIOLATIONS) -> Column:
    """Labels joined with ``"; "`` in suite order."""
    return F.concat_ws("; ", F.col(column))


def quarantine_layout(
    rows: DataFrame,
    table_name: str,
    batch_id,
    payload: list[str],
    violated: Column,
) -> DataFrame:
    """The five quarantine columns.  ``raw_data`` is the row as JSON."""
    return rows.select(
        F.lit(table_name).alias("table_name"),
        F.lit(str(batch_id)).alias("gx_batch_id"),
        violated.alias("violated_rules"),
        F.to_json(F.struct(*[F.col(c) for c in payload])).alias("raw_data"),
        F.current_timestamp().alias("ingestion_time"),
    )


def quarantine_rows(
    annotated: DataFrame, table_name: str, batch_id, column: str = VIOLATIONS
) -> DataFrame:
    """Row-level quarantine: bad rows with their joined rule text."""
    payload = [c for c in annotated.columns if c != column]
    bad = annotated.filter(F.size(column) > 0)
    return quarantine_layout(bad, table_name, batch_id, payload, violated_rules_text(column))


def quarantine_whole_batch(df: DataFrame, table_name: str, batch_id) -> DataFrame:
    """Table-level failure: every row of the batch, one fixed label."""
    return quarantine_layout(df, table_name, batch_id, list(df.columns), F.lit(TABLE_LEVEL_ERROR))


def quarantine_lines(refused: DataFrame, table_name: str, batch_id) -> DataFrame:
    """Refused landing lines (label, raw) in the quarantine layout."""
    return refused.select(
        F.lit(table_name).alias("table_name"),
        F.lit(str(batch_id)).alias("gx_batch_id"),
        F.col("label").alias("violated_rules"),
        F.col("raw").alias("raw_data"),
        F.current_timestamp().alias("ingestion_time"),
    )


def rule_failure_counts(df: DataFrame, suite: Suite) -> DataFrame:
    """Per rule: failing rows and success flag, from a single aggregate.

    Table rules are answered from the schema (no job) and report 0 rows.
    Output: ``table_name, rule, n_failed, success``.
    """
    rules = suite.row_rules
    aggs = [F.count_if(r.failed()).alias(f"n{i}") for i, r in enumerate(rules)]
    counts = df.agg(*aggs) if aggs else df.sparkSession.range(1).select()
    entries = [
        F.struct(F.lit(r.label).alias("rule"), F.col(f"n{i}").cast("long").alias("n_failed"))
        for i, r in enumerate(rules)
    ]
    failed_tables = set(suite.table_failures(df.columns))
    entries += [
        F.struct(F.lit(t.label).alias("rule"), F.lit(0).cast("long").alias("n_failed"))
        for t in suite.table_rules
    ]
    long = counts.select(F.explode(F.array(*entries)).alias("e")).select("e.rule", "e.n_failed")
    return long.select(
        F.lit(suite.table).alias("table_name"),
        "rule",
        "n_failed",
        ((F.col("n_failed") == 0) & ~F.col("rule").isin(list(failed_tables) or [""])).alias("success"),
    )


def violations_long(annotated: DataFrame, keys: list[str], column: str = VIOLATIONS) -> DataFrame:
    """One row per (row, violated rule): ``keys..., rule_column, rule``.

    The label ``[col] rule`` is split back into its column (``Table`` for
    table rules) and rule type.
    """
    exploded = annotated.select(*keys, F.explode(column).alias("label"))
    return exploded.select(
        *keys,
        F.regexp_extract("label", r"^\[([^\]]*)\] ", 1).alias("rule_column"),
        F.regexp_extract("label", r"^\[[^\]]*\] (.*)$", 1).alias("rule"),
        F.col("label"),
    )


def violations_regroup(long: DataFrame, keys: list[str], label: str = "label") -> DataFrame:
    """Regroup the long form per row key into one ``"; "``-joined text.

    A group holds one entry per rule of the suite at most, so no group can
    grow with the data; the list is sorted so the text is deterministic.
    """
    return long.groupBy(*keys).agg(
        F.concat_ws("; ", F.array_sort(F.collect_list(label))).alias("violated_rules")
    )


def violations_join_back(df: DataFrame, regrouped: DataFrame, keys: list[str]) -> DataFrame:
    """All rows with their regrouped rule text, NULL for rows that broke none
    (left join on keys).

    Both sides are keyed by a unique row key, so the join is a plain
    sort-merge (or AQE-broadcast when the violation side turns out small).
    """
    return df.join(regrouped, on=keys, how="left")


def summarize_split(annotated: DataFrame, table_name: str, column: str = VIOLATIONS) -> DataFrame:
    """``table_name, n_input, n_good, n_quarantined`` in one aggregate."""
    bad = F.size(column) > 0
    return annotated.agg(
        F.count(F.lit(1)).alias("n_input"),
        F.count_if(~bad).alias("n_good"),
        F.count_if(bad).alias("n_quarantined"),
    ).select(F.lit(table_name).alias("table_name"), "n_input", "n_good", "n_quarantined")


def quarantine_by_rule(quarantine: DataFrame) -> DataFrame:
    """Failures per (table, batch, rule) from the quarantine's rule text.

    A row that broke two rules counts once for each.  Grouping keys are few
    (tables x batches x rules) and the aggregate is partial per task.
    """
    rules = quarantine.select(
        "table_name", "gx_batch_id", F.explode(F.split("violated_rules", "; ")).alias("rule")
    )
    return rules.groupBy("table_name", "gx_batch_id", "rule").agg(F.count(F.lit(1)).alias("n_rows"))
