"""Declarative data-quality rules compiled to Spark column expressions.

A row rule yields a ``failed`` column that is never NULL (null-safe), so the
whole suite becomes one projection.  A table rule is checked against the
DataFrame's column list on the driver, which costs no job.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from strata.functions.strftime import compile_strftime, matches_strftime

# Rule type names and the table-level label, as they appear in
# the quarantine table's ``violated_rules`` text.
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
STRFTIME = "expect_column_values_to_match_strftime_format"
LENGTH = "expect_column_value_lengths_to_be_between"
COLUMN_SET = "expect_table_columns_to_match_set"
TABLE_LEVEL_ERROR = "Table-level Schema/Count Error"
TABLE_LABEL = "Table"


@dataclass(frozen=True)
class RowRule:
    """Base of row rules: ``failed()`` is a non-null boolean column."""

    column: str

    rule_type = ""

    @property
    def label(self) -> str:
        return f"[{self.column}] {self.rule_type}"

    def failed(self) -> Column:  # pragma: no cover - abstract
        raise NotImplementedError



@dataclass(frozen=True)
class NotNull(RowRule):
    rule_type = NOT_NULL

    def failed(self) -> Column:
        return F.col(self.column).isNull()



@dataclass(frozen=True)
class Between(RowRule):
    """Closed range; either bound may be omitted.  NULL values pass."""

    min_value: float | None = None
    max_value: float | None = None

    rule_type = BETWEEN

    def __post_init__(self) -> None:
        if self.min_value is None and self.max_value is None:
            raise ValueError("Between needs min_value or max_value")

    def failed(self) -> Column:
        c = F.col(self.column)
        if self.min_value is not None and self.max_value is not None:
            bad = ~c.between(self.min_value, self.max_value)
        elif self.min_value is not None:
            bad = c < self.min_value
        else:
            bad = c > self.max_value
        return F.coalesce(bad, F.lit(False))



@dataclass(frozen=True)
class MatchesStrftime(RowRule):
    """String parses under a C strftime pattern.  NULL values pass."""

    strftime_format: str = "%m/%d/%Y %H:%M"

    rule_type = STRFTIME

    def __post_init__(self) -> None:
        compile_strftime(self.strftime_format)  # reject bad patterns early

    def failed(self) -> Column:
        c = F.col(self.column)
        return c.isNotNull() & ~F.coalesce(matches_strftime(c, self.strftime_format), F.lit(False))



@dataclass(frozen=True)
class MaxLength(RowRule):
    """String of at most ``max_value`` characters.  NULL values pass."""

    max_value: int = 255

    rule_type = LENGTH

    def failed(self) -> Column:
        return F.coalesce(F.char_length(F.col(self.column)) > self.max_value, F.lit(False))


@dataclass(frozen=True)
class ColumnSet:
    """Table rule: the column names equal a set (any order) or include it."""

    columns: tuple[str, ...]
    exact_match: bool = True

    rule_type = COLUMN_SET
    column = TABLE_LABEL

    @property
    def label(self) -> str:
        return f"[{TABLE_LABEL}] {self.rule_type}"

    def check(self, actual: Iterable[str]) -> dict:
        actual_set, expected = set(actual), set(self.columns)
        missing = sorted(expected - actual_set)
        unexpected = sorted(actual_set - expected) if self.exact_match else []
        return {"success": not missing and not unexpected, "missing": missing, "unexpected": unexpected}


@dataclass(frozen=True)
class Suite:
    """Ordered rules of one table.  Row rules keep their order in labels."""

    table: str
    rules: tuple = field(default_factory=tuple)

    @property
    def name(self) -> str:
        return f"{self.table}_suite"

    @property
    def row_rules(self) -> Sequence[RowRule]:
        return [r for r in self.rules if isinstance(r, RowRule)]

    @property
    def table_rules(self) -> Sequence[ColumnSet]:
        return [r for r in self.rules if isinstance(r, ColumnSet)]

    def table_failures(self, columns: Iterable[str]) -> list[str]:
        cols = list(columns)
        return [r.label for r in self.table_rules if not r.check(cols)["success"]]

    def with_lengths(self, schema: StructType, max_value: int = 255) -> Suite:
        """The suite and, after its rules, a length rule for every string
        column that has none: what ``VARCHAR(n)`` would enforce, as a
        quarantine instead of a failed write."""
        have = {r.column.lower() for r in self.rules if isinstance(r, MaxLength)}
        strings = [f.name for f in schema.fields if isinstance(f.dataType, StringType) and f.name.lower() not in have]
        return replace(self, rules=(*self.rules, *(MaxLength(c, max_value) for c in strings)))

    def violations(self) -> Column:
        """``array<string>`` of the labels of the row rules a row breaks."""
        checks = [F.when(r.failed(), F.lit(r.label)) for r in self.row_rules]
        if not checks:
            return F.array().cast("array<string>")
        return F.array_compact(F.array(*checks))


_BUILDERS = {
    NOT_NULL: lambda kw: NotNull(kw["column"]),
    BETWEEN: lambda kw: Between(kw["column"], kw.get("min_value"), kw.get("max_value")),
    STRFTIME: lambda kw: MatchesStrftime(kw["column"], kw["strftime_format"]),
    LENGTH: lambda kw: MaxLength(kw["column"], kw["max_value"]),
    COLUMN_SET: lambda kw: ColumnSet(tuple(kw["column_set"]), kw.get("exact_match", True)),
}


def suite_from_spec(table: str, expectations: list[dict]) -> Suite:
    """Build a suite from expectation definitions in the common serialized
    form ``{"type": <rule type>, "kwargs": {...}}`` (e.g. loaded from JSON).

    Unknown rule types raise when the suite is built, never mid-stream.
    """
    rules = []
    for exp in expectations:
        kind = exp.get("type") or exp.get("expectation_type")
        if kind not in _BUILDERS:
            raise ValueError(f"unsupported rule type {kind!r}; supported: {sorted(_BUILDERS)}")
        rules.append(_BUILDERS[kind](exp.get("kwargs", {})))
    return Suite(table, tuple(rules))


def suite_to_spec(suite: Suite) -> list[dict]:
    """The inverse of ``suite_from_spec``."""
    out = []
    for r in suite.rules:
        if isinstance(r, NotNull):
            kw = {"column": r.column}
        elif isinstance(r, Between):
            kw = {"column": r.column, "min_value": r.min_value, "max_value": r.max_value}
            kw = {k: v for k, v in kw.items() if v is not None}
        elif isinstance(r, MaxLength):
            kw = {"column": r.column, "max_value": r.max_value}
        elif isinstance(r, MatchesStrftime):
            kw = {"column": r.column, "strftime_format": r.strftime_format}
        else:
            kw = {"column_set": list(r.columns), "exact_match": r.exact_match}
        out.append({"type": r.rule_type, "kwargs": kw})
    return out
