"""Declarative data-quality checks evaluated as Spark aggregations.

A check names a model, a column and what must hold; its result is the number of failing
rows (for ``unique`` and ``accepted_values``: of failing values). Models that are stages of
the same row stream share one relation: each model is a weight column that says how often a
row occurs in it (0, 1, or more when a join fans out). The checks of all these models then
share their passes over the relation.

Ids are nearly always unique, so ``unique`` on a text column looks for repeated 64-bit hashes first: the
shuffle moves hashes, not ids. Only rows whose hash repeats are grouped by the id itself, which settles the
number exactly; clean data has next to none of them. All row-level checks are observed in the same scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tripmart import workspace

REPORT = "model string, column_name string, check_name string, failures long"

# Kinds that look at all rows of a value together; the others judge row by row.
_ON_VALUES = ("unique", "accepted_values")


@dataclass(frozen=True, eq=False)
class Check:
    model: str
    kind: str
    columns: tuple[str, ...]
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    inclusive: bool = True
    only_if: Column | None = None

    @property
    def name(self) -> tuple[str, str, str]:
        return self.model, self.column_name, self.kind

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)


def not_null(model: str, column: str) -> Check:
    return Check(model, "not_null", (column,))


def unique(model: str, *columns: str) -> Check:
    return Check(model, "unique", columns)


def accepted_values(model: str, column: str, *values) -> Check:
    return Check(model, "accepted_values", (column,), values=values)


def accepted_range(
    model: str,
    column: str,
    low: float | None = None,
    high: float | None = None,
    inclusive: bool = True,
    only_if: Column | None = None,
) -> Check:
    return Check(
        model, "accepted_range", (column,), low=low, high=high, inclusive=inclusive,
        only_if=only_if,
    )


def _broken(check: Check) -> Column:
    """Row-level failure of a check; nulls pass everything but ``not_null``."""
    column = F.col(check.columns[0])
    if check.kind == "not_null":
        return column.isNull()
    if check.kind == "accepted_values":
        return F.coalesce(~column.isin(*check.values), F.lit(False))
    too_low = too_high = F.lit(False)
    if check.low is not None:
        too_low = column < check.low if check.inclusive else column <= check.low
    if check.high is not None:
        too_high = column > check.high if check.inclusive else column >= check.high
    broken = F.coalesce(too_low | too_high, F.lit(False))
    if check.only_if is None:
        return broken
    return F.coalesce(check.only_if, F.lit(False)) & broken


def _stacked(totals: DataFrame, lines: list[tuple], titles: str) -> DataFrame:
    """Turn one row of counters ``_0, _1, ...`` into one row per line of literals."""

    def literal(value: str | None) -> str:
        return "cast(null as string)" if value is None else f"'{value}'"

    cells = (
        ", ".join([*map(literal, line), f"cast(coalesce(_{i}, 0) as bigint)"])
        for i, line in enumerate(lines)
    )
    return totals.selectExpr(f"stack({len(lines)}, {', '.join(cells)}) as ({titles})")


def _as_rows(totals: DataFrame, checks: list[Check]) -> DataFrame:
    lines = [(check.model, check.column_name, check.kind) for check in checks]
    return _stacked(totals, lines, "model, column_name, check_name, failures")


def _failing_weight(check: Check, weights: Mapping[str, Column]) -> Column:
    return F.sum(F.when(_broken(check), weights[check.model]).otherwise(F.lit(0)))


def _row_pass(
    frame: DataFrame, weights: Mapping[str, Column], checks: list[Check]
) -> DataFrame:
    counters = (_failing_weight(c, weights).alias(f"_{i}") for i, c in enumerate(checks))
    return _as_rows(frame.agg(*counters), checks)


def _value_pass(
    frame: DataFrame, weights: Mapping[str, Column], columns: tuple[str, ...],
    checks: list[Check],
) -> DataFrame:
    """Checks that compare the values of some column(s), and others that ride along.

    Rows are combined per value before the shuffle, so one value that holds a large share
    of the rows is no hot spot.
    """
    on_values = [c for c in checks if c.kind in _ON_VALUES]
    on_rows = [c for c in checks if c.kind not in _ON_VALUES]
    models = list(dict.fromkeys(check.model for check in on_values))
    values = frame.groupBy(*columns).agg(
        *(F.sum(weights[m]).alias(f"_in_{m}") for m in models),
        *(_failing_weight(c, weights).alias(f"_row_{i}") for i, c in enumerate(on_rows)),
    )
    filled = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))

    def fails(check: Check) -> Column:
        rows = F.col(f"_in_{check.model}")
        if check.kind == "unique":
            return filled & (rows > 1)
        return filled & (rows > 0) & ~F.col(columns[0]).isin(*check.values)

    counters = [F.count_if(fails(check)) for check in on_values]
    counters += [F.sum(f"_row_{i}") for i in range(len(on_rows))]
    totals = values.agg(*(c.alias(f"_{i}") for i, c in enumerate(counters)))
    return _as_rows(totals, on_values + on_rows)


def lines_of(spark: SparkSession, failures: Mapping[Check, int]) -> DataFrame:
    """Report rows of checks whose failures are known."""
    rows = [(check.model, check.column_name, check.kind, n) for check, n in failures.items()]
    return spark.createDataFrame(rows, REPORT)


class Watched:
    """A relation whose row-level checks are counted while something else reads or writes it.

    ``frame`` is what to run the action on; ``failing`` then has the failing rows of each check (of
    ``accepted_values`` too, where the report counts values: none if there are no such rows).
    """

    def __init__(self, frame: DataFrame, checks: Iterable[Check], weights: Mapping[str, Column] | None = None):
        self.checks = list(checks)
        weights = weights or {check.model: F.lit(1) for check in self.checks}
        self._seen = Observation()
        counters = [_failing_weight(c, weights).alias(f"_{i}") for i, c in enumerate(self.checks)]
        self.frame = frame.observe(self._seen, F.count(F.lit(1)).alias("_rows"), *counters)

    def failing(self) -> dict[Check, int]:
        """Waits for the action."""
        try:
            seen = self._seen.get
        except Py4JJavaError as error:
            # A relation that the optimizer knows to be empty is folded away, and what it counts with it.
            if "assertion failed" not in str(error):
                raise
            seen = {}
        return {check: seen.get(f"_{i}") or 0 for i, check in enumerate(self.checks)}


def _hash_pass(
    frame: DataFrame, weights: Mapping[str, Column], columns: tuple[str, ...], checks: list[Check]
) -> DataFrame:
    """``unique`` checks of one set of columns, and all others that look at rows, in one scan.

    Runs at once: what has to be counted exactly depends on what the scan finds.
    """
    spark = frame.sparkSession
    on_ids = [c for c in checks if c.kind == "unique"]
    watched = Watched(frame, [c for c in checks if c.kind != "unique"], weights)
    models = list(dict.fromkeys(check.model for check in on_ids))
    # A row counts as often as in the model that has it most often, so that no model's repeats are missed.
    times = F.greatest(*(weights[m] for m in models)) if len(models) > 1 else weights[models[0]]
    filled = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))
    hashed = watched.frame.select(
        F.when(filled, F.xxhash64(*columns)).alias("_hash"), times.cast("bigint").alias("_times")
    )
    counted = hashed.where(F.col("_hash").isNotNull()).groupBy("_hash").agg(F.sum("_times").alias("_times"))
    path = workspace.fresh_path(spark, "repeated-hashes")
    counted.where(F.col("_times") > 1).select("_hash").write.parquet(path)
    repeated = spark.read.schema("_hash long").parquet(path)

    failing = watched.failing()
    exact = []
    if repeated.isEmpty():
        workspace.remove(spark, path)
        failing |= dict.fromkeys(on_ids, 0)
    else:
        rows = frame.withColumn("_hash", F.xxhash64(*columns)).join(repeated, "_hash", "left_semi")
        exact.append(_value_pass(rows, weights, columns, on_ids))
    for check in [c for c in watched.checks if c.kind == "accepted_values" and failing[c]]:
        del failing[check]
        exact.append(_value_pass(frame, weights, check.columns, [check]))
    parts = [lines_of(spark, failing)] if failing else []
    return reduce(DataFrame.unionByName, [*parts, *exact])


def run_checks(
    frame: DataFrame,
    checks: Iterable[Check],
    weights: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Report rows of the checks of one relation.

    A text column under ``unique`` takes all checks of rows along in its pass, which runs at once. Else each
    distinct set of columns under ``unique`` or ``accepted_values`` takes one pass; row-level checks
    join the pass of their own column, else one over a list of accepted values, which has few
    groups; only without such a pass do they take their own.
    """
    checks = list(checks)
    if weights is None:
        weights = {check.model: F.lit(1) for check in checks}
    kinds = dict(zip(frame.columns, (f.dataType for f in frame.schema.fields), strict=True))
    texts = [
        c.columns
        for c in checks
        if c.kind == "unique" and len(c.columns) == 1 and isinstance(kinds[c.columns[0]], StringType)
    ]
    parts = []
    if texts:
        along = [c for c in checks if c.kind != "unique" or c.columns == texts[0]]
        parts.append(_hash_pass(frame, weights, texts[0], along))
        checks = [c for c in checks if all(c is not a for a in along)]
    passes: dict[tuple[str, ...], list[Check]] = {}
    for check in checks:
        if check.kind in _ON_VALUES:
            passes.setdefault(check.columns, []).append(check)
    few_groups = [c.columns for c in checks if c.kind == "accepted_values"]
    alone = []
    for check in checks:
        if check.kind in _ON_VALUES:
            continue
        if check.kind == "not_null" and check.columns in passes:
            passes[check.columns].append(check)
        elif few_groups:
            passes[few_groups[0]].append(check)
        else:
            alone.append(check)
    parts += [_value_pass(frame, weights, columns, group) for columns, group in passes.items()]
    if alone:
        parts.append(_row_pass(frame, weights, alone))
    return reduce(DataFrame.unionByName, parts)


def missing_references(
    fact: DataFrame, dimension: DataFrame, key: str
) -> DataFrame:
    """Fact keys without a dimension row, with the number of fact rows that use them."""
    return (
        fact.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("fact_rows"))
        .join(dimension.select(key), key, "left_anti")
    )


def reference_check(
    fact: DataFrame, dimension: DataFrame, key: str, model: str
) -> DataFrame:
    """Report row: fact rows whose key is absent from the dimension."""
    check = Check(model, "relationships", (key,))
    missing = missing_references(fact, dimension, key)
    return _as_rows(missing.agg(F.sum("fact_rows").alias("_0")), [check])


def contract_profile(
    frame: DataFrame,
    models: Mapping[str, tuple[StructType, StructType]],
    weights: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per model column: expected and actual type and the number of filled rows.

    ``models`` gives contract and actual schema of the models whose rows are in ``frame``.
    Columns that are missing, unexpected or of another type show in ``status``.
    """
    lines, counters = [], []
    for model, (contract, schema) in models.items():
        expected = {f.name: f.dataType.simpleString() for f in contract.fields}
        actual = {f.name: f.dataType.simpleString() for f in schema.fields}
        weight = weights[model] if weights else F.lit(1)
        for name in dict.fromkeys([*expected, *actual]):
            filled = F.lit(0)
            if name in actual:
                filled = F.when(F.col(name).isNotNull(), weight).otherwise(F.lit(0))
            counters.append(F.sum(filled).alias(f"_{len(counters)}"))
            status = "ok"
            if name not in actual or name not in expected:
                status = "unexpected" if name in actual else "missing"
            elif actual[name] != expected[name]:
                status = "type differs"
            lines.append((model, name, expected.get(name), actual.get(name), status))
    titles = "model, column_name, expected_type, actual_type, status, filled_rows"
    return _stacked(frame.agg(*counters), lines, titles)
