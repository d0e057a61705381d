"""Declarative checks and their runner.

Row-level checks of a table are fused into aggregate passes over it (one
counter per check); other checks run as their own query.  What has to be computed
for many of them is stored first.  The result is one row per check, computed
lazily: nothing but that small table ever leaves the executors.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import at_once, is_scan, stage
from . import checks as C

COUNTERS_PER_PASS = 200
PASSES_UNSTORED = 2   # a computed table that is read more often is stored first

ROW_CHECKS = {
    "not_null": lambda column: C.null_row(column),
    "accepted_values": lambda column, values: C.outside_values(column, values),
    "not_accepted_values": lambda column, values: C.inside_values(column, values),
    "accepted_range": lambda column, **kw: C.outside_range(column, **kw),
    "expression_is_true": lambda column=None, **kw: C.expression_false(column=column, **kw),
    "not_empty_string": lambda column, **kw: C.blank_text(column, **kw),
    "assert_equal": lambda actual, expected: C.unequal(actual, expected),
}
# these count distinct values, not rows
VALUE_CHECKS = {"accepted_values", "not_accepted_values"}

# tables a parameter may name
TABLE_PARAMETERS = ("parent", "b")

SET_CHECKS = {
    "accepted_values": C.accepted_values, "not_accepted_values": C.not_accepted_values,
    "unique": C.unique, "unique_combination": C.unique_combination, "relationships": C.relationships,
    "at_least_one": C.at_least_one, "not_constant": C.not_constant, "not_null_proportion": C.not_null_proportion,
    "recency": C.recency, "cardinality_equality": C.cardinality_equality, "equal_rowcount": C.equal_rowcount,
    "fewer_rows_than": C.fewer_rows_than, "equality": C.equality,
    "mutually_exclusive_ranges": C.mutually_exclusive_ranges, "sequential_values": C.sequential_values,
    "columns_match": C.columns_match,
}

# metric of a check when it is not the number of failing rows
METRICS = {
    "equal_rowcount": "coalesce(sum(coalesce(diff_count, 0)), 0)",
    "fewer_rows_than": "coalesce(sum(coalesce(row_count_delta, 0)), 0)",
    "equality": "count(*) + coalesce(abs(count_if(which_diff = 'a_minus_b') - count_if(which_diff = 'b_minus_a')), 0)",
}


@dataclass(frozen=True)
class Check:
    """One check of one table.

    ``error_if`` / ``warn_if`` are comparisons on the metric (such as '> 0');
    severity 'warn' turns errors into warnings; ``where`` filters the rows that
    are checked; ``fail_calc`` replaces the metric.
    """

    table: str
    kind: str
    params: dict = field(default_factory=dict)
    severity: str = "error"
    error_if: str = "!= 0"
    warn_if: str = "!= 0"
    where: str | None = None
    fail_calc: str | None = None

    @property
    def name(self) -> str:
        p = self.params
        what = p.get("column") or p.get("columns") or p.get("expression") or p.get("field") or ""
        what = "_".join(what) if isinstance(what, (list, tuple)) else what
        groups = p.get("group_by")
        return "_".join(str(x) for x in (self.kind, self.table, what, *(groups or [])) if x)

    @property
    def fused(self) -> bool:
        return self.kind in ROW_CHECKS and self.kind not in VALUE_CHECKS and self.fail_calc is None


def failing_rows(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    """The rows a check reports."""
    df = tables[check.table]
    df = df.where(check.where) if check.where else df
    if check.kind in ROW_CHECKS and check.kind not in VALUE_CHECKS:
        return df.where(ROW_CHECKS[check.kind](**check.params))
    named = {k: tables[v] if k in TABLE_PARAMETERS and isinstance(v, str) else v for k, v in check.params.items()}
    return SET_CHECKS[check.kind](df, **named)


def _result(check: Check, failures: Column) -> list[Column]:
    return [F.lit(check.name).alias("check_name"), F.lit(check.table).alias("table_name"),
            F.lit(check.kind).alias("kind"), F.lit(check.severity).alias("severity"), failures.alias("failures")]


def _counter(check: Check) -> Column:
    bad = ROW_CHECKS[check.kind](**check.params)
    if check.where:
        bad = bad & C.true_only(F.expr(check.where))
    return F.count_if(bad)


def _fused(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One pass over a table, one output row per check."""
    counted = df.agg(*[_counter(c).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = [F.struct(*_result(c, F.col(f"c{i}")), _status(c, F.col(f"c{i}"))) for i, c in enumerate(checks)]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _status(check: Check, failures: Column) -> Column:
    def holds(rule: str) -> Column:
        op, bound = _parse(rule)
        return {"<": failures < bound, "<=": failures <= bound, ">": failures > bound, ">=": failures >= bound,
                "=": failures == bound, "!=": failures != bound}[op]

    if check.severity == "warn":
        status = F.when(holds(check.warn_if), "warn")
    else:
        status = F.when(holds(check.error_if), "error").when(holds(check.warn_if), "warn")
    return status.otherwise("pass").alias("status")


def _parse(rule: str) -> tuple[str, int]:
    text = rule.strip().replace("<>", "!=").replace("==", "=")
    op = next(o for o in ("<=", ">=", "!=", "<", ">", "=") if text.startswith(o))
    return op, int(text[len(op):])


def _fused_values(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Distinct offending values of many columns in one pass.

    Good rows emit nothing; offending (check, value) pairs are combined
    map-side before they are counted.
    """
    offending = []
    for c in checks:
        bad = ROW_CHECKS[c.kind](**c.params)
        if c.where:
            bad = bad & C.true_only(F.expr(c.where))
        offending.append(F.when(bad, F.col(c.params["column"]).cast("string")))
    pairs = df.select(F.posexplode(F.array(*offending)).alias("i", "v")).where(F.col("v").isNotNull()).distinct()
    counted = pairs.agg(*[F.count_if(F.col("i") == i).alias(f"c{i}") for i in range(len(checks))])
    rows = [F.struct(*_result(c, F.col(f"c{i}")), _status(c, F.col(f"c{i}"))) for i, c in enumerate(checks)]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _single(check: Check, tables: dict[str, DataFrame]) -> DataFrame:
    metric = check.fail_calc or METRICS.get(check.kind, "count(*)")
    one = failing_rows(check, tables).agg(F.expr(metric).cast("bigint").alias("failures"))
    return one.select(*_result(check, F.col("failures")), _status(check, F.col("failures")))


def _passes(checks: list[Check]) -> Counter:
    """How often each table is read: once for all its fused checks of a kind, once for every other check and as its parent."""
    fused = {(c.table, c.kind in VALUE_CHECKS) for c in checks if c.fail_calc is None and c.kind in ROW_CHECKS}
    single = [c for c in checks if c.fail_calc is not None or c.kind not in ROW_CHECKS]
    return Counter([t for t, _ in fused] + [c.table for c in single] + [other for c in checks for other in _others(c)])


def _others(check: Check) -> list[str]:
    return [v for k, v in check.params.items() if k in TABLE_PARAMETERS and isinstance(v, str)]


def _columns(table: str, checks: list[Check]) -> set[str] | None:
    """Columns that the checks of a table read; None when an expression or a comparison may read any."""
    read: set[str] = set()
    for c in checks:
        if c.table == table:
            if c.where or c.fail_calc or set(c.params) - {"column", "columns", "values", "min_value", "max_value", "inclusive", "parent", "field"}:
                return None
            read |= {*([c.params["column"]] if "column" in c.params else []), *c.params.get("columns", [])}
        if table in _others(c):
            if c.kind != "relationships":
                return None
            read.add(c.params["field"])
    return read


def _stored(tables: dict[str, DataFrame], checks: list[Check]) -> dict[str, DataFrame]:
    """The tables, with those that are computed and read in many passes stored: the columns that the checks read."""
    often = [t for t, n in _passes(checks).items() if n > PASSES_UNSTORED and not is_scan(tables[t])]
    if not often:
        return tables

    def store(name: str) -> DataFrame:
        columns, df = _columns(name, checks), tables[name]
        return stage(df.select(*sorted(columns)) if columns and columns <= set(df.columns) else df, "checked")

    return {**tables, **dict(zip(often, at_once(tables[often[0]].sparkSession, *(partial(store, t) for t in often)), strict=True))}


def run(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """(check_name, table_name, kind, severity, failures, status), one row per check."""
    passes: dict[tuple, list[Check]] = defaultdict(list)
    tables, parts = _stored(tables, checks), []
    for c in checks:
        if c.fused:
            passes[c.table, _fused].append(c)
        elif c.kind in VALUE_CHECKS and c.fail_calc is None:
            passes[c.table, _fused_values].append(c)
        else:
            parts.append(_single(c, tables))
    for (table, fuse), group in passes.items():
        for at in range(0, len(group), COUNTERS_PER_PASS):
            parts.append(fuse(tables[table], group[at:at + COUNTERS_PER_PASS]))
    return reduce(DataFrame.unionByName, parts)


def store_failures(check: Check, tables: dict[str, DataFrame], path: str) -> DataFrame:
    """Write a check's failing rows below ``path`` and return them."""
    target = f"{path}/{check.name}"
    failing_rows(check, tables).write.mode("overwrite").parquet(target)
    return tables[check.table].sparkSession.read.parquet(target)


def assert_passed(spark: SparkSession, results: DataFrame) -> None:
    """Raise when a check ended in error."""
    bad = [f"{r.check_name}: {r.failures}" for r in results.where("status = 'error'").collect()]
    if bad:
        raise AssertionError("; ".join(bad))
