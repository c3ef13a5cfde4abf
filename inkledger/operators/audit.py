"""Checks the database would have enforced, and arithmetic checks, over whole tables."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkledger import model as M


def _finding(df: DataFrame, rule: str, table: str, column: str) -> DataFrame:
    """(rule, table, column, violations) from a frame with one ``violations`` value."""
    return df.select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
                     F.lit(column).alias("column_name"),
                     F.coalesce(F.col("violations"), F.lit(0)).cast("bigint").alias("violations"))


def _scan_rules(table: str, df: DataFrame) -> list[tuple[str, str, object]]:
    """(rule, column, condition) for everything one pass over the table can tell."""
    required = (M.PRIMARY_KEY[table], *M.NOT_NULL.get(table, ()))
    rules = [("not_null", c, F.col(c).isNull()) for c in required if c in df.columns]
    rules += [("max_length", c, F.length(F.col(c)) > n)
              for c, n in M.MAX_LENGTH.get(table, {}).items() if c in df.columns]
    for field in M.AUDITED[table].fields:
        if isinstance(field.dataType, T.DecimalType) and field.dataType.scale == 2 and field.name in df.columns:
            bound = 10 ** (field.dataType.precision - field.dataType.scale)
            # stored tables cannot break it; tables read under wider types can
            rules.append(("precision", field.name, F.abs(F.round(F.col(field.name), 2)) >= bound))
    return rules


def audit_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Not-null, length and precision violations: one scan and one aggregate per table."""
    parts = []
    for table, df in tables.items():
        rules = _scan_rules(table, df)
        if not rules:
            continue
        counted = df.agg(*[F.count_if(cond).alias(f"v{i}") for i, (_, _, cond) in enumerate(rules)])
        rows = F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
                                  F.lit(column).alias("column_name"), F.col(f"v{i}").alias("violations"))
                         for i, (rule, column, _) in enumerate(rules)])
        parts.append(counted.select(F.inline(rows)))
    return reduce(DataFrame.union, parts)


def _keys(tables: Mapping[str, DataFrame], referred: Collection[str] = ()) -> list[DataFrame]:
    """Findings of each primary key and unique column, but for the primary keys of ``referred``."""
    parts = []
    for table, df in tables.items():
        for column in (M.PRIMARY_KEY[table], *M.UNIQUE.get(table, ())):
            if column not in df.columns or table in referred and column == M.PRIMARY_KEY[table]:
                continue
            counts = tables[table].filter(F.col(column).isNotNull()).groupBy(column).agg(
                F.count(F.lit(1)).alias("n"))
            parts.append(_finding(counts.agg(F.count_if(F.col("n") > 1).alias("violations")),
                                  "unique", table, column))
    return parts


def audit_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Values that occur more than once in a primary key or unique column, counted per column."""
    return reduce(DataFrame.union, _keys(tables))


def _references(tables: Mapping[str, DataFrame], target: str) -> list[tuple[str, str]]:
    """(table, column) of what refers to a table's primary key."""
    return [(table, column) for table, column, to in M.FOREIGN_KEYS if to == target and table in tables and target in tables]


def _audit_target(tables: Mapping[str, DataFrame], target: str, unique: bool) -> DataFrame:
    """References to a table's primary key that have no target, and (``unique``) keys that occur more than once.

    Keys and all references to them are counted per value in one aggregation: a value most rows share is a row a
    task, and no side is broadcast, whose packed files would say little of its rows.
    """
    key, users = M.PRIMARY_KEY[target], _references(tables, target)
    sides = [(target, key), *users]
    rows = [tables[table].select(F.col(column).alias("value"), *[F.lit(int(i == k)).cast("bigint").alias(f"n{k}") for k in range(len(sides))])
            for i, (table, column) in enumerate(sides)]
    counts = reduce(DataFrame.unionAll, rows).filter(F.col("value").isNotNull()).groupBy("value").agg(*[F.sum(f"n{k}").alias(f"n{k}") for k in range(len(sides))])
    rules = [("unique", target, key, F.count_if(F.col("n0") > 1))] if unique else []
    rules += [("foreign_key", table, column, F.sum(F.when(F.col("n0") == 0, F.col(f"n{k}")))) for k, (table, column) in enumerate(users, 1)]
    found = counts.agg(*[F.coalesce(rule[-1], F.lit(0)).cast("bigint").alias(f"v{i}") for i, rule in enumerate(rules)])
    return found.select(F.inline(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.col(f"v{i}").alias("violations"))
        for i, (rule, table, column, _) in enumerate(rules)])))


def audit_foreign_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows whose reference has no target."""
    return reduce(DataFrame.union, [_audit_target(tables, target, False) for target in tables if _references(tables, target)])


def constraint_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All rules; a key that others refer to is looked at once, with them."""
    targets = [t for t in tables if _references(tables, t)]
    parts = [_audit_target(tables, target, True) for target in targets]
    return reduce(DataFrame.union, [audit_columns(tables), *_keys(tables, targets), *parts])


def line_totals(lines: DataFrame) -> DataFrame:
    """Sum of line amounts per invoice."""
    return lines.groupBy("invoice_id").agg(F.sum("amount").cast("decimal(38,2)").alias("line_total"),
                                           F.count(F.lit(1)).alias("line_count"))


def reconcile_totals(invoices: DataFrame, lines: DataFrame, tolerance: str = "0.02") -> DataFrame:
    """Per invoice: do the lines add up to the subtotal, and the subtotal to the total."""
    def wide(name: str):
        return F.coalesce(F.col(name), F.lit(0)).cast("decimal(18,2)")

    expected = wide("subtotal") - wide("discount") + wide("tax_amount")
    limit = F.lit(tolerance).cast("decimal(12,2)")
    return (invoices.select("invoice_id", "invoice_number", "subtotal", "discount", "tax_amount", "total_amount")
            .join(line_totals(lines), "invoice_id", "left")
            .select("invoice_id", "invoice_number", "subtotal", "total_amount",
                    F.coalesce("line_total", F.lit(0)).cast("decimal(38,2)").alias("line_total"),
                    expected.cast("decimal(38,2)").alias("expected_total"),
                    (F.abs(F.coalesce("line_total", F.lit(0)) - wide("subtotal")) <= limit).alias("lines_match"),
                    (F.abs(expected - F.col("total_amount")) <= limit).alias("total_matches")))
