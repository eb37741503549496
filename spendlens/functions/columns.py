"""Small column builders shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (NULL counts as 0)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def label_by(branches: list[tuple[str, Column]], default: str) -> Column:
    """Label of the first branch that holds, else the default."""
    (name, condition), *rest = branches
    label = F.when(condition, F.lit(name))
    for name, condition in rest:
        label = label.when(condition, F.lit(name))
    return label.otherwise(F.lit(default))


def flags_by(table: dict[str, str]) -> dict[str, Column]:
    """0/1 columns by name from a table of conditions."""
    return {name: flag(F.expr(condition)) for name, condition in table.items()}


def labels_by(table: dict[str, tuple[list[tuple[str, str]], str]]) -> dict[str, Column]:
    """Label columns by name from a table of (label, condition) lists."""
    return {name: label_by([(label, F.expr(condition)) for label, condition in branches], rest)
            for name, (branches, rest) in table.items()}


def tier_by(value: Column, bounds: list[tuple[str, float]], top: str) -> Column:
    """Name of the first tier whose exclusive upper bound exceeds the value.
    A NULL value has no tier."""
    return F.when(value.isNotNull(), label_by([(name, value < bound) for name, bound in bounds], top))


# Money is added up in whole ten-thousandths, up to this amount
MONEY_UNITS = 10_000
MOST_MONEY = 9e14
WIDE = "decimal(38,0)"


def typed_money(value: Column) -> Column:
    """A double as money: rounded to whole units. What is no number or beyond
    ``MOST_MONEY`` becomes NULL."""
    known = F.when(F.abs(value) <= MOST_MONEY, F.round(value * MONEY_UNITS, 0))
    return money(known.cast("long"))


def units(amount: Column | str) -> Column:
    """Money as a whole number of units; sums of these do not depend on the order."""
    return F.rint((F.col(amount) if isinstance(amount, str) else amount) * MONEY_UNITS).cast("long")


def money(count: Column) -> Column:
    """Units as money: one division, after all sums."""
    return count.cast("double") / F.lit(float(MONEY_UNITS))


def squared(count: Column) -> Column:
    """The exact square of units."""
    return count.cast("decimal(19,0)") * count.cast("decimal(19,0)")


def sum_money(amount: Column | str, over=None) -> Column:
    total = F.sum(units(amount))
    return money(total if over is None else total.over(over))


def sum_money_widely(amount: Column | str) -> Column:
    """The sum over a whole table, which may pass 64 bits."""
    return money(F.sum(units(amount).cast(WIDE)))


def mean_of(total: Column, count: Column) -> Column:
    return total / F.nullif(count, F.lit(0))


def spread(count: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from a count, a sum and a sum of squares of whole
    numbers: exact up to the one division and the root. NULL below two values."""
    wide = count.cast("decimal(20,0)")
    apart = (wide * squares - total.cast("decimal(19,0)") * total.cast("decimal(19,0)")).cast("double")
    n = count.cast("double")
    return F.when(count > 1, F.sqrt(apart / F.nullif(n * (n - 1), F.lit(0.0))))


def money_when(condition: Column, amount: str = "txn_amount") -> Column:
    """Sum of the amount over the rows where the condition holds, else 0.0."""
    return money(F.sum(F.when(condition, units(amount)).otherwise(F.lit(0))))


def share_of(part: Column, total: Column) -> Column:
    """part / total, and 0.0 unless the total is positive."""
    return F.when(total > 0, part / total).otherwise(F.lit(0.0))


def safe_div(part: Column, total: Column) -> Column:
    """part / total, and 0.0 when the total is NULL or zero."""
    return F.when(total.isNull() | (total == 0), F.lit(0.0)).otherwise(part / total)


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
