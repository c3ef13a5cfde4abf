"""Display forms of money, dates and status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fmt_money(amount: Column, digits: int = 2) -> Column:
    """$1,234.56; a missing amount shows as 0.  Decimals are shown from their own digits, not through a double."""
    return F.concat(F.lit("$"), F.format_number(F.coalesce(amount, F.lit(0)), digits))


def month_label(month: Column) -> Column:
    return F.coalesce(F.date_format(month, "MMMM yyyy"), F.lit("Unknown"))


def fmt_ts(ts: Column, seconds: bool = False) -> Column:
    pattern = "yyyy-MM-dd HH:mm:ss" if seconds else "yyyy-MM-dd HH:mm"
    return F.coalesce(F.date_format(ts, pattern), F.lit("N/A"))


def fmt_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def status_label(status: Column) -> Column:
    return F.upper(status)


def status_class(status: Column) -> Column:
    """Approved and failed have a class of their own; every other status shows as pending."""
    own = status.isin("approved", "failed")
    return F.when(own, F.concat(F.lit("status-"), status)).otherwise(F.lit("status-pending"))


def pct_of_max(report: DataFrame, column: str, out: str = "width_pct") -> DataFrame:
    """Percentage of the column's maximum, 0 where the maximum is not positive.

    For report rows (months, statuses): the window puts all of them into one partition,
    which costs less than aggregating the table again for its maximum.
    """
    top = F.max(column).over(Window.partitionBy(F.lit(1))).cast("double")
    share = F.col(column).cast("double") / top * 100
    return report.withColumn(out, F.when(top > 0, share).otherwise(F.lit(0.0)))


def shown(value: Column) -> Column:
    """A value inside a message; missing reads None."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def line_display(df: DataFrame) -> DataFrame:
    """'description: quantity x $price = $amount' per line."""
    return df.withColumn("display", F.concat(
        F.col("description"), F.lit(": "), shown(F.col("quantity")), F.lit(" x "),
        fmt_money(F.col("unit_price")), F.lit(" = "), fmt_money(F.col("amount"))))
