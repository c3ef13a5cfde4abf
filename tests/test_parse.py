import datetime as dt
import random
from decimal import Decimal

from pyspark.sql import functions as F

from inkledger.functions.parse import (
    invoice_code, job_id_from_arn, job_id_from_key, stable_id, to_date, to_decimal, to_double,
)


def column(spark, values, expr):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(expr).collect()]


def test_numbers(spark):
    texts = ["12", " 1.5 ", "1_000", "1e3", ".5", "5.", "-2", "1,000", "$5", "100d", "N/A", "", None, "nan", "inf", "1__0"]
    expected = [12, 1.5, 1000, 1000, .5, 5, -2] + [None] * 9
    assert column(spark, texts, to_double("v")) == expected


def test_numbers_agree_with_float_on_random_texts(spark):
    draw = random.Random(11)
    texts = {"".join(draw.choice("0123456789..__eE+- ") for _ in range(draw.randrange(1, 8))) for _ in range(4000)}
    texts = sorted(texts | {" 1 ", "1e5", "1_0.0_1", "1e1_0", "._1", "1._0", "+.5E-3"})

    def python(text):
        try:
            return float(text)
        except ValueError:
            return None

    assert dict(zip(texts, column(spark, texts, to_double("v")))) == {t: python(t) for t in texts}


def test_decimals_round_half_away_from_zero(spark):
    texts = ["0.005", "-0.005", "2.675", "9999999999.99", "9999999999.995", "10000000000"]
    assert column(spark, texts, to_decimal("v")) == [
        Decimal("0.01"), Decimal("-0.01"), Decimal("2.68"), Decimal("9999999999.99"), None, None]


DATES = [
    ("2025-11-05", dt.date(2025, 11, 5)), ("2025-1-2", dt.date(2025, 1, 2)),
    ("2025-11-05T10:00:00", dt.date(2025, 11, 5)), ("2025/11/05", dt.date(2025, 11, 5)),
    ("20251105", dt.date(2025, 11, 5)), ("11/05/2025", dt.date(2025, 11, 5)),
    ("1-2-2025", dt.date(2025, 1, 2)), ("Nov 20, 2025", dt.date(2025, 11, 20)),
    ("November 2 2025", dt.date(2025, 11, 2)), ("20 nov 2025", dt.date(2025, 11, 20)),
    ("5-September-2025", dt.date(2025, 9, 5)), (" 2025-11-05 ", dt.date(2025, 11, 5)),
    ("", None), ("2025", None), ("2025-11", None), ("2025-13-01", None), ("13/13/2025", None),
    ("Novembre 2, 2025", None), ("soon", None), (None, None),
    ("11/15/25", dt.date(2025, 11, 15)), ("1/2/70", dt.date(1970, 1, 2)), ("1/2/69", dt.date(2069, 1, 2)),
    ("15-Nov-25", dt.date(2025, 11, 15)), ("Nov-15-25", dt.date(2025, 11, 15)), ("2025-Nov-15", dt.date(2025, 11, 15)),
    ("Nov-15-2025", dt.date(2025, 11, 15)), ("Saturday, November 15, 2025", dt.date(2025, 11, 15)),
    ("Sat 15 Nov 2025", dt.date(2025, 11, 15)), ("990108", dt.date(1999, 1, 8)), ("2025.319", dt.date(2025, 11, 15)),
    ("2024.366", dt.date(2024, 12, 31)), ("2025.366", None), ("2025.000", None), ("J2460995", dt.date(2025, 11, 15)),
    ("2025-11-05 10:00:00.5+02", dt.date(2025, 11, 5)), ("2025-11-05T10:00Z", dt.date(2025, 11, 5)),
    ("2025-11-15 garbage", None), ("2025-11-15Tzzz", None), ("2025-11-15T", None), ("11/15/25 x", None), ("Saturday", None),
    ("2025.11.15", dt.date(2025, 11, 15)), ("11.15.2025", dt.date(2025, 11, 15)), ("Nov/15/2025", dt.date(2025, 11, 15)),
    ("20251115T101112", dt.date(2025, 11, 15)), ("11/15/2025 10:00", dt.date(2025, 11, 15)),
    ("November 15, 2025 10:30 AM", dt.date(2025, 11, 15)), ("15nov2025", dt.date(2025, 11, 15)), ("2025 Nov 15", dt.date(2025, 11, 15)),
    ("Nov. 15, 2025", dt.date(2025, 11, 15)), ("10:00 2025/11/15", dt.date(2025, 11, 15)), ("10:15 PM Nov 15 2025", dt.date(2025, 11, 15)),
    ("15 Nov 2025 23:59:59.999 UTC", dt.date(2025, 11, 15)), ("Nov 15 2025 10:00 +05:30", dt.date(2025, 11, 15)), ("11/15/2025T10:00Z", dt.date(2025, 11, 15)),
    ("20251115t1011z", dt.date(2025, 11, 15)), ("2025319", dt.date(2025, 11, 15)), ("Saturday 2025-11-15", dt.date(2025, 11, 15)),
    ("2025-11-15 Sat", dt.date(2025, 11, 15)), ("15.Nov.2025", dt.date(2025, 11, 15)), ("2025/Nov/15", dt.date(2025, 11, 15)), ("5 may 70", dt.date(1970, 5, 5)),
    ("2025 11 15", dt.date(2025, 11, 15)), ("1/2/5", dt.date(2005, 1, 2)), ("2024-02-29", dt.date(2024, 2, 29)), ("29 Feb 2024", dt.date(2024, 2, 29)),
    ("29 Feb 2025", None), ("Feb 30 2025", None), ("2025-11/15", None), ("2025 - 11 - 15", None), ("11/15/2025 25:00", None), ("2025-11-15 10:60", None),
    ("Nov 15 2025 13:00 PM", None), ("20251115T251112", None), ("2025111", dt.date(2025, 4, 21)), ("20251", None), ("Nov 2025", None), ("15 2025", None), ("10:00", None),
    ("1e5", None), ("15/11/2025", None), ("99-Jan-08x", None), ("J", None), ("J99999999", None), ("t", None), (",", None), ("2025--11-15", None),
]


def test_dates(spark):
    got = column(spark, [t for t, _ in DATES], to_date("v"))
    assert [(t, d, x) for (t, d), x in zip(DATES, got) if d != x] == []


def test_path_parts(spark):
    keys = ["/job-1/0/custom_output/0/result.json", "job-2/0/result.json", "job-3", ""]
    assert column(spark, keys, job_id_from_key(F.col("v"))) == ["job-1", "job-2", "job-3", ""]
    assert column(spark, ["arn:x:job/abc", "abc"], job_id_from_arn(F.col("v"))) == ["abc", "abc"]


def test_ids_are_stable_and_distinct(spark):
    ids = spark.range(20000).select(stable_id(F.lit("invoice"), F.col("id")).alias("x"))
    again = spark.range(0, 20000, 1, 13).select(stable_id(F.lit("invoice"), F.col("id")).alias("x"))
    assert ids.distinct().count() == 20000
    assert ids.exceptAll(again).count() == 0
    assert spark.range(1).select(invoice_code(F.lit(7))).first()[0] == "INV-0007"
