"""Text to typed values, keys and path parts.

The ``*_sql`` builders take and give SQL expression text, so that whole projections go to
the JVM in one call and parts can be used inside lambdas; the other functions give Columns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkledger.model import ID

# Number syntax accepted for amounts: digits may be grouped by single underscores.
_DIGITS = r"\d+(?:_\d+)*"
NUMBER = rf"^\s*[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?\s*$"
NON_FINITE = r"(?i)^\s*[+-]?(?:nan|inf|infinity)\s*$"

# The common date form, with or without a time and zone.
_CLOCK = r"(?:[01]?\d|2[0-3]):[0-5]\d(?::(?:[0-5]\d|60)(?:\.\d+)?)?|24:00(?::00)?"
_ISO_CLOCK = rf"(?:[T ] *(?:{_CLOCK})(?: *(?:Z|UTC|GMT|[+-]\d{{1,2}}(?::?\d{{2}})?))?)?"
ISO_DATE = rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}}){_ISO_CLOCK}$"
# Other forms are read by their tokens.  What a date text may hold, each token as one letter:
# N number, T clock time, M month, A half of day, Z zone, t, J, a space, and separators as they are.
WEEKDAY = r"\b(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?\b"
MONTH = ("^(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
         "sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)$")
TOKEN = r"(\d+(?::\d+)+(?:\.\d+)?|\d+|[a-z]+|\s+|[^\sa-z\d])"
_ZONE = "(?: ?Z| ?[-+][NT])?"
_DAY = ("N-N-N|N/N/N|N\\.N\\.N|N N N|N\\.N|N|JN|"
        "M-N-N|M/N/N|M\\.N\\.N|M\\.? ?N N|N-M-N|N/M/N|N\\.M\\.N|N ?M\\.? ?N")
SHAPE = f"^((?:T ?A?{_ZONE} )?)({_DAY})(?:(?: ?t ?| )T ?A?{_ZONE}|tN{_ZONE})?$"
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
#: The Julian day of 1970-01-01.
JULIAN_EPOCH = 2440588


def is_number_sql(text: str) -> str:
    return f"({text}) RLIKE r'{NUMBER}'"


def is_non_finite_sql(text: str) -> str:
    return f"({text}) RLIKE r'{NON_FINITE}'"


def number_sql(text: str, dtype: str) -> str:
    """Number text as ``dtype``; null when it is no finite number or too large.

    Decimals round half away from zero.
    """
    return f"try_cast(CASE WHEN {is_number_sql(text)} THEN replace(trim({text}), '_', '') END AS {dtype})"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is worked out once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _token_date_sql(text: str) -> str:
    """Date text by its tokens: their kinds make a shape, the shape tells which of them are year, month and day."""
    plain = f"trim(regexp_replace(regexp_replace(lower({text}), r'{WEEKDAY}', ' '), r'[\\s,]+', ' '))"
    tokens = f"regexp_extract_all({plain}, r'{TOKEN}', 1)"
    kind = (f"CASE WHEN x RLIKE r'^\\d+:' THEN 'T' WHEN x RLIKE r'^\\d' THEN 'N' WHEN x RLIKE r'{MONTH}' THEN 'M' "
            "WHEN x IN ('am', 'pm') THEN 'A' WHEN x IN ('z', 'utc', 'gmt') THEN 'Z' WHEN x = 't' THEN 't' WHEN x = 'j' THEN 'J' "
            "WHEN x IN (' ', '-', '/', '.', '+') THEN x ELSE '?' END")
    shape = f"array_join(transform(t, x -> {kind}), '')"
    clocks = (f"NOT exists(t, x -> x RLIKE r'^\\d+:' AND NOT x RLIKE r'^(?:{_CLOCK})$')"
              r" AND (NOT s LIKE '%A%' OR exists(t, x -> x RLIKE r'^(?:0?[1-9]|1[0-2]):'))"
              r" AND (NOT s RLIKE r'tN' OR element_at(t, locate('tN', s) + 1) RLIKE r'^(?:[01]\d|2[0-3])[0-5]\d(?:[0-5]\d)?$')")
    day = f"regexp_extract(s, r'{SHAPE}', 2)"
    first = f"length(regexp_extract(s, r'{SHAPE}', 1)) + 1"
    parts = f"filter(slice(t, {first}, length(d)), x -> x RLIKE r'^[a-z\\d]')"

    def ymd(year: str, month: str, day_of: str) -> str:
        return f"try_cast(concat_ws('-', {year}, {month}, {day_of}) AS date)"

    def year(x: str) -> str:
        return f"concat(CASE WHEN length({x}) > 2 THEN '' WHEN lpad({x}, 2, '0') < '70' THEN '20' ELSE '19' END, CASE WHEN length({x}) > 2 THEN {x} ELSE lpad({x}, 2, '0') END)"

    def month(x: str) -> str:
        return f"(locate(left({x}, 3), '{MONTHS}') + 2) div 3"

    def ordinal(y: str, n: str) -> str:
        start = f"try_cast(concat({y}, '-01-01') AS date)"
        return f"CASE WHEN {n} <> '000' AND year(date_add({start}, CAST({n} AS int) - 1)) = year({start}) THEN date_add({start}, CAST({n} AS int) - 1) END"

    one, two, three = "p[0]", "p[1]", "p[2]"
    found = f"""CASE regexp_replace(d, '[^NMJ]', '')
        WHEN 'NNN' THEN CASE WHEN length({one}) > 2 THEN {ymd(one, two, three)} ELSE {ymd(year(three), one, two)} END
        WHEN 'MNN' THEN CASE WHEN length({two}) > 2 THEN {ymd(two, month(one), three)} ELSE {ymd(year(three), month(one), two)} END
        WHEN 'NMN' THEN CASE WHEN length({one}) > 2 THEN {ymd(one, month(two), three)} ELSE {ymd(year(three), month(two), one)} END
        WHEN 'NN' THEN CASE WHEN length({one}) = 4 AND length({two}) = 3 THEN {ordinal(one, two)} END
        WHEN 'N' THEN CASE length({one})
          WHEN 8 THEN {ymd(f"left({one}, 4)", f"substr({one}, 5, 2)", f"right({one}, 2)")}
          WHEN 6 THEN {ymd(year(f"left({one}, 2)"), f"substr({one}, 3, 2)", f"right({one}, 2)")}
          WHEN 7 THEN {ordinal(f"left({one}, 4)", f"right({one}, 3)")} END
        WHEN 'JN' THEN CASE WHEN length({two}) <= 7 THEN date_add(DATE'1970-01-01', try_cast({two} AS int) - {JULIAN_EPOCH}) END END"""
    dated = _let("d", day, f"CASE WHEN d <> '' AND {clocks} THEN {_let('p', parts, found)} END")
    return _let("t", tokens, _let("s", shape, dated))


def date_sql(text: str) -> str:
    """Date text as the database reads it, month before day where both are numbers; null where it would refuse.

    Numeric forms with one of ``- / .`` or spaces, forms with an English month in any place, eight or six digits in
    a row, year and day of year, Julian days; a weekday, a clock time with zone or half of day before or after are
    checked and left.  Two-digit years 70 to 99 are 19xx, 00 to 69 20xx.
    """
    iso = f"trim({text})"

    def part(group: int) -> str:
        return f"regexp_extract({iso}, r'{ISO_DATE}', {group})"

    # the common form first: its branch looks at nothing else
    return (f"CASE WHEN {iso} RLIKE r'{ISO_DATE}' THEN try_cast(concat_ws('-', {part(1)}, {part(2)}, {part(3)}) AS date) "
            f"ELSE {_token_date_sql(text)} END")


def discount_sql(text: str, present: str) -> str:
    """Sign dropped, falsy is 0, text that is no number is null (an error for the caller)."""
    return f"CASE WHEN {present} THEN abs({number_sql(text, 'decimal(12,2)')}) ELSE 0.00BD END"


def to_double(text: str) -> Column:
    return F.expr(number_sql(text, "double"))


def to_decimal(text: str, dtype: str = "decimal(12,2)") -> Column:
    return F.expr(number_sql(text, dtype))


def to_date(text: str) -> Column:
    return F.expr(date_sql(text))


def normalize_discount(text: str, present: str) -> Column:
    return F.expr(discount_sql(text, present))


def stable_id(*parts: Column) -> Column:
    """A 120-bit whole number made from the natural key.

    Needs no numbering pass and gives the same id on every retry and replay.  64 bits
    would collide at some 10**10 keys; 120 bits fit decimal(38,0).
    """
    digest = F.md5(F.concat_ws("\u0001", *[p.cast("string") for p in parts]))
    high = F.conv(F.substring(digest, 1, 15), 16, 10).cast(ID)
    low = F.conv(F.substring(digest, 16, 15), 16, 10).cast(ID)
    return (high * F.lit(1 << 60).cast("decimal(19,0)") + low).cast(ID)


def job_id_from_key(key: Column) -> Column:
    """Job id in a result path: first segment, or the second when the path starts with '/'."""
    parts = F.split(key, "/")
    rooted = (F.get(parts, F.lit(0)) == "") & (F.size(parts) > 1)
    return F.get(parts, F.when(rooted, F.lit(1)).otherwise(F.lit(0)))


def job_id_from_arn(arn: Column) -> Column:
    """Last '/' segment of a job ARN."""
    return F.element_at(F.split(arn, "/"), -1)


def object_uri(bucket: Column, key: Column) -> Column:
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)


def invoice_code(number: Column) -> Column:
    return F.format_string("INV-%04d", number)


def new_status(action: Column) -> Column:
    return F.when(action == "approve", F.lit("approved")).otherwise(F.lit("rejected"))
