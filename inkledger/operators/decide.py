"""Validation, status decision and outcome of each document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkledger import model as M
from inkledger.functions.parse import is_non_finite_sql, stable_id
from inkledger.operators.extract import cast_invoice

ACCEPTED, ERROR = "persisted", "error"
DUPLICATE = "duplicate invoice_number"


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "\\'") + "'"


def validate(typed: DataFrame) -> DataFrame:
    """``validation_errors`` in a fixed order, ``warnings``, ``is_valid`` and ``needs_review``."""
    errors = [f"CASE WHEN NOT present.{name} THEN {_text(M.MISSING_FIELD % name)} END"
              for name in M.REQUIRED_FIELDS]
    # '-inf' is a number that is not positive; 'nan' and 'inf' are neither error
    number = f"(total_number IS NOT NULL OR {is_non_finite_sql('total_amount')})"
    not_positive = "(coalesce(total_number <= 0, false) OR total_amount RLIKE r'(?i)^\\s*-inf')"
    errors.append(f"CASE WHEN total_amount <> '' AND {number} AND {not_positive} "
                  f"THEN format_string({_text(M.INVALID_TOTAL)}, total_amount) END")
    errors.append(f"CASE WHEN total_amount <> '' AND NOT {number} "
                  f"THEN format_string({_text(M.INVALID_TOTAL_FORMAT)}, total_amount) END")
    checked = typed.selectExpr(
        "*", f"array_compact(array({', '.join(errors)})) AS validation_errors",
        f"array_compact(array(CASE WHEN confidence < {M.MIN_CONFIDENCE} THEN "
        f"format_string({_text(M.LOW_CONFIDENCE)}, CAST(confidence AS string)) END)) AS warnings")
    return checked.selectExpr("*", "size(validation_errors) = 0 AS is_valid", "size(warnings) > 0 AS needs_review")


def decide_status(validated: DataFrame, threshold: float = M.HIGH_VALUE_THRESHOLD) -> DataFrame:
    """failed, pending_review (high value or low confidence) or approved; null without a total."""
    return validated.selectExpr(
        "*", f"CASE WHEN total_number IS NULL THEN NULL WHEN NOT is_valid THEN 'failed' "
             f"WHEN total_number > {threshold} OR needs_review THEN 'pending_review' "
             f"ELSE 'approved' END AS status")


def outcome_rules() -> list[tuple[str, str]]:
    """(reason, SQL condition) in the order in which storing a document would fail."""
    def long(name: str, table: str, column: str) -> tuple[str, str]:
        # excess spaces are cut off, any other excess is an error
        return f"{column} too long", f"length(rtrim({name})) > {M.MAX_LENGTH[table][column]}"

    unread_line = " OR ".join(
        f"(z.line_items.{c} IS NOT NULL AND z.lines.{c} IS NULL)" for c in ("quantity", "unit_price", "amount"))
    bank = [long(c, "bank_details", c) for c in ("bank_name", "account_number", "routing_number")]
    return [
        ("document shape", "size(shape_errors) > 0"),
        ("total_amount not a number", "total_number IS NULL"),
        ("company_name missing", "company_name IS NULL"),
        long("company_name", "vendors", "vendor_name"),
        long("company_contact", "vendors", "vendor_phone"),
        long("payment_terms", "vendors", "payment_terms"),
        long("bill_to", "customers", "customer_name"),
        long("client_email", "customers", "customer_email"),
        ("discount not a number", "discount_value IS NULL"),
        ("invoice_number missing", "invoice_number IS NULL"),
        long("invoice_number", "invoices", "invoice_number"),
        ("invoice_date missing or not a date", "invoice_day IS NULL"),
        ("due_date not a date", "due_date IS NOT NULL AND due_day IS NULL"),
        ("subtotal not storable", "subtotal IS NOT NULL AND subtotal_value IS NULL"),
        ("tax not storable", "tax IS NOT NULL AND tax_value IS NULL"),
        ("total_amount not storable", "total_value IS NULL"),
        long("po_number", "invoices", "po_number"),
        ("confidence not storable", "confidence_score IS NULL"),
        long("s3_key", "invoices", "s3_key"),
        long("s3_bucket", "invoices", "s3_bucket"),
        ("line description missing", "exists(lines, x -> x.description IS NULL)"),
        ("line number not storable", f"exists(arrays_zip(line_items, lines), z -> {unread_line})"),
        *[(reason, f"present.bank_name AND {condition}") for reason, condition in bank],
    ]


def classify_outcome(decided: DataFrame) -> DataFrame:
    """``error``: the first reason why the document cannot be stored, null when it can.

    Uniqueness is not looked at here: a document in error must not claim its number.
    """
    cases = " ".join(f"WHEN {condition} THEN {_text(reason)}" for reason, condition in outcome_rules())
    # A generator, because a filter on its output stays above it: otherwise Catalyst copies
    # the whole chain of parsing and checks into the filter and evaluates it twice.
    return decided.selectExpr("*", f"explode(array(CASE {cases} END)) AS error")


def cut_names(classified: DataFrame) -> DataFrame:
    """Names that are compared, cut to their column's length (only spaces can be cut, see the outcome rules).

    Done before ids, uniqueness and grouping, which then see what the tables will hold.
    """
    def cut(name: str, table: str, column: str) -> Column:
        return F.when(F.col("error").isNull(), F.left(F.col(name), F.lit(M.MAX_LENGTH[table][column]))).otherwise(F.col(name))

    return classified.withColumns({"invoice_number": cut("invoice_number", "invoices", "invoice_number"),
                                   "company_name": cut("company_name", "vendors", "vendor_name")})


def process_documents(extracted: DataFrame) -> DataFrame:
    """Typed, validated, decided, classified and cut; everything but uniqueness."""
    return cut_names(classify_outcome(decide_status(validate(cast_invoice(extracted)))))


def dedupe_invoices(classified: DataFrame, identity: tuple[str, ...] = ("arrival", "s3_key")) -> DataFrame:
    """Documents without error that come first for their invoice number.

    ``identity`` orders and names a delivery.  ``row_number() = 1`` is planned with a
    limit before the shuffle, so each task sends one row per number however often the
    number occurs.
    """
    first = Window.partitionBy("invoice_number").orderBy(*identity)
    return (classified.filter(F.col("error").isNull())
            .withColumn("_place", F.row_number().over(first))
            .filter(F.col("_place") == 1).drop("_place"))


def mark_duplicates(classified: DataFrame, identity: tuple[str, ...] = ("arrival", "s3_key")) -> DataFrame:
    """All documents with ``outcome``; later holders of a stored number get an error too.

    Only key columns go through the uniqueness step; the join back is on the delivery's
    identity, which no two rows share.  ``classified`` is read twice: pass a stored table.
    """
    winners = (dedupe_invoices(classified.select("invoice_number", *identity, "error"), identity)
               .select(*identity, F.lit(True).alias("_first")))
    claimed = classified.join(winners, list(identity), "left")
    return set_outcome(claimed.withColumn("_lost", F.col("_first").isNull())).drop("_first")


def set_outcome(claimed: DataFrame) -> DataFrame:
    """``outcome`` and the final ``error``; ``_lost`` is true where another document has the number."""
    refused = F.col("error").isNull() & F.coalesce("_lost", F.lit(False))
    return (claimed
            .withColumn("error", F.when(refused, F.lit(DUPLICATE)).otherwise(F.col("error")))
            .withColumn("outcome", F.when(F.col("error").isNull(), F.lit(ACCEPTED)).otherwise(F.lit(ERROR)))
            .drop("_lost"))


def split_outcomes(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, errors); the errors carry nothing to store but their message."""
    errors = marked.filter(F.col("outcome") == ERROR).select("arrival", "s3_bucket", "s3_key", "error")
    return marked.filter(F.col("outcome") == ACCEPTED), errors


def process_results(marked: DataFrame, invoice_id: Column) -> DataFrame:
    """Response per document: code 200 with id, number and status, or 500 with the error."""
    ok = F.col("outcome") == ACCEPTED
    return marked.select(
        "arrival", "s3_key",
        F.when(ok, F.lit(200)).otherwise(F.lit(500)).alias("status_code"),
        F.when(ok, invoice_id).alias("invoice_id"),
        F.when(ok, F.col("invoice_number")).alias("invoice_number"),
        F.when(ok, F.col("status")).alias("status"),
        "error")


def extraction_log(documents: DataFrame, marked: DataFrame, invoice_id: Column,
                   logged_at: Column, model_version: str | None = None) -> DataFrame:
    """One log row per document: raw text, confidence, success, error."""
    ok = F.col("outcome") == ACCEPTED
    facts = marked.select("arrival", "s3_key", "invoice_number", "outcome", "confidence_score", "error",
                          F.when(ok, invoice_id).alias("invoice_id"))
    return documents.join(facts, ["arrival", "s3_key"]).select(
        stable_id(F.lit("log"), F.col("s3_key"), F.col("arrival")).alias("log_id"),
        "arrival", "s3_key", "invoice_id", logged_at.alias("extraction_timestamp"),
        F.lit(model_version).cast("string").alias("model_version"),
        F.col("confidence_score").alias("overall_confidence"),
        F.col("raw").alias("raw_json"),
        F.lit(None).cast("int").alias("processing_time_ms"),
        ok.alias("success"), F.col("error").alias("error_message"))
