from pyspark.sql import functions as F

from inkledger.operators.decide import (
    dedupe_invoices, extraction_log, mark_duplicates, process_documents, process_results, split_outcomes,
)
from inkledger.operators.extract import extract_flatten
from tests.helpers import ABSENT, document, documents


def process(spark, *texts):
    return process_documents(extract_flatten(documents(spark, list(texts))))


VALIDATION_ERRORS = [
    ({}, []),
    ({"invoice_number": "", "company_name": None, "total_amount": 0, "invoice_date": ABSENT},
     ["Missing required field: invoice_number", "Missing required field: company_name",
      "Missing required field: total_amount", "Missing required field: invoice_date", "Invalid total amount: 0"]),
    ({"total_amount": "-5.00"}, ["Invalid total amount: -5.00"]),
    ({"total_amount": "0"}, ["Invalid total amount: 0"]),
    ({"total_amount": "-inf"}, ["Invalid total amount: -inf"]),
    ({"total_amount": "nan"}, []),
    ({"total_amount": "N/A"}, ["Invalid total amount format: N/A"]),
    ({"total_amount": "$1,200.00"}, ["Invalid total amount format: $1,200.00"]),
    ({"total_amount": ""}, ["Missing required field: total_amount"]),
    ({"total_amount": None}, ["Missing required field: total_amount"]),
]


def test_validation_errors(spark):
    rows = process(spark, *[document(**c) for c, _ in VALIDATION_ERRORS]).orderBy("arrival").collect()
    assert [r.validation_errors for r in rows] == [e for _, e in VALIDATION_ERRORS]
    assert [r.is_valid for r in rows] == [not e for _, e in VALIDATION_ERRORS]


STATUS = [
    ("100", 0.9, "approved"), ("50000", 0.9, "approved"), ("50000.01", 0.9, "pending_review"),
    ("100", 0.7, "approved"), ("100", 0.6999, "pending_review"), ("100", ABSENT, "pending_review"),
    ("-1", 0.1, "failed"), ("60000", 0.1, "pending_review"), ("N/A", 0.9, None),
]


def test_status(spark):
    texts = [document(confidence, total_amount=total) for total, confidence, _ in STATUS]
    rows = process(spark, *texts).orderBy("arrival").collect()
    assert [r.status for r in rows] == [status for *_, status in STATUS]


def test_low_confidence_compares_the_unrounded_value(spark):
    row = process(spark, document(0.699999)).first()
    assert str(row.confidence_score) == "70.00" and row.needs_review
    assert row.warnings[0].startswith("Low confidence: 69.99")


OUTCOME = [
    ({}, None), ({"total_amount": "-5"}, None), ({"invoice_number": ""}, None), ({"company_name": ""}, None),
    ({"subtotal": None, "tax": ABSENT, "due_date": None}, None), ({"discount": ""}, None),
    ({"total_amount": None}, "total_amount not a number"), ({"total_amount": "N/A"}, "total_amount not a number"),
    ({"total_amount": "nan"}, "total_amount not a number"), ({"total_amount": "inf"}, "total_amount not a number"),
    ({"total_amount": "10000000000"}, "total_amount not storable"),
    ({"company_name": None}, "company_name missing"), ({"invoice_number": None}, "invoice_number missing"),
    ({"invoice_date": ""}, "invoice_date missing or not a date"), ({"due_date": ""}, "due_date not a date"),
    ({"discount": "5%"}, "discount not a number"), ({"subtotal": ""}, "subtotal not storable"),
    ({"tax": "x"}, "tax not storable"), ({"payment_terms": "x" * 51}, "payment_terms too long"),
    ({"payment_terms": "x" * 50 + "  "}, None), ({"company_name": "x" * 256}, "vendor_name too long"),
    ({"invoice_number": "x" * 101}, "invoice_number too long"), ({"po_number": "x" * 101}, "po_number too long"),
    ({"confidence": 100}, "confidence not storable"),
    ({"invoice_items": [{"quantity": 1}]}, "line description missing"),
    ({"invoice_items": [{"description": "a", "amount": "x"}]}, "line number not storable"),
    ({"bank_details": {"bank_name": "x" * 256}}, "bank_name too long"),
    ({"bank_details": {"account_number": "x" * 101}}, None),
    ({"bank_details": 5}, "document shape"),
]


def test_outcome(spark):
    rows = process(spark, *[document(**c) for c, _ in OUTCOME]).orderBy("arrival").collect()
    assert [r.error for r in rows] == [e for _, e in OUTCOME]


def test_first_arrival_wins_and_errors_claim_nothing(spark):
    rows = process(spark, document(total_amount="N/A"), document(company_name="First"),
                   document(company_name="Second"), document(invoice_number="", company_name="Blank"),
                   document(invoice_number="", company_name="Blank 2"))
    assert {r.arrival for r in dedupe_invoices(rows).collect()} == {1, 3}
    marked = mark_duplicates(rows)
    assert [(r.arrival, r.error) for r in marked.orderBy("arrival").collect()] == [
        (0, "total_amount not a number"), (1, None), (2, "duplicate invoice_number"),
        (3, None), (4, "duplicate invoice_number")]
    accepted, errors = split_outcomes(marked)
    assert accepted.count() == 2 and errors.count() == 3


def test_responses_and_log(spark):
    docs = documents(spark, [document(), document(), document(total_amount=60000)])
    marked = mark_duplicates(process_documents(extract_flatten(docs)))
    answers = process_results(marked, F.col("arrival")).orderBy("arrival").collect()
    assert [(r.status_code, r.invoice_id, r.status) for r in answers] == [
        (200, 0, "approved"), (500, None, None), (500, None, None)]
    log = extraction_log(docs, marked, F.col("arrival"), F.lit("2025-01-01").cast("timestamp"))
    assert [(r.success, r.error_message) for r in log.orderBy("arrival").collect()] == [
        (True, None), (False, "duplicate invoice_number"), (False, "duplicate invoice_number")]
    assert log.filter("raw_json is null").count() == 0


def test_a_hot_number_is_cut_before_the_shuffle(spark):
    """The plan keeps one row per number and task before anything is exchanged."""
    plan = dedupe_invoices(process(spark, document()))._jdf.queryExecution().executedPlan().toString()
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert "Final" in before and "row_number(), 1, Partial" in after
