import json
from decimal import Decimal

from inkledger.operators.extract import cast_invoice, extract_flatten
from tests.helpers import ABSENT, document, documents


def flats(spark, texts, strict=False):
    return extract_flatten(documents(spark, texts), strict).orderBy("arrival").collect()


def flat(spark, text, strict=False):
    return extract_flatten(documents(spark, [text]), strict).first()


def test_fields_are_renamed_and_nested_ones_lifted(spark):
    row = flat(spark, document())
    assert (row.company_contact, row.payment_instructions, row.bank_name, row.routing_number) == (
        "555", "wire", "First", "2")
    assert [tuple(x) for x in row.line_items] == [("x", "1", "90.00", "90.00")]
    assert row.confidence == 90.0 and row.confidence_score == Decimal("90.00")
    assert row.confidence_text == "90.0" and row.shape_errors == []


def test_absent_parts_have_defaults(spark):
    row = flat(spark, json.dumps({"inference_result": {}}))
    assert row.invoice_number is None and row.line_items == [] and row.confidence == 0.0
    assert row.confidence_text == "0" and row.shape_errors == []
    assert not any(row.present)


TRUTHINESS = [
    ("x", True), ("0", True), (" ", True), ("false", True), ("[]", True), (5, True), (True, True), ([1], True),
    (ABSENT, False), (None, False), ("", False), (0, False), (0.0, False), (False, False), ([], False), ({}, False),
]


def test_truthiness(spark):
    rows = flats(spark, [document(invoice_number=v, total_amount=v) for v, _ in TRUTHINESS])
    assert [(r.present.invoice_number, r.present.total_amount) for r in rows] == [(p, p) for _, p in TRUTHINESS]


TOTAL_TEXTS = [
    ("-5.00", "-5.00"), (-5.0, "-5.0"), (-5, "-5"), (100.10, "100.1"), ("100.10", "100.10"), (0, "0"),
]


def test_total_text_keeps_the_form_of_its_type(spark):
    rows = flats(spark, [document(total_amount=v) for v, _ in TOTAL_TEXTS])
    assert [r.total_amount for r in rows] == [t for _, t in TOTAL_TEXTS]


SHAPE_ERRORS = [
    ({"invoice_date": 20251105}, ["invoice_date"]), ({"invoice_date": "20251105"}, []),
    ({"due_date": True}, ["due_date"]), ({"due_date": None}, []),
    ({"subtotal": True}, ["subtotal"]), ({"subtotal": "true"}, []),
    ({"company_name": {"a": 1}}, ["company_name"]), ({"company_name": "{a}"}, []),
    ({"po_number": [1]}, ["po_number"]), ({"po_number": 12}, []),
    ({"bank_details": "First"}, ["bank_details"]), ({"payment_details": [1]}, ["payment_details"]),
    ({"invoice_items": "x"}, ["invoice_items"]), ({"invoice_items": [None]}, ["invoice_items"]),
    ({"invoice_items": ["x"]}, ["invoice_items"]), ({"invoice_items": {"a": 1}}, ["invoice_items"]),
    ({"invoice_items": None}, []), ({"invoice_items": 0}, []), ({"invoice_items": ""}, []),
    ({"invoice_items": {}}, []), ({"invoice_items": []}, []),
    ({"confidence": "0.9"}, ["confidence"]), ({"confidence": True}, []), ({"confidence": 1}, []),
]


def test_shape_errors(spark):
    rows = flats(spark, [document(**c) for c, _ in SHAPE_ERRORS])
    assert [r.shape_errors for r in rows] == [e for _, e in SHAPE_ERRORS]


def test_other_fields_survive_a_misfit(spark):
    row = flat(spark, document(invoice_items=0, confidence=True))
    assert (row.invoice_number, row.bank_name, row.confidence) == ("A-1", "First", 100.0)


MALFORMED = [
    '{"a": 1} x', '{"a": 1,}', "\ufeff{}",     "", "{", "nonsense", "[1]", "{'a': 1}", '{"inference_result": {"a": ',
]


def test_malformed(spark):
    assert ["document" in r.shape_errors for r in flats(spark, MALFORMED)] == [True] * len(MALFORMED)


def test_null_objects_are_errors_only_when_strict(spark):
    text = document(bank_details=None, confidence=None)
    assert flat(spark, text).shape_errors == []
    assert flat(spark, text, strict=True).shape_errors == ["bank_details", "confidence"]
    assert flat(spark, document(bank_details=ABSENT), strict=True).shape_errors == []


DISCOUNT = [
    ("-1.25", "1.25"), ("0", "0.00"), (None, "0.00"), (ABSENT, "0.00"), (0, "0.00"), (-3, "3.00"),
    (True, "1.00"), (False, "0.00"), ("", "0.00"), ("5%", None),
]


def test_discount(spark):
    texts = [document(discount=d) for d, _ in DISCOUNT]
    rows = cast_invoice(extract_flatten(documents(spark, texts))).orderBy("arrival").collect()
    assert [r.discount_value for r in rows] == [v and Decimal(v) for _, v in DISCOUNT]


def test_lines_are_numbered_and_typed(spark):
    items = [{"description": "a", "quantity": "2", "unit_price": 1.5, "amount": "3"}, {"description": None}]
    row = cast_invoice(extract_flatten(documents(spark, [document(invoice_items=items)]))).first()
    assert [(x.line_number, x.description, x.quantity, x.amount) for x in row.lines] == [
        (1, "a", Decimal("2.00"), Decimal("3.00")), (2, None, None, None)]
