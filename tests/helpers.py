"""Small inputs shared by the tests."""

import json

GOOD = {
    "invoice_number": "A-1", "company_name": "Acme", "company_address": "1 Road",
    "company_contact_information": "555", "bill_to": "Bob", "client_email": "b@example.org",
    "invoice_date": "2025-11-20", "due_date": "2025-12-20", "po_number": "PO-1",
    "subtotal": "90.00", "discount": "0", "tax": "10.00", "total_amount": "100.00",
    "payment_terms": "NET-30", "payment_details": {"payment_instructions": "wire"},
    "bank_details": {"bank_name": "First", "account_number": "1", "routing_number": "2"},
    "invoice_items": [{"description": "x", "quantity": 1, "unit_price": "90.00", "amount": "90.00"}],
}
ABSENT = object()


def document(confidence=0.9, **changes) -> str:
    body = {**GOOD, **changes}
    body = {k: v for k, v in body.items() if v is not ABSENT}
    blueprint = {} if confidence is ABSENT else {"confidence": confidence}
    return json.dumps({"inference_result": body, "matched_blueprint": blueprint})


def documents(spark, texts, key="/job-{0}/0/custom_output/0/result.json"):
    rows = [(i, "b", key.format(i), text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "arrival bigint, s3_bucket string, s3_key string, raw string")
