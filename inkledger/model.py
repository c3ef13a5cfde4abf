"""Data model: table schemas, column limits, status domain and fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
QUANTITY = T.DecimalType(10, 2)
SCORE = T.DecimalType(5, 2)
ID = T.DecimalType(38, 0)


TEXT, DATE, TIME, FLAG, INT = T.StringType(), T.DateType(), T.TimestampType(), T.BooleanType(), T.IntegerType()


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


# --- Fixed values -----------------------------------------------------------
# These must equal the documented behaviour for results to agree.

REQUIRED_FIELDS = ("invoice_number", "company_name", "total_amount", "invoice_date")
HIGH_VALUE_THRESHOLD = 50000
MIN_CONFIDENCE = 70

RESULT_PATH_MARK = "custom_output"
RESULT_FILE_END = "result.json"
JOB_TAG = "bedrock_job_id"
STATE_TAG = "processing_status"
STATE_STARTED = "in_progress"

MISSING_FIELD = "Missing required field: %s"
INVALID_TOTAL = "Invalid total amount: %s"
INVALID_TOTAL_FORMAT = "Invalid total amount format: %s"
LOW_CONFIDENCE = "Low confidence: %s%%"

MISSING_PARAMETER = "Error: Missing invoice_id or action"
UNKNOWN_ACTION = "Error: Action must be approve or reject"
INVOICE_NOT_FOUND = "Error: Invoice not found"

NOTICE_SUBJECT = "🔔 High-Value Invoice Approval Required: %s"
NOTICE_BODY = """High-Value Invoice Requires Approval

Invoice Number: %s
Vendor: %s
Amount: %s
Date: %s
Due Date: %s
PO Number: %s

Confidence Score: %s%%

This invoice exceeds the %s threshold and requires manual approval.

----- ACTION REQUIRED -----

APPROVE: %s

REJECT: %s

Click one of the links above to approve or reject this invoice."""

TAX_PERCENT = 8
DUE_DAYS = 30
SAMPLE_VENDOR = "ACME CORPORATION"
SAMPLE_ADDRESS = "123 Business Street, New York, NY 10001"
SAMPLE_CONTACT = "Tel: (555) 123-4567 | Email: billing@acme.com"
SAMPLE_SERVICES = (
    "Consulting Services", "Software Development", "Cloud Infrastructure",
    "Data Analytics", "API Integration", "Technical Support",
    "Project Management", "Security Audit", "Performance Optimization",
    "System Maintenance",
)
SAMPLE_BASE_PRICES = (50, 75, 100, 125, 150, 175, 200)
SAMPLE_DISCOUNT_PERCENTS = (5, 10, 15)
SAMPLE_TERMS = "Payment is due within 30 days of invoice date."
SAMPLE_INSTRUCTIONS = "Please include invoice number on payment."
SAMPLE_BANK = ("First National Bank", "1234567890", "987654321")

SUMMARY_CSV = _table(**{
    "Invoice Number": TEXT, "Vendor": TEXT, "Customer": TEXT, "Email": TEXT,
    "Date": DATE, "Due Date": DATE, "Subtotal": MONEY, "Tax": MONEY,
    "Discount": MONEY, "Total": MONEY, "Filename": TEXT,
})
# ----------------------------------------------------------------------------

VENDORS = _table(
    vendor_id=ID, vendor_name=TEXT, vendor_email=TEXT, payment_terms=TEXT, is_approved=FLAG,
    vendor_address=TEXT, vendor_phone=TEXT, created_at=TIME,
)
CUSTOMERS = _table(
    customer_id=ID, customer_name=TEXT, customer_address=TEXT, customer_email=TEXT, created_at=TIME,
)
INVOICES = _table(
    invoice_id=ID, invoice_number=TEXT, vendor_id=ID, invoice_date=DATE, due_date=DATE,
    subtotal=MONEY, tax_amount=MONEY, total_amount=MONEY, status=TEXT, s3_key=TEXT,
    processed_at=TIME, approved_at=TIME, paid_at=TIME, customer_id=ID, discount=MONEY,
    payment_instructions=TEXT, confidence_score=SCORE, s3_bucket=TEXT, created_at=TIME,
    po_number=TEXT, payment_terms=TEXT,
)
LINE_ITEMS = _table(
    line_item_id=ID, invoice_id=ID, description=TEXT, quantity=QUANTITY, unit_price=MONEY,
    amount=MONEY, line_number=INT,
)
BANK_DETAILS = _table(
    bank_id=ID, vendor_id=ID, bank_name=TEXT, account_number=TEXT, routing_number=TEXT,
    created_at=TIME,
)
EXTRACTION_LOG = _table(
    log_id=ID, invoice_id=ID, extraction_timestamp=TIME, model_version=TEXT,
    overall_confidence=SCORE, raw_json=TEXT, processing_time_ms=INT, success=FLAG,
    error_message=TEXT,
)

TABLES = {
    "vendors": VENDORS,
    "customers": CUSTOMERS,
    "invoices": INVOICES,
    "invoice_line_items": LINE_ITEMS,
    "bank_details": BANK_DETAILS,
}

AUDITED = {**TABLES, "extraction_log": EXTRACTION_LOG}

# Constraints, as data: used by both the outcome rules and the audit.
PRIMARY_KEY = {
    "vendors": "vendor_id", "customers": "customer_id", "invoices": "invoice_id", "invoice_line_items": "line_item_id",
    "bank_details": "bank_id", "extraction_log": "log_id",
}
NOT_NULL = {
    "vendors": ("vendor_name",),
    "invoices": ("invoice_number", "invoice_date", "total_amount"),
    "invoice_line_items": ("description",),
}
UNIQUE = {"vendors": ("vendor_name",), "invoices": ("invoice_number",)}
FOREIGN_KEYS = (
    ("invoices", "vendor_id", "vendors"),
    ("invoices", "customer_id", "customers"),
    ("invoice_line_items", "invoice_id", "invoices"),
    ("bank_details", "vendor_id", "vendors"),
    ("extraction_log", "invoice_id", "invoices"),
)
MAX_LENGTH = {
    "vendors": {"vendor_name": 255, "vendor_email": 255, "payment_terms": 50, "vendor_phone": 50},
    "customers": {"customer_name": 255, "customer_email": 255},
    "invoices": {"invoice_number": 100, "status": 50, "s3_key": 500, "s3_bucket": 255,
                 "po_number": 100, "payment_terms": 255},
    "bank_details": {"bank_name": 255, "account_number": 100, "routing_number": 100},
    "extraction_log": {"model_version": 100},
}
# Values the additive migrations give to rows written before them.
DEFAULTS = {
    "vendors": {"is_approved": "false"},
    "invoices": {"status": "'pending'", "discount": "0"},
}

LINE_TEXT = "array<struct<description:string,quantity:string,unit_price:string,amount:string>>"

# Fields whose truthiness matters; extraction keeps it in the struct ``present``.
TRUTH_TESTED = (*REQUIRED_FIELDS, "discount", "bank_name")
