"""SQL twins of the registered queries, over the same tables."""

from __future__ import annotations

from inkledger.checks.fixture import FAULTS

# One row per order: the document's texts.
DOCS = """
src AS (
  SELECT o_orderkey AS k, o_custkey, CAST(o_orderdate AS DATE) AS ordered,
         CAST(round(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders),
priced AS (
  SELECT *, CAST(cents / 500.0 AS DECIMAL(12,2)) AS total,
         CAST(CASE WHEN k % 5 = 0 THEN 0 ELSE 1.25 END AS DECIMAL(12,2)) AS off
  FROM src),
taxed AS (SELECT *, CAST(total * 2 / 27 AS DECIMAL(12,2)) AS tax_part FROM priced),
docs AS (
  SELECT k AS arrival, k, 'results' AS s3_bucket,
    '/job-' || k || '/0/' || CASE WHEN k % 11 = 0 THEN 'standard_output' ELSE 'custom_output' END
      || '/0/result.json' AS s3_key,
    CASE WHEN k % 50 = 7 THEN '' WHEN k % 40 = 3 THEN 'INV-' || (k - 1) ELSE 'INV-' || k END AS invoice_number,
    s_name AS company_name, s_suppkey,
    CASE WHEN k % 9 <> 0 THEN 'addr-' || k END AS company_address,
    'tel-' || (k % 1000) AS company_contact,
    c_name AS bill_to, 'c' || o_custkey || '@example.org' AS client_email,
    CASE WHEN k % 50 <> 11 THEN strftime(ordered, '%Y-%m-%d') END AS invoice_date,
    CASE WHEN k % 50 <> 11 THEN strftime(ordered + 30, '%Y-%m-%d') END AS due_date,
    'PO-' || (1000 + k % 9000) AS po_number,
    CAST(CAST(total + off - tax_part + CASE WHEN k % 13 = 0 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS VARCHAR) AS subtotal,
    CASE WHEN k % 5 = 0 THEN NULL WHEN k % 2 = 0 THEN '-1.25' ELSE '1.25' END AS discount,
    CAST(tax_part AS VARCHAR) AS tax,
    CASE WHEN k % 50 = 13 THEN 'N/A' WHEN k % 50 = 17 THEN '-5.00' ELSE CAST(total AS VARCHAR) END AS total_amount,
    'NET-' || (30 * (1 + k % 3)) AS payment_terms,
    'quote INV-' || k AS payment_instructions,
    CASE WHEN k % 4 <> 0 THEN 'Bank ' || (k % 7) END AS bank_name,
    'acct-' || k AS account_number, 'rt-' || (k % 100) AS routing_number,
    ((200 - (k * 37) % 100) / 200.0::DOUBLE) * 100 AS confidence,
    TIMESTAMP '2024-01-01' + to_minutes(k) AS processed_at
  FROM taxed
  JOIN supplier ON s_suppkey = k % (SELECT count(*) FROM supplier)
  JOIN customer ON c_custkey = o_custkey)"""

# Typed, validated, decided, classified.
DECIDED = DOCS + """,
typed AS (
  SELECT *, TRY_CAST(invoice_date AS DATE) AS invoice_day, TRY_CAST(due_date AS DATE) AS due_day,
    TRY_CAST(subtotal AS DECIMAL(12,2)) AS subtotal_value, TRY_CAST(tax AS DECIMAL(12,2)) AS tax_value,
    TRY_CAST(total_amount AS DECIMAL(12,2)) AS total_value, TRY_CAST(total_amount AS DOUBLE) AS total_number,
    abs(CAST(coalesce(discount, '0') AS DECIMAL(12,2))) AS discount_value,
    CAST(confidence AS DECIMAL(5,2)) AS confidence_score
  FROM docs),
checked AS (
  SELECT *, list_filter([
      CASE WHEN coalesce(invoice_number, '') = '' THEN 'Missing required field: invoice_number' END,
      CASE WHEN coalesce(company_name, '') = '' THEN 'Missing required field: company_name' END,
      CASE WHEN coalesce(total_amount, '') = '' THEN 'Missing required field: total_amount' END,
      CASE WHEN coalesce(invoice_date, '') = '' THEN 'Missing required field: invoice_date' END,
      CASE WHEN total_number <= 0 THEN 'Invalid total amount: ' || total_amount END,
      CASE WHEN total_amount <> '' AND total_number IS NULL
           THEN 'Invalid total amount format: ' || total_amount END], lambda x: x IS NOT NULL) AS errors,
    CASE WHEN confidence < 70 THEN 'Low confidence: ' || CAST(confidence AS VARCHAR) || '%' ELSE '' END AS warnings
  FROM typed),
decided AS (
  SELECT *, CASE WHEN total_number IS NULL THEN NULL WHEN len(errors) > 0 THEN 'failed'
      WHEN total_number > 50000 OR confidence < 70 THEN 'pending_review' ELSE 'approved' END AS status,
    CASE WHEN total_number IS NULL THEN 'total_amount not a number'
      WHEN invoice_day IS NULL THEN 'invoice_date missing or not a date' END AS error
  FROM checked)"""

# The rows that end in the tables.
STORED = DECIDED + """,
accepted AS (
  SELECT *, k AS invoice_id, s_suppkey AS vendor_id, k AS customer_id FROM decided WHERE error IS NULL
  QUALIFY row_number() OVER (PARTITION BY invoice_number ORDER BY arrival) = 1),
invoices AS (
  SELECT invoice_id, invoice_number, vendor_id, customer_id, invoice_day AS invoice_date, due_day AS due_date,
    subtotal_value AS subtotal, discount_value AS discount, tax_value AS tax_amount, total_value AS total_amount,
    status, confidence_score, po_number, payment_terms, s3_key, processed_at, company_name AS vendor_name, s3_bucket
  FROM accepted)"""

LINES = STORED + """,
lines AS (
  SELECT l_orderkey AS invoice_id,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
      l_extendedprice, l_quantity, l_shipdate) AS INTEGER) AS line_number,
    p_name AS description, CAST(l_quantity AS DECIMAL(10,2)) AS quantity,
    CAST(((CAST(round(l_extendedprice * 100) AS BIGINT) * 2 + CAST(l_quantity AS BIGINT))
      // (CAST(l_quantity AS BIGINT) * 2)) / 100.0 AS DECIMAL(12,2)) AS unit_price,
    CAST(CAST(round(l_extendedprice * 100) AS BIGINT) / 100.0 AS DECIMAL(12,2)) AS amount
  FROM lineitem JOIN part ON p_partkey = l_partkey),
newest AS (SELECT * FROM invoices ORDER BY processed_at DESC NULLS FIRST, invoice_id LIMIT 1)"""

# Requests, and the lookups they make.
ACTIONS = STORED + """,
actions AS (
  SELECT event_id AS action_id, ts AS action_time, (event_id * 7) % ((SELECT count(*) * 6 FROM orders) // 5) AS target,
    CASE WHEN event_type IN ('click', 'purchase') THEN 'approve' WHEN event_type = 'error' THEN 'reject'
      WHEN event_type = 'signup' THEN 'escalate' END AS action
  FROM events),
answered AS (
  SELECT a.*, i.invoice_id, i.invoice_number, i.vendor_name, i.total_amount, i.status AS initial_status,
    CASE WHEN action IS NULL OR action = 'escalate' THEN 400
      WHEN i.invoice_id IS NOT NULL AND action_time >= i.processed_at THEN 200 ELSE 404 END AS status_code,
    CASE WHEN action = 'approve' THEN 'approved' ELSE 'rejected' END AS new_status
  FROM actions a LEFT JOIN invoices i ON i.invoice_id = a.target),
last_action AS (
  SELECT * FROM answered WHERE status_code = 200
  QUALIFY row_number() OVER (PARTITION BY invoice_id ORDER BY action_time DESC, action_id DESC) = 1)"""

# Sample invoices: draws are 32-bit parts of an MD5 of 'seed|...'.
SAMPLES = """
heads AS (SELECT o_orderkey AS id, md5('1|head|' || o_orderkey) AS h, md5('1|deal|' || o_orderkey) AS d FROM orders),
draws AS (
  SELECT id, {h0} % 6 + 3 AS line_count, CAST({h1} % 90 + 1 AS INTEGER) AS age, {h2} % 9000 + 1000 AS po,
    {h3} % 1000000 AS cust,
    CASE WHEN {d0} % 10 >= 7 THEN [5, 10, 15][{d1} % 3 + 1] ELSE 0 END AS pct
  FROM heads),
items AS (
  SELECT id, md5('1|line|' || id || '|' || i) AS x FROM (SELECT id, unnest(generate_series(1, line_count)) AS i FROM draws)),
sums AS (
  SELECT id, sum(([50, 75, 100, 125, 150, 175, 200][{x0} % 7 + 1] * 100 + {x1} % 100) * ({x2} % 100 + 1)) AS cents
  FROM items GROUP BY id),
samples AS (
  SELECT id, printf('INV-%04d', id) AS invoice_number, DATE '2025-12-31' - age AS invoice_date,
    DATE '2025-12-31' - age + 30 AS due_date, 'PO-' || po AS po_number,
    printf('Customer %06d', cust) AS customer, printf('customer%06d@example.org', cust) AS email,
    CAST(line_count AS BIGINT) AS line_count, CAST(cents AS BIGINT) AS cents,
    CAST(cents * 8 AS BIGINT) AS tax_bp, CAST(cents * pct AS BIGINT) AS off_bp,
    printf('sample_invoices/invoice_%04d.pdf', id) AS filename
  FROM draws JOIN sums USING (id)),
money AS (
  SELECT *, (tax_bp + 50) // 100 AS tax_c, (off_bp + 50) // 100 AS off_c FROM samples),
generated AS (
  SELECT id, invoice_number, invoice_date, due_date, po_number, customer, email, line_count, filename,
    CAST(cents AS DECIMAL(38,2)) / 100 AS s, cents, tax_c, off_c FROM money)"""
for _name in "hdx":
    for _slot in range(4):
        SAMPLES = SAMPLES.replace(
            "{%s%d}" % (_name, _slot), f"('0x' || substr({_name}, {1 + 8 * _slot}, 8))::BIGINT")


def _cents(expr: str, dtype: str = "DECIMAL(12,2)") -> str:
    return f"CAST(CAST({expr} AS DECIMAL(30,0)) * 0.01 AS {dtype})"


def _money(expr: str, digits: int = 2) -> str:
    return f"'$' || format('{{:,.{digits}f}}', CAST(coalesce({expr}, 0) AS DOUBLE))"


WIDE = "DECIMAL(38,2)"
CLASS = "CASE WHEN status IN ('approved', 'failed') THEN 'status-' || status ELSE 'status-pending' END"
MONTHS = STORED + f""",
months AS (
  SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS month, count(*) AS invoice_count,
    CAST(sum(total_amount) AS {WIDE}) AS total_amount
  FROM invoices WHERE invoice_date IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 12)"""
STATUSES = STORED + f""",
statuses AS (
  SELECT status, count(*) AS invoice_count, CAST(sum(total_amount) AS {WIDE}) AS total_amount
  FROM invoices GROUP BY status)"""
TOP = STORED + f""",
top AS (
  SELECT vendor_name, count(invoice_id) AS invoice_count, CAST(sum(total_amount) AS {WIDE}) AS total_amount
  FROM invoices GROUP BY vendor_name ORDER BY 3 DESC NULLS FIRST, 1 LIMIT 5)"""
RECENT = STORED + """,
recent AS (SELECT * FROM invoices ORDER BY processed_at DESC NULLS FIRST, invoice_id LIMIT 10)"""

NOTICE = """'High-Value Invoice Requires Approval

Invoice Number: ' || invoice_number || '
Vendor: ' || company_name || '
Amount: ' || {amount} || '
Date: ' || coalesce(invoice_date, 'None') || '
Due Date: ' || coalesce(due_date, 'None') || '
PO Number: ' || po_number || '

Confidence Score: ' || CAST(CAST(confidence_score AS DOUBLE) AS VARCHAR) || '%

This invoice exceeds the $50,000.00 threshold and requires manual approval.

----- ACTION REQUIRED -----

APPROVE: ' || approve_url || '

REJECT: ' || reject_url || '

Click one of the links above to approve or reject this invoice.'""".replace("{amount}", _money("total_number"))


def _audit() -> str:
    """Every rule of the audit that the stored tables and the raw documents are held to."""
    def row(scope, rule, table, column, count):
        return f"SELECT '{scope}' AS scope, '{rule}' AS rule, '{table}' AS table_name, '{column}' AS column_name, CAST(({count}) AS BIGINT) AS violations"

    limits = {"vendor_name": 255, "vendor_email": 255, "payment_terms": 255, "vendor_phone": 50, "customer_name": 255,
              "customer_email": 255, "invoice_number": 100, "status": 50, "s3_key": 500, "s3_bucket": 255,
              "po_number": 100, "bank_name": 255, "account_number": 100, "routing_number": 100}
    rules = {
        "vendors": ["not_null vendor_id", "unique vendor_id", "not_null vendor_name", "max_length vendor_name", "max_length vendor_email",
                    "max_length payment_terms", "max_length vendor_phone", "unique vendor_name"],
        "customers": ["not_null customer_id", "unique customer_id", "max_length customer_name", "max_length customer_email"],
        "invoices": ["not_null invoice_id", "unique invoice_id", "not_null invoice_number", "not_null invoice_date", "not_null total_amount",
                     "max_length invoice_number", "max_length status", "max_length s3_key",
                     "max_length s3_bucket", "max_length po_number", "max_length payment_terms",
                     "precision subtotal", "precision tax_amount", "precision total_amount",
                     "precision discount", "precision confidence_score", "unique invoice_number",
                     "foreign_key vendor_id vendors", "foreign_key customer_id customers"],
        "invoice_line_items": ["not_null description", "precision quantity", "precision unit_price",
                               "precision amount", "foreign_key invoice_id invoices"],
        "bank_details": ["not_null bank_id", "unique bank_id", "max_length bank_name", "max_length account_number", "max_length routing_number",
                         "foreign_key vendor_id vendors"],
    }

    def count(table, rule, column, target=None):
        if rule == "unique":
            return f"SELECT count(*) FROM (SELECT {column} FROM {table} GROUP BY 1 HAVING count(*) > 1)"
        if rule == "foreign_key":
            return f"SELECT count(*) FROM {table} t ANTI JOIN {target} u ON u.{column} = t.{column}"
        longest = 50 if (table, column) == ("vendors", "payment_terms") else limits.get(column)
        whole = {"quantity": "1e8", "confidence_score": "1e3"}.get(column, "1e10")
        bad = {"not_null": f"{column} IS NULL", "max_length": f"length({column}) > {longest}",
               "precision": f"abs({column}) >= {whole}"}[rule]
        return f"SELECT count(*) FROM {table} WHERE {bad}"

    tables = """,
        vendors AS (SELECT vendor_id, company_name AS vendor_name, CAST(NULL AS VARCHAR) AS vendor_email,
            arg_min_null(payment_terms, arrival) AS payment_terms, arg_max_null(company_contact, arrival) AS vendor_phone
          FROM accepted GROUP BY 1, 2),
        customers AS (SELECT customer_id, bill_to AS customer_name, client_email AS customer_email FROM accepted),
        invoice_line_items AS (SELECT l.* FROM lines l SEMI JOIN invoices i ON i.invoice_id = l.invoice_id),
        bank_details AS (SELECT k AS bank_id, vendor_id, bank_name, account_number, routing_number FROM accepted WHERE bank_name <> '')
        """
    rows = []
    for table, texts in rules.items():
        for text in texts:
            rule, column, *target = text.split(" ")
            rows.append(row("stored", rule, table, column, count(table, rule, column, *target)))
    rows += [
        row("documents", "not_null", "invoices", "invoice_number", "SELECT count(*) FROM typed WHERE invoice_number IS NULL"),
        row("documents", "not_null", "invoices", "invoice_date", "SELECT count(*) FROM typed WHERE invoice_day IS NULL"),
        row("documents", "not_null", "invoices", "total_amount", "SELECT count(*) FROM typed WHERE total_value IS NULL"),
        row("documents", "max_length", "invoices", "invoice_number", "SELECT count(*) FROM typed WHERE length(invoice_number) > 100"),
        row("documents", "precision", "invoices", "total_amount", "SELECT count(*) FROM typed WHERE abs(total_value) >= 1e10"),
        row("documents", "unique", "invoices", "invoice_number",
            "SELECT count(*) FROM (SELECT invoice_number FROM typed GROUP BY 1 HAVING count(*) > 1)"),
        row("documents", "not_null", "vendors", "vendor_name", "SELECT count(*) FROM typed WHERE company_name IS NULL"),
        row("documents", "max_length", "vendors", "vendor_name", "SELECT count(*) FROM typed WHERE length(company_name) > 255"),
        row("documents", "unique", "vendors", "vendor_name",
            "SELECT count(*) FROM (SELECT company_name FROM typed GROUP BY 1 HAVING count(*) > 1)"),
    ]
    return f"WITH {LINES}{tables}" + " UNION ALL ".join(rows)


def _broken() -> str:
    """Every rule over tables made to break it; counted by the plainest query for each."""
    tables = """
        base AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS ordered, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
        invoices AS (SELECT CASE WHEN k % 101 <> 0 THEN k // 2 * 2 END AS invoice_id,
            CASE WHEN k % 40 = 3 THEN 'same' WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN rpad('n', 101, '*') ELSE CAST(k AS VARCHAR) END AS invoice_number,
            k % 7 AS vendor_id, k AS customer_id, CASE WHEN k % 11 <> 0 THEN ordered END AS invoice_date,
            CAST(cents * CASE WHEN k % 13 = 0 THEN 1000 ELSE 0 END AS DECIMAL(38,2)) AS total_amount FROM base),
        vendors AS (SELECT k % 5 AS vendor_id, CASE WHEN k % 3 <> 0 THEN 'v' || (k % 5) END AS vendor_name FROM base),
        customers AS (SELECT k AS customer_id, rpad('c', 256, '*') AS customer_name FROM base WHERE k % 2 = 0),
        invoice_line_items AS (SELECT k * 2 AS invoice_id, k % 9 AS line_item_id, CASE WHEN k % 4 > 0 THEN 'x' END AS description,
            CASE WHEN k % 6 = 0 THEN 1e9 ELSE 1 END AS quantity FROM base),
        bank_details AS (SELECT k AS bank_id, k % 6 AS vendor_id, rpad('a', 101, '*') AS account_number FROM base),
        extraction_log AS (SELECT k % 50 AS log_id, k * 3 AS invoice_id FROM base)"""
    rules = [("not_null", t, c, f"{c} IS NULL") for t, c in (
        ("vendors", "vendor_id"), ("vendors", "vendor_name"), ("customers", "customer_id"), ("invoices", "invoice_id"),
        ("invoices", "invoice_number"), ("invoices", "invoice_date"), ("invoices", "total_amount"),
        ("invoice_line_items", "line_item_id"), ("invoice_line_items", "description"), ("bank_details", "bank_id"), ("extraction_log", "log_id"))]
    rules += [("max_length", t, c, f"length({c}) > {n}") for t, c, n in (
        ("vendors", "vendor_name", 255), ("customers", "customer_name", 255), ("invoices", "invoice_number", 100), ("bank_details", "account_number", 100))]
    rules += [("precision", "invoices", "total_amount", "total_amount >= 1e10"), ("precision", "invoice_line_items", "quantity", "quantity >= 1e8")]
    parts = [(r, t, c, f"SELECT count(*) FROM {t} WHERE {bad}") for r, t, c, bad in rules]
    parts += [("unique", t, c, f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)") for t, c in (
        ("vendors", "vendor_id"), ("vendors", "vendor_name"), ("customers", "customer_id"), ("invoices", "invoice_id"), ("invoices", "invoice_number"),
        ("invoice_line_items", "line_item_id"), ("bank_details", "bank_id"), ("extraction_log", "log_id"))]
    parts += [("foreign_key", t, c, f"SELECT count(*) FROM {t} t ANTI JOIN {u} u ON u.{c} = t.{c} WHERE t.{c} IS NOT NULL") for t, c, u in (
        ("invoices", "vendor_id", "vendors"), ("invoices", "customer_id", "customers"), ("invoice_line_items", "invoice_id", "invoices"),
        ("bank_details", "vendor_id", "vendors"), ("extraction_log", "invoice_id", "invoices"))]
    return f"WITH {tables} " + " UNION ALL ".join(
        f"SELECT '{r}' AS rule, '{t}' AS table_name, '{c}' AS column_name, CAST(({q}) AS BIGINT) AS violations" for r, t, c, q in parts)


def oracles() -> dict[str, str]:
    sql = {
        "extract_flatten": f"""WITH {DECIDED}
            SELECT arrival, s3_bucket, s3_key, invoice_number, company_name, company_address, company_contact,
              bill_to, client_email, invoice_date, due_date, po_number, subtotal, discount, tax, total_amount,
              payment_terms, payment_instructions, bank_name, account_number, routing_number, confidence_score,
              k % 4 AS item_count,
              array_to_string([('item-' || (k % 97) || '-' || i) FOR i IN generate_series(1, k % 4)], ';') AS descriptions,
              CAST(0 AS BIGINT) AS shape_error_count
            FROM typed""",
        "cast_invoice": f"""WITH {DECIDED}
            SELECT arrival, invoice_day AS invoice_date, due_day AS due_date, subtotal_value AS subtotal,
              discount_value AS discount, tax_value AS tax_amount, total_value AS total_amount FROM typed""",
        "confidence_score": f"WITH {DECIDED} SELECT arrival, confidence, confidence_score FROM typed",
        "normalize_discount": f"""WITH {DECIDED}
            SELECT discount AS discount_text, discount_value AS discount, count(*) AS n FROM typed GROUP BY 1, 2""",
        "result_file_filter": f"""WITH {DOCS}
            SELECT s3_key, CASE WHEN k % 11 = 0 THEN 'Skipped' ELSE 'Processed' END AS message, 'job-' || k AS job_id
            FROM docs""",
        "intake_manifest": """
            SELECT 200 AS status_code, key AS original_key, 's3://incoming/' || key AS input_uri,
              'arn:job/' || k AS invocation_arn, CAST(k AS VARCHAR) AS job_id,
              'Processing started for ' || key AS message, CAST(k AS VARCHAR) AS tag_job, 'in_progress' AS tag_state
            FROM (SELECT o_orderkey AS k, 'invoice_' || o_orderkey || '_' || copy || '.pdf' AS key
                  FROM orders, (VALUES ('a'), ('b')) t(copy) WHERE o_orderkey % 6 <> 0)""",
        "validate_extractions": f"""WITH {DECIDED}
            SELECT arrival, array_to_string(errors, '; ') AS errors, warnings, len(errors) = 0 AS is_valid,
              confidence < 70 AS needs_review FROM checked""",
        "decide_status": f"WITH {DECIDED} SELECT arrival, status FROM decided",
        "outcome_split": f"""WITH {STORED},
            marked AS (SELECT d.*, a.arrival IS NOT NULL AS ok FROM decided d LEFT JOIN
              (SELECT arrival FROM accepted) a ON a.arrival = d.arrival)
            SELECT arrival, s3_key, CASE WHEN ok THEN 200 ELSE 500 END AS status_code,
              CASE WHEN ok THEN k END AS invoice_id, CASE WHEN ok THEN invoice_number END AS invoice_number,
              CASE WHEN ok THEN status END AS status,
              CASE WHEN ok THEN NULL ELSE coalesce(error, 'duplicate invoice_number') END AS error FROM marked""",
        "extraction_log": f"""WITH {STORED},
            marked AS (SELECT d.*, a.arrival IS NOT NULL AS ok FROM decided d LEFT JOIN
              (SELECT arrival FROM accepted) a ON a.arrival = d.arrival)
            SELECT arrival, CASE WHEN ok THEN k END AS invoice_id, processed_at AS extraction_timestamp,
              confidence_score AS overall_confidence, ok AS success,
              CASE WHEN ok THEN NULL ELSE coalesce(error, 'duplicate invoice_number') END AS error_message,
              po_number AS raw_po FROM marked""",
        "dedupe_invoices": f"WITH {STORED} SELECT * EXCLUDE (vendor_name, s3_bucket) FROM invoices",
        "upsert_vendors": f"""WITH {STORED}
            SELECT arg_min_null(vendor_id, arrival) AS vendor_id, company_name AS vendor_name,
              CAST(NULL AS VARCHAR) AS vendor_email, arg_min_null(payment_terms, arrival) AS payment_terms,
              true AS is_approved, arg_max_null(company_address, arrival) AS vendor_address,
              arg_max_null(company_contact, arrival) AS vendor_phone, min(processed_at) AS created_at
            FROM accepted GROUP BY company_name""",
        "append_customers": f"""WITH {STORED}
            SELECT customer_id, bill_to AS customer_name, bill_to AS customer_address,
              client_email AS customer_email, processed_at AS created_at FROM accepted""",
        "explode_line_items": f"""WITH {STORED},
            items AS (SELECT k, unnest(generate_series(1, k % 4)) AS i FROM accepted)
            SELECT k AS invoice_id, 'item-' || (k % 97) || '-' || i AS description,
              CAST(1 + (k + i) % 50 AS DECIMAL(10,2)) AS quantity,
              {_cents("1025 + (k * 7 + i) % 90 * 100")} AS unit_price,
              {_cents("(1025 + (k * 7 + i) % 90 * 100) * (1 + (k + i) % 50)")} AS amount,
              CAST(i AS INTEGER) AS line_number FROM items""",
        "invoice_lines": f"""WITH {LINES}
            SELECT l.* FROM lines l SEMI JOIN invoices i ON i.invoice_id = l.invoice_id""",
        "append_bank_details": f"""WITH {STORED}
            SELECT k AS bank_id, vendor_id, bank_name, account_number, routing_number, processed_at AS created_at
            FROM accepted WHERE bank_name <> ''""",
        "summary_totals": f"""WITH {STORED}
            SELECT count(*) AS total_invoices, CAST(sum(total_amount) AS {WIDE}) AS total_amount,
              CAST(CAST(sum(total_amount) AS {WIDE}) AS DOUBLE) / count(total_amount) AS avg_amount FROM invoices""",
        "summary_display": f"""WITH {STORED}
            SELECT count(*) AS total_invoices, {_money("sum(total_amount)")} AS total_amount,
              {_money("CAST(sum(total_amount) AS DOUBLE) / count(total_amount)")} AS avg_amount FROM invoices""",
        "monthly_trend": f"WITH {MONTHS} SELECT * FROM months",
        "monthly_trend_bars": f"""WITH {MONTHS}
            SELECT month, strftime(month, '%B %Y') AS label, invoice_count, {_money("total_amount")} AS amount,
              {_money("total_amount", 0)} AS bar_text,
              CAST(total_amount AS DOUBLE) / (SELECT CAST(max(total_amount) AS DOUBLE) FROM months) * 100 AS width_pct
            FROM months""",
        "status_breakdown": f"WITH {STATUSES} SELECT * FROM statuses",
        "status_breakdown_bars": f"""WITH {STATUSES}
            SELECT upper(status) AS label, {CLASS} AS css_class, invoice_count, {_money("total_amount")} AS amount,
              CAST(invoice_count AS DOUBLE) / (SELECT CAST(max(invoice_count) AS DOUBLE) FROM statuses) * 100 AS width_pct
            FROM statuses""",
        "top_vendors": f"WITH {TOP} SELECT * FROM top",
        "top_vendors_display": f"WITH {TOP} SELECT vendor_name, invoice_count, {_money('total_amount')} AS amount FROM top",
        "recent_invoices": f"WITH {RECENT} SELECT invoice_number, vendor_name, total_amount, status, processed_at FROM recent",
        "recent_invoices_display": f"""WITH {RECENT}
            SELECT invoice_number, vendor_name, {_money("total_amount")} AS amount, upper(status) AS label,
              {CLASS} AS css_class, strftime(processed_at, '%Y-%m-%d %H:%M') AS processed FROM recent""",
        "invoice_listing": f"""WITH {RECENT}
            SELECT invoice_id, invoice_number, vendor_name, total_amount, status, processed_at FROM recent""",
        "latest_invoice_detail": f"""WITH {LINES}
            SELECT invoice_number, vendor_name, invoice_date, due_date, subtotal, discount, tax_amount, total_amount,
              status, confidence_score, po_number, payment_terms FROM newest""",
        "latest_invoice_display": f"""WITH {LINES}
            SELECT invoice_number, vendor_name, invoice_date, due_date, po_number, payment_terms,
              {_money("subtotal")} AS subtotal, '-' || {_money("abs(discount)")} AS discount,
              {_money("tax_amount")} AS tax, {_money("total_amount")} AS total, status,
              CAST(confidence_score AS VARCHAR) || '%' AS confidence FROM newest""",
        "latest_invoice_lines": f"""WITH {LINES}
            SELECT line_number, description, quantity, unit_price, amount,
              description || ': ' || quantity || ' x ' || {_money("unit_price")} || ' = ' || {_money("amount")} AS display
            FROM lines WHERE invoice_id = (SELECT invoice_id FROM newest)""",
        "latest_line_total": f"""WITH {LINES}
            SELECT CAST(coalesce(sum(amount), 0) AS {WIDE}) AS line_total, count(*) AS line_count,
              {_money("sum(amount)")} AS shown_total
            FROM lines WHERE invoice_id = (SELECT invoice_id FROM newest)""",
        "latest_invoice_bank": f"""WITH {LINES}
            SELECT bank_name, account_number, routing_number FROM accepted
            WHERE bank_name <> '' AND vendor_id = (SELECT vendor_id FROM newest) ORDER BY k LIMIT 1""",
        "reconcile_totals": f"""WITH {LINES},
            sums AS (SELECT invoice_id, sum(amount) AS line_sum FROM lines GROUP BY 1)
            SELECT i.invoice_id, invoice_number, subtotal, total_amount,
              CAST(coalesce(line_sum, 0) AS {WIDE}) AS line_total,
              CAST(subtotal - discount + tax_amount AS {WIDE}) AS expected_total,
              abs(coalesce(line_sum, 0) - subtotal) <= 0.02 AS lines_match,
              abs(subtotal - discount + tax_amount - total_amount) <= 0.02 AS total_matches
            FROM invoices i LEFT JOIN sums s ON s.invoice_id = i.invoice_id""",
        "notifications": f"""WITH {STORED},
            high AS (SELECT *, 'https://approve.example.org?invoice_id=' || invoice_id || '&action=approve' AS approve_url,
              'https://approve.example.org?invoice_id=' || invoice_id || '&action=reject' AS reject_url
              FROM accepted WHERE total_number > 50000)
            SELECT invoice_id, invoice_number, '🔔 High-Value Invoice Approval Required: ' || invoice_number AS subject,
              {NOTICE} AS body, approve_url, reject_url FROM high""",
        "job_routing": f"""WITH {STORED},
            routed AS (SELECT *, 'job-' || invoice_id AS job_id,
              CASE WHEN invoice_id % 6 <> 0 THEN 'invoice_' || invoice_id || '_a.pdf' END AS source_key FROM invoices)
            SELECT invoice_number, status, job_id, source_key, 's3://incoming/' || source_key AS source,
              's3://' || CASE WHEN status = 'approved' THEN 'processed' ELSE 'failed' END || '/' || source_key AS destination,
              CASE WHEN source_key IS NULL THEN 'no source file' WHEN status = 'approved' THEN 'approved'
                ELSE 'status: ' || status END AS reason FROM routed""",
        "approval_responses": f"""WITH {ACTIONS}
            SELECT action_id, status_code,
              CASE WHEN status_code = 200 AND action = 'approve' THEN 'Invoice Approved'
                WHEN status_code = 200 THEN 'Invoice Rejected'
                WHEN status_code = 404 THEN 'Error: Invoice not found'
                WHEN action IS NULL THEN 'Error: Missing invoice_id or action'
                ELSE 'Error: Action must be approve or reject' END AS title,
              CASE WHEN status_code = 200 THEN invoice_number END AS invoice_number,
              CASE WHEN status_code = 200 THEN vendor_name END AS vendor_name,
              CASE WHEN status_code = 200 THEN {_money("total_amount")} END AS amount,
              CASE WHEN status_code = 200 THEN new_status END AS new_status,
              CASE WHEN status_code = 200 THEN action_time END AS action_time FROM answered""",
        "apply_approvals": f"""WITH {ACTIONS}
            SELECT i.invoice_id, i.invoice_number, coalesce(l.new_status, i.status) AS status,
              coalesce(l.action_time, i.processed_at) AS processed_at
            FROM invoices i LEFT JOIN last_action l ON l.invoice_id = i.invoice_id""",
        "status_history": f"""WITH {ACTIONS}
            SELECT action_id, invoice_id, invoice_number,
              coalesce(lag(new_status) OVER (PARTITION BY invoice_id ORDER BY action_time, action_id), initial_status)
                AS previous_status, new_status, action_time FROM answered WHERE status_code = 200""",
        "approval_pages": f"""WITH {ACTIONS}
            SELECT action_id, CASE WHEN action = 'approve' THEN 'Invoice Approved' ELSE 'Invoice Rejected' END AS title,
              invoice_number, vendor_name, {_money("total_amount")} AS amount,
              coalesce(lag(new_status) OVER (PARTITION BY invoice_id ORDER BY action_time, action_id), initial_status)
                AS previous_status, new_status, strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time
            FROM answered WHERE status_code = 200""",
        "constraint_audit": _audit(),
        "schema_align": f"""WITH {STORED}
            SELECT invoice_id, invoice_number, total_amount,
              CASE WHEN invoice_id % 2 = 0 THEN 'pending' ELSE status END AS status,
              CASE WHEN invoice_id % 2 = 0 THEN 0 ELSE discount END AS discount,
              CASE WHEN invoice_id % 2 = 1 THEN po_number END AS po_number,
              CASE WHEN invoice_id % 2 = 1 THEN confidence_score END AS confidence_score FROM invoices""",
        "stream_approvals": f"""WITH {ACTIONS}
            SELECT coalesce(l.new_status, i.status) AS status, count(*) AS invoice_count
            FROM invoices i LEFT JOIN last_action l ON l.invoice_id = i.invoice_id GROUP BY 1""",
        "generate_invoices": f"""WITH {SAMPLES}
            SELECT id, invoice_number, invoice_date, due_date, po_number, customer, email, line_count,
              {_cents("cents", WIDE)} AS subtotal, {_cents("tax_c")} AS tax, {_cents("off_c")} AS discount,
              {_cents("cents - off_c + tax_c")} AS total, filename FROM generated""",
        "generated_totals": f"""WITH {SAMPLES}
            SELECT count(*) AS invoice_count, {_cents("sum(cents - off_c + tax_c)", WIDE)} AS total_value FROM generated""",
        "summary_csv_roundtrip": f"""WITH {SAMPLES}
            SELECT invoice_number, 'ACME CORPORATION' AS vendor, customer, email, invoice_date AS date, due_date,
              {_cents("cents")} AS subtotal, {_cents("tax_c")} AS tax, {_cents("off_c")} AS discount,
              {_cents("cents - off_c + tax_c")} AS total, filename FROM generated""",
    }
    sql["merge_vendors"] = sql["upsert_vendors"]
    sql["generated_documents"] = f"""WITH {SAMPLES},
        decided AS (SELECT (cents - off_c + tax_c) AS c, line_count FROM generated)
        SELECT CASE WHEN c > 5000000 THEN 'pending_review' ELSE 'approved' END AS status, CAST(NULL AS VARCHAR) AS error,
          count(*) AS n, {_cents("sum(c)", WIDE)} AS total_amount, CAST(sum(line_count) AS BIGINT) AS line_count
        FROM decided GROUP BY 1"""
    # Streams look only at result files, so uniqueness is decided among those.
    streamed = STORED.replace("FROM checked)", "FROM checked WHERE k % 11 <> 0)")
    sql["stream_ingest"] = f"""WITH {streamed},
        marked AS (SELECT d.*, a.arrival IS NOT NULL AS ok FROM decided d LEFT JOIN
          (SELECT arrival FROM accepted) a ON a.arrival = d.arrival)
        SELECT arrival, CASE WHEN ok THEN 'persisted' ELSE 'error' END AS outcome, invoice_number, company_name,
          invoice_day AS invoice_date, total_value AS total_amount, status,
          CASE WHEN ok THEN NULL ELSE coalesce(error, 'duplicate invoice_number') END AS error, k % 4 AS item_count
        FROM marked"""
    sql["stream_dashboard"] = f"""WITH {streamed}
        SELECT status, count(*) AS invoice_count, CAST(sum(total_value) AS {WIDE}) AS total_amount
        FROM accepted GROUP BY status"""
    mixed = streamed.replace("ORDER BY arrival) = 1", "ORDER BY k % 3 <> 0, arrival) = 1")
    sql["bulk_then_stream"] = f"""WITH {mixed}
        SELECT d.arrival, CASE WHEN a.arrival IS NOT NULL THEN 'persisted' ELSE 'error' END AS outcome,
          CASE WHEN a.arrival IS NULL THEN coalesce(d.error, 'duplicate invoice_number') END AS error
        FROM decided d LEFT JOIN accepted a ON a.arrival = d.arrival"""
    sql["replayed_dashboard"] = f"""WITH {streamed},
        totals AS (SELECT status, count(*) AS invoice_count, CAST(sum(total_value) AS {WIDE}) AS total_amount FROM accepted GROUP BY status)
        SELECT * FROM totals UNION ALL SELECT 'store ' || status, invoice_count, total_amount FROM totals"""
    sql["split_outcomes"] = f"""WITH {STORED}
        SELECT d.arrival, d.s3_key, a.invoice_number,
          CASE WHEN a.arrival IS NULL THEN coalesce(d.error, 'duplicate invoice_number') END AS error
        FROM decided d LEFT JOIN accepted a ON a.arrival = d.arrival"""
    sql["recent_invoices_partial"] = f"""WITH {STORED},
        top AS (SELECT *, row_number() OVER (ORDER BY processed_at DESC NULLS FIRST, invoice_id) AS place FROM invoices WHERE vendor_id % 3 = 0)
        SELECT part, invoice_number, vendor_name, CASE WHEN part = 'latest' THEN confidence_score END AS score
        FROM top, (VALUES ('recent', 10), ('listing', 10), ('latest', 1)) p(part, n) WHERE place <= n"""
    sql["apply_approvals_vendors"] = f"""WITH {ACTIONS}
        SELECT i.invoice_id, CASE WHEN i.vendor_id % 3 = 0 THEN coalesce(l.new_status, i.status) ELSE i.status END AS status,
          CASE WHEN i.vendor_id % 3 = 0 THEN coalesce(l.action_time, i.processed_at) ELSE i.processed_at END AS processed_at
        FROM invoices i LEFT JOIN last_action l ON l.invoice_id = i.invoice_id"""
    sql["long_names"] = f"""WITH {DECIDED},
        firsts AS (SELECT * FROM decided WHERE error IS NULL QUALIFY row_number() OVER (PARTITION BY k // 2 ORDER BY arrival) = 1)
        SELECT 'invoices' AS what, count(*) AS n FROM firsts
        UNION ALL SELECT 'vendors', count(DISTINCT company_name) FROM firsts UNION ALL SELECT 'violations', 0"""
    # 41 forms that are dates, 16 that are none, and the Julian day
    sql["date_forms"] = """
        SELECT o_orderkey AS arrival, CAST(o_orderkey % 58 AS INTEGER) AS form,
          CASE WHEN o_orderkey % 58 NOT BETWEEN 41 AND 56 THEN CAST(o_orderdate AS DATE) END AS day FROM orders"""
    sql["exact_money"] = r"""
        SELECT arrival, '$' || ltrim(reverse(regexp_replace(reverse(CAST(c // 100 AS VARCHAR)), '(\d{3})', '\1,', 'g')), ',')
          || '.' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS shown
        FROM (SELECT o_orderkey AS arrival, CAST(o_orderkey AS HUGEINT) * 123456789012 + 123456789012345678907 AS c FROM orders)"""
    turn = f"o_orderkey % {len(FAULTS) + 1}"
    reasons = " ".join(f"WHEN {i} THEN '{reason}'" for i, (reason, _) in enumerate(FAULTS) if reason)
    # what the status rules say of a document is independent of whether it can be stored
    no_total = [i for i, (reason, _) in enumerate(FAULTS) if reason == "total_amount not a number"] + [0]
    invalid = [i for i, (reason, changes) in enumerate(FAULTS)
               if reason in ("invoice_number missing", "company_name missing")]
    high = [i for i, (reason, _) in enumerate(FAULTS) if reason == "total_amount not storable"]
    sql["outcome_reasons"] = f"""
        SELECT o_orderkey AS arrival, CASE {turn} {reasons} END AS error,
          CASE WHEN {turn} IN ({", ".join(map(str, no_total))}) THEN NULL WHEN {turn} IN ({", ".join(map(str, invalid))}) THEN 'failed'
            WHEN {turn} IN ({", ".join(map(str, high))}) THEN 'pending_review' ELSE 'approved' END AS status FROM orders"""
    sql["stream_answers"] = sql["approval_responses"]
    sql["audit_broken"] = _broken()
    sql["tables_round_trip"] = f"""WITH {LINES}
        SELECT 'vendors' AS table_name, count(DISTINCT vendor_id) AS n, CAST(0 AS {WIDE}) AS total FROM accepted
        UNION ALL SELECT 'customers', count(*), CAST(sum(length(bill_to)) AS {WIDE}) FROM accepted
        UNION ALL SELECT 'invoices', count(*), CAST(sum(total_amount) AS {WIDE}) FROM invoices
        UNION ALL SELECT 'invoice_line_items', count(*), CAST(sum(amount) AS {WIDE}) FROM lines l SEMI JOIN invoices i ON i.invoice_id = l.invoice_id
        UNION ALL SELECT 'bank_details', count(*), CAST(sum(length(account_number)) AS {WIDE}) FROM accepted WHERE bank_name <> ''"""
    sql["dashboard_output"] = f"""WITH {MONTHS},
        statuses AS (SELECT status, CAST(sum(total_amount) AS {WIDE}) AS total_amount FROM invoices GROUP BY status),
        top AS (SELECT vendor_name, CAST(sum(total_amount) AS {WIDE}) AS total_amount FROM invoices GROUP BY vendor_name ORDER BY 2 DESC, 1 LIMIT 5),
        recent AS (SELECT total_amount FROM invoices ORDER BY processed_at DESC NULLS FIRST, invoice_id LIMIT 10)
        SELECT 'summary' AS result, CAST(1 AS BIGINT) AS n, CAST(sum(total_amount) AS {WIDE}) AS largest FROM invoices
        UNION ALL SELECT 'monthly', count(*), max(total_amount) FROM months
        UNION ALL SELECT 'status', count(*), max(total_amount) FROM statuses
        UNION ALL SELECT 'vendors', count(*), max(total_amount) FROM top
        UNION ALL SELECT 'recent', count(*), CAST(max(total_amount) AS {WIDE}) FROM recent"""
    from inkledger.checks.store_oracle import oracles as of_stores  # needs this module first

    return {**sql, **of_stores(sql)}
