"""SQL twins of ``store_queries``."""

from __future__ import annotations

from inkledger.checks.oracle import DECIDED, MONTHS, STORED, WIDE

# streams and loads look only at result files
FILES = ("FROM checked)", "FROM checked WHERE k % 11 <> 0)")
STREAMED = STORED.replace(*FILES)


def _outcomes(cte: str, columns: str = "") -> str:
    return f"""WITH {cte}
        SELECT {columns} d.arrival, CASE WHEN a.arrival IS NOT NULL THEN 'persisted' ELSE 'error' END AS outcome,
          CASE WHEN a.arrival IS NULL THEN coalesce(d.error, 'duplicate invoice_number') END AS error
        FROM decided d LEFT JOIN accepted a ON a.arrival = d.arrival"""


def _results(cte: str) -> str:
    none = f"CAST(NULL AS {WIDE})"
    rest = "CAST(NULL AS DOUBLE) AS average, CAST(NULL AS VARCHAR) AS vendor_name, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS TIMESTAMP) AS processed_at"
    return f"""WITH {cte},
        statuses AS (SELECT status, count(*) AS n, CAST(sum(total_amount) AS {WIDE}) AS total_amount FROM invoices GROUP BY status),
        top AS (SELECT vendor_name, count(*) AS n, CAST(sum(total_amount) AS {WIDE}) AS total_amount FROM invoices GROUP BY vendor_name
                ORDER BY 3 DESC, 1 LIMIT 5),
        recent AS (SELECT * FROM invoices ORDER BY processed_at DESC NULLS FIRST, invoice_id LIMIT 10)
        SELECT 'summary' AS result, CAST(NULL AS VARCHAR) AS label, count(*) AS n, CAST(sum(total_amount) AS {WIDE}) AS total_amount,
          CAST(CAST(sum(total_amount) AS {WIDE}) AS DOUBLE) / count(total_amount) AS average, CAST(NULL AS VARCHAR) AS vendor_name,
          CAST(NULL AS VARCHAR) AS status, CAST(NULL AS TIMESTAMP) AS processed_at FROM invoices
        UNION ALL SELECT 'monthly', CAST(month AS VARCHAR), invoice_count, total_amount, {rest} FROM months
        UNION ALL SELECT 'status', status, n, total_amount, {rest} FROM statuses
        UNION ALL SELECT 'vendors', vendor_name, n, total_amount, {rest} FROM top
        UNION ALL SELECT 'recent', invoice_number, NULL, CAST(total_amount AS {WIDE}), NULL, vendor_name, status, processed_at FROM recent"""


def oracles(of: dict[str, str]) -> dict[str, str]:
    """Twins of the store's queries; ``of`` has those of the queries that they must agree with."""
    first, second = (STREAMED.replace("WHERE k % 11 <> 0)", f"WHERE k % 11 <> 0 AND k % 3 <> {i})") for i in (0, 1))
    return {
        "stream_routing": of["job_routing"],
        "stream_history": of["status_history"],
        # nothing differs from the full audit after any delivery, and after the last all is there
        "audit_delta": f"SELECT *, 'after 3' AS scope FROM ({of['audit_broken']})",
        "file_ingest": f"""WITH {DECIDED}
            SELECT 'results' AS s3_bucket, s3_key, invoice_number, status, error FROM decided WHERE k % 11 <> 0
            UNION ALL SELECT NULL, s3_key, NULL, NULL, 'Skipped' FROM decided WHERE k % 11 = 0""",
        "broken_load": _outcomes(STREAMED),
        "partial_commit": f"""WITH {STORED.replace(FILES[0], "FROM checked WHERE k % 11 <> 0 AND k % 2 = 0)")}
            SELECT CASE WHEN a.arrival IS NOT NULL THEN 'persisted' ELSE 'error' END AS what, count(*) AS n
            FROM decided d LEFT JOIN accepted a ON a.arrival = d.arrival GROUP BY 1
            UNION ALL SELECT status, count(*) FROM accepted GROUP BY 1""",
        # the second writer's documents whose number the first has stored are out before its own are compared
        "two_writers": f"""WITH one AS (WITH {first} SELECT d.*, a.arrival IS NOT NULL AS ok FROM decided d LEFT JOIN (SELECT arrival FROM accepted) a ON a.arrival = d.arrival),
            two AS (WITH {second} SELECT d.*, a.arrival IS NOT NULL AND d.invoice_number NOT IN (SELECT invoice_number FROM one WHERE ok) AS ok
                    FROM decided d LEFT JOIN (SELECT arrival FROM accepted) a ON a.arrival = d.arrival)
            SELECT source, arrival, CASE WHEN ok THEN 'persisted' ELSE 'error' END AS outcome,
              CASE WHEN NOT ok THEN coalesce(error, 'duplicate invoice_number') END AS error
            FROM (SELECT 'writer0' AS source, arrival, ok, error FROM one UNION ALL SELECT 'writer1', arrival, ok, error FROM two)""",
        "live_dashboard": _results(MONTHS.replace(*FILES)),
        "dashboard_results": _results(MONTHS),
        "stored_vendors": f"""WITH {STREAMED}
            SELECT arg_min_null(vendor_id, arrival) AS vendor_id, company_name AS vendor_name,
              CAST(NULL AS VARCHAR) AS vendor_email, arg_min_null(payment_terms, arrival) AS payment_terms,
              true AS is_approved, arg_max_null(company_address, arrival) AS vendor_address,
              arg_max_null(company_contact, arrival) AS vendor_phone, min(processed_at) AS created_at
            FROM accepted GROUP BY company_name""",
        "merged_store": _outcomes(STREAMED, "'stream' AS writer,") + f"""
            UNION ALL SELECT 'again', arrival, 'error', coalesce(error, 'duplicate invoice_number') FROM (WITH {STREAMED} SELECT * FROM decided) WHERE k % 7 = 0""",
    }
