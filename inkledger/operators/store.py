"""The stored tables as projections and aggregates of the accepted documents.

Nothing is updated in place: an accepted document is one row with its vendor, customer,
lines and bank inside, so writing it is the whole transaction, and each table follows
from the set of accepted rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkledger.functions.parse import stable_id
from inkledger.model import MAX_LENGTH


def assign_keys(accepted: DataFrame, invoice_id: Column | None = None, vendor_id: Column | None = None,
                customer_id: Column | None = None) -> DataFrame:
    """Ids as functions of the natural keys; a customer row belongs to its invoice."""
    invoice = invoice_id if invoice_id is not None else stable_id(F.lit("invoice"), F.col("invoice_number"))
    vendor = vendor_id if vendor_id is not None else stable_id(F.lit("vendor"), F.col("company_name"))
    customer = customer_id if customer_id is not None else stable_id(
        F.lit("customer"), F.col("invoice_number"))
    return accepted.withColumns({"invoice_id": invoice, "vendor_id": vendor, "customer_id": customer})


def _stored(name: str, table: str, column: str) -> Column:
    """Text cut to the column's length (only spaces can be cut, see the outcome rules)."""
    return F.left(F.col(name), F.lit(MAX_LENGTH[table][column])).alias(column)


def vendor_state(accepted: DataFrame) -> DataFrame:
    """Per vendor name what its first document fixed and what its last one set.

    Both carry their place in the order, so states of disjoint sets of documents merge.  The
    first and last arrivals are numbers and aggregated by hash before the shuffle; only the
    documents at those arrivals, a few per vendor, are then fetched with their texts.
    """
    ends = accepted.groupBy("company_name").agg(F.min("arrival").alias("low"), F.max("arrival").alias("high"))
    ends = ends.select("company_name", F.explode(F.array_distinct(F.array("low", "high"))).alias("arrival"))
    # both keys: a vendor with most of the documents is spread by their arrivals
    rows = accepted.select("company_name", "arrival", "s3_key", "vendor_id", "payment_terms", "processed_at",
                           "company_address", "company_contact").join(ends, ["company_name", "arrival"])
    first = F.min(F.struct("arrival", "s3_key", "vendor_id", "payment_terms", "processed_at"))
    last = F.max(F.struct("arrival", "s3_key", "company_address", "company_contact"))
    return rows.groupBy("company_name").agg(first.alias("first"), last.alias("last"))


def merge_vendor_states(*states: DataFrame) -> DataFrame:
    """The state of all documents from the states of their parts, e.g. earlier ones and a new batch."""
    merged = reduce(DataFrame.unionByName, states)
    return merged.groupBy("company_name").agg(F.min("first").alias("first"), F.max("last").alias("last"))


def vendors_of(state: DataFrame) -> DataFrame:
    return state.select(
        F.col("first.vendor_id").alias("vendor_id"),
        _stored("company_name", "vendors", "vendor_name"),
        F.lit(None).cast("string").alias("vendor_email"),
        _stored("first.payment_terms", "vendors", "payment_terms"),
        F.lit(True).alias("is_approved"),
        F.col("last.company_address").alias("vendor_address"),
        _stored("last.company_contact", "vendors", "vendor_phone"),
        F.col("first.processed_at").alias("created_at"))


def upsert_vendors(accepted: DataFrame) -> DataFrame:
    """One row per vendor name: address and phone of the last document, nulls included;
    id, terms and creation time of the first."""
    return vendors_of(vendor_state(accepted))


def append_customers(accepted: DataFrame) -> DataFrame:
    """One customer row per stored invoice; there is no key that would merge them."""
    return accepted.select(
        "customer_id", _stored("bill_to", "customers", "customer_name"),
        F.col("bill_to").alias("customer_address"),
        _stored("client_email", "customers", "customer_email"),
        F.col("processed_at").alias("created_at"))


def build_invoices(accepted: DataFrame) -> DataFrame:
    return accepted.select(
        "invoice_id", _stored("invoice_number", "invoices", "invoice_number"), "vendor_id",
        F.col("invoice_day").alias("invoice_date"), F.col("due_day").alias("due_date"),
        F.col("subtotal_value").alias("subtotal"), F.col("tax_value").alias("tax_amount"),
        F.col("total_value").alias("total_amount"), "status",
        _stored("s3_key", "invoices", "s3_key"), "processed_at",
        F.lit(None).cast("timestamp").alias("approved_at"),
        F.lit(None).cast("timestamp").alias("paid_at"),
        "customer_id", F.col("discount_value").alias("discount"), "payment_instructions",
        "confidence_score", _stored("s3_bucket", "invoices", "s3_bucket"),
        F.col("processed_at").alias("created_at"),
        _stored("po_number", "invoices", "po_number"),
        _stored("payment_terms", "invoices", "payment_terms"))


def explode_line_items(accepted: DataFrame) -> DataFrame:
    """One row per line, numbered from 1 in document order."""
    line = accepted.select("invoice_id", F.inline("lines"))
    return line.select(
        stable_id(F.lit("line"), F.col("invoice_id"), F.col("line_number")).alias("line_item_id"),
        "invoice_id", "description", "quantity", "unit_price", "amount", "line_number")


def append_bank_details(accepted: DataFrame) -> DataFrame:
    """One row per stored invoice that names a bank."""
    return accepted.filter("present.bank_name").select(
        stable_id(F.lit("bank"), F.col("invoice_id")).alias("bank_id"), "vendor_id",
        _stored("bank_name", "bank_details", "bank_name"),
        _stored("account_number", "bank_details", "account_number"),
        _stored("routing_number", "bank_details", "routing_number"),
        F.col("processed_at").alias("created_at"))


def project_tables(accepted: DataFrame) -> dict[str, DataFrame]:
    return {
        "vendors": upsert_vendors(accepted),
        "customers": append_customers(accepted),
        "invoices": build_invoices(accepted),
        "invoice_line_items": explode_line_items(accepted),
        "bank_details": append_bank_details(accepted),
    }
