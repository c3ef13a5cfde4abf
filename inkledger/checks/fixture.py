"""The star-schema tables seen as invoice documents, tables, actions and files.

One order is one document.  ``k`` is its order key and its arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkledger.model import JOB_TAG, MONEY, QUANTITY
from inkledger.operators.decide import dedupe_invoices, mark_duplicates, process_documents
from inkledger.operators.extract import extract_flatten
from inkledger.operators.hot import number_within
from inkledger.operators.store import (
    append_bank_details, append_customers, assign_keys, build_invoices, project_tables, upsert_vendors,
)
from inkledger.session import shared_dir, stored

BUCKET = "results"


def _long(n: int) -> str:
    return '"' + "x" * n + '"'


#: A document without fault: field and JSON text.
SOUND = {
    "company_name": '"Acme"', "company_address": '"1 Road"', "company_contact_information": '"555"', "bill_to": '"Bob"',
    "client_email": '"b@example.org"', "invoice_date": '"2025-11-20"', "due_date": '"2025-12-20"', "po_number": '"PO-1"',
    "subtotal": '"90.00"', "discount": '"0"', "tax": "10.5", "total_amount": '"100.50"', "payment_terms": '"NET-30"',
    "payment_details": '{"payment_instructions":"wire"}',
    "bank_details": '{"bank_name":"First","account_number":"1","routing_number":"2"}',
    "invoice_items": '[{"description":"x","quantity":1,"unit_price":"90.00","amount":"90.00"}]',
}
#: (reason, changed fields) of each turn; turns with a name of their own change something else.
FAULTS = [
    ("document shape", {}), ("document shape", {"bank_details": '"text"'}), ("document shape", {"invoice_items": '{"a":1}'}),
    ("document shape", {"po_number": "[1]"}), ("document shape", {"invoice_date": "20251120"}),
    ("total_amount not a number", {"total_amount": '"N/A"'}), ("company_name missing", {"company_name": "null"}),
    ("vendor_name too long", {"company_name": _long(256)}), ("vendor_phone too long", {"company_contact_information": _long(51)}),
    ("payment_terms too long", {"payment_terms": _long(51)}), ("customer_name too long", {"bill_to": _long(256)}),
    ("customer_email too long", {"client_email": _long(256)}), ("discount not a number", {"discount": '"ten"'}),
    ("invoice_number missing", {}), ("invoice_number too long", {}), ("invoice_date missing or not a date", {"invoice_date": '"soon"'}),
    ("due_date not a date", {"due_date": '"2025-13-01"'}), ("subtotal not storable", {"subtotal": '"1e11"'}), ("tax not storable", {"tax": '"x"'}),
    ("total_amount not storable", {"total_amount": '"1e10"'}), ("po_number too long", {"po_number": _long(101)}),
    ("confidence not storable", {}), ("s3_key too long", {}), ("s3_bucket too long", {}),
    ("line description missing", {"invoice_items": '[{"quantity":1}]'}),
    ("line number not storable", {"invoice_items": '[{"description":"x","quantity":"many"}]'}),
    ("bank_name too long", {"bank_details": '{"bank_name":' + _long(256) + "}"}),
    ("account_number too long", {"bank_details": '{"bank_name":"F","account_number":' + _long(101) + "}"}),
    ("routing_number too long", {"bank_details": '{"bank_name":"F","routing_number":' + _long(101) + "}"}),
    (None, {"bank_details": "null", "payment_details": "null", "discount": "true"}),
]
BROKEN = 0
UNNUMBERED, LONG_NUMBER, UNSURE, LONG_KEY, LONG_BUCKET = (
    [reason for reason, _ in FAULTS].index(r) for r in (
        "invoice_number missing", "invoice_number too long", "confidence not storable", "s3_key too long", "s3_bucket too long"))


def _k() -> Column:
    return F.col("k")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def orders(spark: SparkSession, sf_dir: str, with_customer: bool = False) -> DataFrame:
    """Orders with the supplier that plays the vendor, and the customer when asked for."""
    suppliers = load(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    n_sup = suppliers.agg(F.count(F.lit(1))).scalar()
    base = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), "o_custkey", F.col("o_orderdate").cast("date").alias("ordered"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    # keys are dense from 0, so k % count is a supplier key
    df = base.withColumn("s_suppkey", _k() % n_sup).join(suppliers, "s_suppkey")
    if with_customer:
        customers = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
        df = df.join(customers, "o_custkey")
    return df


def _fields() -> dict[str, Column]:
    """Every document text as a function of the order."""
    total = (F.col("cents") / 500).cast(MONEY)
    discount = F.when(_k() % 5 == 0, F.lit(0)).otherwise(1.25).cast(MONEY)
    tax = (total * 2 / 27).cast(MONEY)
    # every 13th document's parts miss its total by 1.00
    subtotal = (total + discount - tax + F.when(_k() % 13 == 0, 1).otherwise(0)).cast(MONEY)
    return {
        "invoice_number": F.when(_k() % 50 == 7, F.lit(""))
        .when(_k() % 40 == 3, F.concat(F.lit("INV-"), (_k() - 1).cast("string")))
        .otherwise(F.concat(F.lit("INV-"), _k().cast("string"))),
        "company_name": F.col("s_name"),
        "company_address": F.when(_k() % 9 != 0, F.concat(F.lit("addr-"), _k().cast("string"))),
        "company_contact": F.concat(F.lit("tel-"), (_k() % 1000).cast("string")),
        "invoice_date": F.when(_k() % 50 != 11, F.col("ordered").cast("string")),
        "due_date": F.when(_k() % 50 != 11, F.date_add("ordered", 30).cast("string")),
        "po_number": F.concat(F.lit("PO-"), (1000 + _k() % 9000).cast("string")),
        "subtotal": subtotal.cast("string"),
        "discount": F.when(_k() % 5 == 0, F.lit(None)).when(_k() % 2 == 0, F.lit("-1.25")).otherwise(F.lit("1.25")),
        "tax": tax.cast("string"),
        "total_amount": F.when(_k() % 50 == 13, F.lit("N/A")).when(_k() % 50 == 17, F.lit("-5.00"))
        .otherwise(total.cast("string")),
        "payment_terms": F.concat(F.lit("NET-"), (30 * (1 + _k() % 3)).cast("string")),
        "payment_instructions": F.concat(F.lit("quote INV-"), _k().cast("string")),
        "bank_name": F.when(_k() % 4 != 0, F.concat(F.lit("Bank "), (_k() % 7).cast("string"))),
        "account_number": F.concat(F.lit("acct-"), _k().cast("string")),
        "routing_number": F.concat(F.lit("rt-"), (_k() % 100).cast("string")),
    }


def _customer_fields() -> dict[str, Column]:
    return {"bill_to": F.col("c_name"),
            "client_email": F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@example.org"))}


def result_key() -> Column:
    folder = F.when(_k() % 11 == 0, F.lit("standard_output")).otherwise(F.lit("custom_output"))
    return F.concat(F.lit("/job-"), _k().cast("string"), F.lit("/0/"), folder, F.lit("/0/result.json"))


def confidence_fraction() -> Column:
    return (200 - (_k() * 37) % 100) / F.lit(200.0)


def processed_at(arrival: Column) -> Column:
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return start + F.make_dt_interval(mins=arrival.cast("int"))


def _items() -> Column:
    """0 to 3 items computed from the order alone, as a document's list of objects."""
    def item(i: Column) -> Column:
        quantity = 1 + (_k() + i) % 50
        cents = 1025 + (_k() * 7 + i) % 90 * 100
        return F.struct(
            F.concat(F.lit("item-"), (_k() % 97).cast("string"), F.lit("-"), i.cast("string")).alias("description"),
            quantity.cast(QUANTITY).alias("quantity"), (cents / 100).cast(MONEY).alias("unit_price"),
            (cents * quantity / 100).cast(MONEY).alias("amount"))
    return F.filter(F.transform(F.sequence(F.lit(1), F.lit(3)), item),
                    lambda _, i: i < _k() % 4)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as JSON documents (``sources.extractions.DOCUMENT``)."""
    f = {**_fields(), **_customer_fields()}
    renamed = {"company_contact": "company_contact_information"}
    nested = ("payment_instructions", "bank_name", "account_number", "routing_number")
    flat = [f[n].alias(renamed.get(n, n)) for n in f if n not in nested]
    inference = F.struct(
        *flat, F.struct(f["payment_instructions"].alias("payment_instructions")).alias("payment_details"),
        F.struct(*[f[n].alias(n) for n in nested[1:]]).alias("bank_details"), _items().alias("invoice_items"))
    body = F.to_json(F.struct(inference.alias("inference_result"),
                              F.struct(confidence_fraction().alias("confidence")).alias("matched_blueprint")))
    # texts are built and parsed by many tasks, also where the table has few files or row groups
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return orders(spark, sf_dir, True).repartition(tasks, "k").select(
        _k().alias("arrival"), F.lit(BUCKET).alias("s3_bucket"), result_key().alias("s3_key"), body.alias("raw"))


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents, flat."""
    return extract_flatten(documents(spark, sf_dir))


def keyed(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids taken from the star schema: order key and supplier key."""
    n_sup = load(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    return assign_keys(df, F.col("arrival"), F.col("arrival") % n_sup, F.col("arrival"))


def classified(spark: SparkSession, sf_dir: str, flat: DataFrame | None = None) -> DataFrame:
    """The documents decided; ``flat``: their ``extracted`` rows, where a query has them stored."""
    done = process_documents(extracted(spark, sf_dir) if flat is None else flat)
    return keyed(done.withColumn("processed_at", processed_at(F.col("arrival"))), spark, sf_dir)


def accepted(spark: SparkSession, sf_dir: str, flat: DataFrame | None = None) -> DataFrame:
    return dedupe_invoices(classified(spark, sf_dir, flat))


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_duplicates(stored(classified(spark, sf_dir), "classified"))


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_invoices(accepted(spark, sf_dir))


def vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert_vendors(accepted(spark, sf_dir))


def vendor_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id and name of every vendor, straight from the suppliers: enough for lookups by key."""
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("vendor_id"), F.col("s_name").alias("vendor_name"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return append_customers(accepted(spark, sf_dir))


def banks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return append_bank_details(accepted(spark, sf_dir)).withColumn("bank_id", F.substring("account_number", 6, 20).cast("bigint"))


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]


def order_lines(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    """All order lines as line items, numbered per order along ``LINE_ORDER``.

    Lines stay rows: an order may have any number of them, so they are never collected
    into a list.  ``only`` restricts to the orders of a frame with ``invoice_id``.
    """
    lines = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("invoice_id"), *LINE_ORDER)
    if only is not None:
        lines = lines.join(only.select("invoice_id"), "invoice_id", "left_semi")
    numbered = number_within(lines, "invoice_id", LINE_ORDER, "line_number")
    parts = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    quantity = F.col("l_quantity").cast("bigint")
    unit = F.floor((cents * 2 + quantity) / (quantity * 2))
    return numbered.join(parts, "l_partkey").select(
        "invoice_id", F.col("line_number").cast("int").alias("line_number"),
        F.col("p_name").alias("description"), F.col("l_quantity").cast(QUANTITY).alias("quantity"),
        (unit / 100).cast(MONEY).alias("unit_price"), (cents / 100).cast(MONEY).alias("amount"))


LINES = "array<struct<line_number:int,description:string,quantity:decimal(10,2),unit_price:decimal(12,2),amount:decimal(12,2)>>"
#: What tables other than the lines take from an accepted document.
FACTS = ["arrival", "s3_bucket", "s3_key", "invoice_id", "vendor_id", "customer_id", "invoice_number", "company_name", "company_address",
         "company_contact", "bill_to", "client_email", "invoice_day", "due_day", "po_number", "subtotal_value", "discount_value", "tax_value",
         "total_value", "payment_terms", "payment_instructions", "bank_name", "account_number", "routing_number", "confidence_score", "status",
         "processed_at", "present"]


def stored_tables(spark: SparkSession, sf_dir: str, flat: DataFrame | None = None) -> dict[str, DataFrame]:
    """The five tables as a store would hold them: accepted documents and lines written once.

    Lines are the orders', so documents go through the choice of firsts without theirs.
    """
    work = shared_dir(spark, "tables")
    accepted(spark, sf_dir, flat).select(*FACTS, F.array().cast(LINES).alias("lines")).write.parquet(f"{work}/accepted")
    facts = spark.read.parquet(f"{work}/accepted")
    order_lines(spark, sf_dir, facts).write.parquet(f"{work}/lines")
    tables = project_tables(facts)
    tables["invoice_line_items"] = spark.read.parquet(f"{work}/lines")
    return tables


def actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as approval requests; some name no stored invoice."""
    n = load(spark, sf_dir, "orders").agg((F.count(F.lit(1)) * 6)).scalar()
    kind = F.col("event_type")
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("action_id"), F.col("ts").alias("action_time"),
        ((F.col("event_id") * 7) % F.floor(n / 5)).cast("string").alias("invoice_id"),
        F.when(kind.isin("click", "purchase"), F.lit("approve")).when(kind == "error", F.lit("reject"))
        .when(kind == "signup", F.lit("escalate")).alias("action"))


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files tagged with the job of each order, except every 6th, which has none."""
    base = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).filter(_k() % 6 != 0)
    copy = F.explode(F.array(F.lit("b"), F.lit("a")))
    return base.select("k", copy.alias("copy")).select(
        F.lit("incoming").alias("bucket"),
        F.concat(F.lit("invoice_"), _k().cast("string"), F.lit("_"), "copy", F.lit(".pdf")).alias("key"),
        F.create_map(F.lit(JOB_TAG), F.concat(F.lit("job-"), _k().cast("string"))).alias("tags"))
