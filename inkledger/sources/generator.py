"""Sample invoices: every draw is a function of (id, seed), so any partitioning gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkledger import model as M
from inkledger.functions.display import fmt_date
from inkledger.functions.parse import invoice_code


def _digest(seed: int, *parts: Column) -> Column:
    """128 repeatable bits as hex text, enough for four draws."""
    return F.md5(F.concat_ws("|", F.lit(seed).cast("string"), *[p.cast("string") for p in parts]))


def _draw(digest: Column, slot: int) -> Column:
    """The digest's ``slot``-th (0-3) whole number in [0, 2**32)."""
    return F.conv(F.substring(digest, 1 + 8 * slot, 8), 16, 10).cast("bigint")


def _pick(values: tuple, draw: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (draw % len(values)).cast("int"))


def generate_invoices(ids: DataFrame, today: Column, seed: int = 1) -> DataFrame:
    """One sample invoice per ``id``: 3-8 lines, 8% tax, for 3 in 10 a discount, dated 1-90 days back."""
    key = F.col("id")

    def line(digest: Column) -> Column:
        price = ((_pick(M.SAMPLE_BASE_PRICES, _draw(digest, 0)) * 100
                  + _draw(digest, 1) % 100) / 100).cast(M.MONEY)
        quantity = (_draw(digest, 2) % 100 + 1).cast("int")
        return F.struct(
            _pick(M.SAMPLE_SERVICES, _draw(digest, 3)).alias("description"),
            quantity.alias("quantity"), price.alias("unit_price"),
            (price * quantity).cast(M.MONEY).alias("amount"))

    head = ids.select(key, _digest(seed, F.lit("head"), key).alias("h"),
                      _digest(seed, F.lit("deal"), key).alias("d"))
    count = (_draw(F.col("h"), 0) % 6 + 3).cast("int")
    digests = F.transform(F.sequence(F.lit(1), count), lambda i: _digest(seed, F.lit("line"), key, i))
    lines = head.select(
        key,
        F.transform(digests, line).alias("lines"),
        F.when(_draw(F.col("d"), 0) % 10 >= 7,
               _pick(M.SAMPLE_DISCOUNT_PERCENTS, _draw(F.col("d"), 1)))
        .otherwise(0).alias("discount_percent"),
        F.date_sub(today, (_draw(F.col("h"), 1) % 90 + 1).cast("int")).alias("invoice_date"),
        (_draw(F.col("h"), 2) % 9000 + 1000).alias("po"),
        (_draw(F.col("h"), 3) % 1000000).alias("customer"),
    )
    subtotal = F.aggregate("lines", F.lit(0).cast("decimal(14,2)"),
                           lambda total, x: (total + x["amount"]).cast("decimal(14,2)"))
    summed = lines.withColumn("subtotal", subtotal)
    return invoice_arithmetic(summed).select(
        "id",
        invoice_code(key).alias("invoice_number"),
        F.lit(M.SAMPLE_VENDOR).alias("vendor"),
        F.format_string("Customer %06d", "customer").alias("customer"),
        F.format_string("customer%06d@example.org", "customer").alias("email"),
        "invoice_date",
        F.date_add("invoice_date", M.DUE_DAYS).alias("due_date"),
        F.format_string("PO-%d", "po").alias("po_number"),
        "lines", "subtotal", "tax", "discount", "total",
        F.format_string("sample_invoices/invoice_%04d.pdf", key).alias("filename"),
    )


def invoice_arithmetic(df: DataFrame) -> DataFrame:
    """tax, discount and total from ``subtotal`` and ``discount_percent``, to the cent."""
    return (df
            .withColumn("tax", (F.col("subtotal") * M.TAX_PERCENT / 100).cast(M.MONEY))
            .withColumn("discount", (F.col("subtotal") * F.col("discount_percent") / 100).cast(M.MONEY))
            .withColumn("total", (F.col("subtotal") - F.col("discount") + F.col("tax")).cast(M.MONEY)))


def generate_extractions(spark: SparkSession, n: int, today: Column, seed: int = 1,
                         partitions: int | None = None) -> DataFrame:
    """Documents (key and JSON text) for ``n`` sample invoices."""
    return to_documents(generate_invoices(spark.range(1, n + 1, 1, partitions), today, seed))


def to_documents(invoices: DataFrame) -> DataFrame:
    bank, account, routing = M.SAMPLE_BANK
    item = F.transform("lines", lambda x: F.struct(
        x["description"].alias("description"), x["quantity"].alias("quantity"),
        x["unit_price"].alias("unit_price"), x["amount"].alias("amount")))
    inference = F.struct(
        "invoice_number", F.col("vendor").alias("company_name"),
        F.lit(M.SAMPLE_ADDRESS).alias("company_address"),
        F.lit(M.SAMPLE_CONTACT).alias("company_contact_information"),
        F.col("customer").alias("bill_to"), F.col("email").alias("client_email"),
        fmt_date(F.col("invoice_date")).alias("invoice_date"),
        fmt_date(F.col("due_date")).alias("due_date"), "po_number",
        "subtotal", "discount", "tax", F.col("total").alias("total_amount"),
        F.lit(M.SAMPLE_TERMS).alias("payment_terms"),
        F.struct(F.lit(M.SAMPLE_INSTRUCTIONS).alias("payment_instructions")).alias("payment_details"),
        F.struct(F.lit(bank).alias("bank_name"), F.lit(account).alias("account_number"),
                 F.lit(routing).alias("routing_number")).alias("bank_details"),
        item.alias("invoice_items"))
    blueprint = F.struct(F.lit(0.95).alias("confidence"))
    return invoices.select(
        F.col("id").alias("arrival"), F.lit("").alias("s3_bucket"),
        F.format_string("/job-%d/0/custom_output/0/result.json", "id").alias("s3_key"),
        F.to_json(F.struct(inference.alias("inference_result"),
                           blueprint.alias("matched_blueprint"))).alias("raw"))


def generated_totals(invoices: DataFrame) -> DataFrame:
    return invoices.agg(F.count(F.lit(1)).alias("invoice_count"),
                        F.sum("total").cast("decimal(38,2)").alias("total_value"))


def summary_rows(invoices: DataFrame) -> DataFrame:
    """The eleven summary columns of generated invoices."""
    return invoices.select(
        F.col("invoice_number").alias("Invoice Number"), F.col("vendor").alias("Vendor"),
        F.col("customer").alias("Customer"), F.col("email").alias("Email"),
        F.col("invoice_date").alias("Date"), F.col("due_date").alias("Due Date"),
        F.col("subtotal").cast(M.MONEY).alias("Subtotal"), F.col("tax").alias("Tax"),
        F.col("discount").alias("Discount"), F.col("total").alias("Total"),
        F.col("filename").alias("Filename"))
