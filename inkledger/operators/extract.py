"""JSON documents to flat rows, and flat texts to typed columns.

A flat row has ``arrival``, ``s3_bucket``, ``s3_key``, the texts of ``SCALARS`` as the
document gave them, ``line_items`` (a list of text structs), ``confidence`` (percent,
unrounded), ``confidence_score``, ``confidence_text``, ``present`` (is a field truthy) and
``shape_errors`` (fields whose JSON type the tables cannot take).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkledger.functions.parse import date_sql, discount_sql, number_sql
from inkledger.model import LINE_TEXT, TRUTH_TESTED

# output column -> path in the document
SCALARS = {
    "invoice_number": "inference_result.invoice_number",
    "company_name": "inference_result.company_name",
    "company_address": "inference_result.company_address",
    "company_contact": "inference_result.company_contact_information",
    "bill_to": "inference_result.bill_to",
    "client_email": "inference_result.client_email",
    "invoice_date": "inference_result.invoice_date",
    "due_date": "inference_result.due_date",
    "po_number": "inference_result.po_number",
    "subtotal": "inference_result.subtotal",
    "discount": "inference_result.discount",
    "tax": "inference_result.tax",
    "total_amount": "inference_result.total_amount",
    "payment_terms": "inference_result.payment_terms",
    "payment_instructions": "inference_result.payment_details.payment_instructions",
    "bank_name": "inference_result.bank_details.bank_name",
    "account_number": "inference_result.bank_details.account_number",
    "routing_number": "inference_result.bank_details.routing_number",
}
OBJECTS = {
    "payment_details": "inference_result.payment_details",
    "bank_details": "inference_result.bank_details",
    "matched_blueprint": "matched_blueprint",
}
ITEMS = "inference_result.invoice_items"
CONFIDENCE = "matched_blueprint.confidence"
DATES = ("invoice_date", "due_date")
AMOUNTS = ("subtotal", "tax", "total_amount")

_FLAT = ", ".join(f"{p.split('.')[1]}:string" for p in SCALARS.values() if p.count(".") == 1)
READ_SCHEMA = (
    f"inference_result struct<{_FLAT}, payment_details:struct<payment_instructions:string>, "
    "bank_details:struct<bank_name:string,account_number:string,routing_number:string>, "
    f"invoice_items:{LINE_TEXT}>, matched_blueprint struct<confidence:double>, misfit string")
# JSON as the standard has it; a text or a part that does not fit the schema sets ``misfit``.
READ_OPTIONS = {"columnNameOfCorruptRecord": "misfit", "allowSingleQuotes": "false"}


def _kind(path: str) -> str:
    """JSON type at the path: null when absent, VOID for a JSON null.

    This parses the document a second time, so it stands only in branches taken for the
    few values whose text does not tell the type.
    """
    return f"schema_of_variant(try_variant_get(try_parse_json(raw), '$.{path}', 'variant'))"


def _also(cheap: str, costly: str) -> str:
    """Both hold.  A branch, not AND: Spark hoists what several ANDs share and evaluates it always."""
    return f"if({cheap}, {costly}, false)"


def _truthy(value: str, path: str) -> str:
    """Absent, null, '', 0, false, [] and {} are false; the texts '0' and ' ' are true."""
    written_out = r"^(false|\[\s*\]|\{\s*\}|-?0[0.]*([eE].*)?)$"
    return (f"CASE WHEN {value} IS NULL OR {value} = '' THEN false "
            f"WHEN {value} RLIKE r'{written_out}' THEN coalesce({_kind(path)} = 'STRING', true) ELSE true END")


def extract_flatten(documents: DataFrame, strict: bool = False) -> DataFrame:
    """Parse each document once and name its fields.

    Texts that are no JSON, sub-objects of the wrong type and values no table column can
    take are named in ``shape_errors``.  A null sub-object counts as absent, or as an
    error with ``strict``.  The score is rounded half up.  JSON numbers keep the digits
    the document has, but for the total: 5.00 reads 5.0, as its messages show it.
    """
    value = {n: f"j.{p}" for n, p in SCALARS.items()}
    read = documents.withColumn("j", F.from_json("raw", READ_SCHEMA, READ_OPTIONS))
    text = dict(value)
    # a true discount counts as the number 1
    text["discount"] = ("if(" + _also(f"{value['discount']} = 'true'", f"{_kind(SCALARS['discount'])} = 'BOOLEAN'")
                        + f", '1', {value['discount']})")
    total = value["total_amount"]
    padded = _also(rf"{total} RLIKE r'^-?\d+\.\d+0$'", f"{_kind(SCALARS['total_amount'])} <> 'STRING'")
    text["total_amount"] = rf"if({padded}, regexp_replace({total}, r'(\.\d+?)0+$', '$1'), {total})"
    present = ", ".join(f"'{n}', {_truthy(value[n], SCALARS[n])}" for n in TRUTH_TESTED)
    fraction = (f"coalesce(j.{CONFIDENCE}, CASE WHEN j.misfit IS NOT NULL THEN "
                f"try_variant_get(try_parse_json(raw), '$.{CONFIDENCE}', 'double') END, 0D)")
    flat = read.selectExpr(
        "arrival", "s3_bucket", "s3_key", *[f"{text[n]} AS {n}" for n in SCALARS],
        f"coalesce(j.{ITEMS}, array()) AS line_items", f"{fraction} * 100 AS confidence",
        # a whole number of the document stays one when shown
        _also(f"coalesce(j.{CONFIDENCE}, 0D) IN (0D, 1D)",
              f"coalesce({_kind(CONFIDENCE)}, 'BIGINT') = 'BIGINT'") + " AS whole",
        f"named_struct({present}) AS present",
        f"{_shape_errors(value, strict)} AS shape_errors")
    return flat.selectExpr(
        "* EXCEPT (whole)", "try_cast(confidence AS decimal(5,2)) AS confidence_score",
        "CASE WHEN whole THEN CAST(CAST(confidence AS bigint) AS string) "
        "ELSE CAST(CAST(try_cast(confidence AS decimal(5,2)) AS double) AS string) END AS confidence_text")


def _shape_errors(value: dict[str, str], strict: bool) -> str:
    """Names of the parts with a wrong JSON type, as one array expression."""
    def named(name: str, condition: str) -> str:
        return f"CASE WHEN {condition} THEN '{name}' END"

    # The reader stops at the closing brace, and takes the first object of a list.
    # What it could not fit is looked at in detail; a document that is no object has no parts.
    whole_object = r"trim(BOTH ' \t\r\n' FROM raw) LIKE '{%}'"
    misfits = [named("document", f"raw IS NULL OR NOT {whole_object} OR try_parse_json(raw) IS NULL")]
    misfits += [named(n, f"{_kind(p)} NOT LIKE 'OBJECT%' AND {_kind(p)} <> 'VOID'") for n, p in OBJECTS.items()]
    items_text = f"try_variant_get(try_parse_json(raw), '$.{ITEMS}', 'string')"
    misfits.append(named("invoice_items", f"j.{ITEMS} IS NULL AND {_truthy(items_text, ITEMS)}"))
    misfits.append(named("confidence", f"{_kind(CONFIDENCE)} RLIKE '^(OBJECT|ARRAY|STRING)'"))

    fitting = []
    if strict:
        nulls = {**OBJECTS, "confidence": CONFIDENCE}
        fitting += [named(n, _also(f"j.{p} IS NULL", f"{_kind(p)} = 'VOID'")) for n, p in nulls.items()]
    for name, path in SCALARS.items():
        # an object or list, or a text that looks like one
        bad = _also(f"left({value[name]}, 1) IN ('[', '{{')", f"{_kind(path)} RLIKE '^(OBJECT|ARRAY)'")
        if name in DATES:
            # a number or truth value, or digits in a text
            bad = _also(rf"{value[name]} RLIKE r'^(-?[\d.]+([eE].*)?|true|false|[\[{{].*)$'",
                        f"{_kind(path)} <> 'STRING'")
        elif name in AMOUNTS:
            bad += " OR " + _also(f"{value[name]} IN ('true', 'false')", f"{_kind(path)} = 'BOOLEAN'")
        fitting.append(named(name, bad))
    fitting.append(named("invoice_items", f"exists(j.{ITEMS}, x -> x IS NULL)"))

    def listed(parts: list[str]) -> str:
        return f"array_compact(array({', '.join(parts)}))"

    return (f"CASE WHEN raw IS NULL OR j.misfit IS NOT NULL OR NOT {whole_object} "
            f"THEN concat({listed(misfits)}, {listed(fitting)}) ELSE {listed(fitting)} END")


def cast_invoice(extracted: DataFrame) -> DataFrame:
    """Add typed values beside the texts; a text that cannot be stored has a null value.

    ``total_number`` is the double the decisions compare; ``lines`` the typed items with
    their position from 1.
    """
    money = "decimal(12,2)"
    return extracted.selectExpr(
        "*",
        f"{date_sql('invoice_date')} AS invoice_day",
        f"{date_sql('due_date')} AS due_day",
        f"{number_sql('subtotal', money)} AS subtotal_value",
        f"{number_sql('tax', money)} AS tax_value",
        f"{number_sql('total_amount', money)} AS total_value",
        f"{number_sql('total_amount', 'double')} AS total_number",
        f"{discount_sql('discount', 'present.discount')} AS discount_value",
        f"""transform(line_items, (x, i) -> named_struct(
              'line_number', i + 1, 'description', x.description,
              'quantity', {number_sql('x.quantity', 'decimal(10,2)')},
              'unit_price', {number_sql('x.unit_price', money)},
              'amount', {number_sql('x.amount', money)})) AS lines""")
