"""Vendor business rules, bills, outcomes, and the rows of each report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled, fmt_score, mailing_line, normalize_name, yes_no

UNKNOWN_CATEGORY = "UNKNOWN CATEGORY - MANUAL REVIEW NEEDED"
US_DATE = "MM/dd/yyyy"
ADDRESS = ("street", "line_2", "city", "state", "postcode")
# Report columns.
BILL_HEADERS = ["Bill no.", "Vendor", "Bill Date", "Due Date", "Type", "Category", "Description", "Amount", "Customer / Project", "Memo"]
SUMMARY_HEADERS = ["Run ID", "Shipping Company", "Invoice File", "Processing Start", "Processing End", "Status", "Bill Number", "SO Number", "Total Amount", "Match Method", "Match Severity", "Customer Name", "Customer Number", "Master Row", "BOL Method", "BOL Score", "Page-1 Method", "Page-1 Score", "Fail Step", "Fail Message", "Fail Detail", "Log File", "Match Fail Reason"]
DISCREPANCY_HEADERS = ["Run ID", "Shipping Company", "Invoice File", "Match Method", "Customer Name", "Customer Number", "Master Row", "Master Street", "Master Line 2", "Master City", "Master State", "Master Postcode", "Page-1 Name", "Page-1 Street", "Page-1 Line 2", "Page-1 City", "Page-1 State", "Page-1 Postcode", "Name Differs", "Street Differs", "Line 2 Differs", "City Differs", "State Differs", "Postcode Differs", "Current Consignee Name and Address", "Suggested Consignee Name and Address"]


def bill_date(invoice: Column, ship: Column) -> Column:
    """The invoice date if both fall in one month, else the ship date."""
    return F.when(F.trunc(invoice, "MM") == F.trunc(ship, "MM"), invoice).otherwise(ship)


def due_date(past_due: Column) -> Column:
    return F.date_sub(past_due, 1)


def category(shipper: Column, categories: dict[str, str]) -> Column:
    """The first key that contains the shipper or is contained in it."""
    out = None
    for key, value in categories.items():
        hit = shipper.contains(key) | F.lit(key).contains(shipper)
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return F.lit(UNKNOWN_CATEGORY) if out is None else out.otherwise(UNKNOWN_CATEGORY)


def make_bills(invoices: DataFrame, vendor_name: str, categories: dict[str, str]) -> DataFrame:
    """Bills of invoices with a customer: dates stay dates and amounts decimals until a sink."""
    return invoices.filter("customer_name is not null").select(
        "invoice_id", F.lit(vendor_name).alias("vendor"), bill_date(F.col("invoice_date"), F.col("ship_date")).alias("bill_date"), due_date(F.col("past_due_date")).alias("due_date"),
        F.col("invoice_number").alias("bill_number"), category(F.col("shipper"), categories).alias("category"), F.col("so_number").alias("description"), F.col("total_amount").alias("amount"), F.col("customer_name").alias("customer"), F.col("so_number").alias("memo"),
    )


def bill_rows(bills: DataFrame) -> DataFrame:
    us = lambda c: F.date_format(c, US_DATE)
    values = [F.col("bill_number"), F.col("vendor"), us("bill_date"), us("due_date"), F.lit("Category Details"), F.col("category"), F.col("description"), F.col("amount").cast("decimal(12,2)").cast("string"), F.col("customer"), F.col("memo")]
    return bills.select(*[v.alias(h) for v, h in zip(values, BILL_HEADERS)])


def outcomes(parsed: DataFrame, match: DataFrame, bills: DataFrame | None, missing: Column) -> DataFrame:
    """One row an invoice: all stages and the first step that failed.

    ``missing``: first_missing() of the vendor. Later steps only count where no
    earlier one failed. Without ``bills`` every invoice with a customer counts as
    billed, as by make_bills(), so nothing is parsed and matched a second time.
    """
    billed = F.when(F.col("customer_name").isNotNull(), True).alias("_bill")
    m = match.select("invoice_id", "method", "severity", "success", F.col("entry").alias("match_entry"), "bol_method", "bol_score", "inv_method", "inv_score", "fail_reason", *([billed] if bills is None else []))
    rows = parsed.withColumn("_missing", missing).join(m, "invoice_id", "left")
    if bills is not None:
        rows = rows.join(bills.select("invoice_id", F.lit(True).alias("_bill")), "invoice_id", "left")
    step = F.when(F.col("parse_error"), "parse_pdf").when(F.col("_missing").isNotNull(), "validate_fields").when(~F.coalesce("success", F.lit(False)), "match_customer").when(F.col("_bill").isNull(), "build_bill_entry")
    message = F.when(F.col("parse_error"), "PDF parsing failed").when(F.col("_missing").isNotNull(), F.concat(F.lit("missing required field: "), F.col("_missing.field"))).when(step == "match_customer", F.coalesce("fail_reason", F.lit("no match"))).when(step == "build_bill_entry", "bill could not be built")
    early = F.col("parse_error") | F.col("_missing").isNotNull()
    hide = lambda c: F.when(~early, F.col(c)).alias(c)
    return rows.select("invoice_id", *[c for c in parsed.columns if c != "invoice_id"], *[hide(c) for c in ("method", "severity", "success", "match_entry", "bol_method", "bol_score", "inv_method", "inv_score", "fail_reason")], step.alias("fail_step"), message.alias("fail_message"), F.when(F.col("_missing").isNotNull(), F.col("_missing.reason")).alias("fail_detail"), (F.col("_bill").isNotNull() & step.isNull()).alias("billed"))


def summary_rows(outcome: DataFrame, run_id: str = "", company: str = "", start: str = "", end: str = "") -> DataFrame:
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    values = [F.lit(run_id), F.lit(company), s("invoice_id"), F.lit(start), F.lit(end), F.when(F.col("billed"), "SUCCESS").otherwise("FAIL"), s("invoice_number"), s("so_number"), s("total_amount"), s("method"), s("severity"), s("match_entry.customer_name"), s("match_entry.customer_number"), s("match_entry.row"), s("bol_method"), fmt_score(F.col("bol_score")), s("inv_method"), fmt_score(F.col("inv_score")), F.coalesce("fail_step", F.lit("N/A")), s("fail_message"), s("fail_detail"), F.lit(""), s("fail_reason")]
    return outcome.select(*[v.alias(h) for v, h in zip(values, SUMMARY_HEADERS)])


def discrepancies(match: DataFrame, page1: DataFrame) -> DataFrame:
    """Resolved invoices whose page-1 consignee differs from the master entry in any field."""
    p = page1.select("invoice_id", F.col("name").alias("page1_name"), F.col("address").alias("_p"))
    rows = match.filter("success").select("invoice_id", "method", "entry").join(p, "invoice_id", "left")
    differs = {"name": normalize_name(F.col("page1_name")) != normalize_name(F.col("entry.customer_name"))}
    for x in ADDRESS:
        differs[x] = F.when(F.col("_p").isNull(), filled(F.col(f"entry.address.{x}"))).otherwise(~F.col(f"_p.{x}").eqNullSafe(F.col(f"entry.address.{x}")))
    out = rows.select("invoice_id", "method", F.col("entry.customer_name").alias("customer_name"), F.col("entry.customer_number").alias("customer_number"), F.col("entry.row").alias("master_row"), *[F.col(f"entry.address.{x}").alias(f"master_{x}") for x in ADDRESS], "page1_name", *[F.coalesce(F.col(f"_p.{x}"), F.lit("")).alias(f"page1_{x}") for x in ADDRESS], *[c.alias(f"{k}_differs") for k, c in differs.items()])
    return out.filter(" or ".join(f"{k}_differs" for k in differs))


def discrepancy_rows(found: DataFrame, run_id: str = "", company: str = "") -> DataFrame:
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    line = lambda name, p: mailing_line(F.col(name), *[F.col(f"{p}_{x}") for x in ADDRESS])
    values = [F.lit(run_id), F.lit(company), s("invoice_id"), F.col("method"), s("customer_name"), s("customer_number"), s("master_row"), *[s(f"master_{x}") for x in ADDRESS], s("page1_name"), *[s(f"page1_{x}") for x in ADDRESS], *[yes_no(F.col(f"{x}_differs")) for x in ("name", *ADDRESS)], line("page1_name", "page1"), line("customer_name", "master")]
    return found.select(*[v.alias(h) for v, h in zip(values, DISCREPANCY_HEADERS)])
