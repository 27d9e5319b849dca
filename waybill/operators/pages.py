"""Fields of invoice pages, as expressions over page text and layout text.

Each field is a (value, reason) pair: the value is null exactly if there is a
reason. A date that isn't a calendar day makes ``parse_error`` true, which fails
the invoice as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.address import normalize_address, plain_address
from ..functions.text import clean_name, filled, let, strip

DATE = r"\d{2}/\d{2}/\d{4}"
CSZ_LINE = r"^(.+?),\s+([A-Za-z]{2})\s+(\d{5}(?:-\d{4})?)\s*$"
#: Lines of a consignee block that are searched for the city line.
BLOCK_LINES = 7
FIELDS = ["invoice_number", "invoice_date", "ship_date", "shipper", "consignee", "consignee_address_line_1", "consignee_address_line_2", "consignee_city", "consignee_state", "consignee_postcode", "so_number", "total_amount", "past_due_date"]


def found(text: Column, pattern: str, group: int = 1) -> Column:
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def day(text: Column) -> Column:
    """MM/DD/YYYY as a date; null if there is no such day."""
    return F.try_to_timestamp(text, F.lit("MM/dd/yyyy")).cast("date")


def nth_date(text: Column, n: int) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(DATE), 0), F.lit(n))


def money(text: Column) -> Column:
    return F.translate(text, ",", "").try_cast("decimal(12,2)")


def consignee_block(layout: Column, two_columns: bool) -> Column:
    """STRUCT of the block under the line that ends in CONSIGNEE.

    Fragments stand three or more spaces apart; the last is the consignee's.
    With ``two_columns`` lines of one fragment are passed over and the last but
    one is the shipper's; without, a lone fragment counts as the consignee's.
    """

    def from_lines(lines: Column) -> Column:
        headers = F.filter(F.transform(lines, lambda x, i: F.when(F.regexp_replace(x, r"(?U)\s+$", "").endswith("CONSIGNEE"), i)), lambda i: i.isNotNull())
        return let(F.get(headers, 0), lambda at: F.when(at.isNotNull(), let(F.slice(lines, at + 2, F.greatest(F.size(lines) - at - 1, F.lit(0))), from_rest)).otherwise(nothing))

    def from_rest(rest: Column) -> Column:
        parts = F.transform(F.filter(F.transform(rest, strip), lambda x: x != ""), lambda x: F.split(x, r"(?U)\s{3,}"))
        return let(F.filter(parts, lambda p: F.size(p) >= 2) if two_columns else parts, from_parts)

    def from_parts(parts: Column) -> Column:
        rows = F.slice(F.transform(parts, lambda p: F.struct(strip(F.element_at(p, -1)).alias("right"), strip(F.try_element_at(p, F.lit(-2))).alias("left"))), 1, BLOCK_LINES)
        return let(rows, lambda r: result(F.lit(True), F.size(parts), F.array_position(F.transform(r, lambda x: x.right.rlike(CSZ_LINE)), True), F.transform(r, lambda x: x.right), F.transform(r, lambda x: x.left)))

    def result(header: Column, n: Column, at: Column, right: Column, left: Column) -> Column:
        texts = "array<string>"
        return F.struct(header.alias("header"), n.cast("int").alias("n_lines"), at.cast("int").alias("city_at"), right.cast(texts).alias("right"), left.cast(texts).alias("left"))

    nothing = result(F.lit(False), F.lit(0), F.lit(0), F.array(), F.array())
    return let(F.split(F.coalesce(layout, F.lit("")), r"\r\n|\n|\r|\f"), from_lines)


def block_fields(b: Column) -> tuple[dict[str, Column], Column]:
    """(values of the consignee fields and the left column's name, the reason if the block as a whole failed)"""
    reason = F.when(~b.header, "no line ending in 'CONSIGNEE' found in layout text").when((b.city_at == 0) & (b.n_lines >= BLOCK_LINES), "scanned >6 lines past CONSIGNEE without finding city/state/zip").when(b.city_at == 0, "no city/state/zip line found in consignee block").when(b.city_at < 2, "consignee block has CSZ but no name line")
    csz = F.try_element_at(b.right, b.city_at)
    ok = lambda c: F.when(reason.isNull(), c)
    values = {
        "consignee": ok(F.get(b.right, 0)),
        "consignee_address_line_1": ok(F.when(b.city_at > 2, F.get(b.right, 1))),
        "consignee_address_line_2": ok(F.when(b.city_at > 3, F.get(b.right, 2))),
        "consignee_city": ok(strip(F.regexp_extract(csz, CSZ_LINE, 1))),
        "consignee_state": ok(F.upper(F.regexp_extract(csz, CSZ_LINE, 2))),
        "consignee_postcode": ok(F.regexp_extract(csz, CSZ_LINE, 3)),
        "left_name": ok(F.get(b.left, 0)),
    }
    return values, reason


def _held(rows: DataFrame, name: str, fields: list[Column]) -> DataFrame:
    """Adds a struct that is computed once a row.

    Spark substitutes expressions into later filters and projections, so an
    expensive one would run once for each mention; it doesn't reach through a generator.
    """
    return rows.withColumn(name, F.explode(F.array(F.struct(*fields))))


def _result(pages: DataFrame, raw: dict[str, Column], why: dict[str, Column], block: Column, two_columns: bool) -> DataFrame:
    """Fields, reasons and parse_error from raw strings (dates and money not yet converted)."""
    rows = _held(pages, "_q", [block.alias("block"), *[c.alias(k) for k, c in raw.items()]])
    q = {k: F.col(f"_q.{k}") for k in raw}
    values, whole = block_fields(F.col("_q.block"))
    rows = _held(rows, "_v", [whole.alias("whole"), *[c.alias(k) for k, c in values.items()]])
    values, whole = {k: F.col(f"_v.{k}") for k in values}, F.col("_v.whole")
    dates = ("invoice_date", "ship_date", "past_due_date")
    bad = F.lit(False)
    for k in dates:
        bad = bad | (q[k].isNotNull() & day(q[k]).isNull())
    out = dict(q) | {k: day(q[k]) for k in dates} | {"total_amount": money(q["total_amount"])} | {k: v for k, v in values.items() if k != "left_name"}
    if two_columns:
        out["shipper"] = values["left_name"]
    reasons = {k: F.when(q[k].isNull(), w) for k, w in why.items()}
    for k in values:
        if k == "left_name" and not two_columns:
            continue
        missing = {"consignee_address_line_1": "no address line found between name and city/state/zip", "left_name": "shipper name not found in CONSIGNEE block"}.get(k)
        reasons["shipper" if k == "left_name" else k] = F.coalesce(whole, F.when(~filled(values[k]), missing)) if missing else whole
    entries = F.filter(F.array(*[F.struct(F.lit(k).alias("k"), reasons[k].alias("v")) for k in FIELDS]), lambda e: e.v.isNotNull())
    told = F.map_from_entries(F.transform(entries, lambda e: F.struct(e.k, e.v)))
    rows = _held(rows, "_f", [*[out[k].alias(k) for k in FIELDS], told.alias("reasons"), bad.alias("parse_error")])
    return rows.select(*pages.columns, "_f.*")


# Shippers in the order they are looked for, and the short name of one.
SHIPPERS_A = ["Old Wisconsin Sausage Company", "Midwest Refrigerated Services", "DairyFood USA"]
SHORT_NAMES_A = {"MRS": "Midwest Refrigerated Services"}


def parse_vendor_a(pages: DataFrame) -> DataFrame:
    """Fields of pages (.., text, layout) in vendor A's layout: dates by order, total by the last comma."""
    t = F.col("text")
    known = None
    for s in SHIPPERS_A:
        known = F.when(t.contains(s), s) if known is None else known.when(t.contains(s), s)
    for short, name in SHORT_NAMES_A.items():
        known = known.when(t.contains(short), name)
    block = r"(?s)S\s*H\s*I\s*P\s*P\s*E\s*R.*?([A-Z][A-Za-z\s&]+)\n"
    amounts = F.regexp_extract_all(t, F.lit(r"\$?([\d,]+\.\d{2})"), 1)
    with_comma = F.filter(amounts, lambda a: a.contains(","))
    dates = F.size(F.regexp_extract_all(t, F.lit(DATE), 0)).cast("string")
    raw = {
        "invoice_number": F.coalesce(found(t, r"INVOICE\s+(\d{7})"), found(t, r"\b(\d{7})\b")),
        "invoice_date": nth_date(t, 1), "ship_date": nth_date(t, 2), "past_due_date": nth_date(t, 3),
        "shipper": F.coalesce(known, strip(found(t, block))),
        "so_number": F.concat(F.lit("SO-"), found(t, r"S[O0]-(\d+)")),
        "total_amount": F.coalesce(F.try_element_at(with_comma, F.lit(-1)), F.try_element_at(amounts, F.lit(-1))),
    }
    why = {
        "invoice_number": F.lit("no 7-digit invoice number found (tried 'INVOICE <7-digits>' then any 7-digit token)"),
        "invoice_date": F.lit("no MM/DD/YYYY date found in text (invoice date is the 1st date)"),
        "ship_date": F.concat(F.lit("fewer than 2 MM/DD/YYYY dates found (ship date is the 2nd date; found "), dates, F.lit(")")),
        "past_due_date": F.concat(F.lit("fewer than 3 MM/DD/YYYY dates found (past-due date is the 3rd date; found "), dates, F.lit(")")),
        "shipper": F.lit("no known shipper matched; SHIPPER-block fallback also failed"),
        "so_number": F.lit("no match for pattern 'S[O0]-<digits>' in extracted text (tolerant of letter-O vs digit-0)"),
        "total_amount": F.lit("no $X.XX amount found in text (expected total near 'PLEASE PAY THIS AMOUNT')"),
    }
    return _result(pages, raw, why, consignee_block(F.col("layout"), two_columns=False), two_columns=False)


def parse_vendor_b(pages: DataFrame) -> DataFrame:
    """Fields of pages (.., text, layout) in vendor B's layout: labelled dates, total in USD, shipper from the left column."""
    t = F.col("text")
    raw = {
        "invoice_number": found(t, r"\b(\d{7})\b"),
        "invoice_date": nth_date(t, 1),
        "ship_date": F.coalesce(found(t, rf"({DATE})HIGH"), found(t, rf"SHIP\s*DATE[^\d]*?({DATE})")),
        "past_due_date": found(t, rf"({DATE})\s+\$[\d,]+\.\d{{2}}\s*USD"),
        "shipper": F.lit(None).cast("string"),
        "so_number": F.concat(F.lit("SO-"), found(t, r"S[O0]-(\d+(?:/\d+)*)")),
        "total_amount": found(t, r"\$([\d,]+\.\d{2})\s*USD"),
    }
    why = {
        "invoice_number": F.lit("no 7-digit invoice number found in page-1 text"),
        "invoice_date": F.lit("no MM/DD/YYYY date found in text (invoice date is the 1st date)"),
        "ship_date": F.lit("ship date not found (looked for date glued to the BILL TO code, then 'SHIP DATE' label)"),
        "past_due_date": F.lit("no past-due date found preceding '$X.XX USD' total"),
        "so_number": F.lit("no match for 'S[O0]-<digits>(/<digits>)*' (slash-joined multi-SO supported)"),
        "total_amount": F.lit("no '$X.XX USD' total found"),
    }
    return _result(pages, raw, why, consignee_block(F.col("layout"), two_columns=True), two_columns=True)


def page_ship_to(parsed: DataFrame, usps: bool = True) -> DataFrame:
    """The page-1 extraction of parsed invoices: invoice_id, source, name, name_candidates, address, success, failure_reason."""
    line_1, line_2, city, state, postcode = (F.col(f"consignee_{x}") for x in ("address_line_1", "address_line_2", "city", "state", "postcode"))
    needed = {"line_1": line_1, "city": city, "state": state, "postcode": postcode}
    missing = F.filter(F.array(*[F.when(~filled(c), k) for k, c in needed.items()]), lambda x: x.isNotNull())
    args = (line_1, city, state, postcode, F.lit(False))
    a = normalize_address(*args, line_2) if usps else plain_address(*args, line_2)
    rows = parsed.withColumn("_missing", missing).withColumn("_a", a).withColumn("_name", F.when(filled(F.col("consignee")), clean_name(F.col("consignee"))))
    parts = F.struct(*[F.col(f"_a.{x}").alias(x) for x in ("street", "line_2", "city", "state", "postcode")])
    ok = (F.size("_missing") == 0) & (F.col("_a.street") != "")
    reason = F.when(F.size("_missing") > 0, F.concat(F.lit("Page-1 CONSIGNEE block missing required address field(s): ["), F.array_join(F.transform("_missing", lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))).when(~ok, "Page-1 address fields were present but normalization produced an empty street")
    cands = F.when(filled(F.col("_name")), F.array("_name")).otherwise(F.array().cast("array<string>"))
    return rows.select("invoice_id", F.lit("page1").alias("source"), F.col("_name").alias("name"), cands.alias("name_candidates"), F.when(ok, parts).alias("address"), ok.alias("success"), reason.alias("failure_reason"))


def first_missing(required: list[str]) -> Column:
    """STRUCT<field, reason> of the first required field without a value; null if there is none."""
    entries = F.filter(F.array(*[F.struct(F.lit(k).alias("field"), F.col(k).isNull().alias("gone"), F.element_at("reasons", F.lit(k)).alias("reason")) for k in required]), lambda e: e.gone)
    return F.get(entries, 0)
