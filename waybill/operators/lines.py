"""Addresses and customer lines straight from text lines, without boxes: the older, simpler extraction paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.address import normalize_address
from ..functions.text import CSZ_STATE_LIST, PHONE_LOOSE, SHIP_FROM_LABEL, SHIP_TO_LABEL, SHIPPER_BLOCK, clean_lines, filled, first_fragment, let, looks_like_company, own_line

STREET_START = r"(?i)^\s*(?:\d|p\.?\s*o\.?\s*box)"
APPOINTMENT = r"(?i)\bappt\b|Pickup"
AFTER_LABEL, SHIPPER_LINES, AFTER_SHIPPER = 5, 10, 7


def first_index(items: Column, test) -> Column:
    """Place (from 0) of the first item that passes; null if none does."""
    return F.get(F.filter(F.transform(items, lambda x, i: F.when(test(x), i)), lambda i: i.isNotNull()), 0)


def parse_address(raw: Column) -> Column:
    """STRUCT<name, street_line_1, street_line_2, city, state, postcode, note> of one address block's text.

    The first line with a city, a state and a ZIP ends the block; above it the
    first line that begins with a number or a P.O. box begins the street.
    """
    none = F.lit(None).cast("string")

    def out(note, name=none, one=none, two=none, city=none, state=none, postcode=none) -> Column:
        values = {"name": name, "street_line_1": one, "street_line_2": two, "city": city, "state": state, "postcode": postcode, "note": F.lit(note) if isinstance(note, str) else note}
        return F.struct(*[v.cast("string").alias(k) for k, v in values.items()])

    def with_lines(lines: Column) -> Column:
        return F.when(F.size(lines) == 0, out("no usable OCR lines")).otherwise(let(F.struct(lines.alias("lines"), first_index(lines, lambda x: x.rlike(CSZ_STATE_LIST)).alias("at")), with_city))

    def with_city(q: Column) -> Column:
        line = F.get(q.lines, q["at"])
        got = lambda g: F.regexp_extract(line, CSZ_STATE_LIST, g)
        city, state, postcode = F.trim(got(1)), F.upper(got(2)), got(3)
        above = F.slice(q.lines, 1, q["at"])
        parts = F.struct(above.alias("above"), first_index(above, lambda x: x.rlike(STREET_START)).alias("street"), city.alias("city"), state.alias("state"), postcode.alias("postcode"))
        return F.when(q["at"].isNull(), out("no city/state/zip pattern found", name=F.get(q.lines, 0))).when(q["at"] == 0, out("no lines above city/state/zip", city=F.upper(city), state=state, postcode=postcode)).otherwise(let(parts, with_parts))

    def with_parts(q: Column) -> Column:
        n = F.size(q.above)
        begin = F.coalesce(q.street, n - 1)
        name = F.nullif(F.array_join(F.slice(q.above, 1, begin), " "), F.lit(""))
        one, two = F.get(q.above, begin), F.get(q.above, begin + 1)
        a = normalize_address(one, q.city, q.state, q.postcode, None, two)
        return let(a, lambda x: out("", name, F.when(filled(x.street), x.street).otherwise(one), F.when(filled(x.line_2), x.line_2).otherwise(two), F.upper(q.city), q.state, q.postcode))

    return let(clean_lines(raw), with_lines)


def pick_customer_line(lines: Column, own_name: str) -> Column:
    """The customer's line of a ship-to column: after the label, else after the shipper's block, else above the payer's line."""
    tested = F.transform(lines, lambda x: F.struct(x.alias("t"), looks_like_company(x, own_name).alias("ok")))

    def pick(xs: Column) -> Column:
        company = lambda part: F.get(F.filter(part, lambda x: x.ok), 0).t
        label = lambda x: x.t.rlike(SHIP_TO_LABEL) & ~x.t.rlike(SHIP_FROM_LABEL)
        after = F.filter(F.transform(xs, lambda x, i: F.when(label(x), company(F.slice(xs, i + 2, AFTER_LABEL)))), lambda t: t.isNotNull())
        shipper = first_index(xs, lambda x: x.t.rlike(SHIPPER_BLOCK))
        end = first_index(F.slice(xs, shipper + 1, SHIPPER_LINES), lambda x: x.t.rlike(PHONE_LOOSE) | x.t.rlike(APPOINTMENT))
        past = F.when(end.isNotNull(), company(F.slice(xs, shipper + end + 2, AFTER_SHIPPER)))
        own = first_index(xs, lambda x: x.t.rlike(own_line(own_name)))
        above = F.when(own > 0, F.try_element_at(F.filter(F.slice(xs, 1, own), lambda x: x.ok), F.lit(-1)).t)
        return F.coalesce(F.get(after, 0), past, above)

    return let(tested, pick)


def customer_lines(pages: DataFrame, own_name: str, text_col: str = "text") -> DataFrame:
    """invoice_id, customer: pick_customer_line() over a column's OCR text, lines cleaned first."""
    lines = F.filter(F.transform(F.split(F.coalesce(text_col, F.lit("")), "\n"), first_fragment), lambda x: x != "")
    return pages.withColumn("_l", F.explode(F.array(lines))).select("invoice_id", pick_customer_line(F.col("_l"), own_name).alias("customer"))


def block_box(block: DataFrame) -> DataFrame:
    """The box around each invoice's address block."""
    return block.groupBy("invoice_id").agg(F.min("y_top").alias("y_top"), F.max("y_bot").alias("y_bot"), F.min("x_left").alias("x_left"), F.max("x_right").alias("x_right"))


def extraction_json(extractions: DataFrame) -> DataFrame:
    """invoice_id, source, json of each extraction."""
    rest = [c for c in extractions.columns if c not in ("invoice_id", "source")]
    return extractions.select("invoice_id", "source", F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias("json"))


def compare_goldens(made: DataFrame, goldens: DataFrame) -> DataFrame:
    """invoice stems whose JSON (stem, json) differs from the golden's, or that only one side has."""
    both = made.select("stem", F.col("json").alias("got")).join(goldens.select("stem", F.col("json").alias("expected")), "stem", "full")
    return both.filter(~F.col("got").eqNullSafe(F.col("expected")))
