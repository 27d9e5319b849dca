"""The customer master: cells to rows, validation rules, entries, lookups and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.address import normalize_address, plain_address
from ..functions.text import fmt_postcode, let, norm_text, normalize_name, strip

CELLS = ["name", "al1", "al2", "city", "state", "postcode"]
# Rule names and how grave each is.
REQUIRED, TRIPLE, NO_NUMBER = "required_fields_present", "triple_unique", "could_not_extract_customer_number"
DUPLICATE_NUMBER, MALFORMED = "duplicate_customer_number", "malformed_customer_number_format"
SEVERITY = {REQUIRED: "hard", TRIPLE: "hard", NO_NUMBER: "hard", DUPLICATE_NUMBER: "soft", MALFORMED: "soft"}
CELL_TITLES = {"name": "Name", "al1": "AddressLine1", "al2": "AddressLine2", "city": "City", "state": "State", "postcode": "Postcode"}
ADDRESS_KEY = ["street", "city", "state", "postcode"]
SEPARATOR = r"\s+-"
STRICT = r"^(.+)\s+-\s*(\d+)(?:[\s,]+(.*?))?\s*$"


def parse_al1(al1: Column) -> Column:
    """STRUCT<name, number, extra, parsed_ok, recovered> of a ship-to cell.

    A number follows the last separator (space, dash) in the strict form; failing
    that, the first six digits that stand alone after the first separator.
    """
    none = F.lit(None).cast("string")

    def parts(s: Column) -> Column:
        after = F.regexp_extract(s, r"(?s)^.*?\s+-(.*)$", 1)
        seen = F.struct(s.alias("s"), s.rlike(SEPARATOR).alias("sep"), s.rlike(STRICT).alias("strict"), F.nullif(F.regexp_extract(after, r"\b(\d{6})\b", 1), F.lit("")).alias("six"))
        return let(seen, result)

    def result(q: Column) -> Column:
        strict, found = q.sep & q.strict, q.sep & ~q.strict & q.six.isNotNull()
        return F.struct(
            F.when(strict, strip(F.regexp_extract(q.s, STRICT, 1))).when(found, strip(F.regexp_extract(q.s, r"(?s)^(.*?)\s+-", 1))).otherwise(q.s).alias("name"),
            F.when(strict, F.regexp_extract(q.s, STRICT, 2)).when(found, q.six).otherwise(none).alias("number"),
            F.when(strict, F.nullif(strip(F.regexp_extract(q.s, STRICT, 3)), F.lit(""))).otherwise(none).alias("extra"),
            (~q.sep | q.strict).alias("parsed_ok"),
            found.alias("recovered"),
        )

    return let(strip(F.coalesce(al1, F.lit(""))), parts)


def master_rows(cells: DataFrame, usps: bool = True) -> DataFrame:
    """Sheet rows with the parsed ship-to cell and the address, null without city, state, ZIP or street cell.

    ``usps``: normalise addresses by Publication 28; otherwise in the plain form.
    """
    rows = cells.filter(~(F.col("name").isNull() & F.col("al1").isNull() & F.col("al2").isNull()))
    args = [F.col(c) for c in ("al2", "city", "state", "postcode", "postcode_is_numeric")]
    address = normalize_address(*args) if usps else plain_address(*args, F.lit(""))
    keyed = (norm_text(F.col("city")) != "") & (norm_text(F.col("state")) != "") & (fmt_postcode(F.col("postcode"), F.col("postcode_is_numeric")) != "") & F.col("al2").isNotNull()
    rows = rows.withColumn("_al1", parse_al1(F.col("al1"))).withColumn("_a", address)
    parts = F.struct(*[F.col(f"_a.{x}").alias(x) for x in ("street", "line_2", "city", "state", "postcode")])
    return rows.select("row", *CELLS, "postcode_is_numeric", F.col("_al1.name").alias("shipto_name"), F.col("_al1.number").alias("customer_number"), F.col("_al1.extra").alias("al1_extra"), F.col("_al1.recovered").alias("recovered"), F.when(keyed, parts).alias("address"))


def _shown(c: Column) -> Column:
    return F.when(c.isNull(), "None").otherwise(F.concat(F.lit("'"), c.cast("string"), F.lit("'")))


def _missing() -> Column:
    """Titles of the required cells that are null or blank."""
    blank = lambda c: F.col(c).isNull() | (strip(F.col(c).cast("string")) == "")
    return F.array_compact(F.array(*[F.when(blank(c), CELL_TITLES[c]) for c in CELLS]))


def _with_firsts(rows: DataFrame) -> DataFrame:
    """Adds the first row of each (name, ship-to name, address) and of each customer number.

    Rows that a rule doesn't concern are dealt by row, so null keys gather nowhere.
    """
    rows = rows.withColumns({"_name": strip(F.coalesce(F.col("name").cast("string"), F.lit(""))), "_shipto": normalize_name(F.col("shipto_name")), "_missing": _missing()})
    triple, number = (F.col("_name") != "") & F.col("address").isNotNull(), F.col("customer_number").isNotNull()
    by_triple = Window.partitionBy(F.when(triple, F.struct("_name", "_shipto", "address")), F.when(~triple, F.col("row")))
    by_number = Window.partitionBy("customer_number", F.when(~number, F.col("row")))
    return rows.withColumn("_first_triple", F.min("row").over(by_triple)).withColumn("_first_number", F.min("row").over(by_number))


def _rules() -> dict[str, tuple[Column, Column]]:
    """Rule: (where a row breaks it, what is said), over the columns of _with_firsts()."""
    dump = F.concat_ws(", ", *[F.concat(F.lit(f"{CELL_TITLES[c]}="), _shown(F.col(c))) for c in CELLS])
    return {
        REQUIRED: (F.size("_missing") > 0, F.concat(F.lit("missing required field(s): ["), F.array_join(F.transform("_missing", _shown), ", "), F.lit("]; row data: "), dump)),
        TRIPLE: (F.col("row") > F.col("_first_triple"), F.concat(F.lit("duplicate (Name="), _shown(F.col("_name")), F.lit(", shipto_name="), _shown(F.col("shipto_name")), F.lit(", address) — first seen at row "), F.col("_first_triple").cast("string"))),
        NO_NUMBER: (F.col("customer_number").isNull(), F.concat(F.lit("could not extract customer number from AL1: "), _shown(F.col("al1")))),
        DUPLICATE_NUMBER: (F.col("row") > F.col("_first_number"), F.concat(F.lit("customer number "), F.col("customer_number"), F.lit(" is also on row "), F.col("_first_number").cast("string"))),
        MALFORMED: (F.col("recovered"), F.concat(F.lit("AL1 doesn't match canonical format but a 6-digit customer number ("), F.col("customer_number"), F.lit(") was recovered. AL1="), _shown(F.col("al1")))),
    }


def validate(rows: DataFrame, *only: str) -> DataFrame:
    """All violations (or those of some rules), in one pass over the rows; order by row and rule where they are shown."""
    rules = {r: v for r, v in _rules().items() if not only or r in only}
    found = F.array_compact(F.array(*[F.when(broken, F.struct(F.lit(r).alias("rule"), F.lit(SEVERITY[r]).alias("severity"), said.alias("message"))) for r, (broken, said) in rules.items()]))
    raw = F.struct(*[F.col(c) for c in CELLS])
    return _with_firsts(rows).select("row", F.explode(found).alias("_v"), raw.alias("raw")).select("row", "_v.*", "raw")


def check_required(rows: DataFrame) -> DataFrame:
    return validate(rows, REQUIRED)


def check_triple_unique(rows: DataFrame) -> DataFrame:
    """Every row but the first of each (name, ship-to name, address)."""
    return validate(rows, TRIPLE)


def check_no_number(rows: DataFrame) -> DataFrame:
    return validate(rows, NO_NUMBER)


def check_duplicate_number(rows: DataFrame) -> DataFrame:
    """Every row but the first of each number, with the row just seen first."""
    return validate(rows, DUPLICATE_NUMBER)


def check_malformed(rows: DataFrame) -> DataFrame:
    return validate(rows, MALFORMED)


def valid_master(rows: DataFrame) -> DataFrame:
    """Entries: rows with all required fields and an address. Duplicates stay."""
    return rows.filter((F.size(_missing()) == 0) & F.col("address").isNotNull()).select("row", F.col("name").cast("string").alias("customer_name"), "shipto_name", "customer_number", "address")


def violation_counts(violations: DataFrame) -> DataFrame:
    return violations.groupBy("rule", "severity").agg(F.count("*").alias("n"))


def master_stats(master: DataFrame) -> DataFrame:
    key = F.struct("address.street", "address.city", "address.state", "address.postcode")
    return master.agg(F.count("*").alias("n_rows"), F.countDistinct(key).alias("n_addresses"), F.countDistinct("customer_name").alias("n_customers"))


def shared_addresses(master: DataFrame) -> DataFrame:
    """Address keys on two or more rows, with the number of rows and customers."""
    return master.groupBy("address.street", "address.city", "address.state", "address.postcode").agg(F.count("*").alias("n_rows"), F.countDistinct("customer_name").alias("n_customers")).filter("n_rows > 1")


def multi_address_customers(master: DataFrame) -> DataFrame:
    """Customers on two or more rows, with their addresses in order of state, city, street."""
    row = F.struct("address.state", "address.city", "address.street", "row")
    out = master.groupBy("customer_name").agg(F.count("*").alias("n_rows"), F.array_sort(F.collect_list(row)).alias("_rows")).filter("n_rows > 1")
    return out.select("customer_name", "n_rows", F.array_join(F.transform("_rows", lambda x: F.concat_ws(" / ", x.state, x.city, x.street)), "; ").alias("addresses"))


def _entries(master: DataFrame) -> DataFrame:
    entry = F.struct("row", "customer_name", "shipto_name", "customer_number", "address").alias("e")
    return master.select(*[F.col(f"address.{x}").alias(x) for x in ADDRESS_KEY], entry, normalize_name(F.col("shipto_name")).alias("norm"))


def _names(master: DataFrame) -> DataFrame:
    """The first entry (least row) of each normalised name at an address key, and how many there are."""
    return _entries(master).groupBy(*ADDRESS_KEY, "norm").agg(F.min("e").alias("e"), F.count("*").alias("n"))


def by_address(master: DataFrame) -> DataFrame:
    """One row an address key: n entries; the first of each normalised name, in row order, and these names, one a line."""
    first = F.array_sort(F.collect_list(F.struct("e", "norm"))).alias("_f")
    out = _names(master).groupBy(*ADDRESS_KEY).agg(F.sum("n").alias("n"), first)
    return out.select(*ADDRESS_KEY, "n", F.transform("_f", lambda x: x.e).alias("firsts"), F.array_join(F.transform("_f", lambda x: x.norm), "\n").alias("names"))


def names_by_address(master: DataFrame) -> DataFrame:
    """One row an address key: names, its different ship-to names as written, each with its slot, the place of its
    normalised form in by_address(); codes, the place in ``names`` of every entry's name, in row order; width, how many slots.
    """
    name = _entries(master).groupBy(*ADDRESS_KEY, "norm", F.col("e.shipto_name").alias("shipto_name")).agg(F.min("e").alias("e"), F.collect_list("e.row").alias("rows"))
    out = name.groupBy(*ADDRESS_KEY).agg(F.array_sort(F.collect_list(F.struct("e", "norm", "shipto_name", "rows"))).alias("_f"))
    out = out.withColumn("_norms", F.array_distinct(F.transform("_f", lambda x: x.norm)))
    named = lambda x: F.struct(x.shipto_name.alias("shipto_name"), (F.array_position(F.col("_norms"), x.norm) - 1).cast("int").alias("slot"))
    places = F.array_sort(F.flatten(F.transform("_f", lambda x, i: F.transform(x.rows, lambda r: F.struct(r.alias("row"), i.alias("i"))))))
    return out.select(*ADDRESS_KEY, F.transform("_f", named).alias("names"), F.transform(places, lambda x: x.i).alias("codes"), F.size("_norms").alias("width"))


def lookup_address(keys: DataFrame, master: DataFrame) -> DataFrame:
    """Every key with each entry at its (street, city, state, postcode)."""
    m = master.select(*[F.col(f"address.{x}").alias(x) for x in ("street", "city", "state", "postcode")], "row", "customer_name", "shipto_name")
    return keys.join(m, ["street", "city", "state", "postcode"])


def lookup_customer_name(names: DataFrame, master: DataFrame, name_col: str = "name") -> DataFrame:
    """Every name with each entry whose customer name is the same when normalised."""
    m = master.select(normalize_name(F.col("customer_name")).alias("_k"), "row", "customer_name")
    return names.withColumn("_k", normalize_name(F.col(name_col))).filter("_k <> ''").join(m, "_k").drop("_k")
