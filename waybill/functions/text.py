"""Text normalisation and line predicates, all as built-in Column expressions.

``(?U)`` makes Java's classes Unicode-aware, so that white space includes
no-break spaces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Phrases and patterns that decide results.
USPS_STATES = "A[LKSZR]|C[AOT]|D[CE]|FL|GA|HI|I[ADLN]|K[SY]|LA|M[ADEHINOPST]|N[CDEHJMVY]|O[HKR]|PA|RI|S[CD]|T[NX]|UT|V[AIT]|W[AIVY]"
CSZ_STATE_LIST = rf"\b([A-Za-z][A-Za-z .'\-]+?),?\s+({USPS_STATES})\s+(\d{{5}}(?:-\d{{4}})?)\b"
CSZ = r"\b([A-Z][A-Za-z .'\-]{0,40}?),?\s+([A-Z]{2})\s+(\d{5}(?:-\d{4})?)\b"
PHONE = r"\b\(?\d{3}\)?[-.\s]\d{3}[-.\s]\d{4}\b"
LABEL_LINE = r"(?i)^\s*(?:ship\s*to|ship\s*from|bill\s*to|attn|attention|third\s*party|carrier\s*name|trailer|serial|consignee|freight\s*charge)\b"
JUNK_LINE = r"^[\W_]*$"
STREET_LINE = r"^\s*\d{2,}\s+\w"
PHONE_LOOSE = r"\d{3}[\)\.\-\s]\s*\d{3}[\.\-\s]?\s*\d{4}"
CITY_STATE_ZIP_LOOSE = r"[,\s]+[A-Za-z]{2,3}\s+\d{5}"
ATTN_LINE = r"(?i)^\s*at+[a-z]?[:;.]"
SHIP_TO_LABEL = r"(?i)S\W{0,2}H\W{0,2}I\W{0,2}[BP]\W{0,2}T\W{0,2}O"
SHIP_FROM_LABEL = r"(?i)SHIP\W*FROM"
SHIPPER_BLOCK = r"(?i)(Midwest Refrigerated|OLD WISCONSIN|Old Wisconsin|DairyFood|\bMRS\b|Warehouse|Progress|Weeden|Sheboygan|Madison,\s*WI)"
NOT_A_NAME = r"(?i)\b(BILL|LADING|BAR\s*CODE|SPACE|Carrier|Pickup|appt|Trailer|Serial|SCAC|Email|Special|Instructions|FREIGHT|CHARGES|CONSIGNEE|Customer|Order|ATTN|Hours|Call|receiving|dock|Delivery|Deliveries|Prepaid|Collect)\b"
SHIP_TO_VARIANT = r"(?i)\b[a-z]?(?:sh|sm|sl)[a-z]{0,2}p?\s*t[o0u]\b"
SHIP_FROM_VARIANT = r"(?i)\b[a-z]?(?:sh|sm|sl|sr)[a-z]{0,3}\s*(?:from|prom|rom|fram)\b"


def let(c: Column, f) -> Column:
    """f(c) with c evaluated once, however often f names it."""
    return F.get(F.transform(F.array(c), f), 0)


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def filled(c: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(c, F.lit("")) != ""


def norm_text(c: Column) -> Column:
    return collapse(F.upper(strip(F.coalesce(c.cast("string"), F.lit("")))))


def normalize_name(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


def fmt_postcode(c: Column, numeric: Column) -> Column:
    """Numbers become five digits at least (0 becomes empty); text is stripped."""
    n = c.cast("double").cast("long")
    text = F.coalesce(c, F.lit(""))
    return F.when(c.isNull(), "").when(numeric, F.when(n == 0, "").otherwise(F.format_string("%05d", n))).otherwise(strip(text))


def clean_name(c: Column) -> Column:
    no_pipes = F.translate(F.coalesce(c, F.lit("")), "|", " ")
    return strip(collapse(F.regexp_replace(no_pipes, r"(?U)^[\s.]+", "")))


def clean_for_usps(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^A-Za-z0-9 \-/#]", " "), r"\s+", " "))


def line_text(c: Column) -> Column:
    return strip(collapse(c))


def line_tokens(c: Column) -> Column:
    """Distinct lower-case alphanumeric tokens."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), 0))


def first_fragment(c: Column) -> Column:
    """The first non-empty piece between pipes, without underscores at its ends."""
    parts = F.filter(F.transform(F.split(c, r"\|"), strip), lambda x: x != "")
    piece = F.when(F.contains(c, F.lit("|")), F.coalesce(F.get(parts, 0), F.lit(""))).otherwise(c)
    return strip(F.regexp_replace(strip(piece), "^_+|_+$", ""))


def clean_lines(c: Column) -> Column:
    """Lines without junk at their ends; blank, phone-only and label lines are dropped."""
    trimmed = lambda x: line_text(F.regexp_replace(x, r"^[ \t|:;_—\-•~]+|[ \t|:;_—\-•~]+$", ""))
    lines = F.transform(F.split(F.coalesce(c, F.lit("")), r"\r\n|[\n\r\u000B\f\u001C-\u001E\u0085  ]"), trimmed)
    return F.filter(lines, lambda s: (s != "") & ~s.rlike(rf"(?U){JUNK_LINE}") & ~s.rlike(rf"^(?:{PHONE})$") & ~s.rlike(LABEL_LINE))


def is_address_content(c: Column, min_alnum: int = 3, min_word: int = 5) -> Column:
    """Looks like an address line: enough letters or digits, and a digit, an ``attn``, a P.O. box or a long capitalised word."""
    enough = F.length(F.regexp_replace(c, r"[^\p{L}\p{N}]", "")) >= min_alnum
    some = c.rlike(r"\p{Nd}") | c.rlike(r"(?i)\battn") | c.rlike(r"(?i)\bp\.?\s*o\.?\s*box\b") | c.rlike(r"(?<![A-Za-z])[A-Z][A-Za-z]{%d,}" % (min_word - 1))
    return enough & some


def is_street(c: Column) -> Column:
    """A cleaned line that starts with a number or a P.O. box."""
    cleaned = clean_for_usps(c)
    return (cleaned != "") & (cleaned.rlike(r"^\s*\d+") | cleaned.rlike(r"(?i)^\s*p\.?\s*o\.?\s*box\b"))


def looks_like_company(c: Column, own_name: str = "") -> Column:
    """A plausible customer line. ``own_name``: the paying company, whose lines never are."""
    s = strip(F.coalesce(c, F.lit("")))
    tokens = F.filter(F.split(s, r"(?U)\s+"), lambda x: x != "")
    ok = (F.length(F.regexp_replace(s, "[^A-Za-z]", "")) >= 3) & (F.size(tokens) <= 6) & (F.size(F.filter(tokens, lambda t: F.length(t) <= 2)) <= 1)
    for pattern in (STREET_LINE, PHONE_LOOSE, CITY_STATE_ZIP_LOOSE, ATTN_LINE, SHIP_TO_LABEL, SHIP_FROM_LABEL, SHIPPER_BLOCK, NOT_A_NAME):
        ok &= ~s.rlike(pattern)
    if own_name:
        ok &= ~s.rlike(own_line(own_name))
    return (s != "") & ok


def own_line(own_name: str) -> str:
    """Pattern of a line that holds the first and the last word of the paying company's name."""
    words = own_name.lower().split()
    return rf"(?i){words[0]}\b.*\b{words[-1].rstrip('s')}s?\b"


def text_score(c: Column) -> Column:
    """How much an OCR result looks like an address block: city-state-ZIP, digits and letters, lines."""
    digits = F.length(F.regexp_replace(c, r"[^\p{Nd}]", ""))
    letters = F.length(F.regexp_replace(c, r"[^\p{L}]", ""))
    lines = F.when(c == "", 0).otherwise(F.size(F.split(F.regexp_replace(c, r"\n$", ""), "\n")))
    return F.when(c.rlike(CSZ_STATE_LIST), 50).otherwise(0) + F.when((digits >= 5) & (letters >= 10), 10).otherwise(0) + F.least(F.lit(20), lines)


def yes_no(c: Column) -> Column:
    return F.when(c, "yes").otherwise("no")


def mailing_line(name: Column, street: Column, line_2: Column, city: Column, state: Column, postcode: Column) -> Column:
    """``Name, Street, [Line 2,] City, ST ZIP`` without empty parts."""
    some = lambda sep, *cs: F.array_join(F.filter(F.array(*[F.coalesce(c, F.lit("")) for c in cs]), lambda x: x != ""), sep)
    return some(", ", name, street, line_2, some(", ", city, some(" ", state, postcode)))


def address_summary(a: Column) -> Column:
    base = F.format_string("%s, %s, %s %s", a.street, a.city, a.state, a.postcode)
    return F.when(a.isNull(), "None").otherwise(F.concat(base, F.when(filled(a.line_2), F.concat(F.lit(" ("), a.line_2, F.lit(")"))).otherwise("")))


def fmt_score(c: Column) -> Column:
    return F.when(c.isNull() | (c == 0), "").otherwise(F.bround(c, 0).cast("long").cast("string"))
