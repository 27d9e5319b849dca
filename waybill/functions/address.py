"""Postal address normalisation after USPS Publication 28, table-driven.

The abbreviations are public; the split of a street line into street and unit
follows Publication 28's secondary-unit designators. This is not a statistical
address parser: lines without a house number, P.O. box or known shape use the
plain fallback (upper case, single spaces), which the result tells.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import fmt_postcode, let, norm_text

# USPS abbreviations.
SUFFIXES = {"ALLEY": "ALY", "AVENUE": "AVE", "AV": "AVE", "BOULEVARD": "BLVD", "BRIDGE": "BRG", "BYPASS": "BYP", "CENTER": "CTR", "CIRCLE": "CIR", "COURT": "CT", "COVE": "CV", "CREEK": "CRK", "CRESCENT": "CRES", "CROSSING": "XING", "DRIVE": "DR", "EXPRESSWAY": "EXPY", "EXTENSION": "EXT", "FREEWAY": "FWY", "GARDENS": "GDNS", "GROVE": "GRV", "HEIGHTS": "HTS", "HIGHWAY": "HWY", "HILL": "HL", "HILLS": "HLS", "HOLLOW": "HOLW", "JUNCTION": "JCT", "LAKE": "LK", "LANDING": "LNDG", "LANE": "LN", "LOOP": "LOOP", "MANOR": "MNR", "MEADOWS": "MDWS", "MOUNTAIN": "MTN", "PARKWAY": "PKWY", "PLACE": "PL", "PLAZA": "PLZ", "POINT": "PT", "RIDGE": "RDG", "ROAD": "RD", "ROUTE": "RTE", "SQUARE": "SQ", "STATION": "STA", "STREET": "ST", "STR": "ST", "TERRACE": "TER", "TRAIL": "TRL", "TURNPIKE": "TPKE", "VALLEY": "VLY", "VIEW": "VW", "VILLAGE": "VLG", "VISTA": "VIS", "WAY": "WAY"}
DIRECTIONS = {"NORTH": "N", "SOUTH": "S", "EAST": "E", "WEST": "W", "NORTHEAST": "NE", "NORTHWEST": "NW", "SOUTHEAST": "SE", "SOUTHWEST": "SW"}
UNITS = {"APARTMENT": "APT", "BUILDING": "BLDG", "DEPARTMENT": "DEPT", "FLOOR": "FL", "ROOM": "RM", "SPACE": "SPC", "SUITE": "STE", "STE": "STE", "APT": "APT", "BLDG": "BLDG", "DEPT": "DEPT", "FL": "FL", "RM": "RM", "UNIT": "UNIT", "DOCK": "DOCK", "LOT": "LOT", "#": "UNIT"}
STATES = {"ALABAMA": "AL", "ALASKA": "AK", "ARIZONA": "AZ", "ARKANSAS": "AR", "CALIFORNIA": "CA", "COLORADO": "CO", "CONNECTICUT": "CT", "DELAWARE": "DE", "FLORIDA": "FL", "GEORGIA": "GA", "HAWAII": "HI", "IDAHO": "ID", "ILLINOIS": "IL", "INDIANA": "IN", "IOWA": "IA", "KANSAS": "KS", "KENTUCKY": "KY", "LOUISIANA": "LA", "MAINE": "ME", "MARYLAND": "MD", "MASSACHUSETTS": "MA", "MICHIGAN": "MI", "MINNESOTA": "MN", "MISSISSIPPI": "MS", "MISSOURI": "MO", "MONTANA": "MT", "NEBRASKA": "NE", "NEVADA": "NV", "NEW HAMPSHIRE": "NH", "NEW JERSEY": "NJ", "NEW MEXICO": "NM", "NEW YORK": "NY", "NORTH CAROLINA": "NC", "NORTH DAKOTA": "ND", "OHIO": "OH", "OKLAHOMA": "OK", "OREGON": "OR", "PENNSYLVANIA": "PA", "RHODE ISLAND": "RI", "SOUTH CAROLINA": "SC", "SOUTH DAKOTA": "SD", "TENNESSEE": "TN", "TEXAS": "TX", "UTAH": "UT", "VERMONT": "VT", "VIRGINIA": "VA", "WASHINGTON": "WA", "WEST VIRGINIA": "WV", "WISCONSIN": "WI", "WYOMING": "WY"}


def _mapped(table: dict[str, str], key: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key), key)


def plain_address(street: Column, city: Column, state: Column, postcode: Column, numeric: Column, line_2: Column) -> Column:
    return F.struct(norm_text(street).alias("street"), norm_text(line_2).alias("line_2"), norm_text(city).alias("city"), norm_text(state).alias("state"), fmt_postcode(postcode, numeric).alias("postcode"))


def normalize_address(street: Column, city: Column, state: Column, postcode: Column, numeric: Column | None = None, line_2: Column | None = None) -> Column:
    """STRUCT<street, line_2, city, state, postcode, used_fallback>; all strings upper case, empty if missing."""
    numeric = F.lit(False) if numeric is None else numeric
    line_2 = F.lit("") if line_2 is None else line_2
    bare = lambda c: F.trim(F.regexp_replace(F.regexp_replace(norm_text(c), r"[.,;:'\"]", " "), r"\s+", " "))
    unit = r"^(.*\S)\s+((?:" + "|".join(k for k in UNITS if k != "#") + r")\s+\S+|#\s*\S+)$"
    unit_of = lambda c: F.array_join(F.transform(F.split(c, " "), lambda w, i: F.when(i == 0, _mapped(UNITS, w)).otherwise(w)), " ")
    given = lambda c: let(bare(c), lambda g: F.when(g != "", unit_of(g)).otherwise(""))

    def street_words(main: Column) -> Column:
        """Abbreviations: the suffix is the last word, or the one before a closing direction; directions stand second or last."""

        def short(words: Column) -> Column:
            n = F.size(words)
            closing = F.element_at(words, -1).isin(list(DIRECTIONS) + list(DIRECTIONS.values()))
            last = F.when(closing & (n > 2), n - 2).otherwise(n - 1)
            return F.array_join(F.transform(words, lambda w, i: F.when((i == last) & (i >= 1), _mapped(SUFFIXES, w)).when(((i == 1) & (n > 3)) | ((i == n - 1) & (i > 2)), _mapped(DIRECTIONS, w)).otherwise(w)), " ")

        return F.when(main.startswith("PO BOX "), main).otherwise(let(F.split(main, " "), short))

    def parts(s: Column) -> Column:
        has_unit = s.rlike(unit) & ~s.startswith("PO BOX ")
        split = F.struct(F.when(has_unit, F.regexp_extract(s, unit, 1)).otherwise(s).alias("main"), F.when(has_unit, F.regexp_replace(F.regexp_extract(s, unit, 2), r"^#\s*", "# ")).otherwise("").alias("extra"))
        return let(split, result)

    def result(q: Column) -> Column:
        lines = F.filter(F.array(F.when(q.extra != "", unit_of(q.extra)).otherwise(""), given(line_2)), lambda x: x != "")
        known = _mapped(STATES, F.translate(norm_text(state), ".", ""))
        parsed = F.struct(street_words(q.main).alias("street"), F.array_join(lines, " ").alias("line_2"), F.translate(norm_text(city), ".,", "").alias("city"), known.alias("state"), fmt_postcode(postcode, numeric).alias("postcode"), F.lit(False).alias("used_fallback"))
        plain = F.struct(norm_text(street).alias("street"), norm_text(line_2).alias("line_2"), norm_text(city).alias("city"), norm_text(state).alias("state"), fmt_postcode(postcode, numeric).alias("postcode"), F.lit(True).alias("used_fallback"))
        return F.when(q.main.rlike(r"^(\d+\S* \S|PO BOX \S)"), parsed).otherwise(plain)

    return let(F.regexp_replace(bare(street), r"^P\s*O\s*BOX\s+#?\s*", "PO BOX "), parts)
