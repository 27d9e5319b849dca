"""The invoice engine: scalar vectors, validation, matching, parsing, bills, OCR steps and a whole run."""

import datetime
import json
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from waybill.functions import fuzzy as Z
from waybill.functions import text as X
from waybill.functions.address import normalize_address
from waybill.operators import bills as B
from waybill.operators import lines as L
from waybill.operators import master as M
from waybill.operators import match as R
from waybill.operators import ocr as O
from waybill.plans.run import MasterError, load_master, run_batch
from waybill.plans.vendors import REQUIRED, VENDORS
from waybill.sources import readers, sinks
from waybill.streaming import drop_zone


def one(spark, f, *values, types=None):
    """f of columns holding the values, for each tuple of values."""
    names = [f"c{k}" for k in range(len(values[0]))]
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, types or ["string"] * len(names)))
    rows = spark.createDataFrame([(k, *v) for k, v in enumerate(values)], f"k int, {schema}")
    return [r.o for r in rows.select("k", f(*[F.col(n) for n in names]).alias("o")).orderBy("k").collect()]


# --- scalars --------------------------------------------------------------------
def test_text_normalisation(spark):
    assert one(spark, X.norm_text, (None,), ("  a\t b c ",), ("",)) == ["", "A B C", ""]
    assert one(spark, X.normalize_name, ("St. John's, Inc.",), (None,), ("--",)) == ["st john s inc", "", ""]
    assert one(spark, X.clean_name, (" .. |U.S. | Foods ",), (None,)) == ["U.S. Foods", ""]
    assert one(spark, X.clean_for_usps, ('12 "Main" St., #4',), (None,)) == ["12 Main St #4", ""]
    assert one(spark, X.first_fragment, ("a | b",), (" | _x_ | y",), ("__z",), ("|",)) == ["a", "x", "z", ""]
    assert [sorted(x) for x in one(spark, X.line_tokens, ("Ab 1 ab-2",))] == [["1", "2", "ab"]]


def test_postcode(spark):
    got = one(spark, X.fmt_postcode, (None, False), ("1234", True), ("0", True), (" 01234 ", False), ("123456", True), ("54301.0", True), ("", False), types=["string", "boolean"])
    assert got == ["", "01234", "", "01234", "123456", "54301", ""]


@pytest.mark.parametrize(
    "al1,expected",
    [
        ("Alpha Camp - 200001, ATTN: Dock", ("Alpha Camp", "200001", "ATTN: Dock", True, False)),
        ("Alpha Camp - 200001", ("Alpha Camp", "200001", None, True, False)),
        ("Alpha Center -200002", ("Alpha Center", "200002", None, True, False)),
        ("North-South Inst. - 200003, Rear Door", ("North-South Inst.", "200003", "Rear Door", True, False)),
        ("Alpha - Annex - 200004, ATTN: X", ("Alpha - Annex", "200004", "ATTN: X", True, False)),
        ("Alpha Camp - 200005 ATTN: X", ("Alpha Camp", "200005", "ATTN: X", True, False)),
        ("Beta Meals, Inc.", ("Beta Meals, Inc.", None, None, True, False)),
        ("Beta c/o Gamma-Delta Island", ("Beta c/o Gamma-Delta Island", None, None, True, False)),
        ("Beta - C", ("Beta - C", None, None, False, False)),
        ("Alpha FCC - Camp 200006", ("Alpha FCC", "200006", None, False, True)),
        ("Alpha USP - #200007, ATTN: X", ("Alpha USP", "200007", None, False, True)),
        ("", ("", None, None, True, False)),
        (None, ("", None, None, True, False)),
        ("Short - 12", ("Short", "12", None, True, False)),
    ],
)
def test_parse_al1(spark, al1, expected):
    assert tuple(one(spark, M.parse_al1, (al1,))[0]) == expected


def test_line_predicates(spark):
    assert one(spark, X.is_address_content, ("Harlow",), ("Sati Roca",), ("ab",), ("12 a",), ("Attn bo",), ("P.O. Box a",), ("torent caaik",), ("xHarlow",)) == [True, False, False, True, True, True, False, False]
    assert one(spark, X.is_street, ("12 Main",), ("P.O. Box 4",), ("Main 12",), ("",)) == [True, True, False, False]
    company = lambda c: X.looks_like_company(c, "Own Farms")
    assert one(spark, company, ("Sysco Foods",), ("12 Main St",), ("(555) 123-4567",), ("Tampa, FL 33601",), ("SHIP TO",), ("own big farm",), ("a b c",), ("Order desk",), (None,)) == [True, False, False, False, False, False, False, False, False]
    raw = "  SHIP TO:\nAcme Foods |\n555-123-4567\n---\n12 Main St\nTampa, FL 33601"
    assert one(spark, X.clean_lines, (raw,), (None,)) == [["Acme Foods", "12 Main St", "Tampa, FL 33601"], []]


def test_mailing_line(spark):
    got = one(spark, X.mailing_line, ("N", "1 A St", "", "C", "WI", "5"), ("N", "", None, "", "", ""), ("", "", "", "C", "", "5"))
    assert got == ["N, 1 A St, C, WI 5", "N", "C, 5"]
    assert one(spark, X.fmt_score, (None,), (0,), (84,), types=["int"]) == ["", "", "84"]


def test_usps(spark):
    f = lambda s, l2: normalize_address(s, F.lit("Green Bay."), F.lit("wisconsin"), F.lit("54301"), None, l2)
    got = one(spark, f, ("12 north Main Street, Suite 4", None), ("12 Main St", "Apt 3"), ("P.O. Box 7", None), ("no number road", None), ("", None), ("9 Oak Avenue West #2", None))
    assert [tuple(x)[:2] for x in got] == [("12 N MAIN ST", "STE 4"), ("12 MAIN ST", "APT 3"), ("PO BOX 7", ""), ("NO NUMBER ROAD", ""), ("", ""), ("9 OAK AVE W", "UNIT 2")]
    assert [x.used_fallback for x in got] == [False, False, False, True, True, False]
    assert got[0].state == "WI" and got[3].state == "WISCONSIN"
    again = one(spark, f, *[(x.street, x.line_2) for x in got])
    assert [tuple(x) for x in again][:3] == [tuple(x) for x in got][:3]


# --- fuzzy --------------------------------------------------------------------------
def test_ratio_vectors():
    assert Z.lcs_length("butner fci", "butner fci camp") == 10 and Z.lcs_length("kitten", "sitting") == 4
    assert Z.ratio("", "") == 100 and Z.ratio("a", "") == 0 and Z.ratio("abc", "abc") == 100
    assert round(Z.ratio("kitten", "sitting"), 4) == round(200 * 4 / 13, 4)
    assert Z.partial_ratio("ship to", "xx ship to yy") == 100 and Z.partial_ratio("bill of lading number", "ti of latliog naersteet") < 85
    assert Z.token_sort_ratio("b a", "a b") == 100 and Z.token_set_ratio("a b", "a b c") == 100 and Z.token_set_ratio("", "a") == 0
    assert Z.weighted_ratio("", "a") == 0 and Z.weighted_ratio("alpha camp", "camp alpha") == 95
    assert Z.weighted_ratio("alpha", "alpha foods warehouse") == 90


@given(st.text("ab c", max_size=12), st.text("ab c", max_size=12))
@settings(max_examples=200, deadline=None)
def test_ratio_properties(a, b):
    def lcs(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            new = [0]
            for j, d in enumerate(y):
                new.append(row[j] + 1 if c == d else max(row[j + 1], new[-1]))
            row = new
        return row[-1]

    assert Z.lcs_length(a, b) == lcs(a, b)
    assert Z.ratio(a, b) == Z.ratio(b, a) and 0 <= Z.ratio(a, b) <= 100
    s, t = sorted((a, b), key=len)
    if s and len(s) < len(t):
        windows = [t[max(0, k) : k + len(s)] for k in range(1 - len(s), len(t))]
        assert Z.partial_ratio(a, b) == max(Z.ratio(s, w) for w in windows)
    assert Z.partial_ratio(a, b) >= (Z.ratio(a, b) if len(a) == len(b) else 0)


def test_native_ratio_as_python(spark):
    pairs = [("butner fci", "butner fci camp"), ("", ""), ("", "x"), ("héé", "hée")]
    assert [round(x, 6) for x in one(spark, Z.ratio_native, *pairs)] == [round(Z.ratio(*p), 6) for p in pairs]
    assert one(spark, Z.weighted_ratio_udf, ("a", None), ("a", "a")) [1] == 100


# --- master -------------------------------------------------------------------------
def cells(spark):
    rows = [
        ("Alpha", "Alpha Camp - 200001", "1 Main St", "Tampa", "FL", "33601"),
        ("Beta", "North-South - 200002", "2 Main St", "Tampa", "FL", "33602"),
        ("Alpha", "Alpha Camp - 200003", "1 Main St", "Tampa", "FL", "33601"),
        ("Gamma", "Gamma Site", "3 Main St", None, None, None),
        ("Delta", "Delta - Camp 200004", "4 Main St", "Tampa", "FL", 1234),
        ("Eps", "Eps - #200005, ATTN", "5 Main St", "Tampa", "FL", "33605"),
        ("Zeta", "Zeta Inc", "6 Main St", "Tampa", "FL", "33606"),
        ("Eta", "Eta - 200006 Rear", "7 Main St", "Tampa", "FL", 0),
        ("Theta", "Theta - 200001", "8 Main St", "Tampa", "FL", "33608"),
        (None, None, None, "x", "y", "z"),
    ]
    return spark.createDataFrame(readers.master_cells(rows), readers.MASTER_CELLS)


def test_validation(spark):
    rows = M.master_rows(cells(spark))
    assert rows.count() == 9
    got = [(v.row, v.rule, v.severity) for v in M.validate(rows).orderBy("row", "rule").collect()]
    assert got == [(4, M.TRIPLE, "hard"), (5, M.NO_NUMBER, "hard"), (5, M.REQUIRED, "hard"), (6, M.MALFORMED, "soft"), (7, M.MALFORMED, "soft"), (8, M.NO_NUMBER, "hard"), (10, M.DUPLICATE_NUMBER, "soft")]
    said = {(v.row, v.rule): v.message for v in M.validate(rows).collect()}
    assert "first seen at row 2" in said[4, M.TRIPLE] and "['City', 'State', 'Postcode']" in said[5, M.REQUIRED]
    # Duplicates stay; a zero ZIP passes the fields' rule but has no address.
    assert sorted(r.row for r in M.valid_master(rows).collect()) == [2, 3, 4, 6, 7, 8, 10]
    text, n_hard = sinks.validation_report(M.validate(rows), "sheet", 9, strict=False, generated="now")
    assert n_hard == 4 and "PASS with 4 hard violation(s)" in text and "[OK]" not in text.split("=== SOFT")[0]
    assert M.master_stats(M.valid_master(rows)).first().n_addresses == 6


def test_strict_master_writes_the_report_first(spark, tmp_path):
    path = str(tmp_path / "report.txt")
    with pytest.raises(MasterError):
        load_master(cells(spark), "sheet", path, strict=True)
    assert "aborted via --strict-master" in open(path).read()
    assert load_master(cells(spark), "sheet", path).count() == 7


# --- matching -----------------------------------------------------------------------
ADDRESS = "struct<street:string,line_2:string,city:string,state:string,postcode:string>"


def entry(row, name, street, shipto=None, line_2=""):
    return (row, name, shipto or name, f"2000{row:02d}", (street, line_2, "TAMPA", "FL", "33601"))


def match(spark, sources, entries=None):
    entries = entries or [entry(2, "Alpha", "1 A ST"), entry(3, "Beta", "2 B ST"), entry(4, "Gamma", "3 C ST", "Gamma North Camp"), entry(5, "Delta", "3 C ST", "Delta South Mill"), entry(6, "Own Farms Inventory", "9 Z ST"), entry(7, "Alpha", "4 D ST"), entry(8, "Eps", "5 E ST", "Same Name"), entry(9, "Eps2", "5 E ST", "Same Name")]
    m = spark.createDataFrame(entries, f"row int, customer_name string, shipto_name string, customer_number string, address {ADDRESS}")
    rows = []
    for source, (street, names) in sources.items():
        a = (street, "UNIT 9", "TAMPA", "FL", "33601") if street is not None else None
        rows.append(("i", source, (names or [None])[0], names, a, False))
    e = spark.createDataFrame(rows, f"invoice_id string, source string, name string, name_candidates array<string>, address {ADDRESS}, success boolean")
    return R.match_invoices(e, m, ["own farms inventory"]).first()


N = (None, None)


@pytest.mark.parametrize(
    "bol,page1,method,severity,row",
    [
        (N, N, "hard_fail", "severe", None),
        (("1 A ST", ["Alpha"]), ("1 A ST", ["Alpha"]), "agree", "ok", 2),
        (("1 A ST", ["wrong"]), N, "bol_only", "ok", 2),
        (N, ("2 B ST", None), "inv_only", "ok", 3),
        (("1 A ST", None), ("2 B ST", None), "bol_wins_disagreement", "severe", 2),
        (("3 C ST", ["gamma north camp"]), ("2 B ST", None), "bol_wins_disagreement", "info", 4),
        (("8 NO ST", None), ("8 NO ST", None), "hard_fail", "severe", None),
        (("9 Z ST", None), N, "denied", "severe", None),
        (("9 Z ST", None), ("1 A ST", None), "denied", "severe", None),
        (("1 A ST", None), ("4 D ST", None), "agree", "ok", 2),
        (("3 C ST", ["zzzz qqqq"]), ("1 A ST", None), "inv_only", "ok", 2),
        (("3 C ST", ["zzzz qqqq"]), N, "hard_fail", "severe", None),
        (("3 C ST", []), N, "hard_fail", "severe", None),
        (("3 C ST", ["xx", "dock 4", "Delta South Mill"]), N, "bol_only", "ok", 5),
        (("5 E ST", ["same name"]), N, "bol_only", "ok", 8),
        (("", ["x"]), ("1 A ST", None), "inv_only", "ok", 2),
    ],
)
def test_policy(spark, bol, page1, method, severity, row):
    r = match(spark, {"bol": bol, "page1": page1})
    assert (r.method, r.severity, r.master_row) == (method, severity, row)
    assert r.success == (method not in ("hard_fail", "denied"))
    if method == "denied":
        assert r.entry.row == 6 and "row 6" in r.fail_reason
    if (bol, page1) == (N, N):
        assert r.fail_reason == R.NO_ADDRESS


def test_policy_is_total(spark):
    """Every pair of source methods has one outcome."""
    e = f"struct<row:int,customer_name:string,shipto_name:string,customer_number:string,address:{ADDRESS}>"
    rows, methods = [], [R.NO_INPUT, R.NO_MATCH, R.UNIQUE, R.DISAMBIGUATED, R.AMBIGUOUS]
    for i, a in enumerate(methods):
        for j, b in enumerate(methods):
            for same in (True, False):
                for source, m, name in (("bol", a, "X"), ("page1", b, "X" if same else "Y")):
                    rows.append((f"{i}{j}{same}", source, m, (1, name, "", "", None) if m in (R.UNIQUE, R.DISAMBIGUATED) else None, None, 0, []))
    m = spark.createDataFrame(rows, f"invoice_id string, source string, method string, entry {e}, score int, n_candidates int, matrix array<struct<cand:string,shipto_name:string,score:int>>")
    got = R.combine_sources(m).collect()
    assert len(got) == 50 and all(r.method and r.severity in ("ok", "info", "severe") for r in got)
    assert sum(r.success for r in got) == sum(1 for a in methods for b in methods if {a, b} & {R.UNIQUE, R.DISAMBIGUATED}) * 2


def test_match_log(spark):
    m = spark.createDataFrame([entry(4, "Gamma", "3 C ST", "Gamma North"), entry(5, "Delta", "3 C ST", "Delta South")], f"row int, customer_name string, shipto_name string, customer_number string, address {ADDRESS}")
    e = spark.createDataFrame([("i", "bol", "delta south", ["delta south"], ("3 C ST", "", "TAMPA", "FL", "33601"))], f"invoice_id string, source string, name string, name_candidates array<string>, address {ADDRESS}")
    log = R.match_log(R.match_invoices(e, m)).first().log
    assert "method=bol_only" in log and "score: 100" in log
    assert log.index("WRatio('delta south', 'Delta South') = 100") < log.index("'Gamma North'")


# --- pages, bills and a whole run ------------------------------------------------------
LAYOUT = "x\nSHIPPER      CONSIGNEE\n\nOld Wisconsin Sausage Company     Alpha Camp\n1 Dock Rd     1 Main Street\nlower left    Suite 5\nMadison, WI 53703      Tampa,  fl 33601"
TEXT = "INVOICE 1234567\n01/05/2024\n01/20/2024\nOld Wisconsin Sausage Company\nS0-77\n10.00 1,234.56 5.00\n02/04/2024"
TEXT_B = "Freight 7654321 01/05/2024\n02/01/2024HIGHX\nSO-1/2/3\n10.00\n03/04/2024  $1,234.56 USD"


def pages(spark, *rows):
    return spark.createDataFrame(rows, "invoice_id string, vendor string, text string, layout string")


def test_parse_vendor_a(spark):
    r = VENDORS["a"].parse(pages(spark, ("i", "a", TEXT, LAYOUT))).first()
    assert (r.invoice_number, r.so_number, r.total_amount, r.shipper) == ("1234567", "SO-77", Decimal("1234.56"), "Old Wisconsin Sausage Company")
    assert (r.invoice_date, r.ship_date, r.past_due_date) == (datetime.date(2024, 1, 5), datetime.date(2024, 1, 20), datetime.date(2024, 2, 4))
    assert (r.consignee, r.consignee_address_line_1, r.consignee_address_line_2, r.consignee_city, r.consignee_state, r.consignee_postcode) == ("Alpha Camp", "1 Main Street", "Suite 5", "Tampa", "FL", "33601")
    assert r.reasons == {} and not r.parse_error


def test_parse_failures(spark):
    long = "CONSIGNEE\n" + "\n".join(f"a    l{k}" for k in range(9))
    late = "CONSIGNEE\n" + "\n".join(f"a    l{k}" for k in range(6)) + "\na    Tampa, FL 33601"
    rows = VENDORS["a"].parse(pages(spark, ("1", "a", "", ""), ("2", "a", "01/05/2024 13/45/2024 MRS 5.00", "CONSIGNEE\nTampa, FL 33601"), ("3", "a", None, long), ("4", "a", "x 7654321", "CONSIGNEE\nonly    name"), ("5", "a", "", late))).orderBy("invoice_id").collect()
    assert rows[0].reasons["consignee"] == "no line ending in 'CONSIGNEE' found in layout text" and rows[0].invoice_number is None
    assert rows[1].parse_error and rows[1].shipper == "Midwest Refrigerated Services" and "found 2" in rows[1].reasons["past_due_date"]
    assert rows[1].reasons["consignee"] == "consignee block has CSZ but no name line"
    assert rows[2].reasons["consignee"].startswith("scanned >6 lines")
    assert rows[3].reasons["consignee"] == "no city/state/zip line found in consignee block" and rows[3].invoice_number == "7654321"
    assert rows[4].consignee == "l0" and rows[4].consignee_city == "Tampa"


def test_parse_vendor_b(spark):
    lone = LAYOUT.replace("1 Dock Rd", "lone line\n1 Dock Rd")
    r = VENDORS["b"].parse(pages(spark, ("i", "b", TEXT_B, lone))).first()
    assert (r.invoice_number, r.so_number, r.total_amount, r.shipper, r.consignee_address_line_1) == ("7654321", "SO-1/2/3", Decimal("1234.56"), "Old Wisconsin Sausage Company", "1 Main Street")
    assert (r.ship_date, r.past_due_date) == (datetime.date(2024, 2, 1), datetime.date(2024, 3, 4))


def test_rules(spark):
    day = datetime.date
    rows = spark.createDataFrame([(day(2024, 1, 5), day(2024, 1, 20)), (day(2024, 1, 31), day(2024, 2, 1)), (day(2023, 1, 5), day(2024, 1, 5))], "i date, s date")
    assert [r[0] for r in rows.select(B.bill_date(F.col("i"), F.col("s"))).collect()] == [day(2024, 1, 5), day(2024, 2, 1), day(2024, 1, 5)]
    cat = lambda c: B.category(c, VENDORS["a"].categories)
    assert one(spark, cat, ("DairyFood USA LLC",), ("DairyFood",), ("dairyfood",), ("",)) == ["5128 Product Delivery - Customer:Dairyfood"] * 2 + [B.UNKNOWN_CATEGORY, "Product Delivery - Customer:Outbound Transport - MRS"]


@pytest.fixture(scope="module")
def run(spark):
    master = load_master(cells(spark))
    given = pages(spark, ("ok.pdf", "a", TEXT, LAYOUT.replace("Suite 5", "Dock 5")), ("date.pdf", "a", TEXT.replace("01/20/2024", "13/45/2024"), LAYOUT), ("so.pdf", "a", TEXT.replace("S0-77", ""), LAYOUT), ("miss.pdf", "a", TEXT, LAYOUT.replace("1 Main Street", "99 Elm Street")))
    return run_batch(given, None, master, VENDORS["a"], run_id="r")


def test_outcomes(spark, run):
    got = {r.invoice_id: r for r in run.outcome.collect()}
    assert {k: r.fail_step for k, r in got.items()} == {"ok.pdf": None, "date.pdf": "parse_pdf", "so.pdf": "validate_fields", "miss.pdf": "match_customer"}
    assert "so_number" in got["so.pdf"].fail_message and got["so.pdf"].method is None
    assert run.totals() == {"total": 4, "succeeded": 1, "failed": 3} and run.report()["resolved"] == 1
    b = B.bill_rows(run.bills).collect()
    assert [tuple(x) for x in b] == [("1234567", "Badger State Western, Inc.", "01/05/2024", "02/03/2024", "Category Details", "5127 Product Delivery - Customer:Old Wisconsin", "SO-77", "1234.56", "Alpha", "SO-77")]
    assert "Bill 1 of 1" in sinks.bills_preview(B.bill_rows(run.bills))
    assert [r.invoice_id for r in run.discrepancies.collect()] == ["ok.pdf"]


def test_artifacts(spark, run, tmp_path):
    import csv
    import glob

    out = run.finalize(str(tmp_path))
    read = lambda d: list(csv.DictReader(open(glob.glob(f"{tmp_path}/{d}/part-*.csv")[0], newline="")))
    assert [r["Customer / Project"] for r in read("bills")] == ["Alpha"]
    summary = read("summary")
    assert list(summary[0]) == B.SUMMARY_HEADERS and [r["Status"] for r in summary] == ["FAIL", "FAIL", "SUCCESS", "FAIL"]
    assert read("discrepancies")[0]["Name Differs"] == "yes"
    saved = json.load(open(f"{tmp_path}/manifest.json"))
    assert saved["totals"] == out["totals"] and saved["artifacts"]["bills_csv"]
    assert run.finalize(str(tmp_path / "dry"), dry_run=True)["artifacts"]["bills_csv"] is None
    raw = open(glob.glob(f"{tmp_path}/bills/part-*.csv")[0], newline="").read()
    assert raw.startswith("Bill no.,Vendor,") and raw.endswith("\r\n")
    golden = sinks.golden_json(run.parsed, run.match, run.bills).filter("invoice_id = 'ok.pdf'").first().json
    assert json.loads(golden)["invoice_data"]["ship_date"] == "2024-01-20" and json.loads(golden)["customer_match"]["match_method"] == "inv_only"


def test_first_missing_order(spark):
    assert REQUIRED[0] == "invoice_number"


def test_discrepancy_without_page(spark):
    e = f"struct<row:int,customer_name:string,shipto_name:string,customer_number:string,address:{ADDRESS}>"
    m = spark.createDataFrame([("i", "bol_only", True, (2, "Alpha, Inc.", "", None, ("1 A ST", "", "TAMPA", "FL", "33601"))), ("j", "agree", True, (3, "Beta", "", None, ("2 B ST", "", "T", "FL", "1")))], f"invoice_id string, method string, success boolean, entry {e}")
    p = spark.createDataFrame([("j", "BETA.", ("2 B ST", "", "T", "FL", "1"))], f"invoice_id string, name string, address {ADDRESS}")
    rows = B.discrepancies(m, p).collect()
    assert [r.invoice_id for r in rows] == ["i"] and rows[0].street_differs and not rows[0].line_2_differs and rows[0].name_differs


# --- OCR ------------------------------------------------------------------------------
def lines(spark, *rows):
    return spark.createDataFrame([("i", k, *r, 0, 100) for k, r in enumerate(rows)], O.LINE_TYPES)


def test_words_to_lines(spark):
    w = spark.createDataFrame([("i", "page", 6, 1, 1, 1, 2, 50, 10, 20, 12, " b "), ("i", "page", 6, 1, 1, 1, 1, 10, 12, 20, 8, "a"), ("i", "page", 6, 1, 1, 1, 3, 90, 1, 9, 99, " ")], readers.OCR_WORDS)
    r = O.word_lines(w).first()
    assert (r.text, r.y_top, r.y_bot, r.x_left, r.x_right) == ("a b", 10, 22, 10, 70)


def test_islands_use_the_line_before(spark):
    """The second line ends above the first; the third begins below the second only."""
    got = O.y_islands(lines(spark, ("a", 0, 100), ("b", 5, 20), ("c", 50, 60))).orderBy("line_idx").collect()
    assert [r.island for r in got] == [0, 0, 1]


def test_csz_pick(spark):
    got = O.csz_pick(lines(spark, ("| Tampa, FL 33601", 100, 130), ("Tampa FL 33601-1234", 102, 120), ("Ocala, FL 34470", 300, 305), ("none", 0, 9))).first()
    assert (got.line_idx, got.csz_city, got.csz_zip) == (1, "Tampa", "33601-1234")


def test_anchors(spark):
    p = O.Profile(lower_anchor="own farms")
    ls = lines(spark, ("BILL OF LADING NUMBER: 12", 100, 120), ("Bill of Ladinq Number", 105, 120), ("i", 0, 5), ("Own Farms", 401, 420))
    at = O.anchor_mean(O.anchor_lines(ls, p.upper_anchor)).first().y
    assert at == 102  # the mean of 100 and 105, half to even
    page = spark.createDataFrame([("i", 1000, 1400)], "invoice_id string, page_w int, page_h int")
    hw = spark.createDataFrame([("i", 0, 100, 5, 60, 12, "SHORT"), ("i", 1, 400, 5, 60, 12, "FORM"), ("i", 2, 1, 1, 1, 1, "elsewhere")], "invoice_id string, word_idx int, left int, top int, width int, height int, text string")
    b = O.bounds(page, ls, hw, p).first()
    assert (b.upper_y, b.lower_y, b.mid_y, b.divider_x, b.roi_x2, b.roi_y1, b.roi_y2, b.failure) == (102, 401, 251, 280, 340, 201, 451, None)
    assert "neither the upper anchor ('bill of lading number')" in O.bounds(page, ls.filter("line_idx = 2"), hw, p).first().failure


def test_dedupe_and_walk(spark):
    ls = lines(
        spark,
        ("ship to", 60, 80), ("Acme Foods Inc", 100, 120), ("Acme Foods", 101, 118), ("12 Main Street", 140, 160), ("12 Main Street", 141, 175), ("Suite 4 Dock", 180, 200), ("Tampa, FL 33601", 220, 240), ("oh", 176, 179),
    )
    kept = O.dedupe_passes(ls)
    assert sorted(r.line_idx for r in kept.collect()) == [0, 1, 3, 5, 6, 7]
    csz = O.csz_pick(kept)
    mid = spark.createDataFrame([("i", 10)], "invoice_id string, mid_y int")
    block = O.walk_up(kept, csz, mid)
    rows = block.orderBy("pos").collect()
    assert [r.text for r in rows] == ["Acme Foods Inc", "12 Main Street", "Suite 4 Dock", "Tampa, FL 33601"]
    assert rows[0].stop_reason.startswith("boundary 'ship to'")
    parts = {r.text: r.part for r in O.split_block(block).collect()}
    assert parts == {"Acme Foods Inc": "name", "12 Main Street": "street", "Suite 4 Dock": "line_2", "Tampa, FL 33601": "csz"}
    r = O.bol_ship_to(O.split_block(block), csz).first()
    assert (r.name, r.address.street, r.address.postcode, r.success, r.csz_line) == ("Acme Foods Inc", "12 MAIN ST", "33601", True, "Tampa, FL 33601")


def test_street_is_the_lowest(spark):
    ls = lines(spark, ("1234 Holdings Inc", 10, 20), ("PO Box 5", 30, 40), ("ATTN Bo", 50, 60), ("Tampa, FL 33601", 70, 80)).withColumn("is_csz", F.col("line_idx") == 3)
    assert [r.part for r in O.split_block(ls).orderBy("line_idx").collect()] == ["name", "street", "line_2", "csz"]


def test_label_anchors(spark):
    ls = lines(spark, ("SHIP FROM", 10, 20), ("SHIP TO", 50, 60), ("SMP TO carter", 200, 210), ("Carrier nam", 150, 160), ("third parly freight chargs", 400, 410))
    assert O.top_anchor(ls).first().line_idx == 3 and O.top_anchor(ls).first().score == 85
    assert O.bottom_anchor(ls).first().line_idx == 4
    v = spark.createDataFrame([("i", 0, "noise"), ("i", 1, "Tampa, FL 33601"), ("i", 2, "Tampa, FL 33601")], "invoice_id string, variant_idx int, text string")
    assert O.best_variant(v).first().variant_idx == 1


def test_whole_extraction(spark):
    p = O.Profile(lower_anchor="own farms")
    page = spark.createDataFrame([("i", 1000, 1400), ("none", 1000, 1400)], "invoice_id string, page_w int, page_h int")
    full = lines(spark, ("BILL OF LADING NUMBER", 100, 120), ("OWN FARMS", 400, 420))
    hw = spark.createDataFrame([], "invoice_id string, word_idx int, left int, top int, width int, height int, text string")
    roi = lines(spark, ("Acme Foods", 300, 320), ("12 Main St", 340, 360), ("Tampa, FL 33601", 380, 400))
    got = {r.invoice_id: r for r in O.extract_bol(page, full, hw, roi, p).collect()}
    assert got["i"].address.street == "12 MAIN ST" and got["i"].name == "Acme Foods"
    assert not got["none"].success and "neither" in got["none"].failure_reason


def test_extraction_from_words(spark):
    """Words of three OCR runs; the region's words count from its corner (here y 200 = (100 + 400) // 2 - 50)."""
    p = O.Profile(lower_anchor="own farms")
    page = spark.createDataFrame([(i, 1000, 1400) for i in ("i", "low", "none", "blank")], "invoice_id string, page_w int, page_h int")
    top, own = ("page", 3, 1, 100, "BILL OF LADING NUMBER"), ("page", 6, 2, 400, "Own Farms")
    block = [("roi", 3, 1, 100, "Acme Foods"), ("roi", 6, 2, 140, "12 Main St"), ("roi", 6, 3, 180, "Tampa, FL 33601")]
    split = lambda i, ls: [(i, k, psm, 1, 1, line, n, 10 + 90 * n, y, 80, 20, t) for k, psm, line, y, text in ls for n, t in enumerate(text.split())]
    rows = split("i", [top, own, *block]) + split("low", [top, *block]) + split("none", block) + split("blank", [top, own])
    words = spark.createDataFrame(rows, "invoice_id string, pass string, psm int, block_num int, par_num int, line_num int, word_idx int, left int, top int, width int, height int, text string")
    got = {r.invoice_id: r for r in O.bol_from_words(page, words, p).collect()}
    assert (got["i"].name, got["i"].address.street, got["i"].csz_line, got["i"].failure_reason) == ("Acme Foods", "12 MAIN ST", "Tampa, FL 33601", None)
    assert got["low"].failure_reason == "Could not locate the bottom of the SHIP TO block: the lower anchor ('own farms') was not matched in OCR. The upper anchor ('bill of lading number') was found at y=100."
    assert got["none"].failure_reason.startswith("Could not locate the SHIP TO block on the BOL: neither")
    assert got["blank"].failure_reason.startswith("Found the SHIP TO block but no city/state/ZIP line was identified inside it (searched y=[200, 450]). OCR may")
    assert {i: r.success for i, r in got.items()} == {"i": True, "low": False, "none": False, "blank": False}


def test_parse_address(spark):
    f = lambda c: L.parse_address(c)
    got = one(spark, f, ("ship to:\nAcme\nFoods\n12 Main Street\nSuite 4\nTampa, FL 33601\nrest",), ("Tampa, fl 33601",), ("Acme\nno city",), ("",), ("Acme\nOak Hall\nTampa FL 33601-1234",), ("9 First St\nBig Co\nOcala, FL 34470",))
    assert [tuple(x) for x in got] == [
        ("Acme Foods", "12 MAIN ST", "STE 4", "TAMPA", "FL", "33601", ""),
        ("Tampa, fl 33601", None, None, None, None, None, "no city/state/zip pattern found"),
        ("Acme", None, None, None, None, None, "no city/state/zip pattern found"),
        (None, None, None, None, None, None, "no usable OCR lines"),
        ("Acme", "OAK HALL", None, "TAMPA", "FL", "33601-1234", ""),
        (None, "9 FIRST ST", "BIG CO", "OCALA", "FL", "34470", ""),
    ]
    assert one(spark, f, ("Tampa, FL 33601",))[0].note == "no lines above city/state/zip"


def test_pick_customer_line(spark):
    f = lambda *c: L.pick_customer_line(F.split(c[0], "/"), "Own Farms")
    got = one(spark, f, ("x/SHIP TO/12 Oak St/Sysco Foods/Acme",), ("Warehouse Madison/555-123-4567/12 Oak St/Vistar Retail",), ("Alpha Meats/12 Oak St/Own Big Farms",), ("SHIP FROM/12 Oak St",), ("Own Farms/Late Name",))
    assert got == ["Sysco Foods", "Vistar Retail", "Alpha Meats", None, None]
    rows = spark.createDataFrame([("i", "| __SHIP TO\n Sysco Foods | junk\n"), ("j", None)], "invoice_id string, text string")
    assert {r.invoice_id: r.customer for r in L.customer_lines(rows, "Own Farms").collect()} == {"i": "Sysco Foods", "j": None}


def test_goldens_and_boxes(spark):
    made = spark.createDataFrame([("a", "1"), ("b", "2")], "stem string, json string")
    gold = spark.createDataFrame([("a", "1"), ("b", "3"), ("c", "4")], "stem string, json string")
    assert sorted(r.stem for r in L.compare_goldens(made, gold).collect()) == ["b", "c"]
    assert tuple(L.block_box(lines(spark, ("a", 5, 9), ("b", 2, 7))).first()) == ("i", 2, 9, 0, 100)


# --- sources and stream ------------------------------------------------------------------
def test_scan(spark, tmp_path):
    for n in ("b.pdf", "a.pdf", "c.PDF", "d.txt"):
        (tmp_path / n).write_bytes(b"x")
    assert [r.invoice_id for r in readers.scan_invoices(spark, str(tmp_path)).collect()] == ["a.pdf", "b.pdf"]
    assert readers.scan_invoices(spark, str(tmp_path / "none")).count() == 0


def test_master_csv_and_goldens(spark, tmp_path):
    rows = cells(spark)
    sinks.write_csv(rows, str(tmp_path / "m"))
    assert [r.name for r in readers.read_master_csv(spark, str(tmp_path / "m")).orderBy("row").collect()] == [r.name for r in rows.orderBy("row").collect()]
    (tmp_path / "x.expected.json").write_text('{"invoice_data": {"a": "1"}, "customer_match": {}, "bill_entry": null}')
    assert readers.read_goldens(spark, str(tmp_path / "*.json")).first().stem == "x"


def test_run_id():
    now = datetime.datetime(2024, 7, 1, 12, 0, tzinfo=datetime.timezone.utc)
    assert sinks.run_id("a", now, "abc123") == "a-2024-07-01T08-00-00ET-abc123"


def test_stream(spark, tmp_path):
    pages(spark, ("ok.pdf", "a", TEXT, LAYOUT)).write.parquet(str(tmp_path / "in"))
    got = []
    q = drop_zone.start(spark, str(tmp_path / "in"), load_master(cells(spark)), VENDORS["a"], lambda df, n: got.extend(df.select("invoice_id", "method").collect()), str(tmp_path / "ck"), available_now=True)
    q.awaitTermination(120)
    assert got == [Row(invoice_id="ok.pdf", method="inv_only")]


def test_registry_and_entry(spark):
    import __spark_entry__ as E

    qs, oracles = E.queries(), E.oracle_sql()
    assert set(oracles) <= set(qs) and len(qs) > 60
    assert set(E.entry(spark).columns) >= {"invoice_id", "method", "severity"}
