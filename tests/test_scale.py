"""Tables whose groups grow: many copies of a name at one address, outcomes in one pass, pages without a frame each."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from waybill.functions import fuzzy as Z
from waybill.operators import bills as B
from waybill.operators import master as M
from waybill.operators import match as R
from waybill.operators import ocr as O

ADDRESS = "struct<street:string,line_2:string,city:string,state:string,postcode:string>"


def _site(spark):
    """2,001 entries of two names at one address."""
    rows = spark.range(2000).select((F.col("id") + 10).cast("int").alias("row"), F.lit("Delta").alias("customer_name"), F.when(F.col("id") % 2 == 0, "Delta  South").otherwise("delta-south").alias("shipto_name"))
    rows = rows.unionByName(spark.createDataFrame([(5000, "Gamma", "Gamma North")], "row int, customer_name string, shipto_name string"))
    a = F.struct(*[F.lit(v).alias(k) for k, v in (("street", "3 C ST"), ("line_2", ""), ("city", "TAMPA"), ("state", "FL"), ("postcode", "33601"))])
    return rows.select("*", F.lit("200001").alias("customer_number"), a.alias("address"))


def _extractions(spark):
    at = ("3 C ST", "", "TAMPA", "FL", "33601")
    rows = [("a", "bol", None, ["x", "Delta South"], at), ("a", "page1", None, ["gamma north"], at), ("b", "page1", None, ["Zzz"], at), ("c", "bol", None, ["Delta South"], ("3 C ST", "", "TAMPA", None, "33601")), ("d", "bol", None, ["--"], at)]
    return spark.createDataFrame(rows, f"invoice_id string, source string, name string, name_candidates array<string>, address {ADDRESS}")


def test_copies_of_a_name_are_carried_once(spark):
    group = M.by_address(_site(spark)).first()
    assert group.n == 2001 and [e.row for e in group.firsts] == [10, 5000] and group.names == "delta south\ngamma north"
    got = {(r.invoice_id, r.source): r for r in R.match_sources(_extractions(spark), _site(spark), matrix=False).collect()}
    told = {k: (r.method, r.entry and r.entry.row, r.score, r.n_candidates) for k, r in got.items()}
    assert told == {("a", "bol"): ("disambiguated", 10, 100, 2001), ("a", "page1"): ("disambiguated", 5000, 100, 2001), ("b", "page1"): ("ambiguous", None, told["b", "page1"][2], 2001), ("c", "bol"): ("no_match", None, None, 0), ("d", "bol"): ("ambiguous", None, 0, 2001)}


def test_matrix_has_every_entry(spark):
    got = {(r.invoice_id, r.source): r.matrix for r in R.match_sources(_extractions(spark), _site(spark)).collect()}
    assert len(got["a", "bol"]) == 2 * 2001 and len(got["a", "page1"]) == 2001 and got["d", "bol"] == [] and got["c", "bol"] == []
    assert [(x.cand, x.shipto_name, x.score) for x in got["a", "bol"] if x.cand != "x"][:2] == [("Delta South", "Delta  South", 100), ("Delta South", "delta-south", 100)]
    both = R.match_invoices(_extractions(spark), _site(spark)).filter("invoice_id = 'a'").first()
    assert (both.method, both.severity, both.master_row, len(both.bol_matrix), len(both.inv_matrix)) == ("bol_wins_disagreement", "info", 10, 4002, 2001)


@pytest.mark.parametrize("most", [0, 10_000])
def test_pairs_are_the_rows_of_the_matrices(spark, most):
    """With the names by address broadcast and joined by shuffles."""
    told = [(r.invoice_id, r.source, x.cand, x.shipto_name, x.score) for r in R.match_sources(_extractions(spark), _site(spark)).collect() for x in r.matrix]
    assert sorted(told) == sorted(tuple(r) for r in R.match_pairs(_extractions(spark), _site(spark), max_broadcast=most).collect()) and len(told) == 4002 + 2001 + 2001


@pytest.mark.parametrize("most", [None, 0])
def test_no_shuffle_carries_a_matrix(spark, monkeypatch, most):
    """An invoice's matrices are made after all shuffles, its first one too."""
    if most is not None:
        monkeypatch.setattr(R.expand, "__defaults__", (most,))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        log = R.match_log(R.match_invoices(_extractions(spark), _site(spark)))
        plan = log._jdf.queryExecution().executedPlan().toString().split("\n")
        lowest = max(k for k, line in enumerate(plan) if "WRatio(" in line or "_matrix#" in line)
        assert any("Exchange hashpartitioning" in line for line in plan[lowest:]) and not any("Exchange" in line for line in plan[:lowest])
        assert {r.invoice_id: r.log.count("WRatio(") for r in log.collect()} == {"a": 4002 + 2001, "b": 2001, "c": 0, "d": 0}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _logs(df):
    return sorted(((r.invoice_id or "", r.log) for r in df.collect()))


@pytest.mark.parametrize("most", [0, 10_000])
def test_group_logs_are_those_of_each_invoice(spark, most):
    """Empty and odd names, a source's rows twice, rows of no source, no address, no invoice number."""
    at = ("3 C ST", "", "TAMPA", "FL", "33601")
    rows = [("e", "bol", "Name", [], at), ("f", "bol", "Näme 3:x[2(", ["", "--", "Delta"], at), ("g", "bol", None, ["Delta South"], at), ("g", "bol", None, ["Zzz"], at), ("g", "page1", None, None, at), ("h", "fax", None, ["x"], at)]
    rows += [("i", "bol", "x", ["x"], None), ("i", "page1", "y", ["y"], ("", "", "TAMPA", "FL", "33601")), ("j", "page1", "gamma north", None, at), (None, "page1", "gamma north", None, at)]
    ext = _extractions(spark).unionByName(spark.createDataFrame(rows, "invoice_id string, source string, name string, name_candidates array<string>, address " + ADDRESS))
    master = _site(spark).unionByName(_site(spark).limit(1).withColumns({"row": F.lit(1), "shipto_name": F.lit(None).cast("string")}))
    for deny in (None, ["delta"]):
        got = _logs(R.group_logs(R.alike(ext).cache(), master, deny, max_broadcast=most))
        assert got == _logs(R.match_log(R.match_invoices(ext, master, deny))) and len(got) == 11


def test_log_of_alike_invoices_is_made_once(spark):
    at = F.struct(*[F.lit(v).alias(k) for k, v in (("street", "3 C ST"), ("line_2", ""), ("city", "TAMPA"), ("state", "FL"), ("postcode", "33601"))])
    n = 2 * R.ALIKE_IDS + 500
    ext = spark.range(n).select(F.col("id").cast("string").alias("invoice_id"), F.lit("bol").alias("source"), F.lit(None).cast("string").alias("name"), F.array(F.lit("Delta South")).alias("name_candidates"), F.when(F.col("id") % 100 > 0, at).alias("address"))
    groups = R.alike(ext).cache()
    assert groups.count() <= 5 and groups.agg(F.max(F.size("ids"))).first()[0] <= R.ALIKE_IDS
    logs = R.group_logs(groups, _site(spark)).select("invoice_id", F.length("log").alias("n"), F.sha2("log", 256).alias("log")).collect()
    assert sorted(int(r.invoice_id) for r in logs) == list(range(n)) and len({r.log for r in logs}) == 2


def test_registered_match_log_goes_by_groups(spark, monkeypatch):
    """The query scores and writes each different log once, not once an invoice."""
    from waybill.plans import registry

    seen, whole = [], R.group_logs
    monkeypatch.setattr(R, "group_logs", lambda groups, *a: seen.append((groups.count(), groups.agg(F.sum(F.size("ids"))).first()[0])) or whole(groups, *a))
    got = registry.QUERIES["match_log"](spark, "/root/testdata/sf0.001")
    assert _logs(got) == _logs(R.match_log(registry._match(spark, "/root/testdata/sf0.001", matrix=True)))
    assert seen and seen[0][0] < seen[0][1] == got.count()


def test_outcome_without_bills(spark):
    parsed = spark.createDataFrame([("a", False), ("b", False), ("c", True)], "invoice_id string, parse_error boolean")
    match = R.match_invoices(_extractions(spark), _site(spark), matrix=False)
    missing = F.lit(None).cast("struct<field:string,reason:string>")
    got = sorted((r.invoice_id, r.billed, r.fail_step) for r in B.outcomes(parsed, match, None, missing).collect())
    bills = match.filter("customer_name is not null").select("invoice_id").join(parsed.filter("not parse_error"), "invoice_id")
    assert got == [("a", True, None), ("b", False, "match_customer"), ("c", False, "parse_pdf")]
    assert got == sorted((r.invoice_id, r.billed, r.fail_step) for r in B.outcomes(parsed, match, bills, missing).collect())


@pytest.mark.parametrize("n", [1, 40])
def test_pages_run_over_batches(spark, n):
    """Pages that straddle Arrow batches are whole, and no page has a data frame of its own."""
    rows = [(f"p{k}", i, t, 20 * i + k % 3, 20 * i + 12, 0, 9) for k in range(n) for i, t in enumerate(["ship to", "Acme Foods Inc", "12 Main Street", "12 Main Street", "Suite 4 Dock", "Tampa, FL 33601"])]
    ls = spark.createDataFrame(rows, O.LINE_TYPES).withColumn("y_top", F.when(F.col("line_idx") == 3, F.col("y_top") - 12).otherwise(F.col("y_top")))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 4)
    try:
        kept = O.dedupe_passes(ls)
        plan = kept._jdf.queryExecution().toString()
        assert "MapInArrow" in plan and "FlatMapGroupsInPandas" not in plan
        got = kept.collect()
        assert len({r.invoice_id for r in got}) == n and sorted(r.line_idx for r in got) == sorted([0, 1, 2, 4, 5] * n)
        block = O.walk_up(kept, O.csz_pick(kept), kept.groupBy("invoice_id").agg(F.min("y_top").alias("mid_y"))).collect()
        assert len({r.invoice_id for r in block}) == n and sum(r.is_csz for r in block) == n and all(r.pos >= 0 for r in block)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


@given(st.text("ship to12", max_size=14), st.text("ship to12 x", max_size=14), st.sampled_from([50, 70, 75, 100]))
def test_bound_of_partial_ratio_is_exact(a, b, least):
    assert O._nearly_in(a, b, least) == (Z.partial_ratio(a, b) >= least)
