"""The batch run: pages and bills of lading in; bills, summary, discrepancies and manifest out.

The run is one DataFrame plan in which every stage adds columns; nothing but a
row of totals and a sheet's violations comes to the driver.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bills as B
from ..operators import master as M
from ..operators.match import match_invoices, match_log
from ..operators.pages import first_missing, page_ship_to
from ..sources import sinks
from .shared import settled
from .vendors import VendorSpec


class MasterError(Exception):
    """Hard violations in the master under strict validation."""


@dataclass
class Run:
    """Frames of one run, each computed when a sink asks for it."""

    spec: VendorSpec
    run_id: str
    match: DataFrame
    bills: DataFrame
    outcome: DataFrame
    discrepancies: DataFrame
    parsed: DataFrame
    started: str

    def totals(self) -> dict[str, int]:
        row = self.outcome.agg(F.count("*").alias("total"), F.count_if("billed").alias("succeeded"), F.count_if(~F.col("billed")).alias("failed")).first()
        return row.asDict()

    def report(self) -> dict[str, int]:
        """The console table's totals."""
        ok = lambda c: F.count_if(F.coalesce(F.col(c) != "no_input", F.lit(False)))
        return self.outcome.agg(F.count("*").alias("invoices"), ok("inv_method").alias("page1_ok"), ok("bol_method").alias("bol_ok"), F.count_if(F.coalesce("success", F.lit(False))).alias("resolved"), F.count_if(F.coalesce(F.col("severity") == "severe", F.lit(False))).alias("severe")).first().asDict()

    def logs(self) -> DataFrame:
        """invoice_id, log of matches that aren't plain: all but agreement with certain addresses."""
        plain = F.col("method").isin("agree", "bol_only", "inv_only") & (F.col("severity") == "ok") & F.col("bol_score").isNull() & F.col("inv_score").isNull()
        return match_log(self.match.filter(~plain))

    def finalize(self, folder: str, dry_run: bool = False) -> dict:
        """Write the artifacts: bills only if there are any and this isn't a dry run, the rest always."""
        spark, totals = self.outcome.sparkSession, self.totals()
        ended = datetime.datetime.now().isoformat(timespec="seconds")
        company = self.spec.company
        paths = {"bills_csv": None, "summary_csv": f"{folder}/summary", "consignee_discrepancies_csv": f"{folder}/discrepancies", "invoice_logs": f"{folder}/logs"}
        if totals["succeeded"] and not dry_run:
            paths["bills_csv"] = sinks.write_csv(B.bill_rows(self.bills), f"{folder}/bills", ["Bill no."])
        sinks.write_csv(B.summary_rows(self.outcome, self.run_id, company, self.started, ended), paths["summary_csv"], ["Invoice File"])
        sinks.write_csv(B.discrepancy_rows(self.discrepancies, self.run_id, company), paths["consignee_discrepancies_csv"], ["Invoice File"])
        self.logs().write.mode("overwrite").parquet(paths["invoice_logs"])
        out = {"run_id": self.run_id, "vendor": self.spec.key, "started": self.started, "ended": ended, "totals": totals, "artifacts": paths}
        sinks.write_text(spark, f"{folder}/manifest.json", sinks.manifest(out))
        return out


def load_master(cells: DataFrame, source: str = "", report_path: str | None = None, strict: bool = False, usps: bool = True) -> DataFrame:
    """Entries of the master; the report is written before strict validation raises."""
    rows = settled(M.master_rows(cells, usps))
    text, n_hard = sinks.validation_report(M.validate(rows), source, rows.count(), strict)
    if report_path:
        sinks.write_text(cells.sparkSession, report_path, text)
    if strict and n_hard:
        raise MasterError(f"{n_hard} hard violation(s) in the customer master")
    return M.valid_master(rows)


def run_batch(pages: DataFrame, bol: DataFrame | None, master: DataFrame, spec: VendorSpec, deny_names: list[str] | None = None, usps: bool = True, run_id: str | None = None) -> Run:
    """Parse, validate, match and bill one vendor's invoices.

    pages: invoice_id, text, layout; bol: extractions from bills of lading, if any.
    """
    started = datetime.datetime.now().isoformat(timespec="seconds")
    parsed = settled(spec.parse(pages))
    missing = first_missing(spec.required)
    ready = parsed.filter(~F.col("parse_error")).withColumn("_m", missing).filter("_m is null").drop("_m")
    page1 = page_ship_to(ready, usps)
    columns = ["invoice_id", "source", "name", "name_candidates", "address", "success"]
    sources = page1.select(*columns)
    if bol is not None:
        sources = sources.unionByName(bol.join(ready.select("invoice_id"), "invoice_id", "left_semi").select(*columns))
    match = settled(match_invoices(sources, master, deny_names))
    bills = B.make_bills(ready.join(match.filter("success").select("invoice_id", "customer_name"), "invoice_id"), spec.bill_name, spec.categories)
    outcome = B.outcomes(parsed, match, bills, missing)
    return Run(spec, run_id or sinks.run_id(spec.key), match, bills, settled(outcome), B.discrepancies(match, page1), parsed, started)


def session(app: str = "waybill") -> SparkSession:
    return SparkSession.builder.appName(app).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC").getOrCreate()
