"""Reports: CSV files as Python's csv module writes them, and small texts and JSON made on the driver."""

from __future__ import annotations

import datetime
import json
import secrets
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bills import BILL_HEADERS
from ..operators.master import DUPLICATE_NUMBER, MALFORMED, NO_NUMBER, REQUIRED, TRIPLE

# The report's titles.
RULE_TITLES = {REQUIRED: "Required fields non-empty", TRIPLE: "Triple uniqueness (Name, shipto_name, address)", NO_NUMBER: "Could not extract customer number", DUPLICATE_NUMBER: "Customer numbers are unique", MALFORMED: "Customer number recovered from malformed AL1 format"}
CSV_OPTIONS = {"header": True, "escape": '"', "emptyValue": "", "nullValue": "", "lineSep": "\r\n", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(rows: DataFrame, path: str, order: list[str] | None = None) -> str:
    """One CSV file with a header, also without rows. ``order``: columns that rows are sorted by, at the sink only."""
    rows = rows.orderBy(*[F.col(f"`{c}`") for c in order]) if order else rows
    rows.coalesce(1).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def write_text(spark, path: str, text: str) -> str:
    """A small text file on any file system that Spark writes."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return path


def run_id(vendor: str, now: datetime.datetime | None = None, token: str | None = None) -> str:
    """``<vendor>-YYYY-MM-DDTHH-MM-SSET-<6 hex>``, in New York time."""
    now = (now or datetime.datetime.now(datetime.timezone.utc)).astimezone(ZoneInfo("America/New_York"))
    return f"{vendor}-{now:%Y-%m-%dT%H-%M-%S}ET-{token or secrets.token_hex(3)}"


def verdict(n_hard: int, strict: bool, aborted: bool = False) -> str:
    if aborted:
        return "FAIL (aborted via --strict-master)"
    if n_hard and strict:
        return "FAIL"
    return f"PASS with {n_hard} hard violation(s) (non-strict mode; would FAIL with --strict-master)" if n_hard else "PASS"


def validation_report(violations: DataFrame, source: str, total_rows: int, strict: bool, aborted: bool | None = None, generated: str | None = None) -> tuple[str, int]:
    """(report text, hard violations). Violations of a master sheet are few; they come to the driver in order.

    ``aborted``: whether the run stops here; by default, as strict runs do with hard violations.
    """
    found: dict[str, list] = {}
    hard = {REQUIRED, TRIPLE, NO_NUMBER}
    for v in violations.select("row", "rule", "message").orderBy("row", "rule").toLocalIterator():
        found.setdefault(v.rule, []).append(v)
    n_hard = sum(len(v) for k, v in found.items() if k in hard)
    n_soft = sum(len(v) for k, v in found.items() if k not in hard)
    aborted = strict and n_hard > 0 if aborted is None else aborted
    lines = ["Customer Master Validation Report", "=" * 78, f"Generated:   {generated or datetime.datetime.now().isoformat(timespec='seconds')}", f"Source:      {source}", f"Total rows:  {total_rows}", f"Mode:        {'strict (hard violations are fatal)' if strict else 'non-strict (failures logged, run continues)'}", ""]
    for title, rules, bad, unit in (("=== HARD RULES ===", [r for r in RULE_TITLES if r in hard], "FAIL", "violation(s)"), ("=== SOFT RULES (warnings) ===", [r for r in RULE_TITLES if r not in hard], "WARN", "entries")):
        lines += [title, ""]
        for rule in rules:
            own = found.get(rule, [])
            lines.append(f"[{bad if own else 'OK'}] {RULE_TITLES[rule]}  [rule={rule}]  ({len(own)} {unit})")
            lines += [f"  row {v.row:3d}: {v.message}" for v in own] + [""]
    lines += ["=== SUMMARY ===", f"Hard violations: {n_hard}", f"Soft warnings:   {n_soft}", f"Verdict:         {verdict(n_hard, strict, aborted)}", ""]
    return "\n".join(lines), n_hard


def bills_preview(rows: DataFrame, limit: int = 1000) -> str:
    """The first ``limit`` bills by number, each as an aligned block, for a dry run; bills.csv of a full run holds them all."""
    bills = rows.orderBy(F.col("`Bill no.`")).limit(limit).collect()
    width = max(map(len, BILL_HEADERS))
    blocks = ["\n".join([f"───── Bill {k} of {len(bills)} ─────", *[f"  {h.ljust(width)}  {b[h]}" for h in BILL_HEADERS]]) for k, b in enumerate(bills, 1)]
    return "\n\n".join(blocks) or "(no bills)"


def golden_json(parsed: DataFrame, match: DataFrame, bills: DataFrame) -> DataFrame:
    """invoice_id, json: parsed fields with ISO dates, the match and the bill of each invoice."""
    from ..operators.pages import FIELDS

    data = parsed.select("invoice_id", F.struct(*[F.col(c) for c in FIELDS]).alias("invoice_data"))
    m = match.select("invoice_id", F.struct("customer_name", "customer_number", "master_row", F.col("method").alias("match_method"), "severity", "bol_method", F.col("inv_method").alias("page1_method")).alias("customer_match"))
    b = bills.select("invoice_id", F.struct(*[c for c in bills.columns if c != "invoice_id"]).alias("bill_entry"))
    rows = data.join(m, "invoice_id", "left").join(b, "invoice_id", "left")
    return rows.select("invoice_id", F.to_json(F.struct("invoice_data", "customer_match", "bill_entry"), {"ignoreNullFields": "false"}).alias("json"))


def manifest(values: dict) -> str:
    return json.dumps(values, indent=2)
