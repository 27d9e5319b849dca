"""Command line: run a batch, or validate a master."""

from __future__ import annotations

import argparse
import sys

from .operators.master import master_rows, validate
from .operators.ocr import bol_from_words
from .plans.run import MasterError, load_master, run_batch, session
from .plans.vendors import VENDORS
from .sources import sinks
from .sources.readers import decode_pages, read_master_csv, read_master_xlsx, read_pages, scan_invoices


def _master(spark, path):
    return read_master_xlsx(spark, path) if path.endswith(".xlsx") else read_master_csv(spark, path)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="waybill", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="parse, match and bill one vendor's invoices")
    run.add_argument("--vendor", required=True, choices=sorted(VENDORS))
    run.add_argument("--master", required=True, help="master sheet (.csv or .xlsx)")
    run.add_argument("--pages", help="parquet of page text; otherwise PDF files of the folder are decoded")
    run.add_argument("--bol", help="parquet of bill-of-lading extractions")
    run.add_argument("--ocr-words", help="parquet of the OCR words of bills of lading (pass page, header or roi); needs --ocr-pages")
    run.add_argument("--ocr-pages", help="parquet of invoice_id, page_w, page_h of bills of lading")
    run.add_argument("--own-name", default="", help="the paying company's name")
    run.add_argument("--deny", action="append", default=[], help="customer name that is never billed")
    run.add_argument("--out", required=True)
    run.add_argument("--strict-master", action="store_true")
    run.add_argument("--dry-run", action="store_true")
    run.add_argument("invoice_dir", nargs="?")
    check = sub.add_parser("validate", help="validate a master sheet: exit 0 clean or soft only, 1 hard violations, 2 unreadable")
    check.add_argument("master")
    check.add_argument("--report")
    return p


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = session()
    if args.command == "validate":
        try:
            rows = master_rows(_master(spark, args.master))
            text, n_hard = sinks.validation_report(validate(rows), args.master, rows.count(), strict=True, aborted=False)
        except Exception as e:  # any unreadable sheet
            print(f"can't read {args.master}: {e}", file=sys.stderr)
            return 2
        if args.report:
            sinks.write_text(spark, args.report, text)
        print(text)
        return int(bool(n_hard))
    if not (args.pages or args.invoice_dir):
        print("give --pages or a folder of invoices", file=sys.stderr)
        return 2
    if bool(args.ocr_words) != bool(args.ocr_pages) or (args.ocr_words and args.bol):
        print("give --ocr-words with --ocr-pages, or --bol", file=sys.stderr)
        return 2
    if args.ocr_words and not args.own_name:
        print("--ocr-words needs --own-name, the lower anchor of the forms", file=sys.stderr)
        return 2
    spec = VENDORS[args.vendor].for_payer(args.own_name)
    try:
        master = load_master(_master(spark, args.master), args.master, f"{args.out}/master_validation.txt", args.strict_master)
    except MasterError as e:
        print(e, file=sys.stderr)
        return 1
    pages = read_pages(spark, args.pages).filter(f"vendor = '{args.vendor}'") if args.pages else decode_pages(scan_invoices(spark, args.invoice_dir, with_content=True), args.vendor)
    bol = spark.read.parquet(args.bol) if args.bol else None
    if args.ocr_words:
        bol = bol_from_words(spark.read.parquet(args.ocr_pages), spark.read.parquet(args.ocr_words), spec.profile)
    run = run_batch(pages, bol, master, spec, args.deny)
    print(run.report())
    if args.dry_run:
        from .operators.bills import bill_rows

        print(sinks.bills_preview(bill_rows(run.bills)))
    print(sinks.manifest(run.finalize(args.out, args.dry_run)))
    return 0


if __name__ == "__main__":
    sys.exit(main())
