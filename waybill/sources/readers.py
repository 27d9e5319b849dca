"""Readers of the boundary tables; binary formats go through adapters that need optional libraries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import ship

MASTER_CELLS = T.StructType([T.StructField("row", T.IntegerType()), *[T.StructField(c, T.StringType()) for c in ("name", "al1", "al2", "city", "state", "postcode")], T.StructField("postcode_is_numeric", T.BooleanType())])
PAGES = "invoice_id string, vendor string, text string, layout string"
OCR_WORDS = "invoice_id string, pass string, psm int, block_num int, par_num int, line_num int, word_idx int, left int, top int, width int, height int, text string"
GOLDEN = "invoice_data map<string,string>, customer_match map<string,string>, bill_entry map<string,string>"


def scan_invoices(spark: SparkSession, folder: str, with_content: bool = False) -> DataFrame:
    """invoice_id, path, length of the ``*.pdf`` files of a folder itself, case-sensitive, in order of path.

    A folder without such files, or no folder, gives no rows.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    empty = spark.createDataFrame([], "invoice_id string, path string, length long" + (", content binary" if with_content else ""))
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return empty
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").option("recursiveFileLookup", "false").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("invoice_id"), "path", "length", *(["content"] if with_content else [])).orderBy("path")


def read_master_csv(spark: SparkSession, path: str) -> DataFrame:
    """Master cells from a CSV with the columns of MASTER_CELLS; the sheet row number comes from the file."""
    return spark.read.schema(MASTER_CELLS).option("header", True).option("escape", '"').option("multiLine", True).csv(path)


def read_master_xlsx(spark: SparkSession, path: str) -> DataFrame:
    """Master cells of the active sheet, from row 2; needs openpyxl. The sheet is a small dimension, read on the driver."""
    try:
        from openpyxl import load_workbook
    except ImportError as e:
        raise RuntimeError("reading .xlsx needs openpyxl; export the sheet as CSV and use read_master_csv") from e
    sheet = load_workbook(path, read_only=True, data_only=True).active
    return spark.createDataFrame(master_cells(sheet.iter_rows(min_row=2, values_only=True)), MASTER_CELLS)


def master_cells(rows) -> list[tuple]:
    """Sheet rows to MASTER_CELLS: six cells each, numbers in the postcode told apart."""
    out = []
    for n, cells in enumerate(rows, start=2):
        cells = (list(cells or []) + [None] * 6)[:6]
        number = isinstance(cells[5], (int, float)) and not isinstance(cells[5], bool)
        out.append((n, *[None if c is None else str(c) for c in cells], number))
    return out


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES).parquet(path)


def read_ocr_words(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OCR_WORDS).parquet(path)


def read_goldens(spark: SparkSession, path: str) -> DataFrame:
    """Golden JSON files with the stem that names their invoice."""
    rows = spark.read.schema(GOLDEN).option("multiLine", True).json(path)
    return rows.select(F.regexp_extract(F.input_file_name(), r"([^/]+?)\.expected\.json$", 1).alias("stem"), "*")


def decode_pages(files: DataFrame, vendor: str) -> DataFrame:
    """Page-1 text and layout of scan_invoices(with_content=True) rows; needs pypdf on the executors."""

    def run(batches):
        try:
            from pypdf import PdfReader
        except ImportError as e:
            raise RuntimeError("decoding PDF files needs pypdf on the executors") from e
        import io

        for pdf in batches:
            out = []
            for name, content in zip(pdf["invoice_id"], pdf["content"]):
                page = PdfReader(io.BytesIO(content)).pages[0]
                out.append((name, vendor, page.extract_text(), page.extract_text(extraction_mode="layout")))
            import pandas as pd

            yield pd.DataFrame(out, columns=["invoice_id", "vendor", "text", "layout"])

    ship(files.sparkSession)
    return files.select("invoice_id", "content").mapInPandas(run, PAGES)
