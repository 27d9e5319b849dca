"""Invoice-shaped inputs derived from the star-schema tables, as SQL that Spark and DuckDB read alike.

Nothing here is sampled: each view covers its whole table, and defects are
spread by residues of the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

OWN_NAME = "Own Farms"
DENY = ["own farms inventory"]


def _day(c: str) -> str:
    s = f"CAST({c} AS STRING)"
    return f"concat(substr({s}, 6, 2), '/', substr({s}, 9, 2), '/', substr({s}, 1, 4))"


VIEWS = {
    "master_keys": """
        SELECT c_custkey, k, (k % 700) * 3 % 25 AS base, CAST(floor(k / 700) AS BIGINT) AS lap
        FROM (SELECT c_custkey, CASE WHEN c_custkey % 83 = 5 THEN c_custkey - 1 ELSE c_custkey END AS k FROM customer) c""",
    "master_cells": """
        SELECT CAST(c_custkey + 2 AS INT) AS row,
            CASE WHEN k % 89 = 3 AND k % 2 = 0 THEN NULL WHEN k % 89 = 3 THEN '  ' WHEN k % 101 = 7 THEN 'Own Farms, Inventory' ELSE concat('Customer ', CAST(k % 400 AS STRING)) END AS name,
            CASE k % 8 WHEN 0 THEN concat(nm, ' - ', num, ', ATTN: Dock') WHEN 1 THEN concat(nm, ' - ', num) WHEN 2 THEN concat(nm, ' -', num)
                WHEN 3 THEN concat('North-', nm, ' - ', num, ', Rear Door') WHEN 4 THEN concat(nm, ' - Annex - ', num, ', ATTN: X') WHEN 5 THEN concat(nm, ' - ', num, ' ATTN: X')
                WHEN 6 THEN CASE k % 3 WHEN 0 THEN concat(nm, ', Inc.') WHEN 1 THEN concat(nm, ' - C') ELSE '' END
                ELSE CASE k % 3 WHEN 0 THEN concat(nm, ' FCC - Camp ', num) WHEN 1 THEN concat(nm, ' USP - #', num, ', ATTN: X') ELSE concat(' ', nm, ' - ', substr(num, 1, 5)) END END AS al1,
            CASE WHEN k % 113 = 4 THEN NULL WHEN k % 3 = 0 THEN concat(street, ' MAIN ST') WHEN k % 3 = 1 THEN concat(street, ' Main  St') ELSE concat(street, ' main st ') END AS al2,
            CASE WHEN k % 97 = 5 THEN NULL ELSE concat('City ', CAST(idx AS STRING)) END AS city,
            CASE idx % 5 WHEN 0 THEN 'WI' WHEN 1 THEN 'IL' WHEN 2 THEN 'MN' WHEN 3 THEN 'ia' ELSE 'MI' END AS state,
            CASE WHEN k % 211 = 9 THEN '0' WHEN k % 5 = 0 THEN zip ELSE concat('0', zip) END AS postcode,
            (k % 211 = 9 OR k % 5 = 0) AS postcode_is_numeric
        FROM (SELECT *, concat('Site ', CAST(1000 + k % 500 AS STRING)) AS nm, CAST(200000 + k % 1400 AS STRING) AS num, CAST(100 + k % 700 AS STRING) AS street, CAST(1000 + idx * 300 AS STRING) AS zip
              FROM (SELECT *, (base + lap * (k % 5)) % 25 AS idx FROM master_keys) m) m2""",
    "orders_keyed": """
        SELECT o_orderkey, o_custkey, CAST(o_orderkey AS STRING) AS invoice_id, CAST(o_orderdate AS DATE) AS invoice_date, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 45 AS INT) AS ship_date, CAST(o_orderdate AS DATE) + 30 AS past_due_date,
            CAST(floor(o_totalprice * 100) AS BIGINT) AS cents FROM orders""",
    "extraction": """
        SELECT CAST(o.o_orderkey AS STRING) AS invoice_id, 'page1' AS source, concat('SITE ', CAST(1000 + o.o_custkey % 500 AS STRING), ' CO') AS name, CAST(NULL AS STRING) AS name2, m.al2, m.city, m.state, m.postcode, m.postcode_is_numeric, m.row AS at_row
        FROM orders o JOIN master_cells m ON m.row = o.o_custkey + 2 WHERE o.o_orderkey % 11 <> 4
        UNION ALL
        SELECT CAST(o.o_orderkey AS STRING), 'bol', CASE WHEN o.o_orderkey % 6 = 1 THEN 'DOCK NO FOUR' ELSE concat('SITE ', CAST(1000 + o.o_custkey % 500 AS STRING), ' CO') END, concat('Site.', CAST(1000 + o.o_custkey % 500 AS STRING), ' Inc'), m.al2, CASE WHEN o.o_orderkey % 31 = 7 THEN 'NOWHERE' ELSE m.city END, m.state, m.postcode, m.postcode_is_numeric, m.row
        FROM orders o JOIN master_cells m ON m.row = o.o_custkey + 2 + CASE WHEN o.o_orderkey % 7 = 2 THEN 1 ELSE 0 END WHERE o.o_orderkey % 5 <> 1""",
    "raw_strings": """
        SELECT CAST(o_orderkey AS BIGINT) AS id, CASE o_orderkey % 6 WHEN 0 THEN concat(' .. |Alpha|  ', o_orderpriority, ' ', chr(9), 'Co. ') WHEN 1 THEN concat(chr(9), 'U.S.  Foods #', CAST(o_custkey AS STRING), '/2 "x" ', o_orderstatus) WHEN 2 THEN ''
            WHEN 3 THEN concat('||_', o_orderpriority, '_ | right side') WHEN 4 THEN concat('St. John''s', chr(10), 'Foods & Co - ', CAST(o_custkey AS STRING), ' ') ELSE NULL END AS s FROM orders""",
    "pages": f"""
        SELECT o.o_orderkey, o.invoice_id, CASE WHEN o.o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS vendor,
            CASE WHEN o.o_orderkey % 2 = 0 THEN
                concat('INVOICE ', CASE WHEN o.o_orderkey % 37 = 8 THEN 'none' ELSE lpad(CAST(o.o_orderkey AS STRING), 7, '0') END, chr(10), d1, chr(10), CASE WHEN o.o_orderkey % 29 = 4 THEN '13/45/2024' ELSE d2 END, chr(10), shipper, chr(10), 'S0-', CAST(o.o_custkey AS STRING), chr(10), '10.00 ', amount, ' 5.00', chr(10), CASE WHEN o.o_orderkey % 41 = 6 THEN '' ELSE d3 END)
            ELSE
                concat('Freight ', lpad(CAST(o.o_orderkey AS STRING), 7, '0'), ' ', d1, chr(10), CASE WHEN o.o_orderkey % 3 = 0 THEN concat(d2, 'HIGHX') ELSE concat('SHIP DATE: ', d2) END, chr(10), 'SO-', CAST(o.o_custkey AS STRING), CASE WHEN o.o_orderkey % 5 = 0 THEN '/77/78' ELSE '' END, chr(10), '10.00', chr(10), d3, '  $', amount, CASE WHEN o.o_orderkey % 43 = 9 THEN '' ELSE ' USD' END)
            END AS text,
            concat('Top', chr(10), CASE WHEN o.o_orderkey % 23 = 5 THEN 'nothing' ELSE 'SHIPPER      12CONSIGNEE  ' END, chr(10), '   ', chr(10),
                CASE WHEN o.o_orderkey % 19 = 3 THEN '' ELSE concat(shipper, '    ', 'Site ', CAST(1000 + o.o_custkey % 500 AS STRING), chr(10)) END,
                CASE WHEN o.o_orderkey % 47 = 11 THEN concat('lone line', chr(10)) ELSE '' END,
                concat('1 Dock Rd     ', CAST(100 + o.o_custkey % 700 AS STRING), ' Main St', chr(10)),
                CASE WHEN o.o_orderkey % 4 = 1 THEN concat('left    Suite ', CAST(o.o_custkey % 9 AS STRING), chr(10)) ELSE '' END,
                CASE WHEN o.o_orderkey % 17 = 6 THEN concat('a    b', chr(10), 'a    c', chr(10), 'a    d', chr(10), 'a    e', chr(10), 'a    f', chr(10), 'a    g', chr(10)) ELSE '' END,
                CASE WHEN o.o_orderkey % 13 = 2 THEN '' ELSE concat('Madison, WI 53703      Green Bay,  wi 54301', CASE WHEN o.o_orderkey % 3 = 1 THEN '-1234' ELSE '' END) END) AS layout
        FROM (SELECT *, {_day("invoice_date")} AS d1, {_day("ship_date")} AS d2, {_day("past_due_date")} AS d3,
                CASE o_orderkey % 7 WHEN 0 THEN 'Old Wisconsin Sausage Company' WHEN 1 THEN 'Midwest Refrigerated Services' WHEN 2 THEN 'DairyFood USA' WHEN 3 THEN 'MRS' WHEN 4 THEN 'OLD WISCONSIN' ELSE 'Unheard Of Foods' END AS shipper,
                concat(CASE WHEN cents >= 100000 THEN concat(CAST(CAST(floor(cents / 100000) AS BIGINT) AS STRING), ',', lpad(CAST(CAST(floor(cents / 100) AS BIGINT) % 1000 AS STRING), 3, '0')) ELSE CAST(CAST(floor(cents / 100) AS BIGINT) AS STRING) END, '.', lpad(CAST(cents % 100 AS STRING), 2, '0')) AS amount FROM orders_keyed) o""",
    "ocr_lines": """
        SELECT CAST(l_orderkey AS STRING) AS invoice_id, CAST(l_partkey * 1000000 + l_suppkey * 100 + l_linenumber AS BIGINT) AS line_idx,
            CASE l_linenumber % 7 WHEN 0 THEN concat('City ', chr(65), 'b, WI ', CAST(53000 + l_partkey % 999 AS STRING)) WHEN 1 THEN concat(CAST(l_partkey AS STRING), ' Main St') WHEN 2 THEN 'ast' WHEN 3 THEN concat('Harlow Foods ', CAST(l_suppkey AS STRING)) WHEN 4 THEN concat('| Green Bay, WI  5430', CAST(l_linenumber AS STRING), '-1234') WHEN 5 THEN 'Attn Bo' ELSE 'P.O. Box 12' END AS text,
            CAST(100 + (l_partkey * 7 + l_linenumber * 31) % 200 AS INT) AS y_top, CAST(100 + (l_partkey * 7 + l_linenumber * 31) % 200 + 10 + l_suppkey % 40 AS INT) AS y_bot, CAST(10 AS INT) AS x_left, CAST(400 AS INT) AS x_right
        FROM lineitem""",
    "ocr_words": """
        SELECT CAST(l_orderkey AS STRING) AS invoice_id, 'page' AS pass, CAST(CASE l_linenumber % 3 WHEN 0 THEN 3 WHEN 1 THEN 6 ELSE 11 END AS INT) AS psm, CAST(1 AS INT) AS block_num, CAST(1 AS INT) AS par_num, CAST(l_suppkey % 2 AS INT) AS line_num, CAST(l_linenumber AS INT) AS word_idx,
            CAST(l_partkey % 500 AS INT) AS "left", CAST(l_suppkey % 300 AS INT) AS top, CAST(20 + l_partkey % 30 AS INT) AS width, CAST(10 + l_suppkey % 9 AS INT) AS height, CASE WHEN l_partkey % 13 = 1 THEN '  ' ELSE concat(' w', CAST(l_partkey AS STRING)) END AS text
        FROM lineitem""",
    "bol_pages": "SELECT CAST(o_orderkey AS STRING) AS invoice_id, CAST(1000 AS INT) AS page_w, CAST(1400 AS INT) AS page_h FROM orders",
    "bol_words": """
        SELECT CAST(l_orderkey AS STRING) AS invoice_id, CASE WHEN l_linenumber <= 2 THEN 'page' WHEN l_linenumber <= 4 THEN 'header' ELSE 'roi' END AS pass, CAST(CASE l_partkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 6 ELSE 11 END AS INT) AS psm,
            CAST(l_suppkey AS INT) AS block_num, CAST(1 AS INT) AS par_num, CAST(l_partkey * 10 + l_linenumber AS INT) AS line_num, CAST(l_partkey AS INT) AS word_idx, CAST(CASE l_linenumber WHEN 3 THEN 300 WHEN 4 THEN 480 ELSE 10 END + l_partkey % 40 AS INT) AS "left",
            CAST(CASE l_linenumber WHEN 1 THEN 100 + l_partkey % 50 WHEN 2 THEN 400 + l_suppkey % 50 WHEN 3 THEN 60 + l_partkey % 9 WHEN 4 THEN 60 + l_partkey % 9 WHEN 5 THEN 100 WHEN 6 THEN 140 ELSE 180 END AS INT) AS top, CAST(80 + l_partkey % 30 AS INT) AS width, CAST(18 + l_suppkey % 5 AS INT) AS height,
            CASE l_linenumber WHEN 1 THEN CASE l_partkey % 5 WHEN 0 THEN 'BILL OF LADING NUMBER: 12' WHEN 1 THEN 'Bill of  Ladinq Number' WHEN 2 THEN 'BILL OF LADING SHORT FORM - NOT NEGOTIABLE' WHEN 3 THEN 'Bl of Ldng Nmbr' ELSE 'i' END
                WHEN 2 THEN CASE l_partkey % 4 WHEN 0 THEN 'Own Farms' WHEN 1 THEN '| OWN FARM5 Inc' WHEN 2 THEN ' own fanms ' ELSE 'freight charges' END
                WHEN 3 THEN CASE l_partkey % 4 WHEN 0 THEN 'SHORT' WHEN 1 THEN 'SH0RT' WHEN 2 THEN 'Shor' ELSE 'elsewhere' END WHEN 4 THEN CASE l_partkey % 4 WHEN 0 THEN 'FORM' WHEN 1 THEN 'F0RM' WHEN 2 THEN 'from' ELSE '  ' END
                WHEN 5 THEN concat('Harlow Foods ', CAST(l_suppkey AS STRING)) WHEN 6 THEN concat(CAST(1 + l_partkey % 900 AS STRING), ' Main St') ELSE concat('Green Bay, WI 5430', CAST(l_partkey % 9 AS STRING)) END AS text
        FROM lineitem""",
}
#: The tables each view reads.
NEEDS = {"master_keys": ["customer"], "master_cells": ["master_keys"], "orders_keyed": ["orders"], "extraction": ["orders", "master_cells"], "raw_strings": ["orders"], "pages": ["orders_keyed"], "ocr_lines": ["lineitem"], "ocr_words": ["lineitem"], "bol_pages": ["orders"], "bol_words": ["lineitem"]}


def _closure(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def add(n: str) -> None:
        if n in VIEWS and n not in out:
            for x in NEEDS[n]:
                add(x)
            out.append(n)

    for n in names:
        add(n)
    return out


def with_views(*names: str, **more: str) -> str:
    """A WITH clause of the views (and what they need), for DuckDB. Views named like a table get the prefix ``v_``."""
    ctes = [f"{'v_' if n == 'pages' else ''}{n} AS ({VIEWS[n]})" for n in _closure(names)] + [f"{k} AS ({v})" for k, v in more.items()]
    return "WITH " + ",\n".join(ctes)


def view(spark: SparkSession, sf_dir: str, name: str, parts: int = 0) -> DataFrame:
    """One view as a DataFrame; its tables are read from ``sf_dir`` and, if ``parts`` is given, dealt over so many partitions."""
    if name not in VIEWS:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return table.repartition(parts, table.columns[0]) if parts else table
    sql = VIEWS[name].replace('"left"', "`left`")
    args = {}
    for n in NEEDS[name]:
        args[n] = view(spark, sf_dir, n, parts)
        sql = _placed(sql, n)
    return spark.sql(sql, **args)


def _placed(sql: str, table: str) -> str:
    import re

    return re.sub(rf"\b(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", sql)
