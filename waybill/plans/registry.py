"""The registered queries with their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import address as A
from ..functions import fuzzy as Z
from ..functions import text as X
from ..operators import bills as B
from ..operators import lines as L
from ..operators import master as M
from ..operators import match as R
from ..operators import ocr as O
from ..operators import pages as P
from ..sources.derived import DENY, OWN_NAME, view, with_views
from .shared import settled
from .vendors import VENDORS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def _cells(spark, d):
    return view(spark, d, "master_cells")


def _rows(spark, d):
    return M.master_rows(_cells(spark, d), usps=False)


def _master(spark, d):
    return M.valid_master(_rows(spark, d))


def _extractions(spark, d):
    e = view(spark, d, "extraction")
    a = A.plain_address(F.col("al2"), F.col("city"), F.col("state"), F.col("postcode"), F.col("postcode_is_numeric"), F.lit(""))
    keyed = X.filled(F.col("al2")) & X.filled(F.col("city"))
    return e.select("invoice_id", "source", "name", F.filter(F.array("name", "name2"), lambda x: x.isNotNull()).alias("name_candidates"), F.when(keyed, a).alias("address"), keyed.alias("success"))


def _match(spark, d, matrix=False):
    return R.match_invoices(_extractions(spark, d), _master(spark, d), DENY, matrix)


# --- DuckDB building blocks -------------------------------------------------
def s_norm(c: str) -> str:
    return rf"regexp_replace(upper(regexp_replace(coalesce({c}, ''), '^\s+|\s+$', '', 'g')), '\s+', ' ', 'g')"


def s_name(c: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({c}, '')), '[^a-z0-9]+', ' ', 'g'))"


def s_zip(c: str, num: str) -> str:
    return rf"CASE WHEN {c} IS NULL THEN '' WHEN {num} THEN CASE WHEN TRY_CAST({c} AS BIGINT) = 0 THEN '' ELSE printf('%05d', TRY_CAST({c} AS BIGINT)) END ELSE regexp_replace({c}, '^\s+|\s+$', '', 'g') END"


def s_strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


STRICT = r"^(.+)\s+-\s*(\d+)(?:[\s,]+(.*?))?\s*$"
AL1 = rf"""
    SELECT *, CASE WHEN sep AND strict THEN {s_strip(f"regexp_extract(s, '{STRICT}', 1)")} WHEN rec THEN {s_strip("split_before")} ELSE s END AS shipto_name,
        CASE WHEN sep AND strict THEN regexp_extract(s, '{STRICT}', 2) WHEN rec THEN six END AS customer_number,
        CASE WHEN sep AND strict THEN nullif({s_strip(f"regexp_extract(s, '{STRICT}', 3)")}, '') END AS al1_extra, (NOT sep OR strict) AS parsed_ok, rec AS recovered
    FROM (SELECT *, sep AND NOT strict AND six IS NOT NULL AS rec FROM (
        SELECT *, regexp_matches(s, '\s+-') AS sep, regexp_matches(s, '{STRICT}') AS strict, regexp_extract(s, '^(.*?)\s+-', 1) AS split_before,
            nullif(regexp_extract(regexp_extract(s, '^.*?\s+-(.*)$', 1), '\b(\d{{6}})\b', 1), '') AS six
        FROM (SELECT *, {s_strip("coalesce(al1, '')")} AS s FROM master_cells)))"""
ROWS = f"""
    SELECT row, name, al1, al2, city, state, postcode, postcode_is_numeric, shipto_name, customer_number, al1_extra, recovered,
        ({s_norm("city")} <> '' AND {s_norm("state")} <> '' AND ({s_zip("postcode", "postcode_is_numeric")}) <> '' AND al2 IS NOT NULL) AS has_address,
        {s_norm("al2")} AS a_street, {s_norm("city")} AS a_city, {s_norm("state")} AS a_state, {s_zip("postcode", "postcode_is_numeric")} AS a_zip
    FROM al1p WHERE NOT (name IS NULL AND al1 IS NULL AND al2 IS NULL)"""
BLANK = " OR ".join(f"{c} IS NULL OR trim({c}) = ''" for c in M.CELLS)
MASTER = f"SELECT row, name AS customer_name, shipto_name, customer_number, a_street, a_city, a_state, a_zip FROM mrows WHERE has_address AND NOT ({BLANK})"
RULES = {
    M.REQUIRED: f"SELECT row, '{M.REQUIRED}' AS rule, 'hard' AS severity FROM mrows WHERE {BLANK}",
    M.TRIPLE: f"SELECT row, '{M.TRIPLE}', 'hard' FROM (SELECT row, min(row) OVER (PARTITION BY trim(name), {s_name('shipto_name')}, a_street, a_city, a_state, a_zip) AS f FROM mrows WHERE has_address AND trim(coalesce(name, '')) <> '') WHERE row > f",
    M.NO_NUMBER: f"SELECT row, '{M.NO_NUMBER}', 'hard' FROM mrows WHERE customer_number IS NULL",
    M.DUPLICATE_NUMBER: f"SELECT row, '{M.DUPLICATE_NUMBER}', 'soft' FROM (SELECT row, min(row) OVER (PARTITION BY customer_number) AS f FROM mrows WHERE customer_number IS NOT NULL) WHERE row > f",
    M.MALFORMED: f"SELECT row, '{M.MALFORMED}', 'soft' FROM mrows WHERE recovered",
}
VIOLATIONS = " UNION ALL ".join(f"SELECT * FROM ({q}) AS t(row, rule, severity)" for q in RULES.values())


def texts(df: DataFrame, *columns: str) -> DataFrame:
    """Dates, amounts and numbers that may be missing, as text: both engines print these alike."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def s_texts(sql: str, *columns: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in columns)}) FROM ({sql})"


def base(*views: str, **more: str) -> str:
    return with_views("master_cells", *views, al1p=AL1, mrows=ROWS, master=MASTER, **more)


# --- scalars ------------------------------------------------------------------
@query("normalize_name", f"SELECT 'c' AS kind, c_custkey AS id, {s_name('c_name')} AS n FROM customer UNION ALL SELECT 's', s_suppkey, {s_name('s_name')} FROM supplier UNION ALL SELECT 'p', p_partkey, {s_name('p_name')} FROM part")
def _(spark, d):
    one = lambda t, k, i, n: view(spark, d, t).select(F.lit(k).alias("kind"), F.col(i).alias("id"), X.normalize_name(F.col(n)).alias("n"))
    return one("customer", "c", "c_custkey", "c_name").unionByName(one("supplier", "s", "s_suppkey", "s_name")).unionByName(one("part", "p", "p_partkey", "p_name"))


def _scalar(name: str, f, sql: str) -> None:
    query(name, with_views("raw_strings") + f" SELECT id, {sql} AS out FROM raw_strings")(lambda spark, d: view(spark, d, "raw_strings").select("id", f(F.col("s")).alias("out")))


_scalar("norm_text", X.norm_text, s_norm("s"))
_scalar("clean_name", X.clean_name, s_strip(r"regexp_replace(regexp_replace(replace(coalesce(s, ''), '|', ' '), '^[\s.]+', ''), '\s+', ' ', 'g')"))
_scalar("clean_for_usps", X.clean_for_usps, r"trim(regexp_replace(regexp_replace(coalesce(s, ''), '[^A-Za-z0-9 \-/#]', ' ', 'g'), '\s+', ' ', 'g'))")
_scalar("line_text", X.line_text, s_strip(r"regexp_replace(s, '\s+', ' ', 'g')"))
_scalar("first_fragment", X.first_fragment, rf"""{s_strip("regexp_replace(" + s_strip("CASE WHEN contains(s, '|') THEN coalesce(list_filter(list_transform(string_split(s, '|'), lambda x: " + s_strip("x") + "), lambda x: x <> '')[1], '') ELSE s END") + ", '^_+|_+$', '', 'g')")}""")


@query("fmt_postcode", with_views("master_cells") + f" SELECT row, {s_zip('postcode', 'postcode_is_numeric')} AS zip FROM master_cells")
def _(spark, d):
    return _cells(spark, d).select("row", X.fmt_postcode(F.col("postcode"), F.col("postcode_is_numeric")).alias("zip"))


@query("line_tokens", "SELECT doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))), ' ') AS tokens FROM documents")
def _(spark, d):
    return view(spark, d, "documents").select("doc_id", F.array_join(F.array_sort(X.line_tokens(F.col("text"))), " ").alias("tokens"))


@query("usps_normalize")
def _(spark, d):
    a = A.normalize_address(F.concat(F.col("al2"), F.lit(", Suite 4")), F.col("city"), F.col("state"), F.col("postcode"), F.col("postcode_is_numeric"))
    return _cells(spark, d).select("row", a.alias("a")).select("row", "a.*")


@query("format_score", "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 5 = 1 THEN '' ELSE CAST(o_orderkey % 101 AS VARCHAR) END AS out FROM orders WHERE o_orderkey % 101 <> 0 OR o_orderkey % 5 < 2 UNION ALL SELECT o_orderkey, '' FROM orders WHERE o_orderkey % 101 = 0 AND o_orderkey % 5 >= 2")
def _(spark, d):
    n = F.col("o_orderkey")
    score = F.when(n % 5 == 0, F.lit(None).cast("int")).when(n % 5 == 1, 0).otherwise((n % 101).cast("int"))
    return view(spark, d, "orders").select(n.alias("id"), X.fmt_score(score).alias("out"))


# --- master -------------------------------------------------------------------
@query("parse_al1", with_views("master_cells", al1p=AL1) + " SELECT row, shipto_name AS name, customer_number AS number, al1_extra AS extra, parsed_ok, recovered FROM al1p")
def _(spark, d):
    return _cells(spark, d).select("row", M.parse_al1(F.col("al1")).alias("p")).select("row", "p.*")


@query("master_rows", base() + " SELECT row, shipto_name, customer_number, al1_extra, recovered, CASE WHEN has_address THEN a_street END AS street, CASE WHEN has_address THEN a_city END AS city, CASE WHEN has_address THEN a_state END AS state, CASE WHEN has_address THEN a_zip END AS zip FROM mrows")
def _(spark, d):
    return _rows(spark, d).select("row", "shipto_name", "customer_number", "al1_extra", "recovered", F.col("address.street").alias("street"), F.col("address.city").alias("city"), F.col("address.state").alias("state"), F.col("address.postcode").alias("zip"))


@query("master_valid", base() + " SELECT row, customer_name, shipto_name, customer_number, a_street AS street, a_zip AS zip FROM master")
def _(spark, d):
    return _master(spark, d).select("row", "customer_name", "shipto_name", "customer_number", F.col("address.street").alias("street"), F.col("address.postcode").alias("zip"))


for _name, _rule in {"rule_required": M.REQUIRED, "rule_triple": M.TRIPLE, "rule_no_number": M.NO_NUMBER, "rule_dup_number": M.DUPLICATE_NUMBER, "rule_malformed": M.MALFORMED}.items():
    query(_name, base() + f" SELECT * FROM ({RULES[_rule]}) AS t(row, rule, severity)")(lambda spark, d, r=_rule: M.validate(_rows(spark, d), r).select("row", "rule", "severity"))


@query("violations_all", base() + f" SELECT * FROM ({VIOLATIONS}) ORDER BY row, rule")
def _(spark, d):
    return M.validate(_rows(spark, d)).select("row", "rule", "severity").orderBy("row", "rule")


@query("violations_by_rule", base() + f" SELECT rule, severity, count(*) AS n FROM ({VIOLATIONS}) GROUP BY ALL")
def _(spark, d):
    return M.violation_counts(M.validate(_rows(spark, d)))


@query("master_stats", base() + " SELECT count(*) AS n_rows, count(DISTINCT (a_street, a_city, a_state, a_zip)) AS n_addresses, count(DISTINCT customer_name) AS n_customers FROM master")
def _(spark, d):
    return M.master_stats(_master(spark, d))


@query("shared_addresses", base() + " SELECT a_street AS street, a_city AS city, a_state AS state, a_zip AS postcode, count(*) AS n_rows, count(DISTINCT customer_name) AS n_customers FROM master GROUP BY ALL HAVING count(*) > 1")
def _(spark, d):
    return M.shared_addresses(_master(spark, d))


@query("multi_address_customers", base() + " SELECT customer_name, count(*) AS n_rows, string_agg(a_state || ' / ' || a_city || ' / ' || a_street, '; ' ORDER BY a_state, a_city, a_street, row) AS addresses FROM master GROUP BY customer_name HAVING count(*) > 1")
def _(spark, d):
    return M.multi_address_customers(_master(spark, d))


@query("address_master", base() + " SELECT a_city AS city, a_street AS street, a_state AS state, a_zip AS postcode, row, customer_name FROM master ORDER BY 1, 2, 3, 4, 5")
def _(spark, d):
    return _master(spark, d).select("address.city", "address.street", "address.state", "address.postcode", "row", "customer_name").orderBy("city", "street", "state", "postcode", "row")


E_KEY = f"{s_norm('al2')} AS street, {s_norm('city')} AS city, {s_norm('state')} AS state, {s_zip('postcode', 'postcode_is_numeric')} AS postcode"


@query("lookup_address", base("extraction") + f" SELECT e.invoice_id, e.source, m.row, m.customer_name FROM (SELECT invoice_id, source, {E_KEY} FROM extraction) e JOIN master m ON e.street = m.a_street AND e.city = m.a_city AND e.state = m.a_state AND e.postcode = m.a_zip")
def _(spark, d):
    keys = _extractions(spark, d).filter("address is not null").select("invoice_id", "source", "address.street", "address.city", "address.state", "address.postcode")
    return M.lookup_address(keys, _master(spark, d)).select("invoice_id", "source", "row", "customer_name")


@query("lookup_name", base() + f" SELECT c.c_custkey, m.row FROM customer c JOIN master m ON {s_name("concat('CUSTOMER-', CAST(c.c_custkey % 500 AS VARCHAR), '.')")} = {s_name('m.customer_name')}")
def _(spark, d):
    names = view(spark, d, "customer").select("c_custkey", F.concat(F.lit("CUSTOMER-"), (F.col("c_custkey") % 500).cast("string"), F.lit(".")).alias("name"))
    return M.lookup_customer_name(names, _master(spark, d)).select("c_custkey", "row")


# --- fuzzy ----------------------------------------------------------------------
def s_lcs(a: str, b: str) -> str:
    """LCS as nested folds; list elements are one-element lists, so that state and element have one type."""
    chars = f"list_transform(string_split({a}, ''), lambda c: [unicode(c)::BIGINT])"
    inner = f"list_reduce(list_transform(range(1, length({b}) + 1), lambda j: [j]), lambda acc, jj: list_append(acc, CASE WHEN unicode(({b})[jj[1]])::BIGINT = ca[1] THEN prev[jj[1]] + 1 ELSE greatest(prev[jj[1] + 1], acc[jj[1]]) END), [0::BIGINT])"
    return f"(CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE list_reduce({chars}, lambda prev, ca: {inner}, list_transform(range(0, length({b}) + 1), lambda z: 0::BIGINT))[length({b}) + 1] END)"


def s_ratio(a: str, b: str) -> str:
    return f"(CASE WHEN length({a}) + length({b}) = 0 THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * {s_lcs(a, b)} / (length({a}) + length({b})) END)"


PAIRS = "SELECT DISTINCT lower(x.p_name) AS a, lower(y.p_name) AS b FROM (SELECT DISTINCT p_name FROM part) x, (SELECT DISTINCT p_name FROM part) y WHERE x.p_name < y.p_name"


def _pairs(spark, d):
    names = view(spark, d, "part").select("p_name").distinct()
    return names.alias("x").join(names.alias("y"), F.col("x.p_name") < F.col("y.p_name")).select(F.lower("x.p_name").alias("a"), F.lower("y.p_name").alias("b")).distinct()


def s_tokens(a: str) -> str:
    return f"list_filter(string_split({a}, ' '), lambda t: t <> '')"


SETS = f"""
    SELECT *, array_to_string(list_sort(ta), ' ') AS sa, array_to_string(list_sort(tb), ' ') AS sb, array_to_string(list_sort(list_distinct(list_filter(ta, lambda t: list_contains(tb, t)))), ' ') AS core,
        array_to_string(list_sort(list_distinct(list_filter(ta, lambda t: NOT list_contains(tb, t)))), ' ') AS da, array_to_string(list_sort(list_distinct(list_filter(tb, lambda t: NOT list_contains(ta, t)))), ' ') AS db
    FROM (SELECT *, {s_tokens("a")} AS ta, {s_tokens("b")} AS tb FROM prs)"""
SETS2 = "SELECT *, CASE WHEN core = '' THEN da WHEN da = '' THEN core ELSE core || ' ' || da END AS la, CASE WHEN core = '' THEN db WHEN db = '' THEN core ELSE core || ' ' || db END AS lb FROM sets1"
TOKEN_SET = f"CASE WHEN len(ta) = 0 OR len(tb) = 0 THEN 0.0 WHEN core <> '' AND (da = '' OR db = '') THEN 100.0 WHEN core = '' THEN {s_ratio('la', 'lb')} ELSE greatest({s_ratio('la', 'lb')}, {s_ratio('core', 'la')}, {s_ratio('core', 'lb')}) END"
#: For names whose lengths differ by less than half; longer differences bring in partial ratios.
WRATIO = f"CASE WHEN a = '' OR b = '' THEN 0.0 ELSE greatest({s_ratio('a', 'b')}, 0.95 * {s_ratio('sa', 'sb')}, 0.95 * ({TOKEN_SET})) END"
ROUND = "round({}, 9)"


@query("fuzzy_ratio", f"SELECT a, b, round({s_ratio('a', 'b')}, 6) AS score FROM ({PAIRS})")
def _(spark, d):
    return _pairs(spark, d).withColumn("score", F.round(Z.ratio_udf(F.col("a"), F.col("b")), 6))


@query("fuzzy_ratio_native", f"SELECT a, b, round({s_ratio('a', 'b')}, 6) AS score FROM ({PAIRS})")
def _(spark, d):
    return _pairs(spark, d).withColumn("score", F.round(Z.ratio_native(F.col("a"), F.col("b")), 6))


@query("fuzzy_token_sort", f"WITH prs AS ({PAIRS}), sets1 AS ({SETS}) SELECT a, b, round({s_ratio('sa', 'sb')}, 6) AS score FROM sets1")
def _(spark, d):
    return _pairs(spark, d).withColumn("score", F.round(Z.token_sort_ratio_udf(F.col("a"), F.col("b")), 6))


@query("fuzzy_token_set", f"WITH prs AS ({PAIRS}), sets1 AS ({SETS}), sets2 AS ({SETS2}) SELECT a, b, round({TOKEN_SET}, 6) AS score FROM sets2")
def _(spark, d):
    return _pairs(spark, d).withColumn("score", F.round(Z.token_set_ratio_udf(F.col("a"), F.col("b")), 6))


def s_windows(s: str, t: str) -> str:
    """Best ratio of s against the windows of its length in t, prefixes and suffixes included."""
    windows = f"list_transform(range(1 - length({s}), length({t})), lambda k: substr({t}, greatest(k, 0) + 1, least(length({t}), k + length({s})) - greatest(k, 0)))"
    return f"list_max(list_transform({windows}, lambda w: {s_ratio(s, 'w')}))"


def s_partial(a: str, b: str) -> str:
    return f"CASE WHEN {a} = '' OR {b} = '' THEN CASE WHEN {a} = {b} THEN 100.0 ELSE 0.0 END WHEN length({a}) = length({b}) THEN greatest({s_windows(a, b)}, {s_windows(b, a)}) WHEN length({a}) < length({b}) THEN {s_windows(a, b)} ELSE {s_windows(b, a)} END"


PARTIAL_TOKEN = f"CASE WHEN core <> '' THEN 100.0 WHEN da = sa AND db = sb THEN {s_partial('sa', 'sb')} ELSE greatest({s_partial('sa', 'sb')}, {s_partial('da', 'db')}) END"
FAR = f"greatest({s_ratio('a', 'b')}, sc * ({s_partial('a', 'b')}), 0.95 * sc * ({PARTIAL_TOKEN}))"


@query("fuzzy_partial", f"SELECT a, b, round({s_partial('a', 'b')}, 6) AS score FROM ({PAIRS})")
def _(spark, d):
    return _pairs(spark, d).withColumn("score", F.round(Z.partial_ratio_udf(F.col("a"), F.col("b")), 6))


@query("fuzzy_wratio", f"WITH prs AS ({PAIRS}), sets1 AS ({SETS}), sets2 AS ({SETS2}), lens AS (SELECT *, greatest(length(a), length(b)) / least(length(a), length(b)) AS r FROM sets2) SELECT a, b, round(CASE WHEN r < 1.5 THEN {WRATIO} ELSE {FAR} END, 6) AS score FROM (SELECT *, CASE WHEN r <= 8 THEN 0.9 ELSE 0.6 END AS sc FROM lens)")
def _(spark, d):
    return _pairs(spark, d).withColumn("score", F.round(Z.weighted_ratio_udf(F.col("a"), F.col("b")), 6))


# --- matching ---------------------------------------------------------------------
EXT = f"SELECT invoice_id, source, name, name2, CASE WHEN coalesce(al2, '') <> '' AND coalesce(city, '') <> '' THEN 1 ELSE 0 END AS keyed, {E_KEY} FROM extraction"
HITS = "SELECT e.invoice_id, e.source, e.keyed, e.name, e.name2, m.* FROM ext e LEFT JOIN master m ON e.keyed = 1 AND e.street <> '' AND e.street = m.a_street AND e.city = m.a_city AND e.state = m.a_state AND e.postcode = m.a_zip"
COUNTS = "SELECT invoice_id, source, max(keyed) AS keyed, count(row) AS n, min(row) AS one FROM hits GROUP BY ALL"
CANDS = "SELECT h.invoice_id, h.source, h.row, h.shipto_name, h.name AS cand, 0 AS c FROM hits h JOIN cnt USING (invoice_id, source) WHERE n > 1 UNION ALL SELECT h.invoice_id, h.source, h.row, h.shipto_name, h.name2, 1 FROM hits h JOIN cnt USING (invoice_id, source) WHERE n > 1 AND h.name2 IS NOT NULL"
NAMED = f"SELECT *, {s_name('cand')} AS cn, {s_name('shipto_name')} AS rn FROM cands"
PRS = "SELECT DISTINCT cn AS a, rn AS b FROM named WHERE cn <> '' AND rn <> ''"
SCORES = f"SELECT a, b, CAST(round_even({WRATIO}, 0) AS INTEGER) AS score FROM sets2"
BEST = "SELECT invoice_id, source, max(score) AS score, arg_max(row, (score, -c, -row)) AS best FROM named JOIN scores ON cn = a AND rn = b GROUP BY ALL"
SRC = f"""SELECT c.invoice_id, c.source, CASE WHEN keyed = 0 THEN 'no_input' WHEN n = 0 THEN 'no_match' WHEN n = 1 THEN 'unique' WHEN coalesce(score, 0) >= {R.THRESHOLD} THEN 'disambiguated' ELSE 'ambiguous' END AS method,
    CASE WHEN n = 1 THEN one WHEN n > 1 AND coalesce(score, 0) >= {R.THRESHOLD} THEN best END AS row, CASE WHEN n > 1 THEN coalesce(score, 0) END AS score, n AS n_candidates FROM cnt c LEFT JOIN best b ON b.invoice_id = c.invoice_id AND b.source = c.source"""
FULL = f"""SELECT coalesce(b.invoice_id, p.invoice_id) AS invoice_id, coalesce(b.method, 'no_input') AS bol_method, b.score AS bol_score, b.row AS bol_row, coalesce(p.method, 'no_input') AS inv_method, p.score AS inv_score, p.row AS inv_row, bm.customer_name AS bol_name, pm.customer_name AS inv_name
    FROM (SELECT * FROM src WHERE source = 'bol') b FULL JOIN (SELECT * FROM src WHERE source = 'page1') p ON b.invoice_id = p.invoice_id LEFT JOIN master bm ON bm.row = b.row LEFT JOIN master pm ON pm.row = p.row"""
POLICY = f"""SELECT *, CASE WHEN bol_method = 'no_input' AND inv_method = 'no_input' THEN 'hard_fail' WHEN bol_row IS NOT NULL AND inv_row IS NOT NULL AND bol_name = inv_name THEN 'agree' WHEN bol_row IS NOT NULL AND inv_row IS NOT NULL THEN 'bol_wins_disagreement' WHEN bol_row IS NOT NULL THEN 'bol_only' WHEN inv_row IS NOT NULL THEN 'inv_only' ELSE 'hard_fail' END AS m FROM fulls"""
DECIDED = f"""SELECT invoice_id, CASE WHEN denied THEN 'denied' ELSE m END AS method, CASE WHEN denied OR m = 'hard_fail' THEN 'severe' WHEN m = 'bol_wins_disagreement' AND bol_method = 'unique' AND inv_method = 'unique' THEN 'severe' WHEN m = 'bol_wins_disagreement' THEN 'info' ELSE 'ok' END AS severity, NOT denied AND m <> 'hard_fail' AS success,
    CASE WHEN NOT denied THEN e.customer_name END AS customer_name, CASE WHEN NOT denied THEN e.customer_number END AS customer_number, CASE WHEN NOT denied THEN e.row END AS master_row, e.row AS entry_row, bol_method, bol_score, inv_method, inv_score, bol_method = 'no_input' AND inv_method = 'no_input' AS none
    FROM (SELECT p.*, CASE WHEN m = 'inv_only' THEN inv_row WHEN m <> 'hard_fail' THEN bol_row END AS erow FROM policy p) p LEFT JOIN master e ON e.row = p.erow CROSS JOIN LATERAL (SELECT coalesce({s_name("e.customer_name")} = '{DENY[0]}', FALSE) AS denied)"""
MATCH = dict(ext=EXT, hits=HITS, cnt=COUNTS, cands=CANDS, named=NAMED, prs=PRS, sets1=SETS, sets2=SETS2, scores=SCORES, best=BEST, src=SRC, fulls=FULL, policy=POLICY, decided=DECIDED)


@query("match_source", base("extraction", **MATCH) + s_texts(" SELECT invoice_id, source, method, row, score, CAST(n_candidates AS INTEGER) AS n_candidates FROM src", "row", "score"))
def _(spark, d):
    return texts(R.match_sources(_extractions(spark, d), _master(spark, d), matrix=False).select("invoice_id", "source", "method", F.col("entry.row").alias("row"), "score", "n_candidates"), "row", "score")


@query("name_disambiguation", base("extraction", **MATCH) + " SELECT n.invoice_id, n.source, n.cand, n.shipto_name, s.score FROM named n JOIN scores s ON n.cn = s.a AND n.rn = s.b")
def _(spark, d):
    return R.match_pairs(_extractions(spark, d), _master(spark, d))


@query("match_invoice", base("extraction", **MATCH) + s_texts(" SELECT invoice_id, method, severity, success, customer_name, customer_number, master_row, bol_method, bol_score, inv_method, inv_score FROM decided", "master_row", "bol_score", "inv_score"))
def _(spark, d):
    return texts(_match(spark, d).select("invoice_id", "method", "severity", "success", "customer_name", "customer_number", "master_row", "bol_method", "bol_score", "inv_method", "inv_score"), "master_row", "bol_score", "inv_score")


@query("match_summary", base("extraction", **MATCH) + " SELECT method, severity, count(*) AS n FROM decided GROUP BY ALL")
def _(spark, d):
    return _match(spark, d).groupBy("method", "severity").agg(F.count("*").alias("n"))


@query("batch_totals", base("extraction", **MATCH) + " SELECT count(*) AS total, count_if(success)::BIGINT AS resolved, count_if(severity = 'severe')::BIGINT AS severe, count_if(bol_method <> 'no_input')::BIGINT AS bol_ok, count_if(inv_method <> 'no_input')::BIGINT AS page1_ok FROM decided")
def _(spark, d):
    return R.batch_totals(_match(spark, d))


@query("match_log")
def _(spark, d):
    # A master's file is small, but its cells are slow to parse: in several tasks, and once. Past the generator no filter gets back to the scan.
    cells = view(spark, d, "master_cells", 4 * spark.sparkContext.defaultParallelism)
    cells = cells.select(F.explode(F.array(F.struct("*"))).alias("_r")).select("_r.*")
    master = settled(M.valid_master(M.master_rows(cells, usps=False)))
    return R.group_logs(settled(R.alike(_extractions(spark, d))), master, DENY)


# --- bills ------------------------------------------------------------------------
@query("bill_dates", with_views("orders_keyed") + s_texts(" SELECT invoice_id, CASE WHEN date_trunc('month', invoice_date) = date_trunc('month', ship_date) THEN invoice_date ELSE ship_date END AS bill_date, CAST(past_due_date - 1 AS DATE) AS due_date FROM orders_keyed", "bill_date", "due_date"))
def _(spark, d):
    return texts(view(spark, d, "orders_keyed").select("invoice_id", B.bill_date(F.col("invoice_date"), F.col("ship_date")).alias("bill_date"), B.due_date(F.col("past_due_date")).alias("due_date")), "bill_date", "due_date")


def s_category(c: str, v: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({c}, '{k}') OR contains('{k}', {c}) THEN '{n}'" for k, n in VENDORS[v].categories.items()) + f" ELSE '{B.UNKNOWN_CATEGORY}' END"


SHIPPERS = "SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN 'Old Wisconsin Sausage Company' WHEN 1 THEN 'OLD WISCONSIN SAUSAGE' WHEN 2 THEN 'DairyFood' WHEN 3 THEN 'Midwest Refrigerated Services LLC' ELSE o_orderpriority END AS shipper FROM orders"


@query("bill_category", f"SELECT id, {s_category('shipper', 'a')} AS a, {s_category('shipper', 'b')} AS b FROM ({SHIPPERS})")
def _(spark, d):
    rows = spark.sql(SHIPPERS.replace("FROM orders", "FROM {orders}"), orders=view(spark, d, "orders"))
    return rows.select("id", *[B.category(F.col("shipper"), VENDORS[v].categories).alias(v) for v in ("a", "b")])


# --- pages ------------------------------------------------------------------------
def _parsed(spark, d, v):
    return VENDORS[v].parse(view(spark, d, "pages").filter(F.col("vendor") == v))


DATE, SDAY = r"\d{2}/\d{2}/\d{4}", "CAST(try_strptime({}, '%m/%d/%Y') AS DATE)"
BLOCK_LINES_A = r"list_filter(list_transform(list_filter(lines[h + 1:], lambda x: trim(x) <> ''), lambda x: regexp_split_to_array(trim(x), '\s{3,}')), lambda p: TRUE)"
BLOCK_LINES_B = BLOCK_LINES_A.replace("lambda p: TRUE", "lambda p: len(p) >= 2")


def s_block(v: str) -> str:
    parts = BLOCK_LINES_A if v == "a" else BLOCK_LINES_B
    return f"""
    SELECT *, CASE WHEN h IS NULL THEN 'header' WHEN k = 0 AND n >= 7 THEN 'long' WHEN k = 0 THEN 'city' WHEN k < 2 THEN 'name' END AS failed FROM (
        SELECT *, coalesce(list_position(list_transform(rgt, lambda x: regexp_matches(x, '{P.CSZ_LINE}')), TRUE), 0) AS k FROM (
            SELECT *, len(parts) AS n, list_transform(parts[1:7], lambda p: trim(p[len(p)])) AS rgt, list_transform(parts[1:7], lambda p: trim(p[len(p) - 1])) AS lft FROM (
                SELECT *, CASE WHEN h IS NULL THEN [] ELSE {parts} END AS parts FROM (
                    SELECT *, list_position(list_transform(lines, lambda x: rtrim(x) LIKE '%CONSIGNEE'), TRUE) AS h FROM (SELECT *, string_split(layout, chr(10)) AS lines FROM v_pages WHERE vendor = '{v}')))))"""


def s_fields(v: str) -> str:
    b = lambda c: f"CASE WHEN failed IS NULL THEN {c} END"
    csz = lambda g: f"regexp_extract(rgt[k], '{P.CSZ_LINE}', {g})"
    block = f"{b('rgt[1]')} AS consignee, {b('CASE WHEN k > 2 THEN rgt[2] END')} AS line_1, {b('CASE WHEN k > 3 THEN rgt[3] END')} AS line_2, {b(csz(1))} AS city, {b('upper(' + csz(2) + ')')} AS state, {b(csz(3))} AS postcode"
    got = lambda p: f"nullif(regexp_extract(text, '{p}', 1), '')"
    dates = f"regexp_extract_all(text, '{DATE}')"
    if v == "a":
        amounts = r"regexp_extract_all(text, '\$?([\d,]+\.\d{2})', 1)"
        raw = rf"""coalesce({got(r'INVOICE\s+(\d{7})')}, {got(r'\b(\d{7})\b')}) AS invoice_number, {dates}[1] AS r1, {dates}[2] AS r2, {dates}[3] AS r3,
            CASE {' '.join(f"WHEN contains(text, '{s}') THEN '{s}'" for s in P.SHIPPERS_A)} WHEN contains(text, 'MRS') THEN 'Midwest Refrigerated Services' END AS shipper,
            'SO-' || {got(r'S[O0]-(\d+)')} AS so_number, coalesce(list_filter({amounts}, lambda x: contains(x, ','))[-1], {amounts}[-1]) AS amount"""
    else:
        raw = rf"""{got(r'\b(\d{7})\b')} AS invoice_number, {dates}[1] AS r1, coalesce({got(rf'({DATE})HIGH')}, {got(rf'SHIP\s*DATE[^\d]*?({DATE})')}) AS r2, {got(rf'({DATE})\s+\$[\d,]+\.\d{{2}}\s*USD')} AS r3,
            {b('lft[1]')} AS shipper, 'SO-' || {got(r'S[O0]-(\d+(?:/\d+)*)')} AS so_number, {got(r'\$([\d,]+\.\d{2})\s*USD')} AS amount"""
    day = lambda c: SDAY.format(c)
    bad = " OR ".join(f"({c} IS NOT NULL AND {day(c)} IS NULL)" for c in ("r1", "r2", "r3"))
    return f"SELECT *, {day('r1')} AS invoice_date, {day('r2')} AS ship_date, {day('r3')} AS past_due_date, CAST(replace(amount, ',', '') AS DECIMAL(12,2)) AS total_amount, ({bad}) AS parse_error FROM (SELECT *, {raw}, {block} FROM blk)"


TYPED = ["invoice_date", "ship_date", "past_due_date", "total_amount"]
FLAT = ["invoice_id", "invoice_number", "invoice_date", "ship_date", "past_due_date", "shipper", "consignee", "line_1", "line_2", "city", "state", "postcode", "so_number", "total_amount", "parse_error"]


def _flat(df):
    return df.select("invoice_id", "invoice_number", "invoice_date", "ship_date", "past_due_date", "shipper", "consignee", F.col("consignee_address_line_1").alias("line_1"), F.col("consignee_address_line_2").alias("line_2"), F.col("consignee_city").alias("city"), F.col("consignee_state").alias("state"), F.col("consignee_postcode").alias("postcode"), "so_number", "total_amount", "parse_error")


for _v in ("a", "b"):
    query(f"parse_vendor_{_v}", with_views("pages", blk=s_block(_v), parsed=s_fields(_v)) + s_texts(f" SELECT {', '.join(FLAT)} FROM parsed", *TYPED))(lambda spark, d, v=_v: texts(_flat(_parsed(spark, d, v)), *TYPED))
    query(f"consignee_block_{_v}", with_views("pages", blk=s_block(_v)) + " SELECT invoice_id, CAST(k AS INTEGER) AS city_at, array_to_string(rgt, '|') AS right_col FROM blk")(
        lambda spark, d, v=_v: view(spark, d, "pages").filter(F.col("vendor") == v).select("invoice_id", P.consignee_block(F.col("layout"), v == "b").alias("b")).select("invoice_id", F.coalesce("b.city_at", F.lit(0)).alias("city_at"), F.array_join(F.coalesce("b.right", F.array().cast("array<string>")), "|").alias("right_col"))
    )
    query(f"parse_reasons_{_v}")(lambda spark, d, v=_v: _parsed(spark, d, v).select("invoice_id", F.explode("reasons").alias("field", "reason")))

REQ = ["invoice_number", "invoice_date", "ship_date", "shipper", "consignee", "so_number", "total_amount", "past_due_date"]


@query("first_missing", with_views("pages", blk=s_block("a"), parsed=s_fields("a")) + " SELECT invoice_id, CASE " + " ".join(f"WHEN {c} IS NULL THEN '{c}'" for c in REQ) + " END AS field FROM parsed")
def _(spark, d):
    return _parsed(spark, d, "a").select("invoice_id", P.first_missing(VENDORS["a"].required).alias("m")).select("invoice_id", "m.field")


@query("page_ship_to", with_views("pages", blk=s_block("a"), parsed=s_fields("a")) + f" SELECT invoice_id, consignee AS name, coalesce(line_1, '') <> '' AND coalesce(city, '') <> '' AS success, CASE WHEN coalesce(line_1, '') <> '' AND coalesce(city, '') <> '' THEN {s_norm('line_1')} END AS street, CASE WHEN coalesce(line_1, '') <> '' AND coalesce(city, '') <> '' THEN {s_norm('line_2')} END AS line_2 FROM parsed")
def _(spark, d):
    return P.page_ship_to(_parsed(spark, d, "a"), usps=False).select("invoice_id", "name", "success", F.col("address.street").alias("street"), F.col("address.line_2").alias("line_2"))


# --- whole run, one vendor ------------------------------------------------------------
def _bills(spark, d, v="a"):
    spec = VENDORS[v]
    ready = _parsed(spark, d, v).filter(~F.col("parse_error")).withColumn("_m", P.first_missing(spec.required)).filter("_m is null").drop("text", "layout", "reasons", "_m")
    return B.make_bills(ready.join(_match(spark, d).filter("success").select("invoice_id", "customer_name"), "invoice_id"), spec.bill_name, spec.categories)


def _outcome(spark, d, v="a"):
    return B.outcomes(_parsed(spark, d, v).drop("text", "layout"), _match(spark, d), None, P.first_missing(VENDORS[v].required))


RUN = dict(**MATCH, blk=s_block("a"), parsed=s_fields("a"), miss="SELECT *, CASE " + " ".join(f"WHEN {c} IS NULL THEN '{c}'" for c in REQ) + " END AS gone FROM parsed")
BILLABLE = "FROM miss p JOIN decided m ON p.invoice_id = m.invoice_id WHERE NOT p.parse_error AND p.gone IS NULL AND m.success"


@query("bills", base("extraction", "pages", **RUN) + s_texts(f" SELECT p.invoice_id, '{VENDORS['a'].bill_name}' AS vendor, CASE WHEN date_trunc('month', invoice_date) = date_trunc('month', ship_date) THEN invoice_date ELSE ship_date END AS bill_date, CAST(past_due_date - 1 AS DATE) AS due_date, invoice_number AS bill_number, {s_category('shipper', 'a')} AS category, so_number AS description, total_amount AS amount, m.customer_name AS customer, so_number AS memo {BILLABLE}", "bill_date", "due_date", "amount"))
def _(spark, d):
    return texts(_bills(spark, d), "bill_date", "due_date", "amount")


@query("bill_rows", base("extraction", "pages", **RUN) + f""" SELECT invoice_number AS "Bill no.", '{VENDORS['a'].bill_name}' AS "Vendor", strftime(CASE WHEN date_trunc('month', invoice_date) = date_trunc('month', ship_date) THEN invoice_date ELSE ship_date END, '%m/%d/%Y') AS "Bill Date", strftime(CAST(past_due_date - 1 AS DATE), '%m/%d/%Y') AS "Due Date", 'Category Details' AS "Type", {s_category('shipper', 'a')} AS "Category", so_number AS "Description", CAST(total_amount AS VARCHAR) AS "Amount", m.customer_name AS "Customer / Project", so_number AS "Memo" {BILLABLE}""")
def _(spark, d):
    return B.bill_rows(_bills(spark, d))


STEP = "CASE WHEN p.parse_error THEN 'parse_pdf' WHEN p.gone IS NOT NULL THEN 'validate_fields' WHEN NOT coalesce(m.success, FALSE) THEN 'match_customer' END"


@query("summary_log", base("extraction", "pages", **RUN) + f""" SELECT p.invoice_id AS "Invoice File", CASE WHEN ({STEP}) IS NULL THEN 'SUCCESS' ELSE 'FAIL' END AS "Status", coalesce(p.invoice_number, '') AS "Bill Number", coalesce(CAST(p.total_amount AS VARCHAR), '') AS "Total Amount", CASE WHEN p.parse_error OR p.gone IS NOT NULL THEN '' ELSE coalesce(m.method, '') END AS "Match Method", CASE WHEN p.parse_error OR p.gone IS NOT NULL THEN '' ELSE coalesce(CAST(m.entry_row AS VARCHAR), '') END AS "Master Row", CASE WHEN p.parse_error OR p.gone IS NOT NULL OR coalesce(m.bol_score, 0) = 0 THEN '' ELSE CAST(m.bol_score AS VARCHAR) END AS "BOL Score", coalesce({STEP}, 'N/A') AS "Fail Step" FROM miss p LEFT JOIN decided m ON p.invoice_id = m.invoice_id""")
def _(spark, d):
    return B.summary_rows(_outcome(spark, d)).select("Invoice File", "Status", "Bill Number", "Total Amount", "Match Method", "Master Row", "BOL Score", "Fail Step")


@query("summary_rows_all_columns")
def _(spark, d):
    return B.summary_rows(_outcome(spark, d, "b"), "run", VENDORS["b"].company)


PAGE1 = "SELECT * FROM ext WHERE source = 'page1'"
DIFF = f"""SELECT m.invoice_id, m.method, e.row AS master_row, {s_name('p.name')} <> {s_name('e.customer_name')} AS name_differs,
    CASE WHEN coalesce(p.keyed, 0) = 0 THEN e.a_street <> '' ELSE p.street <> e.a_street END AS street_differs, CASE WHEN coalesce(p.keyed, 0) = 0 THEN e.a_city <> '' ELSE p.city <> e.a_city END AS city_differs, CASE WHEN coalesce(p.keyed, 0) = 0 THEN e.a_zip <> '' ELSE p.postcode <> e.a_zip END AS postcode_differs,
    p.name AS page1_name, CASE WHEN coalesce(p.keyed, 0) = 1 THEN p.street ELSE '' END AS pst, CASE WHEN coalesce(p.keyed, 0) = 1 THEN p.city ELSE '' END AS pct, CASE WHEN coalesce(p.keyed, 0) = 1 THEN p.state ELSE '' END AS pse, CASE WHEN coalesce(p.keyed, 0) = 1 THEN p.postcode ELSE '' END AS pzp
    FROM decided m JOIN master e ON e.row = m.entry_row LEFT JOIN page1 p ON p.invoice_id = m.invoice_id WHERE m.success"""


@query("discrepancies", base("extraction", **MATCH, page1=PAGE1, dif=DIFF) + " SELECT invoice_id, method, master_row, name_differs, street_differs, city_differs, postcode_differs FROM dif WHERE name_differs OR street_differs OR city_differs OR postcode_differs")
def _(spark, d):
    return B.discrepancies(_match(spark, d), _extractions(spark, d).filter("source = 'page1'")).select("invoice_id", "method", "master_row", "name_differs", "street_differs", "city_differs", "postcode_differs")


@query("mailing_line", base("extraction", **MATCH, page1=PAGE1, dif=DIFF) + """ SELECT invoice_id AS "Invoice File", concat_ws(', ', nullif(page1_name, ''), nullif(pst, ''), nullif(concat_ws(', ', nullif(pct, ''), nullif(concat_ws(' ', nullif(pse, ''), nullif(pzp, '')), '')), '')) AS "Current Consignee Name and Address" FROM dif WHERE name_differs OR street_differs OR city_differs OR postcode_differs""")
def _(spark, d):
    found = B.discrepancies(_match(spark, d), _extractions(spark, d).filter("source = 'page1'"))
    return B.discrepancy_rows(found).select("Invoice File", "Current Consignee Name and Address")


# --- OCR --------------------------------------------------------------------------
WLINES = """SELECT invoice_id, pass, psm, block_num, par_num, line_num, string_agg(trim(text), ' ' ORDER BY word_idx, trim(text)) AS text, min(top) AS y_top, max(top + height) AS y_bot, min("left") AS x_left, max("left" + width) AS x_right FROM ocr_words WHERE trim(text) <> '' GROUP BY ALL"""
UNION = "SELECT * , row_number() OVER (PARTITION BY invoice_id, pass ORDER BY y_top, list_position([3, 6, 11], psm), block_num, par_num, line_num) AS line_idx FROM wl WHERE psm IN (3, 6, 11)"


@query("ocr_word_lines", with_views("ocr_words", wl=WLINES) + " SELECT * FROM wl")
def _(spark, d):
    return O.word_lines(view(spark, d, "ocr_words"))


@query("ocr_union", with_views("ocr_words", wl=WLINES, un=UNION) + " SELECT invoice_id, psm, line_num, line_idx FROM un")
def _(spark, d):
    return O.union_passes(O.word_lines(view(spark, d, "ocr_words")), 3, 6, 11).select("invoice_id", "psm", "line_num", "line_idx")


LTEXT = s_strip(r"regexp_replace(text, '\s+', ' ', 'g')")
CSZL = f"SELECT *, {s_strip(f'''regexp_extract(t, '{X.CSZ.replace(chr(39), chr(39) * 2)}', 1)''')} AS csz_city, regexp_extract(t, '{X.CSZ.replace(chr(39), chr(39) * 2)}', 2) AS csz_state, regexp_extract(t, '{X.CSZ.replace(chr(39), chr(39) * 2)}', 3) AS csz_zip FROM (SELECT *, {LTEXT} AS t FROM ocr_lines) WHERE regexp_matches(t, '{X.CSZ.replace(chr(39), chr(39) * 2)}')"


# --- bills of lading: words to bounds -----------------------------------------------
FORM = O.Profile(lower_anchor=OWN_NAME.lower())


def s_anchors(target: str, threshold: int, share: float) -> str:
    """Lines of ``full`` about as long as the target that nearly contain it; each text is scored once."""
    scored = f"SELECT t, CAST(floor({s_partial('a', 't')}) AS INTEGER) AS score FROM (SELECT DISTINCT t, '{target}' AS a FROM (SELECT lower({LTEXT}) AS t FROM un) WHERE length(t) >= {int(len(target) * share)})"
    return f"WITH sc AS MATERIALIZED ({scored}) SELECT u.*, sc.score FROM (SELECT *, lower({LTEXT}) AS t FROM un) u JOIN sc ON u.t = sc.t WHERE sc.score >= {threshold}"


def s_header(target: str) -> str:
    scored = f"SELECT *, {s_ratio('upper(t)', chr(39) + target + chr(39))} AS score FROM (SELECT *, trim(text) AS t FROM bol_words WHERE pass = 'header' AND trim(text) <> '' AND length(trim(text)) <= {len(target) + 2})"
    return f"""SELECT invoice_id, t AS text, "left" AS x_left, "left" + width AS x_right, top AS y_top, score FROM (SELECT *, row_number() OVER (PARTITION BY invoice_id ORDER BY top, score DESC, word_idx) AS r FROM ({scored}) WHERE score >= {O.TUNING.divider_threshold}) WHERE r = 1"""


def s_mean(lines: str, y: str = "y_top") -> str:
    return f"SELECT invoice_id, CAST(round_even(avg({y}), 0) AS INTEGER) AS y, CAST(round_even(avg(score), 0) AS INTEGER) AS score, count(*) AS n FROM {lines} GROUP BY invoice_id"


BOL = dict(
    wl=WLINES.replace("ocr_words", "bol_words"),
    un=UNION + " AND pass = 'page'",
    ups=s_anchors(FORM.upper_anchor, O.TUNING.anchor_threshold, O.TUNING.anchor_min_len),
    lows=s_anchors(FORM.lower_anchor, O.TUNING.anchor_threshold, O.TUNING.anchor_min_len),
    heads=s_anchors(FORM.header, FORM.header_threshold, O.TUNING.header_min_len),
    wa=s_header(FORM.divider_words[0]),
    wb=s_header(FORM.divider_words[1]),
    dv="SELECT coalesce(wa.invoice_id, wb.invoice_id) AS invoice_id, coalesce(CAST(floor((wa.x_right + wb.x_left) / 2) AS INTEGER), wb.x_left, wa.x_right) AS divider_x FROM wa FULL JOIN wb ON wa.invoice_id = wb.invoice_id",
    ends=f"SELECT p.*, coalesce(u.y, h.y + {FORM.header_pad}) AS upper_y, l.y AS lower_y, dv.divider_x FROM bol_pages p LEFT JOIN ({s_mean('ups')}) u ON u.invoice_id = p.invoice_id LEFT JOIN ({s_mean('lows')}) l ON l.invoice_id = p.invoice_id LEFT JOIN ({s_mean('heads', 'y_bot')}) h ON h.invoice_id = p.invoice_id LEFT JOIN dv ON dv.invoice_id = p.invoice_id",
    mids="SELECT *, CAST(floor((upper_y + lower_y) / 2) AS INTEGER) AS mid_y FROM ends",
    bnd=f"""SELECT *, 0 AS roi_x1, CAST(least(page_w, coalesce(divider_x, floor(page_w / 2)) + {O.TUNING.roi_pad_right}) AS INTEGER) AS roi_x2, CASE WHEN mid_y IS NOT NULL THEN greatest(0, mid_y - {O.TUNING.roi_pad_top}) ELSE 0 END AS roi_y1, CASE WHEN lower_y IS NOT NULL THEN least(page_h, lower_y + {O.TUNING.roi_pad_bottom}) ELSE page_h END AS roi_y2,
        CASE WHEN upper_y IS NULL AND lower_y IS NULL THEN 'Could not locate the SHIP TO block on the BOL: neither the upper anchor (''{FORM.upper_anchor}'') nor the lower anchor (''{FORM.lower_anchor}'') could be matched in the page-2 OCR output.'
            WHEN upper_y IS NULL THEN concat('Could not locate the top of the SHIP TO block: the upper anchor (''{FORM.upper_anchor}'') was not matched in OCR. The lower anchor (''{FORM.lower_anchor}'') was found at y=', lower_y, '.')
            WHEN lower_y IS NULL THEN concat('Could not locate the bottom of the SHIP TO block: the lower anchor (''{FORM.lower_anchor}'') was not matched in OCR. The upper anchor (''{FORM.upper_anchor}'') was found at y=', upper_y, '.') END AS failure FROM mids""",
)


def s_bol(sql: str) -> str:
    return with_views("bol_pages", "bol_words", **BOL) + sql


def _page_lines(spark, d):
    return O.union_passes(O.word_lines(view(spark, d, "bol_words").filter("pass = 'page'")), 3, 6, 11)


def _header(spark, d):
    return view(spark, d, "bol_words").filter("pass = 'header'")


def _bounds(spark, d):
    return O.bounds(view(spark, d, "bol_pages"), _page_lines(spark, d), _header(spark, d), FORM)


@query("anchor_lines", s_bol(" SELECT 'upper' AS anchor, invoice_id, line_num, score FROM ups UNION ALL SELECT 'lower', invoice_id, line_num, score FROM lows"))
def _(spark, d):
    found = [O.anchor_lines(_page_lines(spark, d), t).select(F.lit(n).alias("anchor"), "invoice_id", "line_num", "score") for n, t in (("upper", FORM.upper_anchor), ("lower", FORM.lower_anchor))]
    return found[0].unionByName(found[1])


@query("anchor_mean", s_bol(f" SELECT invoice_id, y FROM ({s_mean('lows')})"))
def _(spark, d):
    return O.anchor_mean(O.anchor_lines(_page_lines(spark, d), FORM.lower_anchor))


@query("header_fallback", s_bol(f" SELECT invoice_id, y + {FORM.header_pad} AS y, score, n FROM ({s_mean('heads', 'y_bot')})"))
def _(spark, d):
    return O.header_fallback(_page_lines(spark, d), FORM)


@query("header_words", s_bol(" SELECT * FROM wa UNION ALL SELECT * FROM wb"))
def _(spark, d):
    first, second = (O.header_words(_header(spark, d), t) for t in FORM.divider_words)
    return first.unionByName(second)


@query("divider", s_bol(" SELECT * FROM dv"))
def _(spark, d):
    return O.divider(*[O.header_words(_header(spark, d), t) for t in FORM.divider_words])


@query("midline", s_bol(" SELECT invoice_id, mid_y FROM mids WHERE mid_y IS NOT NULL"))
def _(spark, d):
    return _bounds(spark, d).filter("mid_y is not null").select("invoice_id", "mid_y")


BOUNDS = ["invoice_id", "upper_y", "lower_y", "mid_y", "divider_x", "roi_x1", "roi_x2", "roi_y1", "roi_y2", "failure"]


@query("bol_bounds", s_bol(f" SELECT {', '.join(BOUNDS)} FROM bnd WHERE failure IS NULL UNION ALL SELECT invoice_id, upper_y, lower_y, NULL, divider_x, NULL, NULL, NULL, NULL, failure FROM bnd WHERE failure IS NOT NULL"))
def _(spark, d):
    found = _bounds(spark, d)
    region = ["mid_y", "roi_x1", "roi_x2", "roi_y1", "roi_y2"]
    return found.select(*[F.when(F.col("failure").isNull(), F.col(c)).alias(c) if c in region else F.col(c) for c in BOUNDS])


@query("bol_region", s_bol(" SELECT w.invoice_id, w.text, w.y_top + b.roi_y1 AS y_top, w.y_bot + b.roi_y1 AS y_bot, w.x_left, w.x_right FROM wl w JOIN bnd b ON b.invoice_id = w.invoice_id WHERE w.pass = 'roi' AND b.failure IS NULL"))
def _(spark, d):
    at = _bounds(spark, d).filter("failure is null").select("invoice_id", "roi_x1", "roi_y1")
    lines = O.word_lines(view(spark, d, "bol_words").filter("pass = 'roi'")).join(at, "invoice_id")
    return O.rebase(lines, F.col("roi_x1"), F.col("roi_y1")).select("invoice_id", "text", "y_top", "y_bot", "x_left", "x_right")


@query("bol_extract")
def _(spark, d):
    return O.bol_from_words(view(spark, d, "bol_pages"), view(spark, d, "bol_words"), FORM).select("invoice_id", "name", "address.street", "address.postcode", "success", "failure_reason", "csz_line")



def s_islands(t: str) -> str:
    return f"SELECT *, CAST(sum(fresh) OVER (PARTITION BY invoice_id ORDER BY y_top, line_idx) AS INTEGER) AS island FROM (SELECT *, CASE WHEN y_top > lag(y_bot) OVER (PARTITION BY invoice_id ORDER BY y_top, line_idx) THEN 1 ELSE 0 END AS fresh FROM {t})"


@query("csz_lines", with_views("ocr_lines", csz=CSZL) + " SELECT invoice_id, line_idx, csz_city, csz_state, csz_zip FROM csz")
def _(spark, d):
    return O.csz_lines(view(spark, d, "ocr_lines")).select("invoice_id", "line_idx", "csz_city", "csz_state", "csz_zip")


@query("y_islands", with_views("ocr_lines", isl=s_islands("ocr_lines")) + " SELECT invoice_id, line_idx, island FROM isl")
def _(spark, d):
    return O.y_islands(view(spark, d, "ocr_lines")).select("invoice_id", "line_idx", "island")


@query("csz_pick", with_views("ocr_lines", csz=CSZL, isl=s_islands("csz")) + " SELECT invoice_id, line_idx, csz_zip FROM (SELECT *, row_number() OVER (PARTITION BY invoice_id ORDER BY y_bot - y_top, y_top, line_idx) AS r FROM isl WHERE island = 0) WHERE r = 1")
def _(spark, d):
    return O.csz_pick(view(spark, d, "ocr_lines")).select("invoice_id", "line_idx", "csz_zip")


STREET = r"regexp_matches(u, '^\s*\d+') OR regexp_matches(u, '(?i)^\s*p\.?\s*o\.?\s*box\b')"
USPS = r"trim(regexp_replace(regexp_replace(text, '[^A-Za-z0-9 \-/#]', ' ', 'g'), '\s+', ' ', 'g'))"
SPLIT = f"""SELECT *, max(CASE WHEN NOT is_csz AND u <> '' AND ({STREET}) THEN i END) OVER (PARTITION BY invoice_id) AS spot FROM (SELECT *, line_idx % 100 = 7 AS is_csz, {USPS} AS u, row_number() OVER (PARTITION BY invoice_id ORDER BY y_top, line_idx) AS i FROM ocr_lines)"""


@query("street_split", with_views("ocr_lines", spl=SPLIT) + " SELECT invoice_id, line_idx, CASE WHEN is_csz THEN 'csz' WHEN spot IS NULL OR i < spot THEN 'name' WHEN i = spot THEN 'street' ELSE 'line_2' END AS part FROM spl")
def _(spark, d):
    return O.split_block(view(spark, d, "ocr_lines").withColumn("is_csz", F.col("line_idx") % 100 == 7)).select("invoice_id", "line_idx", "part")


LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents"


def _lines(spark, d):
    return view(spark, d, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))


@query("address_content", rf"SELECT doc_id, length(regexp_replace(line, '[^\p{{L}}\p{{N}}]', '', 'g')) >= 3 AND (regexp_matches(line, '\p{{Nd}}') OR regexp_matches(line, '(?i)\battn') OR regexp_matches(line, '(?i)\bp\.?\s*o\.?\s*box\b') OR regexp_matches(line, '(^|[^A-Za-z])[A-Z][A-Za-z]{{4,}}')) AS ok, count(*) AS n FROM ({LINES}) GROUP BY ALL")
def _(spark, d):
    return _lines(spark, d).select("doc_id", X.is_address_content(F.col("line")).alias("ok")).groupBy("doc_id", "ok").agg(F.count("*").alias("n"))


NEGATIVE = " AND ".join(f"NOT regexp_matches(s, '{p}')" for p in (X.STREET_LINE, X.PHONE_LOOSE, X.CITY_STATE_ZIP_LOOSE, X.ATTN_LINE, X.SHIP_TO_LABEL, X.SHIP_FROM_LABEL, X.SHIPPER_BLOCK, X.NOT_A_NAME, X.own_line(OWN_NAME)))
TOK = r"list_filter(regexp_split_to_array(s, '\s+'), lambda x: x <> '')"


@query("looks_like_company", rf"SELECT conv_id, turn, pos, s <> '' AND length(regexp_replace(s, '[^A-Za-z]', '', 'g')) >= 3 AND len({TOK}) <= 6 AND len(list_filter({TOK}, lambda t: length(t) <= 2)) <= 1 AND {NEGATIVE} AS ok FROM (SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, {s_strip('part')} AS s FROM (SELECT conv_id, turn, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS pos FROM (SELECT conv_id, turn, string_split_regex(text, '[.!?,\n]+') AS parts FROM conversations)))")
def _(spark, d):
    parts = view(spark, d, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", "[.!?,\\n]+")).alias("pos", "part"))
    return parts.select("conv_id", "turn", "pos", X.looks_like_company(F.col("part"), OWN_NAME).alias("ok"))


@query("clean_lines")
def _(spark, d):
    return view(spark, d, "documents").select("doc_id", F.explode(X.clean_lines(F.col("text"))).alias("line"))


@query("best_variant")
def _(spark, d):
    rows = view(spark, d, "ocr_lines").select("invoice_id", F.col("line_idx").alias("variant_idx"), "text")
    return O.best_variant(rows)


@query("ocr_dedupe")
def _(spark, d):
    return O.dedupe_passes(view(spark, d, "ocr_lines"))


def _block(spark, d):
    lines = settled(O.dedupe_passes(view(spark, d, "ocr_lines")))
    csz = O.csz_pick(lines)
    return O.walk_up(lines, csz, lines.groupBy("invoice_id").agg(F.min("y_top").alias("mid_y"))), csz


@query("walk_up")
def _(spark, d):
    return _block(spark, d)[0]


@query("bol_ship_to")
def _(spark, d):
    block, csz = _block(spark, d)
    return O.bol_ship_to(O.split_block(block), csz).select("invoice_id", "name", "address.street", "address.postcode", "success", "csz_line")


@query("top_anchor")
def _(spark, d):
    return O.top_anchor(view(spark, d, "ocr_lines").withColumn("text", F.when(F.col("line_idx") % 100 == 3, "SMP TO Carrier").otherwise(F.col("text"))), VENDORS["a"].carrier_tokens, VENDORS["a"].carrier_codes)


@query("bottom_anchor")
def _(spark, d):
    return O.bottom_anchor(view(spark, d, "ocr_lines").withColumn("text", F.when(F.col("line_idx") % 100 == 5, "Thirb Party Freight Chargs biel to").otherwise(F.col("text"))))


# --- simpler extraction paths -----------------------------------------------------------
BLOCKS = "SELECT invoice_id, string_agg(text, chr(10) ORDER BY line_idx) AS text FROM ocr_lines GROUP BY invoice_id"


def _block_texts(spark, d):
    order = F.array_sort(F.collect_list(F.struct("line_idx", "text")))
    return view(spark, d, "ocr_lines").groupBy("invoice_id").agg(F.array_join(F.transform(order, lambda x: x.text), "\n").alias("text"))


CITY_LINE = X.CSZ_STATE_LIST.replace("'", "''")


@query("parse_address", with_views("ocr_lines", blocks=BLOCKS) + f" SELECT invoice_id, CASE WHEN regexp_matches(text, '{CITY_LINE}') THEN upper(trim(regexp_extract(l, '{CITY_LINE}', 1))) END AS city, CASE WHEN regexp_matches(text, '{CITY_LINE}') THEN regexp_extract(l, '{CITY_LINE}', 3) END AS postcode FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{CITY_LINE}'))[1] AS l FROM blocks)")
def _(spark, d):
    return _block_texts(spark, d).select("invoice_id", L.parse_address(F.col("text")).alias("a")).select("invoice_id", "a.city", "a.postcode")


@query("parse_address_all_columns")
def _(spark, d):
    return _block_texts(spark, d).select("invoice_id", L.parse_address(F.col("text")).alias("a")).select("invoice_id", "a.*")


@query("customer_line")
def _(spark, d):
    return L.customer_lines(_block_texts(spark, d), OWN_NAME)


@query("block_box", with_views("ocr_lines") + " SELECT invoice_id, min(y_top) AS y_top, max(y_bot) AS y_bot, min(x_left) AS x_left, max(x_right) AS x_right FROM ocr_lines GROUP BY invoice_id")
def _(spark, d):
    return L.block_box(view(spark, d, "ocr_lines"))


@query("extraction_json")
def _(spark, d):
    return L.extraction_json(_extractions(spark, d))


@query("usable_extractions", base("extraction", **MATCH) + " SELECT source, keyed = 1 AS usable, count(*) AS n FROM ext GROUP BY ALL")
def _(spark, d):
    return _extractions(spark, d).withColumn("usable", F.col("address").isNotNull() & (F.col("address.street") != "")).groupBy("source", "usable").agg(F.count("*").alias("n"))


@query("run_report")
def _(spark, d):
    return _outcome(spark, d).groupBy("fail_step", "severity").agg(F.count("*").alias("n"))
