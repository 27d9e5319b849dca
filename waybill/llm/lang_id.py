"""Language ID by Bayesian evidence fusion.

For every language and for ``und`` (none of them), four pieces of evidence are
multiplied: the likelihood of the text's byte 4-grams (naive Bayes, tempered,
since overlapping grams repeat what they say), of the declared markup language,
of the language that the address suffix suggests, and a host prior. Host priors
are smoothed in levels: what a grouped aggregation counts on the host is
smoothed by its parent domain, that by all hosts, that by a uniform prior.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import cut, few, join_groups, python_ready, table, text_or_empty
from .html_extract import extract_main_text
from ._repeats import bytes_of, loads, mix, padded

UND = "und"
GRAM_BITS = 16
#: Rows of each label that the text model is fitted on, at most; a language needs LEAST_ROWS in the whole table.
SAMPLE = 4000
LEAST_ROWS = 5
SMOOTH, TEMPER = 0.5, 0.1
#: How often a declaration or a suffix tells the language, and what a level of the host prior weighs in documents.
DECLARED_TRUST, SUFFIX_TRUST, HOST_WEIGHT = 0.9, 0.8, 20.0
MAX_BROADCAST = 1_000_000
SLICE = 1 << 20
#: Country suffixes that suggest one language.
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "au": "en", "ie": "en", "nz": "en", "it": "it", "pt": "pt", "br": "pt", "nl": "nl", "pl": "pl", "ru": "ru", "jp": "ja", "cn": "zh"}


def grams(data: np.ndarray) -> np.ndarray:
    """The bucket of the 4 bytes from each position on, ASCII letters in lower case."""
    low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    return (mix(loads(padded([low]))[: len(data)] & np.uint64(0xFFFFFFFF)) >> np.uint64(64 - GRAM_BITS)).astype(np.int32)


def _counted(batches):
    """Gram counts by label, packed."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        data, off = bytes_of(pa.chunked_array([batch.column("text")]))
        h = grams(data)
        for k, lang in enumerate(batch.column("label").to_pylist()):
            c = counts.setdefault(lang, np.zeros(1 << GRAM_BITS, np.int64))
            c += np.bincount(h[off[k] : max(off[k], off[k + 1] - 3)], minlength=1 << GRAM_BITS)
    yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c.tobytes() for c in counts.values()], pa.binary())], names=["label", "counts"])


def fit(docs: DataFrame, label_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", sample: int = SAMPLE) -> tuple[list[str], np.ndarray]:
    """(languages, log probability of each gram bucket in each, ``und`` last: uniform).

    Every label with at least LEAST_ROWS rows in the whole table is a language,
    fitted on the at most ``sample`` of its rows whose keyed hash is smallest (and
    rows that repeat the last of them); their grams are counted on the executors,
    and at most 4 x languages vectors of fixed size come to the driver.
    """
    python_ready(docs.sparkSession)
    key = F.xxhash64(F.lit("lang-id"), F.col(id_col), F.xxhash64(text_col))
    rows = docs.select(F.lower(F.trim(F.col(label_col).cast("string"))).alias("label"), key.alias("key"), F.col(text_col).cast("string").alias("text")).filter("label <> '' and text is not null")
    rows = rows.filter(F.col("label") != UND)
    # Smallest keys of each label's parts first, so a frequent label isn't one task's.
    ranked = rows.select("label", "key")
    for over in (["label", F.pmod("key", F.lit(64))], ["label"]):
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*over).orderBy("key"))).filter(F.col("rank") <= sample).drop("rank")
    enough = rows.groupBy("label").count().filter(F.col("count") >= LEAST_ROWS).select("label")
    last = cut(ranked.groupBy("label").agg(F.max("key").alias("last")).join(enough, "label"))
    chosen = rows.join(F.broadcast(last), "label").filter(F.col("key") <= F.col("last"))
    counts: dict[str, np.ndarray] = {}
    for r in chosen.select("label", "text").repartition(4).mapInArrow(_counted, "label string, counts binary").collect():
        counts[r.label] = counts.get(r.label, 0) + np.frombuffer(r.counts, np.int64)
    names = sorted(counts)
    logs = [np.log((counts[x] + SMOOTH) / (counts[x].sum() + SMOOTH * (1 << GRAM_BITS))) for x in names]
    return names, np.array([*logs, np.full(1 << GRAM_BITS, -GRAM_BITS * np.log(2))]).T.astype(np.float32)


def _likelihoods(model):
    """Adds ``lik``: the tempered log likelihood of each language, relative to the last (``und``)."""

    def run(batches):
        logs: np.ndarray = model.value
        for batch in batches:
            data, off = bytes_of(pa.chunked_array([batch.column("text")]))
            sums = np.zeros((batch.num_rows, logs.shape[1]))
            for s in range(0, len(data), SLICE):
                e = min(s + SLICE, len(data))
                h = grams(data[s : min(e + 3, len(data))])[: e - s]
                edges = np.unique(np.clip(off, s, e))
                doc = np.repeat(np.searchsorted(off, edges[:-1], side="right") - 1, np.diff(edges))
                inside = np.arange(s, e) + 4 <= off[doc + 1]
                value = logs[h] * inside[:, None]
                at = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
                sums[doc[at]] += np.add.reduceat(value, at, axis=0, dtype=np.float64)
            sums = TEMPER * (sums - sums[:, -1:])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, sums.size + 1, sums.shape[1], dtype=np.int32)), pa.array(sums.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("hash"), batch.column("declared"), batch.column("host"), lists], names=["id", "hash", "declared", "host", "lik"])

    return run


def _each(n: int, f) -> Column:
    return F.array(*[f(k) for k in range(n)])


def _softmax(logs: Column, n: int) -> Column:
    """A normalised array, from logarithms."""
    top = F.array_max(logs)
    e = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def _told(value: Column, names: list[str], trust: float) -> Column:
    """Log likelihood of a declared language under each language; nothing is told by null or an unknown one."""
    n = len(names)
    wrong = float(np.log((1 - trust) / max(1, n - 1)))
    known = value.isNotNull() & value.isin(names[:-1])
    return _each(n, lambda k: F.when(known, F.when(value == names[k], F.lit(float(np.log(trust)))).otherwise(F.lit(wrong))).otherwise(F.lit(0.0)))


def _host(url: Column) -> Column:
    """Host of an address, or the value itself (a site name) without port or user."""
    bare = F.regexp_replace(F.lower(url), r"^[a-z][a-z0-9+.\-]*://", "")
    return F.nullif(F.regexp_replace(F.regexp_replace(bare, r"[/?#].*$", ""), r"^.*@|:\d*$", ""), F.lit(""))


def identify_languages(docs: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text", declared_col: str | None = "lang", address_col: str | None = "source", least: float = 0.5, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """id, text_hash, language, confidence, kept of every row.

    ``address_col`` holds an address or a host; ``declared_col`` a declared
    language, of which the part before ``-`` or ``_`` counts. A row is rejected
    if its language is ``und`` or the confidence is under ``least``. Null and
    empty texts and those of under 4 bytes, which have no 4-gram, are ``und`` with
    confidence 0, whatever declaration, address and host say. Null declarations, addresses
    and hosts tell nothing. Of languages equally probable the first by name is
    taken, ``und`` last. Repeated rows each get a result. An empty table gives an
    empty result. Other columns are not read. text_hash is the text's SHA-256.
    ``declared_col`` must not be the label that the model was fitted on.
    """
    languages, logs = model
    names = [*languages, UND]
    n = len(names)
    spark = docs.sparkSession
    python_ready(spark)
    text = text_or_empty(text_col)
    declared = F.lower(F.substring_index(F.substring_index(F.trim(F.col(declared_col).cast("string")), "-", 1), "_", 1)) if declared_col else F.lit(None).cast("string")
    host = _host(F.col(address_col).cast("string")) if address_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("hash"), declared.alias("declared"), host.alias("host"), text.alias("text"))
    kind = dict(rows.dtypes)["id"]
    scored = cut(rows.mapInArrow(_likelihoods(spark.sparkContext.broadcast(logs)), f"id {kind}, hash binary, declared string, host string, lik array<double>"))
    suffix = F.substring_index("host", ".", -1)
    suggests = F.create_map(*[F.lit(x) for kv in SUFFIXES.items() for x in kv])
    told = [_told(F.col("declared"), names, DECLARED_TRUST), _told(F.when(F.contains("host", F.lit(".")), suggests[suffix]), names, SUFFIX_TRUST)]
    add = lambda x, y: F.zip_with(x, y, lambda a, b: a + b)
    own = scored.withColumns({"log": reduce(add, told, F.col("lik")), "parent": F.substring_index("host", ".", -2)})
    own = own.withColumn("p", _softmax(F.col("log"), n))
    # Level by level: sums of probabilities, combined before the shuffle.
    hosts = cut(own.filter("host is not null").groupBy("host", "parent").agg(F.count("*").alias("_rows"), *[F.sum(F.col("p")[k]).alias(f"c{k}") for k in range(n)]))
    parents = hosts.groupBy("parent").agg(*[F.sum(f"c{k}").alias(f"d{k}") for k in range(n)])
    whole = parents.agg(*[F.sum(f"d{k}").alias(f"w{k}") for k in range(n)]).first()
    total = [float(x or 0.0) for x in whole]
    base = [(x + HOST_WEIGHT / n) / (sum(total) + HOST_WEIGHT) for x in total]
    share = lambda c, above: [(F.col(f"{c}{k}") + HOST_WEIGHT * above[k]) / (reduce(lambda a, b: a + b, [F.col(f"{c}{j}") for j in range(n)]) + HOST_WEIGHT) for k in range(n)]
    up = parents.select(F.col("parent").alias("_parent"), F.array(*share("d", [F.lit(x) for x in base])).alias("q"))
    up = cut(up.join(hosts.groupBy(F.col("parent").alias("_p")).agg(F.count("*").alias("_hosts")), F.col("_parent") == F.col("_p")).select(F.col("_parent").alias("parent"), "q", "_hosts"))
    prior = join_groups(hosts, up, "parent", "_hosts", F.col("host"), max_broadcast).select("host", "_rows", F.array(*share("c", [F.col("q")[k] for k in range(n)])).alias("prior"))
    # Rows of a frequent host, and those without one, stay where they are.
    fused = join_groups(own.drop("parent"), cut(prior), "host", "_rows", F.hex("hash"), max_broadcast)
    logp = F.transform(F.coalesce("prior", F.array(*[F.lit(x) for x in base])), lambda x: F.log(x))
    post = fused.select("id", "hash", "lik", _softmax(add(F.col("log"), logp), n).alias("post"))
    bare = F.forall("lik", lambda x: x == 0)  # no gram at all
    best = F.array_position("post", F.array_max("post")).cast("int")
    language = F.when(bare, F.lit(UND)).otherwise(F.element_at(F.array(*[F.lit(x) for x in names]), best))
    out = post.select(F.col("id").alias(id_col), F.col("hash").alias("text_hash"), language.alias("language"), F.when(bare, F.lit(0.0)).otherwise(F.array_max("post")).alias("confidence"))
    return out.withColumn("kept", (F.col("language") != UND) & (F.col("confidence") >= least))


def keep_identified(docs: DataFrame, decisions: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """``docs`` without the rows that were rejected. The rejected ids are broadcast only if they are at most ``max_broadcast``."""
    gone = cut(decisions.filter("not kept").select(F.col(id_col).alias("__wb_id"), F.col("text_hash").alias("__wb_hash")).distinct())
    gone = F.broadcast(gone) if few(gone, max_broadcast) else gone
    return docs.join(gone, F.col(id_col).eqNullSafe(F.col("__wb_id")) & (F.unhex(F.sha2(text_or_empty(text_col), 256)) == F.col("__wb_hash")), "left_anti")


def declared_markup(html: Column) -> Column:
    """The language that a page's markup declares: ``lang`` of its html element, else its content-language."""
    own = F.regexp_extract(html, r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?\s*([a-z]{2,3})\b""", 1)
    meta = F.regexp_extract(html, r"""(?is)<meta\b[^>]*?http-equiv\s*=\s*["']?content-language["']?[^>]*?\bcontent\s*=\s*["']?\s*([a-z]{2,3})\b""", 1)
    return F.coalesce(F.nullif(own, F.lit("")), F.nullif(meta, F.lit("")))


def identify_pages(pages: DataFrame, model: tuple[list[str], np.ndarray], **options) -> DataFrame:
    """page_id, text_hash, language, confidence, kept of every page, from its main text, declared language, address and host."""
    texts = extract_main_text(pages.select("page_id", "url", "html", declared_markup(F.col("html")).alias("declared")))
    return identify_languages(texts, model, "page_id", "text", "declared", "url", **options)


def op1_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return identify_pages(pages, fit(table(spark, sf_dir, "documents"))).drop("text_hash")


QUERIES = {"op1_lang_id": op1_lang_id}
ORACLES: dict[str, str] = {}
