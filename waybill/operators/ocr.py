"""The relational part of reading a bill of lading: OCR words to lines to a ship-to block.

Coordinates are pixels. Words carry (block_num, par_num, line_num, word_idx); a
line's order among equals is its line_idx, so that every choice is total.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.address import normalize_address, plain_address
from ..functions.fuzzy import lcs_length, partial_ratio, partial_ratio_udf, ratio, ratio_udf, token_set_ratio
from ..functions.text import CSZ, SHIP_FROM_VARIANT, SHIP_TO_VARIANT, clean_for_usps, clean_name, is_street, line_text, line_tokens, strip, text_score
from ..plans.shared import settled
from ..shipping import ship


@dataclass(frozen=True)
class Profile:
    """What a shipper's form looks like. ``lower_anchor``: the paying company's name."""

    # The standard short form.
    upper_anchor: str = "bill of lading number"
    lower_anchor: str = ""
    header: str | None = "bill of lading short form"
    header_threshold: int = 75
    header_pad: int = 30
    divider_words: tuple[str, str] | None = ("SHORT", "FORM")
    boundaries: tuple[str, ...] = ("ship to", "ship from", "carrier name", "trailer number", "serial number", "bill of lading number", "bar code")


@dataclass(frozen=True)
class Tuning:
    # Thresholds and pads.
    anchor_threshold: int = 85
    anchor_min_len: float = 0.9
    header_min_len: float = 0.7
    divider_threshold: int = 75
    roi_pad_top: int = 50
    roi_pad_bottom: int = 50
    roi_pad_right: int = 60
    same_row_text: int = 75
    min_text_share: float = 0.8
    max_lines_up: int = 4
    first_stride_pad: int = 8
    tolerance_min: int = 15
    lock_min: int = 30
    lock_max: int = 60
    boundary_score: int = 70
    boundary_min_len: float = 0.7


PROFILE, TUNING = Profile(), Tuning()
LINE = ["invoice_id", "line_idx", "text", "y_top", "y_bot", "x_left", "x_right"]
LINE_TYPES = "invoice_id string, line_idx long, text string, y_top int, y_bot int, x_left int, x_right int"


def word_lines(words: DataFrame) -> DataFrame:
    """Lines of each OCR pass: words of one (block, par, line) joined in order, with the box around them."""
    w = words.filter(strip(F.coalesce("text", F.lit(""))) != "")
    order = F.array_sort(F.collect_list(F.struct("word_idx", strip(F.col("text")).alias("text"))))
    out = w.groupBy("invoice_id", "pass", "psm", "block_num", "par_num", "line_num").agg(F.array_join(F.transform(order, lambda x: x.text), " ").alias("text"), F.min("top").alias("y_top"), F.max(F.col("top") + F.col("height")).alias("y_bot"), F.min("left").alias("x_left"), F.max(F.col("left") + F.col("width")).alias("x_right"))
    return out


def union_passes(lines: DataFrame, *psms: int) -> DataFrame:
    """All lines of several passes, duplicates kept, numbered by height on the page."""
    some = lines.filter(F.col("psm").isin(*psms))
    rank = F.array_position(F.array(*[F.lit(p) for p in psms]), F.col("psm"))
    order = Window.partitionBy("invoice_id", "pass").orderBy("y_top", rank, "block_num", "par_num", "line_num")
    return some.withColumn("line_idx", F.row_number().over(order).cast("long"))


def rebase(lines: DataFrame, x: Column, y: Column) -> DataFrame:
    """Lines of a region, in page coordinates."""
    return lines.withColumns({"y_top": F.col("y_top") + y, "y_bot": F.col("y_bot") + y, "x_left": F.col("x_left") + x, "x_right": F.col("x_right") + x})


def anchor_lines(lines: DataFrame, target: str, threshold: int = TUNING.anchor_threshold, min_len: float = TUNING.anchor_min_len) -> DataFrame:
    """Lines about as long as the target that contain it nearly; the length is tested before the score."""
    text = F.lower(line_text(F.col("text")))
    long = lines.withColumn("_t", text).filter(F.length("_t") >= int(len(target) * min_len))
    return long.withColumn("score", F.floor(partial_ratio_udf(F.lit(target), F.col("_t"))).cast("int")).filter(F.col("score") >= threshold).drop("_t")


def anchor_mean(anchors: DataFrame) -> DataFrame:
    return anchors.groupBy("invoice_id").agg(F.bround(F.avg("y_top"), 0).cast("int").alias("y"))


def header_fallback(lines: DataFrame, profile: Profile = PROFILE, tuning: Tuning = TUNING) -> DataFrame:
    """The page header's lower edge, a pad under it, where the upper anchor wasn't read."""
    found = anchor_lines(lines, profile.header, profile.header_threshold, tuning.header_min_len)
    return found.groupBy("invoice_id").agg((F.bround(F.avg("y_bot"), 0).cast("int") + profile.header_pad).alias("y"), F.bround(F.avg("score"), 0).cast("int").alias("score"), F.count("*").alias("n"))


def header_words(words: DataFrame, target: str, threshold: int = TUNING.divider_threshold) -> DataFrame:
    """The topmost word of the page header that reads like ``target``; of equals the best score."""
    w = words.withColumn("_t", strip(F.col("text"))).filter((F.col("_t") != "") & (F.length("_t") <= len(target) + 2))
    w = w.withColumn("score", ratio_udf(F.upper("_t"), F.lit(target.upper()))).filter(F.col("score") >= threshold)
    best = F.min_by(F.struct(F.col("_t").alias("text"), F.col("left").alias("x_left"), (F.col("left") + F.col("width")).alias("x_right"), F.col("top").alias("y_top"), "score"), F.struct("top", -F.col("score"), "word_idx"))
    return w.groupBy("invoice_id").agg(best.alias("w")).select("invoice_id", "w.*")


def divider(left: DataFrame, right: DataFrame) -> DataFrame:
    """Where columns part: between the two header words, or at the edge of the one that was read."""
    both = left.select("invoice_id", F.col("x_right").alias("a")).join(right.select("invoice_id", F.col("x_left").alias("b")), "invoice_id", "full")
    return both.select("invoice_id", F.coalesce(F.floor((F.col("a") + F.col("b")) / 2).cast("int"), F.col("b"), F.col("a")).alias("divider_x"))


def bounds(pages: DataFrame, lines: DataFrame, header_word_rows: DataFrame, profile: Profile = PROFILE, tuning: Tuning = TUNING) -> DataFrame:
    """Bounds of the ship-to region of each page (invoice_id, page_w, page_h): upper_y, lower_y, mid_y, roi_*, failure."""
    upper = anchor_mean(anchor_lines(lines, profile.upper_anchor, tuning.anchor_threshold)).withColumnRenamed("y", "_u")
    lower = anchor_mean(anchor_lines(lines, profile.lower_anchor, tuning.anchor_threshold)).withColumnRenamed("y", "lower_y")
    out = pages.join(upper, "invoice_id", "left").join(lower, "invoice_id", "left")
    if profile.header:
        out = out.join(header_fallback(lines, profile, tuning).select("invoice_id", F.col("y").alias("_h")), "invoice_id", "left")
    else:
        out = out.withColumn("_h", F.lit(None).cast("int"))
    if profile.divider_words:
        a, b = (header_words(header_word_rows, t, tuning.divider_threshold) for t in profile.divider_words)
        out = out.join(divider(a, b), "invoice_id", "left")
    else:
        out = out.withColumn("divider_x", F.lit(None).cast("int"))
    out = out.withColumn("upper_y", F.coalesce("_u", "_h")).drop("_u", "_h").withColumn("mid_y", F.floor((F.col("upper_y") + F.col("lower_y")) / 2).cast("int"))
    upper_t, lower_t = repr(profile.upper_anchor), repr(profile.lower_anchor)
    y = lambda c: F.col(c).cast("string")
    # The texts of failures.
    neither = F.lit(f"Could not locate the SHIP TO block on the BOL: neither the upper anchor ({upper_t}) nor the lower anchor ({lower_t}) could be matched in the page-2 OCR output.")
    no_upper = F.concat(F.lit(f"Could not locate the top of the SHIP TO block: the upper anchor ({upper_t}) was not matched in OCR. The lower anchor ({lower_t}) was found at y="), y("lower_y"), F.lit("."))
    no_lower = F.concat(F.lit(f"Could not locate the bottom of the SHIP TO block: the lower anchor ({lower_t}) was not matched in OCR. The upper anchor ({upper_t}) was found at y="), y("upper_y"), F.lit("."))
    failure = F.when(F.col("upper_y").isNull() & F.col("lower_y").isNull(), neither).when(F.col("upper_y").isNull(), no_upper).when(F.col("lower_y").isNull(), no_lower)
    right = F.coalesce("divider_x", F.floor(F.col("page_w") / 2)) + tuning.roi_pad_right
    return out.withColumns({"failure": failure, "roi_x1": F.lit(0), "roi_x2": F.least(F.col("page_w"), right).cast("int"), "roi_y1": F.greatest(F.lit(0), F.col("mid_y") - tuning.roi_pad_top), "roi_y2": F.least(F.col("page_h"), F.col("lower_y") + tuning.roi_pad_bottom)})


def y_islands(lines: DataFrame) -> DataFrame:
    """Numbers overlapping lines: a new island starts where a line begins under the line before it (not under the lowest so far)."""
    order = Window.partitionBy("invoice_id").orderBy("y_top", "line_idx")
    fresh = F.coalesce((F.col("y_top") > F.lag("y_bot").over(order)).cast("int"), F.lit(0))
    return lines.withColumn("_new", fresh).withColumn("island", F.sum("_new").over(order).cast("int")).drop("_new")


def csz_lines(lines: DataFrame) -> DataFrame:
    """Lines with a city, a state and a ZIP code."""
    text = line_text(F.col("text"))
    some = lines.filter(text.rlike(CSZ))
    return some.withColumns({"csz_city": strip(F.regexp_extract(text, CSZ, 1)), "csz_state": F.regexp_extract(text, CSZ, 2), "csz_zip": F.regexp_extract(text, CSZ, 3)})


def csz_pick(lines: DataFrame) -> DataFrame:
    """Of the topmost island of city lines, the tightest; the first on ties."""
    found = y_islands(csz_lines(lines)).filter("island = 0")
    order = Window.partitionBy("invoice_id").orderBy(F.col("y_bot") - F.col("y_top"), "y_top", "line_idx")
    return found.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r", "island")


def _by_page(lines: DataFrame) -> DataFrame:
    """Lines dealt by page over all shuffle partitions, each page's in a row, from the top down: what _pages() reads.

    Python code costs time, not bytes, so partitions aren't merged by size.
    """
    ship(lines.sparkSession)
    dealt = lines.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), "invoice_id")
    return dealt.sortWithinPartitions("invoice_id", F.asc_nulls_last("y_top"), "line_idx")


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[int], list[int]]]:
    """Tables of whole pages with each page's start and end. A page has no frame of its own, which would cost milliseconds."""
    held: list[pa.RecordBatch] = []

    def whole(last: bool):
        t = pa.Table.from_batches(held).combine_chunks()
        ids = t.column("invoice_id").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        start = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])).tolist()
        ends = [*start[1:], t.num_rows]
        return (t, start, ends) if last else (t, start[:-1], ends[:-1])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        t, start, ends = whole(False)
        if start:
            held = t.slice(ends[-1]).to_batches()
            yield t.slice(0, ends[-1]), start, ends
    if held:
        yield whole(True)


@lru_cache(maxsize=1 << 16)
def _same_row(a: str, b: str, least: float) -> bool:
    return token_set_ratio(a, b) >= least


def _clustered(tops: list, bots: list, texts: list[str], tuning: Tuning) -> list[int]:
    """The lines of one page (from the top down) that stay."""
    clusters: list[list[int]] = []
    texts = [" ".join(t.split()).lower() for t in texts]
    for i, (top, text) in enumerate(zip(tops, texts)):
        home = next((c for c in clusters if any(top <= bots[p] for p in c) and any(_same_row(text, texts[p], tuning.same_row_text) for p in c)), None)
        if home is None:
            clusters.append([i])
        else:
            home.append(i)
    out = []
    for c in clusters:
        longest = max(len(texts[i]) for i in c)
        out.append(min((i for i in c if len(texts[i]) >= longest * tuning.min_text_share), key=lambda i: bots[i] - tops[i]))
    return out


def _numbers(t: pa.Table, name: str) -> list:
    """Values of an integer column, nan for null."""
    return t.column(name).combine_chunks().to_numpy(zero_copy_only=False).tolist()


def dedupe_passes(lines: DataFrame, tuning: Tuning = TUNING) -> DataFrame:
    """One line of each physical row read by several passes.

    Order-dependent: a line joins the first cluster with an overlapping member
    and a similar one. Of nearly the longest members the tightest stays. One
    page's lines are one group.
    """

    def run(batches):
        for t, start, ends in _pages(batches):
            tops, bots, texts = _numbers(t, "y_top"), _numbers(t, "y_bot"), t.column("text").to_pylist()
            keep = [s + i for s, e in zip(start, ends) for i in _clustered(tops[s:e], bots[s:e], texts[s:e], tuning)]
            yield from t.take(pa.array(keep, pa.int64())).to_batches()

    return _by_page(lines.select(*LINE)).mapInArrow(run, LINE_TYPES)


@lru_cache(maxsize=1 << 16)
def content_line(text: str) -> bool:
    """is_address_content() for one string, inside grouped code."""
    import re

    if sum(c.isalnum() for c in text) < 3:
        return False
    if any(c.isdigit() for c in text) or re.search(r"(?i)\battn|\bp\.?\s*o\.?\s*box\b", text):
        return True
    return re.search(r"(?<![A-Za-z])[A-Z][A-Za-z]{4,}", text) is not None


def _nearly_in(phrase: str, text: str, least: float) -> bool:
    """partial_ratio() of at least ``least``; what the whole strings have in common bounds it and mostly tells."""
    n, both = min(len(phrase), len(text)), lcs_length(phrase, text)
    # A window holds a common subsequence of at most ``both``, and is at least as long as that.
    if n and 200.0 * both / (n + both) < least:
        return False
    return partial_ratio(phrase, text) >= least


@lru_cache(maxsize=1 << 16)
def boundary_of(text: str, profile: Profile = PROFILE, tuning: Tuning = TUNING) -> str | None:
    """The first boundary phrase that a line nearly contains."""
    low = text.lower().strip()
    return next((p for p in profile.boundaries if low and len(low) >= len(p) * tuning.boundary_min_len and _nearly_in(p, low, tuning.boundary_score)), None)


def _walked(csz: int, mid_y: int, idx: list[int], tops: list[int], bots: list[int], texts: list[str], profile: Profile, tuning: Tuning) -> tuple[list[int], str]:
    """Lines (of one page, from the top down) from the city line upwards, one stride at a time, and why that ended."""
    texts = [" ".join(t.split()) for t in texts]
    taken, stride, top = [csz], int(bots[csz] - tops[csz]) + tuning.first_stride_pad, int(tops[csz])
    reason = f"reached max_steps={tuning.max_lines_up}"
    for _ in range(tuning.max_lines_up):
        target = top - stride
        if target < mid_y:
            reason = f"target y={target} below mid_y={mid_y}"
            break
        reach = max(stride // 2, tuning.tolerance_min)
        near = [i for i, y in enumerate(tops) if y < top and abs(y - target) < reach]
        if not near:
            reason = f"no OCR line within +/-{reach}px of target y={target}"
            break
        groups: list[list[int]] = []
        for i in near:
            if groups and tops[i] <= bots[groups[-1][-1]]:
                groups[-1].append(i)
            else:
                groups.append([i])
        good = [g for g in groups if any(content_line(texts[i]) for i in g) and not any(boundary_of(texts[i], profile, tuning) for i in g)]
        group = min(good or groups, key=lambda g: abs(tops[g[0]] - target))
        best = min(group, key=lambda i: (not content_line(texts[i]), -len(texts[i]), bots[i] - tops[i]))
        text = texts[best]
        if b := boundary_of(text, profile, tuning):
            reason = f"boundary '{b}' @ {text[:50]!r}"
            break
        if not content_line(text):
            reason = f"non-content @ {text[:50]!r}"
            break
        taken.append(best)
        if tuning.lock_min < top - tops[best] < tuning.lock_max:
            stride = int(top - tops[best])
        top = int(tops[best])
    # Lines of one number go together.
    return [i for x in reversed(taken) for i in ([x] if idx.count(idx[x]) == 1 else [j for j, y in enumerate(idx) if y == idx[x]])], reason


def walk_up(lines: DataFrame, csz: DataFrame, mid: DataFrame, profile: Profile = PROFILE, tuning: Tuning = TUNING) -> DataFrame:
    """The address block of each invoice, from the top down to its city line, with the reason the walk stopped.

    Stateful: the stride locks to the gap just seen. One page's lines are one group.
    """
    rows = lines.select(*LINE).join(csz.select("invoice_id", F.col("line_idx").alias("_c")), "invoice_id").join(mid.select("invoice_id", "mid_y"), "invoice_id")
    rows = rows.withColumn("is_csz", F.col("line_idx") == F.col("_c")).drop("_c")

    def run(batches):
        for t, start, ends in _pages(batches):
            idx, tops, bots, mids, texts, here = (*(_numbers(t, c) for c in ("line_idx", "y_top", "y_bot", "mid_y")), t.column("text").to_pylist(), t.column("is_csz").to_pylist())
            keep, pos, why = [], [], []
            for s, e in zip(start, ends):
                at = here.index(True, s, e)
                taken, reason = _walked(at - s, mids[at], idx[s:e], tops[s:e], bots[s:e], texts[s:e], profile, tuning)
                keep += [s + i for i in taken]
                pos += range(len(taken))
                why += [reason] * len(taken)
            out = t.select([*LINE, "is_csz"]).take(pa.array(keep, pa.int64()))
            yield from out.append_column("pos", pa.array(pos, pa.int32())).append_column("stop_reason", pa.array(why, pa.string())).combine_chunks().to_batches()

    return _by_page(rows).mapInArrow(run, LINE_TYPES + ", is_csz boolean, pos int, stop_reason string")


def split_block(block: DataFrame) -> DataFrame:
    """Each line's part in the block: name above the street, street (the lowest street-like line), line_2 under it, csz."""
    order = Window.partitionBy("invoice_id").orderBy("y_top", "line_idx")
    rows = block.withColumn("_i", F.row_number().over(order))
    at = F.max(F.when(~F.col("is_csz") & is_street(line_text(F.col("text"))), F.col("_i"))).over(Window.partitionBy("invoice_id"))
    part = F.when(F.col("is_csz"), "csz").when(F.col("_at").isNull() | (F.col("_i") < F.col("_at")), "name").when(F.col("_i") == F.col("_at"), "street").otherwise("line_2")
    return rows.withColumn("_at", at).withColumn("part", part).drop("_i", "_at")


def bol_ship_to(split: DataFrame, csz: DataFrame, usps: bool = True) -> DataFrame:
    """The bill-of-lading extraction of each block, in the same shape as page_ship_to()."""
    ordered = lambda part, f: F.transform(F.array_sort(F.collect_list(F.when(F.col("part") == part, F.struct("y_top", "line_idx", f(line_text(F.col("text"))).alias("t"))))), lambda x: x.t)
    rows = split.groupBy("invoice_id").agg(ordered("name", clean_name).alias("names"), ordered("street", clean_for_usps).alias("street"), ordered("line_2", clean_for_usps).alias("more"), F.transform(F.array_sort(F.collect_list(F.struct("y_top", "line_idx", line_text(F.col("text")).alias("t")))), lambda x: x.t).alias("raw_lines"))
    rows = rows.join(csz.select("invoice_id", "csz_city", "csz_state", "csz_zip"), "invoice_id")
    line_2 = F.array_join(F.filter("more", lambda x: x != ""), " ")
    args = (F.get("street", 0), F.col("csz_city"), F.col("csz_state"), F.col("csz_zip"), F.lit(False))
    rows = rows.withColumn("_a", normalize_address(*args, line_2) if usps else plain_address(*args, line_2)).withColumn("_names", F.filter("names", lambda x: x != ""))
    ok = F.size("street") > 0
    csz_text = F.format_string("%s, %s %s", "csz_city", "csz_state", "csz_zip")
    reason = F.when(~ok & (F.size("raw_lines") > 1), F.concat(F.lit("Found the city/state/ZIP line ("), csz_text, F.lit(") but no street address line could be identified above it"))).when(~ok, F.concat(F.lit("Found the city/state/ZIP line ("), csz_text, F.lit(") but no other lines were captured above it")))
    parts = F.struct(*[F.col(f"_a.{x}").alias(x) for x in ("street", "line_2", "city", "state", "postcode")])
    return rows.select("invoice_id", F.lit("bol").alias("source"), F.get("_names", 0).alias("name"), F.col("_names").alias("name_candidates"), F.when(ok, parts).alias("address"), ok.alias("success"), reason.alias("failure_reason"), "raw_lines", csz_text.alias("csz_line"))


def extract_bol(pages: DataFrame, page_lines: DataFrame, header_word_rows: DataFrame, roi_lines: DataFrame, profile: Profile = PROFILE, tuning: Tuning = TUNING, usps: bool = True, at: DataFrame | None = None) -> DataFrame:
    """Ship-to extractions of bills of lading, with a failure where a step found nothing. ``at``: the pages' bounds() where known."""
    at = settled(bounds(pages, page_lines, header_word_rows, profile, tuning)) if at is None else at
    good = at.filter("failure is null")
    lines = settled(dedupe_passes(roi_lines.join(good.select("invoice_id"), "invoice_id", "left_semi"), tuning))
    inside = lines.join(good.select("invoice_id", "roi_y1", "roi_y2"), "invoice_id").filter("y_top between roi_y1 and roi_y2").select(*LINE)
    csz = csz_pick(inside)
    out = bol_ship_to(split_block(walk_up(lines, csz, good, profile, tuning)), csz, usps)
    none = at.join(out.select("invoice_id"), "invoice_id", "left_anti")
    reason = F.coalesce("failure", F.concat(F.lit("Found the SHIP TO block but no city/state/ZIP line was identified inside it (searched y=["), F.col("roi_y1").cast("string"), F.lit(", "), F.col("roi_y2").cast("string"), F.lit("]). OCR may have garbled the line, or it may sit outside the expected vertical range.")))
    types = dict(out.dtypes)
    failed = none.select("invoice_id", F.lit("bol").alias("source"), *[F.lit(None).cast(types[c]).alias(c) for c in ("name", "name_candidates", "address")], F.lit(False).alias("success"), reason.alias("failure_reason"), *[F.lit(None).cast(types[c]).alias(c) for c in ("raw_lines", "csz_line")])
    return out.unionByName(failed)


def bol_from_words(pages: DataFrame, words: DataFrame, profile: Profile = PROFILE, tuning: Tuning = TUNING, usps: bool = True) -> DataFrame:
    """Ship-to extractions from the OCR words of bills of lading.

    pages: invoice_id, page_w, page_h, one row a page. words: invoice_id, pass
    (page, header or roi), psm, block_num, par_num, line_num, word_idx, left, top,
    width, height, text. Words of the region (roi) count from the region's own
    corner, which bounds() gives; the others from the page's.
    """
    lines = word_lines(words)
    full = union_passes(lines.filter("pass = 'page'"), 3, 6, 11)
    header = words.filter("pass = 'header'")
    at = settled(bounds(pages, full, header, profile, tuning))
    corner = at.filter("failure is null").select("invoice_id", "roi_x1", "roi_y1")
    region = rebase(union_passes(lines.filter("pass = 'roi'"), 3, 6, 11).join(corner, "invoice_id"), F.col("roi_x1"), F.col("roi_y1"))
    return extract_bol(pages, full, header, region.select(*LINE), profile, tuning, usps, at)


def best_variant(variants: DataFrame) -> DataFrame:
    """The OCR variant whose text looks most like an address; the earlier on ties."""
    best = F.max_by(F.struct("variant_idx", "text", "score"), F.struct("score", -F.col("variant_idx")))
    return variants.withColumn("score", text_score(F.col("text"))).groupBy("invoice_id").agg(best.alias("b")).select("invoice_id", "b.*")


def _near(tokens: Column, target: str, threshold: int) -> Column:
    """Whether some token reads like the target: its ratio is at least the threshold."""

    ship()

    @F.pandas_udf("boolean")
    def near(lists: pd.Series) -> pd.Series:
        known: dict[str, bool] = {}

        def like(t: str) -> bool:
            if t not in known:
                known[t] = ratio(target, t) >= threshold
            return known[t]

        return lists.map(lambda ts: any(like(t) for t in ts))

    return near(tokens)


def top_anchor(lines: DataFrame, carrier_tokens: tuple[str, ...] = (), carrier_codes: tuple[str, ...] = ()) -> DataFrame:
    """The ship-to label's line: tiers by how sure it is, at least 100 pixels under SHIP FROM; topmost, then best.

    The carrier's name and codes mark the two least sure tiers; without codes there are none.
    """
    text = line_text(F.col("text"))
    low, tokens = F.lower(text), line_tokens(text)
    rows = lines.withColumns({"_t": text, "_low": low, "_k": tokens})
    below = F.min(F.when(F.col("_t").rlike(SHIP_FROM_VARIANT), F.col("y_top"))).over(Window.partitionBy("invoice_id"))
    rows = rows.withColumn("_from", below).filter(F.col("y_top") >= F.coalesce(F.col("_from") + 100, F.lit(0)))
    rows = rows.filter(~(F.col("_low").contains("ship from") | F.col("_low").contains("smp from") | F.col("_low").contains("bill to")))
    has = lambda *t: F.arrays_overlap("_k", F.array(*[F.lit(x) for x in t]))
    score = F.when(F.col("_t").rlike(SHIP_TO_VARIANT), 100).when(_near(F.col("_k"), "carrier", 75) & _near(F.col("_k"), "name", 80), 85)
    if carrier_tokens:
        score = score.when(has(*carrier_tokens) & has("state", *carrier_codes), 70)
    if carrier_codes:
        score = score.when(has(*carrier_codes), 65)
    order = Window.partitionBy("invoice_id").orderBy("y_top", F.desc("score"), "line_idx")
    return rows.withColumn("score", score).filter("score is not null").withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_t", "_low", "_k", "_from", "_r")


def bottom_anchor(lines: DataFrame, targets: tuple[str, ...] = ("third", "party", "freight", "charges", "bill", "to"), least: int = 3) -> DataFrame:
    """The line with most of the target tokens, nearly enough; the first on ties."""
    tokens = line_tokens(line_text(F.col("text")))
    rows = lines.withColumn("_k", tokens)
    hits = sum((_near(F.col("_k"), t, 80).cast("int") for t in targets), F.lit(0))
    order = Window.partitionBy("invoice_id").orderBy(F.desc("hits"), "line_idx")
    out = rows.withColumn("hits", hits).filter(F.col("hits") >= least).withColumn("_r", F.row_number().over(order)).filter("_r = 1")
    return out.withColumn("score", F.floor(F.col("hits") * 100 / len(targets)).cast("int")).drop("_k", "_r")
