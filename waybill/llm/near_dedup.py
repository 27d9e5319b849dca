"""Near-duplicate classes by DartMinHash signatures and a banded join.

A text's shingles are elements with weights. Darts are thrown at the plane of
weight and time in unit cells, Poisson(1) of them in each cell of each element,
all from hashes of (element, cell); a dart counts for a text if its weight lies
below the element's weight there. Each dart belongs to one of ``k``
coordinates; the earliest dart of a coordinate is its signature entry, and two
texts share an entry with a probability equal to their weighted Jaccard
similarity (after Christiani, "DartMinHash: fast sketching for weighted sets",
2020). A text of total weight W needs cells up to about k ln k / W in time only.

1. Identical texts are one node. Every node gets its signature in the scan.
2. Bands of the signature make buckets. A bucket of two gives one candidate. In
   a larger one, entries that agree estimate similarities, and the maximum
   spanning forest of the estimates gives the first candidates. A bucket over
   ``CAP`` nodes is dealt into blocks; each block sends one node to a bucket of
   the blocks' heads, which is treated likewise, level by level.
3. Candidates are checked exactly, on all shingles.
4. Classes are the connected components of the links that pass.
5. Estimates err, and forests of blocks are not the bucket's forest, so in every
   bucket that holds several classes all pairs of different classes with estimates
   over the floor are checked as well. A bucket's largest class is compared with
   the other nodes once for all its buckets, if that takes fewer rows; its members
   are dealt into blocks of ``CAP``, which the others visit. No pair is written:
   a group first tells which of its nodes have such a pair, then gets their
   shingles and gives the links. A pair is compared in the first band it shares,
   however many nodes the bucket has.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import cut, few, join_groups, partitions, python_ready, table, text_or_empty, without
from ._repeats import K2, K3, Plan, Words, binaries, bytes_of, mix, numbers

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 5
#: Nodes compared with each other in one task; larger buckets are dealt into blocks.
CAP = 256
#: Visitors of a block in one task, in units of CAP; more are dealt into parts.
VISITORS = 1
#: Estimates this far below the threshold (four standard errors) are no candidates.
SLACK = 0.13
MAX_BROADCAST = 2_000_000
#: Documents' words handled at once.
CHUNK = 1 << 17


@lru_cache(maxsize=1)
def _poisson() -> np.ndarray:
    """Cumulative probabilities of 0, 1, ... darts in a unit cell."""
    p = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
    return p[p < 1 - 1e-16]


def unit(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle hash, count) of the distinct shingles of each text, in order.

    Texts of fewer words have one shingle, of all their words; texts without words have none.
    """
    words = Words(data, offsets, Plan("words", width, width))
    first = words.first
    n = np.diff(first)
    total = int(first[-1])
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), count)
    start = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    hashes = np.append(words.hashes[:total], np.zeros(width, np.uint64))
    x = np.zeros(len(doc), dtype=np.uint64)
    end = first[doc + 1]
    for k in range(width):
        x = np.where(start + k < end, mix((x + hashes[start + k]) * K3 + K2), x)
    order = np.lexsort((x, doc))
    x, doc = x[order], doc[order]
    new = np.append(True, (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])) if len(x) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return doc[at], x[at], np.diff(np.append(at, len(x)))


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """For each document and coordinate its earliest dart (a hash of it), 0 for documents without elements.

    Entries of ``doc`` ascend. Weights may be any positive numbers.
    """
    out = np.zeros((n_docs, k), dtype=np.uint64)
    mass = np.bincount(doc, weights=weight, minlength=n_docs)
    todo = np.flatnonzero(mass > 0)
    enough = k * (math.log(k) + 3)
    limit = np.zeros(n_docs)
    limit[todo] = enough / mass[todo]
    begin = np.searchsorted(doc, np.arange(n_docs + 1))
    while len(todo):
        # Unit cells of each element: ceil(weight) of weight by ceil(limit) of time.
        size = begin[todo + 1] - begin[todo]
        e = np.repeat(begin[todo], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        high = np.ceil(weight[e]).astype(np.int64)
        wide = np.ceil(limit[doc[e]]).astype(np.int64)
        cells = high * wide
        of = np.repeat(np.arange(len(e)), cells)
        c = np.arange(len(of)) - np.repeat(np.cumsum(cells) - cells, cells)
        w, t = c // wide[of], c % wide[of]
        e = e[of]
        key = mix(mix(element[e] + w.astype(np.uint64) * K2) + (t.astype(np.uint64) + np.uint64(1)) * K3)
        n = np.searchsorted(_poisson(), unit(key), side="right")
        dart = np.repeat(np.arange(len(e)), n)
        j = np.arange(len(dart)) - np.repeat(np.cumsum(n) - n, n)
        name = mix(key[dart] + (j.astype(np.uint64) + np.uint64(1)) * K2)
        when = t[dart] + unit(mix(name + K2))
        d = doc[e[dart]]
        hit = when <= limit[d]
        if (weight != np.floor(weight)).any():
            hit &= w[dart] + unit(mix(name + K3)) < weight[e[dart]]
        d, name, when = d[hit], name[hit], when[hit]
        place = d * k + (mix(name * K3 + K2) % np.uint64(k)).astype(np.int64)
        order = np.lexsort((when, place))
        place, name = place[order], name[order]
        first = np.append(True, place[1:] != place[:-1]) if len(place) else np.zeros(0, bool)
        out.reshape(-1)[place[first]] = name[first]
        filled = np.bincount(place[first] // k, minlength=n_docs)
        todo = todo[filled[todo] < k]
        limit[todo] *= 2
        out[todo] = 0
    return out


def _fresh(batches, most: int = 200_000):
    """The batches without rows whose text was seen before in the task (at least among the last ``most`` texts)."""
    seen: set[bytes] = set()
    for batch in batches:
        new = []
        for k, sha in enumerate(batch.column("sha").to_pylist()):
            if sha not in seen:
                seen.add(sha)
                new.append(k)
        if len(seen) > most:
            seen.clear()
        yield batch if len(new) == batch.num_rows else batch.take(pa.array(new, pa.int64()))


def _signed(width: int, bands: int, rows: int, weighted: bool):
    """For each text its band keys, and a byte of each entry for estimates."""
    k = bands * rows

    def run(batches):
        for batch in _fresh(batches):
            at = 0
            size = pa.compute.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(size)
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 6 * CHUNK)))
                part = batch.slice(at, stop - at)
                at = stop
                data, off = bytes_of(pa.chunked_array([part.column("text")]))
                doc, element, count = shingles(data, off, width)
                sig = signatures(doc, element, count.astype(np.float64) if weighted else np.ones(len(count)), part.num_rows, k)
                some = np.flatnonzero(sig.any(axis=1))
                if not len(some):
                    continue
                sig = sig[some]
                keys = np.zeros((len(sig), bands), dtype=np.uint64)
                for r in range(rows):
                    keys = mix(keys * K3 + sig[:, r::rows])
                keys = mix(keys + np.arange(1, bands + 1, dtype=np.uint64) * K2).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays([part.column("sha").take(pa.array(some)), lists, binaries(list((sig & np.uint64(255)).astype(np.uint8)))], names=["sha", "bands", "sig"])

    return run


def forest(members: np.ndarray, sig: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Edges of the maximum spanning forest of estimated similarities of at least ``least``.

    Prim's algorithm, one row of estimates at a time. Ties go to smaller nodes, so
    buckets agree on edges.
    """
    n, k = sig.shape
    order = np.argsort(members)
    members, sig = members[order], sig[order]
    best, parent, out = np.full(n, -1.0), np.full(n, -1), []
    open_ = np.ones(n, dtype=bool)
    for _ in range(n):
        v = int(np.argmax(np.where(open_, best, -2.0)))
        if parent[v] >= 0:
            out.append((int(members[parent[v]]), int(members[v])))
        open_[v] = False
        estimate = (sig == sig[v]).sum(axis=1) / k
        better = open_ & (estimate >= least) & (estimate > best)
        best[better], parent[better] = estimate[better], v
    return out


def rivals(root: np.ndarray, sig: np.ndarray, keys: np.ndarray, own: np.ndarray, inner: bool, least: float):
    """For each own node with any: (node, others of a different root with estimates of at least ``least``, best first).

    Nodes that are not ``own`` are compared with own ones only; own ones with each
    other if ``inner``. keys: band keys of which no two nodes of a pair share one.
    """
    k = sig.shape[1]
    order = np.argsort(~own, kind="stable")  # own nodes first
    root, sig, keys, n_own = root[order], sig[order], keys[order], int(own.sum())
    for v in range(n_own):
        begin = v + 1 if inner else n_own
        w = np.flatnonzero(root[begin:] != root[v]) + begin
        if not len(w):
            continue
        estimate = (sig[w] == sig[v]).sum(axis=1) / k
        over = estimate >= least
        w, estimate = w[over], estimate[over]
        if keys.shape[1] and len(w):
            new = ~(keys[w] == keys[v]).any(axis=1)
            w, estimate = w[new], estimate[new]
        if len(w):
            yield order[v], order[w[np.argsort(-estimate, kind="stable")]]


def _groups(batches):
    """Rows come in order of (bucket, lo, hi): tables of whole such groups, with their keys, starts and ends."""
    held: list[pa.RecordBatch] = []

    def whole(t: pa.Table, last: bool):
        code = np.stack([numbers(t.column(c)).astype(np.int64) for c in ("bucket", "lo", "hi")], axis=1)
        start = np.flatnonzero(np.append(True, (code[1:] != code[:-1]).any(axis=1)))
        ends = np.append(start[1:], len(code))
        if not last:
            start, ends = start[:-1], ends[:-1]
        return (t, code, start, ends), t.slice(ends[-1] if len(ends) else 0)

    for batch in batches:
        held.append(batch)
        out, rest = whole(pa.Table.from_batches(held), False)
        held = rest.to_batches()
        yield out
    if held and (t := pa.Table.from_batches(held)).num_rows:
        yield whole(t, True)[0]


def _candidates(least: float):
    """The first candidates of each group."""

    def run(batches):
        seen: set[tuple[int, int]] = set()
        for t, _, start, ends in _groups(batches):
            nodes = numbers(t.column("node"))
            data, off = bytes_of(t.column("sig"))
            sig = data.reshape(len(nodes), -1)
            found = []
            for s, e in zip(start, ends):
                found += forest(nodes[s:e], sig[s:e], least)
            new = {(min(x), max(x)) for x in found} - seen
            if len(seen) > 100_000:
                seen.clear()
            seen.update(new)
            out = np.array(sorted(new), dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], names=["a", "b"])

    return run


def _matrices(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    data, _ = bytes_of(t.column("sig"))
    bands = t.column("bands").combine_chunks()
    return data.reshape(t.num_rows, -1), numbers(bands.flatten()).reshape(t.num_rows, -1)


def _rivals(least: float):
    """Nodes of each group that are in a pair to check."""

    def run(batches):
        for t, code, start, ends in _groups(batches):
            own, roots, skip = numbers(t.column("own")).astype(bool), numbers(t.column("root")), numbers(t.column("skip"))
            sig, bands = _matrices(t)
            hit = np.zeros(t.num_rows, bool)
            for s, e in zip(start, ends):
                for v, w in rivals(roots[s:e], sig[s:e], bands[s:e, : skip[s]], own[s:e], code[s, 2] == 0, least):
                    hit[s + v] = True
                    hit[s + w] = True
            for part in t.select(["bucket", "lo", "hi", "node", "root", "own", "skip"]).filter(pa.array(hit)).to_batches():
                yield part

    return run


def _joined(least: float, threshold: float, weighted: bool):
    """Links that connect classes of each group."""

    def run(batches):
        for t, code, start, ends in _groups(batches):
            own, roots, skip = numbers(t.column("own")).astype(bool), numbers(t.column("root")), numbers(t.column("skip"))
            sig, bands = _matrices(t)
            cells = t.column("cells")
            out = []
            for s, e in zip(start, ends):
                up = {r: r for r in roots[s:e].tolist()}
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in cells.slice(s, e - s)]
                for v, others in rivals(roots[s:e], sig[s:e], bands[s:e, : skip[s]], own[s:e], code[s, 2] == 0, least):
                    for w in others:
                        x, y = _top(up, int(roots[s + v])), _top(up, int(roots[s + w]))
                        if x != y and similarity(sets[v], sets[w], weighted) >= threshold:
                            up[x] = y
                            out.append((int(roots[s + v]), int(roots[s + w])))
            links = np.array(out, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    return run


def _top(up: dict[int, int], x: int) -> int:
    while up[x] != x:
        up[x] = up[up[x]]
        x = up[x]
    return x


def _sets(width: int, weighted: bool):
    def run(batches):
        for batch in _fresh(batches):
            for s in range(0, batch.num_rows, 128):
                part = batch.slice(s, 128)
                data, off = bytes_of(pa.chunked_array([part.column("text")]))
                doc, element, count = shingles(data, off, width)
                at = np.searchsorted(doc, np.arange(part.num_rows + 1))
                cells = [element[x:y] if not weighted else np.stack([element[x:y], count[x:y].astype(np.uint64)]).reshape(-1) for x, y in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays([part.column("sha"), part.column("node"), binaries(cells)], names=["sha", "node", "cells"])

    return run


def similarity(a: np.ndarray, b: np.ndarray, weighted: bool) -> float:
    if not weighted:
        if len(a) > len(b):
            a, b = b, a
        both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
        return both / (len(a) + len(b) - both)
    (x, v), (y, w) = a.reshape(2, -1), b.reshape(2, -1)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = np.minimum(v[i], w[j]).sum()
    return float(both) / float(v.sum() + w.sum() - both)


def _linked(threshold: float, weighted: bool):
    def run(batches):
        for batch in batches:
            rows = zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist())
            keep = [similarity(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), weighted) >= threshold for x, y in rows]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(keep, pa.bool_())], names=["a", "b", "linked"])

    return run


def components(edges: DataFrame, most_rounds: int = 64) -> DataFrame:
    """node, root: connected components by the alternating large-star and small-star steps.

    Every round is a few grouped minima and joins over the edges, which end as
    stars around each component's smallest node. Edges never leave the executors.
    """
    spark = edges.sparkSession
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = None
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("b > a").join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(low, F.col("a") == F.col("u"))
        edges = cut(small.select("a", F.col("m").alias("b")).unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b"))).filter("a <> b").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _blocks(n, cap: int):
    """How many blocks a bucket of n nodes has: a power of two, so that blocks of buckets of like size are alike."""
    return F.when(n <= cap, 1).otherwise(F.pow(F.lit(2.0), F.ceil(F.log2(n / cap)))).cast("int")


def near_roots(texts: DataFrame, width: int = SHINGLE, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, weighted: bool = False, max_broadcast: int = MAX_BROADCAST, cap: int = CAP, visitors: int = VISITORS) -> DataFrame:
    """sha, root: classes of the texts of ``texts`` (sha binary, text string) that have a link. Texts are told apart by sha."""
    spark = texts.sparkSession
    python_ready(spark)
    least = threshold - SLACK
    held = lambda df: F.broadcast(df) if few(df, max_broadcast) else df
    # Nodes are numbered, so unlike hashes they can't collide; the checkpoint keeps the numbers.
    signed = texts.mapInArrow(_signed(width, bands, rows, weighted), "sha binary, bands array<long>, sig binary").dropDuplicates(["sha"])
    signed = cut(signed.withColumns({"node": F.monotonically_increasing_id(), "h": F.xxhash64("sha")}))
    banded = signed.select("node", "h", F.posexplode("bands").alias("last", "bucket"))
    buckets = cut(banded.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi")).filter("n > 1"))
    pairs = buckets.filter("n = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    members = cut(banded.join(held(buckets.filter("n > 2").select("bucket", "n")), "bucket"))
    by_group = lambda df: df.join(signed.select("node", "sig"), "node").repartition(partitions(spark), "bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")

    # Levels of heads of blocks.
    largest, level, groups = buckets.agg(F.max("n")).first()[0] or 0, members.select("bucket", "n", "node", "h"), []
    several = largest > cap
    while True:
        level = level.withColumn("blocks", _blocks(F.col("n"), cap)).withColumn("block", F.pmod(F.xxhash64("h"), F.col("blocks").cast("long")).cast("int"))
        groups.append(level.select("node", "bucket", F.lit(len(groups)).alias("lo"), F.col("block").alias("hi")))
        if largest <= cap:
            break
        heads = level.filter("blocks > 1").groupBy("bucket", "blocks", "block").agg(F.min(F.struct("h", "node")).alias("x"))
        level = cut(heads.select("bucket", F.col("blocks").cast("long").alias("n"), "x.node", F.col("x.h").alias("h")))
        largest = 1 << math.ceil(math.log2(largest / cap))
    first = groups[0]
    for more in groups[1:]:
        first = first.unionByName(more)
    edges = cut(pairs.unionByName(by_group(first).mapInArrow(_candidates(least), "a long, b long")).distinct())

    # Shingles of all nodes that may be checked.
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node")))
    if several:
        nodes = nodes.unionByName(members.filter(F.col("n") > cap).select("node"))
    named = cut(nodes.distinct().join(signed.select("node", "sha"), "node").select("sha", "node"))
    if few(named, max_broadcast):
        sources = texts.join(F.broadcast(named), "sha").select("sha", "node", "text")
    else:
        sources = texts.groupBy("sha").agg(F.first("text").alias("text")).join(named, "sha").select("sha", "node", "text")
    sets = cut(sources.mapInArrow(_sets(width, weighted), "sha binary, node long, cells binary").dropDuplicates(["sha"]).select("node", "cells"))

    both = edges.join(sets.select(F.col("node").alias("a"), F.col("cells").alias("sa")), "a").join(sets.select(F.col("node").alias("b"), F.col("cells").alias("sb")), "b")
    checked = cut(both.select("a", "b", "sa", "sb").mapInArrow(_linked(threshold, weighted), "a long, b long, linked boolean"))

    def rooted(frame: DataFrame, roots: DataFrame, node: str, root: str) -> DataFrame:
        named = roots.select(F.col("node").alias(node), F.col("root").alias("_root"))
        return frame.join(named, node, "left").withColumn(root, F.coalesce("_root", node)).drop("_root")

    def measured(work: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
        """work with roots, and the buckets of several roots: n, the most frequent root, s nodes of others, blocks."""
        mine = rooted(work, held(roots), "node", "root")
        per = mine.groupBy("bucket", "root").agg(F.count("*").alias("c")).groupBy("bucket").agg(F.sum("c").alias("n"), F.max(F.struct("c", "root")).alias("t"), F.count("*").alias("roots")).filter("roots > 1")
        per = per.select("bucket", "n", (F.col("n") - F.col("t.c")).alias("s"), F.col("t.root").alias("top"), _blocks(F.col("n"), cap).alias("blocks"))
        return mine, cut(per)

    roots = cut(components(checked.filter("linked").select("a", "b")))
    rejected = checked.filter("not linked").select("a", "b")
    if not several and rooted(rooted(rejected, roots, "a", "ra"), roots, "b", "rb").filter("ra <> rb").isEmpty():
        return _by_sha(roots, signed)  # every forest lies within its classes
    mine, mixed = measured(members.select("bucket", "node", "last"), roots)
    if mixed.isEmpty():
        return _by_sha(roots, signed)

    # A pair shares no band before a bucket's own. However large a bucket is, all its pairs of different classes meet.
    mine = cut(mine.join(held(mixed), "bucket").select("bucket", "node", "root", "top", "n", "s", "blocks", F.col("last").cast("int").alias("skip")))
    strangers = mine.filter("root <> top")
    # The largest class of a bucket at once for all its buckets, where that takes fewer rows.
    seen = cut(strangers.select("top", "node", "root").distinct())
    sizes = roots.groupBy(F.col("root").alias("top")).agg(F.count("*").alias("size"))
    tops = mixed.groupBy("top").agg(F.sum(F.col("n") + F.col("s") * F.col("blocks")).alias("cost")).join(seen.groupBy("top").agg(F.count("*").alias("guests")), "top").join(sizes, "top", "left")
    tops = tops.select("top", "cost", "guests", F.coalesce("size", F.lit(1)).alias("size")).withColumn("blocks", _blocks(F.col("size"), cap))
    chosen = cut(tops.filter(F.col("size") + F.col("guests") * F.col("blocks") <= F.col("cost")))
    parts = lambda s: F.greatest(F.lit(1), F.ceil(F.col(s) / (cap * visitors))).cast("int").alias("parts")
    block = F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")

    def dealt(own: DataFrame, guests: DataFrame) -> DataFrame:
        """Groups (bucket, lo, hi): a block's own nodes and a part of its visitors."""
        own = own.select("bucket", "node", "root", "skip", F.lit(True).alias("own"), block.alias("lo"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("hi"))
        guests = guests.select("bucket", "node", "root", "skip", "home", "parts", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("lo")).filter("lo <> home")
        return own.unionByName(guests.select("bucket", "node", "root", "skip", F.lit(False).alias("own"), "lo", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts").cast("long")).cast("int").alias("hi")))

    named = chosen.select("top", "size", "guests", "blocks", parts("guests"), F.xxhash64(F.lit("class"), "top").alias("bucket"))
    named = cut(named)
    inside = join_groups(roots, named.withColumnRenamed("top", "root"), "root", "size", F.col("node").cast("string"), max_broadcast).filter("bucket is not null")
    single = named.join(sizes.select("top"), "top", "left_anti").select("bucket", F.col("top").alias("node"), F.col("top").alias("root"), "blocks", "parts")
    inside = inside.select("bucket", "node", "root", "blocks", "parts").unionByName(single).withColumn("skip", F.lit(0))
    outside = join_groups(seen, named, "top", "guests", F.col("node").cast("string"), max_broadcast).filter("bucket is not null").select("bucket", "node", "root", "blocks", "parts", F.lit(0).alias("skip"), F.lit(-1).alias("home"))
    classes = dealt(inside, outside)
    # Strangers to it among themselves, bucket by bucket.
    marked = held(named.select("top", F.lit(True).alias("done")))
    others = strangers.join(marked, "top").select("bucket", "node", "root", "skip", _blocks(F.col("s"), cap).alias("blocks"), parts("s")).withColumn("home", block)
    # Buckets whose largest class spreads too far: all of the bucket's nodes.
    whole = mine.join(marked, "top", "left_anti").select("bucket", "node", "root", "top", "skip", "blocks", parts("s")).withColumn("home", block)
    groups = cut(classes.unionByName(dealt(others, others.filter("blocks > 1"))).unionByName(dealt(whole, whole.filter("blocks > 1 and root <> top"))))

    fields = "bucket long, lo int, hi int, node long, root long, own boolean, skip int"
    full = signed.select("node", "sig", "bands")
    sorted_ = lambda df: df.repartition(partitions(spark), "bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
    found = cut(sorted_(groups.join(full, "node")).mapInArrow(_rivals(least), fields))
    new = cut(sorted_(found.join(full, "node").join(sets, "node")).mapInArrow(_joined(least, threshold, weighted), "a long, b long"))
    if not new.isEmpty():
        merged = components(new)
        ends = roots.select("node").unionByName(merged.select("node")).distinct()
        roots = cut(rooted(rooted(ends, roots, "node", "old").withColumnRenamed("node", "own").withColumnRenamed("old", "node"), merged, "node", "root").select(F.col("own").alias("node"), "root"))
    return _by_sha(roots, signed)


def _by_sha(roots: DataFrame, signed: DataFrame) -> DataFrame:
    return cut(roots.join(signed.select("node", "sha"), "node").select("sha", "root"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, **options) -> DataFrame:
    """Every row of ``docs``, with class_id, class_size and kept.

    Two texts are linked if the Jaccard similarity of their sets of shingles of
    five words (with ``weighted``: of the shingles with their counts) is at least
    0.8; classes are connected by links. Texts of fewer words are one shingle;
    texts without words (nulls too) are only alike if identical. A class is named
    by its smallest id, so ids should be unique. The row with a class's smallest id stays; of several with that id, one. A null id is larger
    than any other. Repeated rows are members of their own. An empty table gives
    an empty result; input columns named like a result column are replaced.
    ``carry``: the columns to return besides the id (all by default). Texts are
    told apart by their SHA-256.
    """
    docs = without(docs, "class_id", "class_size", "kept")
    carry = [c for c in (docs.columns if carry is None else carry) if c != id_col]
    text = text_or_empty(text_col)
    sha = F.unhex(F.sha2(text, 256))
    roots = near_roots(docs.select(sha.alias("sha"), text.alias("text")), **options)
    rows = docs.select(F.col(id_col).alias("_id"), sha.alias("_sha"), F.struct(F.lit(0).alias("__wb_none"), *[F.col(f"`{c}`") for c in carry]).alias("_row"))
    if text_col not in carry:
        rows = cut(rows)
    # One row a text; with the id in the key, a text of many copies is many keys at first.
    low = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_n").alias("n"))
    own = rows.groupBy("_sha", "_id").agg(F.count("*").alias("_n")).groupBy("_sha").agg(F.min(low).alias("_low"), F.sum("_n").alias("_n"))
    own = cut(own.join(roots.withColumnRenamed("sha", "_sha"), "_sha", "left"))
    linked = own.filter("root is not null")
    first = F.min(F.struct(F.col("_low.none").alias("none"), F.col("_low.id").alias("id"), F.col("_sha").alias("sha"))).alias("_first")
    classes = cut(linked.groupBy("root").agg(first, F.sum("_n").alias("class_size"), F.count("*").alias("_texts")))
    linked = join_groups(linked, classes, "root", "_texts", F.hex("_sha")).select("_sha", "_n", F.col("_low.n").alias("_same"), F.col("_first.id").alias("class_id"), "class_size", (F.col("_first.sha") == F.col("_sha")).alias("_best"))
    alone = own.filter("root is null").select("_sha", "_n", F.col("_low.n").alias("_same"), F.col("_low.id").alias("class_id"), F.col("_n").alias("class_size"), F.lit(True).alias("_best"))
    # Rows need their text's class only if it isn't theirs alone.
    texts = cut(alone.unionByName(linked).filter("class_size > 1"))
    out = join_groups(rows, texts, "_sha", "_n", F.coalesce(F.col("_id").cast("string"), F.lit("")))
    single = F.col("_best").isNull()
    kept = single | (F.col("_best") & F.col("_id").eqNullSafe(F.col("class_id")))
    out = out.select("_id", "_row", "_sha", F.when(single, F.col("_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", F.lit(1).cast("long")).alias("class_size"), kept.alias("kept"), F.coalesce(F.col("_same") > 1, F.lit(False)).alias("_again"))
    if not texts.filter("_best and _same > 1").isEmpty():
        # Rows to keep that are repeated with text and id are counted, not gathered, and one stays.
        again = F.col("kept") & F.col("_again")
        top = out.filter(again).groupBy("_sha", "class_id", "class_size").agg(F.first("_id").alias("_id"), F.first("_row").alias("_row"), F.count("*").alias("_n"))
        top = top.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).select("_id", "_row", "class_id", "class_size", (F.col("_i") == 1).alias("kept"))
        out = out.filter(~again).select("_id", "_row", "class_id", "class_size", "kept").unionByName(top)
    return out.select(F.col("_id").alias(id_col), *[F.col(f"_row.`{c}`").alias(c) for c in carry], "class_id", "class_size", "kept")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=[])


QUERIES = {"op8_near_dedup": op8_near_dedup}
ORACLES: dict[str, str] = {}
