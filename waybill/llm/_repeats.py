"""Windows that repeat across documents: the plan shared by substring and suffix-array dedup.

1. Texts are dealt once into chunks by a hash of the row. Exact copies of a
   text in a smaller document need no search and are only flagged.
2. Every window of ``window`` units (words or bytes) has a minimiser, the
   smallest hash of the ``gram`` consecutive units in it. Each chunk sends the
   distinct minimisers it holds, packed, to the minimisers' buckets; a bucket
   tells each chunk which of them other documents hold too.
3. Runs of consecutive windows with a minimiser held elsewhere travel as one
   packed string to the minimiser's partition, in which equal windows meet;
   those in a document larger than the smallest become spans to remove.
4. Spans return to the chunks, which cut them out.

The chunks' exchange of texts is one exchange in the plan, read by each step.
A packed string that several documents of a chunk share is sent for the
smallest only; the others' spans are known at once. Frequent minimisers (common
lines, say) are dealt by a second hash of the window as well, its grams half a
window to the right or left, so that different contexts part. A group that still
holds over ``PIECE`` bytes (a passage in very many documents) isn't searched as a
whole: its strings are cut into windows, those that repeat within a piece are
settled there, and the others are dealt by their own hash, where only equal
windows meet.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import partitions, python_ready, text_chunks, text_or_empty

U8 = np.dtype("<u8")
K1, K2, K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
POS_BITS = np.uint64(24)
POS_MASK = np.uint64((1 << 24) - 1)
#: Windows in one slice; positions in a slice fit POS_BITS.
SLICE = 1 << 16
#: A minimiser in at least so many documents is dealt by its context as well. Results don't depend on it.
HOT = 1000
#: Bytes of packed strings searched at once; a larger group is dealt window by window. Results don't depend on it.
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= K1
    x ^= x >> np.uint64(29)
    return x


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    base = 0x5851F42D4C957F2D
    n = 1 << bits
    of = lambda b: np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, b, dtype=np.uint64))])
    return of(base), of(pow(base, -1, 1 << 64)), mix(np.arange(1, 257, dtype=np.uint64) * K2)


class Prefix:
    """Polynomial prefix hashes modulo 2^64 of a byte buffer, one random value for each byte value."""

    def __init__(self, buf: np.ndarray):
        self.pow, self.inv, values = _powers(max(20, int(len(buf)).bit_length()))
        self.sums = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum(values[buf] * self.pow[: len(buf)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.inv[start]


def loads(buf: np.ndarray) -> np.ndarray:
    """Every 8 bytes from each position on, as one number; buf has 8 bytes to spare at its end."""
    return np.ndarray((len(buf) - 7,), dtype=U8, buffer=buf, strides=(1,))


def padded(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([*parts, np.zeros(16, dtype=np.uint8)])


def same_bytes(at: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the bytes from a and b on are equal; at: loads() of the buffer."""
    same, live, k = np.ones(len(a), dtype=bool), np.arange(len(a)), 0
    while len(live):
        d = at[a[live] + k] ^ at[b[live] + k]
        rest = length[live] - k
        short = rest < 8
        d[short] &= (np.uint64(1) << (rest[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        same[live[d != 0]] = False
        k += 8
        live = live[(d == 0) & (rest > 8)]
    return same


def slices(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - start
    offsets = np.zeros(len(start) + 1, dtype=np.int32)
    np.cumsum(size, out=offsets[1:])
    data = buf[np.repeat(start - offsets[:-1], size) + np.arange(offsets[-1])]
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def binaries(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.tobytes() for v in values], pa.binary())


def bytes_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The data and the offsets of a string or binary column without nulls."""
    arrays = [a for a in column.chunks if len(a)]
    if not arrays:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data, offsets, base = [], [np.zeros(1, np.int64)], 0
    for a in arrays:
        wide = pa.types.is_large_string(a.type) or pa.types.is_large_binary(a.type)
        off = np.frombuffer(a.buffers()[1], dtype=np.int64 if wide else np.int32)[a.offset : a.offset + len(a) + 1].astype(np.int64)
        data.append(np.frombuffer(a.buffers()[2], dtype=np.uint8)[off[0] : off[-1]] if a.buffers()[2] is not None else np.zeros(0, np.uint8))
        offsets.append(off[1:] - off[0] + base)
        base += off[-1] - off[0]
    return np.concatenate(data), np.concatenate(offsets)


def numbers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).to_numpy(zero_copy_only=False)


@dataclass(frozen=True)
class Plan:
    """What one operator compares. kind: 'words' or 'bytes'."""

    kind: str
    window: int = 50
    gram: int = 8

    def units(self, data: np.ndarray, offsets: np.ndarray) -> Units:
        return (Words if self.kind == "words" else Bytes)(data, offsets, self)


class Units:
    """The units of a chunk's texts, numbered through. first: each document's first unit, and the end."""

    first: np.ndarray
    buf: np.ndarray  # as the windows' bytes are taken from

    def __init__(self, data: np.ndarray, offsets: np.ndarray, plan: Plan):
        self.plan = plan

    def span(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes in buf of units from start up to, without, end."""
        raise NotImplementedError

    def gram_hashes(self, start: int, end: int) -> np.ndarray:
        raise NotImplementedError

    def gram_at(self, unit: np.ndarray) -> np.ndarray:
        """Hashes of the grams that begin at these units."""
        raise NotImplementedError

    def runs(self):
        """For each slice: runs of windows with one minimiser as (minimiser, its unit, first window, windows, document)."""
        n, width, gram = int(self.first[-1]), self.plan.window, self.plan.gram
        grams, total = width - gram + 1, int(self.first[-1]) - width + 1
        for s in range(0, max(0, total), SLICE):
            e = min(s + SLICE, total)
            h = self.gram_hashes(s, e + width - gram)
            key = mix(h)
            key &= ~POS_MASK
            key |= np.arange(len(h), dtype=np.uint64)
            step = 1
            while step * 2 <= grams:
                key = np.minimum(key[:-step], key[step:])
                step *= 2
            if step < grams:
                key = np.minimum(key[: len(key) - (grams - step)], key[grams - step :])
            # Runs end where the minimiser changes, where a document begins, and where windows begin to reach beyond their document.
            new = np.empty(e - s, dtype=bool)
            new[0] = True
            np.not_equal(key[1:], key[:-1], out=new[1:])
            lo, hi = np.searchsorted(self.first, [s, e], side="right")
            edges = self.first[max(0, lo - 1) : hi + 1]
            for edge in (edges, edges - width + 1):
                new[edge[(edge > s) & (edge < e)] - s] = True
            at = np.flatnonzero(new)
            size = np.diff(np.append(at, e - s))
            doc = np.searchsorted(self.first, s + at, side="right") - 1
            inside = s + at + width <= self.first[doc + 1]
            at, size, doc = at[inside], size[inside], doc[inside]
            yield key[at] >> POS_BITS, s + (key[at] & POS_MASK).astype(np.int64), s + at, size, doc


class Bytes(Units):
    def __init__(self, data, offsets, plan):
        super().__init__(data, offsets, plan)
        self.buf, self.first = padded([data]), offsets
        self.at = loads(self.buf)

    def span(self, start, end):
        return start, end

    def gram_hashes(self, start, end):
        a, g = self.at, self.plan.gram
        x = mix(a[start:end] * K2)
        x = mix(x + a[start + 8 : end + 8] * K3)
        return x + a[start + g - 8 : end + g - 8] * K2

    def gram_at(self, unit):
        a, g = self.at, self.plan.gram
        return mix(mix(a[unit] * K2) + a[unit + 8] * K3) + a[unit + g - 8] * K2


class Words(Units):
    """Words are runs of anything but ASCII white space; buf joins them by single spaces."""

    def __init__(self, data, offsets, plan):
        super().__init__(data, offsets, plan)
        space = np.append((data == 0x20) | ((data >= 0x09) & (data <= 0x0D)), True)
        before = np.empty(len(space), dtype=bool)
        before[0] = True
        before[1:] = space[:-1]
        edge = np.zeros(len(space), dtype=bool)  # a document's first byte starts a word, and ends the word before
        edge[offsets] = True
        start = np.flatnonzero(~space[:-1] & (before[:-1] | edge[:-1]))
        end = np.flatnonzero(~before & (space | edge))
        self.first = np.searchsorted(start, offsets)
        size = end - start
        self.at = np.zeros(len(start) + 1, dtype=np.int64)  # of words in buf
        np.cumsum(size + 1, out=self.at[1:])
        self.buf = np.full(self.at[-1] + 16, 0x20, dtype=np.uint8)
        pos = np.repeat(self.at[:-1] - np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else size, size) + np.arange(size.sum())
        inside = np.zeros(len(data) + 1, dtype=np.int8)
        np.add.at(inside, start, 1)
        np.add.at(inside, end, -1)
        self.buf[pos] = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
        hashes = np.zeros(len(start) + plan.gram, dtype=np.uint64)
        for s in range(0, len(start), SLICE):
            e = min(s + SLICE, len(start))
            lo = self.at[s]
            hashes[s:e] = mix(Prefix(self.buf[lo : self.at[e]]).of(self.at[s:e] - lo, self.at[s + 1 : e + 1] - 1 - lo))
        self.hashes = hashes

    def span(self, start, end):
        return self.at[start], self.at[end] - 1

    def gram_hashes(self, start, end):
        x = np.zeros(end - start, dtype=np.uint64)
        for k in range(self.plan.gram):
            x = (x + self.hashes[start + k : end + k]) * K3
        return x

    def gram_at(self, unit):
        x = np.zeros(len(unit), dtype=np.uint64)
        for k in range(self.plan.gram):
            x = (x + self.hashes[unit + k]) * K3
        return x


def _rows_of(rid: np.ndarray, ids: np.ndarray, target: np.ndarray, target_id: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, entry) for every row with the hash and id of an entry; hashes alone could collide."""
    order = np.argsort(rid, kind="stable")
    lo, hi = np.searchsorted(rid[order], target, "left"), np.searchsorted(rid[order], target, "right")
    of = np.repeat(np.arange(len(target)), hi - lo)
    row = order[lo[of] + np.arange(len(of)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)]
    same = ids[row] == target_id[of]
    return row[same], of[same]


def _take(left: pa.Table, right: pa.Table, plan: Plan, copies_too: bool = False):
    """A chunk's rows that are searched, as (units, rows' rid, rows' id)."""
    rid = numbers(left.column("rid"))
    if not copies_too:
        flags = right.filter(pa.compute.is_valid(right.column("rid"))) if right.num_rows else right
        row, _ = _rows_of(rid, numbers(left.column("id")), numbers(flags.column("rid")), numbers(flags.column("id")))
        keep = numbers(left.column("has_id")).astype(bool)
        keep[row] = False
        left = left.filter(pa.array(keep))
        rid = rid[keep]
    data, offsets = bytes_of(left.column("text"))
    return plan.units(data, offsets), rid, numbers(left.column("id")), left


ANCHORS = "chunk int, bucket int, h binary, f binary"
BACK = "chunk int, rid long, id long, h binary"
SEGMENTS = "key long, chunk int, rid long, id long, at int, anchor int, seg binary"
SPANS = "chunk int, rid long, id long, s int, e int"


def _anchors(plan: Plan, buckets: int):
    """Step 2: the distinct minimisers of a chunk; f: in how many of its documents, up to 255."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        chunk = left.column("chunk")[0].as_py() if left.num_rows else 0
        units, _, _, _ = _take(left, right, plan)
        found = [np.unique((h << np.uint64(24)) | doc.astype(np.uint64)) for h, _, _, _, doc in units.runs()]
        h = (np.unique(np.concatenate(found)) >> np.uint64(24)) if found else np.zeros(0, np.uint64)
        h, n = np.unique(h, return_counts=True)
        f = np.minimum(n, 255).astype(np.uint8)
        b = (h % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(b, kind="stable")
        b, h, f = b[order], h[order], f[order]
        own, at = np.unique(b, return_index=True)
        ends = np.append(at[1:], len(b))
        h = (h // np.uint64(buckets)).astype(np.uint32)
        return pa.table({"chunk": pa.array(np.full(len(own), chunk, np.int32)), "bucket": pa.array(own), "h": binaries([h[x:y] for x, y in zip(at, ends)]), "f": binaries([f[x:y] for x, y in zip(at, ends)])})

    return run


def _repeated(buckets: int, hot_from: int):
    """Step 2: for each chunk, its minimisers that several documents hold, with the lowest bit for frequent ones."""

    def run(t: pa.Table) -> pa.Table:
        bucket = t.column("bucket")[0].as_py()
        data, off = bytes_of(t.column("h"))
        h = data.view(np.uint32)
        f = bytes_of(t.column("f"))[0]
        chunk = np.repeat(numbers(t.column("chunk")), np.diff(off) // 4)
        order = np.argsort(h, kind="stable")
        h, f, chunk = h[order], f[order], chunk[order]
        at = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        n = np.diff(np.append(at, len(h)))
        docs = np.add.reduceat(f.astype(np.int64), at)
        more = np.repeat(docs > 1, n)
        hot = np.repeat(docs >= hot_from, n)
        h, hot, chunk = h[more].astype(np.uint64), hot[more].astype(np.uint64), chunk[more]
        full = ((h * np.uint64(buckets) + np.uint64(bucket)) << np.uint64(1)) | hot
        order = np.argsort(chunk, kind="stable")
        full, chunk = full[order], chunk[order]
        own, at = np.unique(chunk, return_index=True)
        return pa.table({"chunk": pa.array(own.astype(np.int32)), "rid": pa.nulls(len(own), pa.int64()), "id": pa.nulls(len(own), pa.int64()), "h": binaries([full[x:y] for x, y in zip(at, np.append(at[1:], len(full)))])})

    return run


def _once(t: pa.Table, plan: Plan) -> pa.Table:
    """Packed strings that repeat in the chunk, for the smallest document only; for others the span, without a string.

    Such a row has its span in ``at`` and ``anchor``, and a key that spreads.
    """
    code = numbers(t.column("seg").combine_chunks().dictionary_encode().indices)
    ids = numbers(t.column("id"))
    order = np.lexsort((ids, code))
    starts = np.flatnonzero(np.append(True, code[order][1:] != code[order][:-1])) if len(order) else np.zeros(0, np.int64)
    least = np.empty(len(code), dtype=np.int64)
    least[order] = np.repeat(ids[order][starts], np.diff(np.append(starts, len(order))))
    late = ids > least
    if not late.any():
        return t
    seg = t.column("seg").filter(pa.array(late))
    if plan.kind == "bytes":
        size = pa.compute.binary_length(seg).to_numpy().astype(np.int64)
    else:
        size = pa.compute.count_substring(seg, " ").to_numpy().astype(np.int64) + 1
    gone = t.filter(pa.array(late))
    at = numbers(gone.column("at"))
    known = pa.table({"key": gone.column("rid"), "chunk": gone.column("chunk"), "rid": gone.column("rid"), "id": gone.column("id"), "at": at, "anchor": (at + size).astype(np.int32), "seg": pa.nulls(gone.num_rows, pa.binary())})
    return pa.concat_tables([t.filter(pa.array(~late)), known])


def _segments(plan: Plan):
    """Step 3: runs of windows whose minimiser repeats, as packed strings."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        sets = right.filter(pa.compute.is_valid(right.column("h"))) if right.num_rows else right
        if left.num_rows and sets.num_rows:
            chunk = left.column("chunk")[0].as_py()
            units, rid, ids, _ = _take(left, right, plan)
            known = np.sort(bytes_of(sets.column("h"))[0].view(np.uint64))
            names, hot = known >> np.uint64(1), known & np.uint64(1)
            for h, unit, first, n, doc in units.runs():
                k = np.minimum(np.searchsorted(names, h), len(names) - 1)
                hit = names[k] == h
                h, unit, first, n, doc, alone = h[hit], unit[hit], first[hit], n[hit], doc[hit], hot[k[hit]].astype(bool)
                key, anchor = h.astype(np.int64), unit - first  # the minimiser's place, seen from the first window
                if alone.any():
                    # Two parts of each run: windows that hold the gram half a window to the right of the minimiser, and the rest, which hold the one to its left.
                    half = (plan.window - plan.gram) // 2
                    u, w, m, i = unit[alone], first[alone], n[alone], np.flatnonzero(alone)
                    cut = np.clip(u - (plan.window - plan.gram - half), w, w + m)
                    parts = [(i[z > 0], v[z > 0], z[z > 0], g[z > 0], k) for v, z, g, k in ((w, cut - w, u - half, K2), (cut, w + m - cut, u + half, K3))]
                    stay = ~alone
                    keys = [mix(h[i] * k + mix(units.gram_at(g))).view(np.int64) for i, _, _, g, k in parts]
                    own = np.concatenate([i for i, *_ in parts])
                    key, first, n = np.concatenate([key[stay], *keys]), np.concatenate([first[stay], *[v for _, v, _, _, _ in parts]]), np.concatenate([n[stay], *[z for _, _, z, _, _ in parts]])
                    doc, unit = np.concatenate([doc[stay], doc[own]]), np.concatenate([unit[stay], unit[own]])
                    anchor = unit - first
                s, e = units.span(first, first + n + plan.window - 1)
                out.append(pa.table({"key": key, "chunk": np.full(len(key), chunk, np.int32), "rid": rid[doc], "id": ids[doc], "at": (first - units.first[doc]).astype(np.int32), "anchor": anchor.astype(np.int32), "seg": slices(units.buf, s, e)}))
        return _once(pa.concat_tables(out), plan) if out else pa.table({"key": pa.array([], pa.int64()), "chunk": pa.array([], pa.int32()), "rid": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "at": pa.array([], pa.int32()), "anchor": pa.array([], pa.int32()), "seg": pa.array([], pa.binary())})

    return run


@dataclass
class Windows:
    """Windows of packed strings in key order: byte ranges in buf, and for each its row, place in the row and group (key)."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    place: np.ndarray
    key: np.ndarray
    offset: np.ndarray  # of the minimiser in the window, in units


def unpack(table: pa.Table, plan: Plan) -> Windows:
    data, off = bytes_of(table.column("seg"))
    key, anchor = numbers(table.column("key")), numbers(table.column("anchor")).astype(np.int64)
    width = plan.window
    if plan.kind == "bytes":
        n = np.diff(off) - width + 1
        row = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        start = off[row] + place
        end = start + width
    else:
        gap = np.append(data == 0x20, True)
        gap_at = np.flatnonzero(gap[:-1])
        starts = np.sort(np.concatenate([off[:-1], gap_at + 1]))
        ends = np.sort(np.concatenate([off[1:], gap_at]))
        first = np.searchsorted(starts, off)
        n = np.diff(first) - width + 1
        row = np.repeat(np.arange(len(n)), n)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        word = first[row] + place
        start, end = starts[word], ends[word + width - 1]
    return Windows(padded([data]), start, end, row, place, key[row], anchor[row] - place)


def _groups(batches, piece: int):
    """Rows come in order of key: (table of whole keys of at most ``piece`` bytes each, None), or (part of a larger key, key).

    Whether a key is large depends on its rows alone, not on how they come in batches.
    """
    held: list[pa.RecordBatch] = []
    size, large = 0, None

    def settled(table: pa.Table):
        keys = numbers(table.column("key"))
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        rows = np.diff(np.append(start, len(keys)))
        over = np.add.reduceat(pa.compute.binary_length(table.column("seg")).to_numpy().astype(np.int64), start) > piece
        small = np.repeat(~over, rows)
        if small.any():
            yield table if small.all() else table.filter(pa.array(small)), None
        for k in np.flatnonzero(over):
            yield table.slice(start[k], rows[k]), keys[start[k]]

    for batch in batches:
        for k in range(0, batch.num_rows, 2048):
            part = batch.slice(k, 2048)
            if large is not None:
                own = int(np.searchsorted(numbers(part.column("key")), large, "right"))
                if own:
                    yield pa.Table.from_batches([part.slice(0, own)]), large
                if own == part.num_rows:
                    continue
                part, large = part.slice(own), None
            held.append(part)
            size += part.column("seg").nbytes
            if size < piece:
                continue
            table = pa.Table.from_batches(held)
            keys = numbers(table.column("key"))
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield from settled(table.slice(0, cut))
            table = table.slice(cut)
            if pa.compute.sum(pa.compute.binary_length(table.column("seg"))).as_py() > piece:
                large = keys[-1]
                yield table, large
                held, size = [], 0
            else:
                held, size = table.to_batches(), table.column("seg").nbytes
    if held and (table := pa.Table.from_batches(held)).num_rows:
        yield from settled(table)


def _valid(batches):
    for batch in batches:
        yield batch.filter(pa.compute.is_valid(batch.column("seg")))


def _least(table: pa.Table, plan: Plan, classes) -> tuple[Windows, np.ndarray, np.ndarray]:
    """The windows of packed strings, their documents, and the smallest document of each one's content in the table."""
    w = unpack(table, plan)
    ids = numbers(table.column("id"))[w.row]
    number, order, starts = classes(w)
    least = np.minimum.reduceat(ids[order], starts) if len(order) else ids
    return w, ids, least[number]


def _runs(w: Windows, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first window, windows) of the runs of consecutive windows that go."""
    edge = np.ones(len(gone) + 1, dtype=bool)
    edge[1:-1] = (gone[1:] != gone[:-1]) | (w.row[1:] != w.row[:-1])
    at = np.flatnonzero(edge)
    size = np.diff(at)
    at = at[:-1]
    return at[gone[at]], size[gone[at]]


def _spans(plan: Plan, classes, windows: bool = False, piece: int = PIECE):
    """Step 3: rows come in order of key and id. classes(windows) numbers windows by content, verified by bytes.

    A key over ``piece`` bytes is left to _windows(), unless rows are single
    ``windows`` already: then a key's rows are equal, but for collisions of the
    hash, and come with the smallest id first, so one string of each content is kept.
    """

    def flush(table: pa.Table) -> pa.RecordBatch:
        w, ids, low = _least(table, plan, classes)
        at, size = _runs(w, ids > low)
        row = w.row[at]
        s = numbers(table.column("at"))[row] + w.place[at]
        return pa.record_batch({"chunk": numbers(table.column("chunk"))[row].astype(np.int32), "rid": numbers(table.column("rid"))[row], "id": numbers(table.column("id"))[row], "s": s.astype(np.int32), "e": (s + size + plan.window - 1).astype(np.int32)})

    def run(batches):
        def searched():
            for batch in batches:
                known.append(batch.filter(pa.compute.is_null(batch.column("seg"))))
                yield batch.filter(pa.compute.is_valid(batch.column("seg")))

        known: list[pa.RecordBatch] = []
        key, seen = None, {}
        for table, large in _groups(searched(), piece):
            if large is None:
                yield flush(table)
            elif windows:
                if large != key:
                    key, seen = large, {}
                ids = numbers(table.column("id"))
                low = np.array([seen.setdefault(x, i) for x, i in zip(table.column("seg").to_pylist(), ids.tolist())], dtype=np.int64)
                gone = table.filter(pa.array(ids > low))
                s = numbers(gone.column("at"))
                yield pa.record_batch({"chunk": numbers(gone.column("chunk")), "rid": numbers(gone.column("rid")), "id": numbers(gone.column("id")), "s": s, "e": (s + plan.window).astype(np.int32)})
            while known:
                yield _known(known.pop())
        while known:
            yield _known(known.pop())

    return run


def _known(rows: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([rows.column(c) for c in ("chunk", "rid", "id", "at", "anchor")], names=["chunk", "rid", "id", "s", "e"])


def _windows(plan: Plan, classes, piece: int = PIECE):
    """Step 3: the windows of keys over ``piece`` bytes, keyed by their own hash.

    Of windows that repeat within a piece only the smallest document's go on; the
    others' spans are known.
    """

    def run(batches):
        for table, large in _groups(_valid(batches), piece):
            if large is None:
                continue
            for part in [table.slice(k, 4096) for k in range(0, table.num_rows, 4096)]:
                w, ids, low = _least(part, plan, classes)
                chunk, rid, own, place = (numbers(part.column(c)) for c in ("chunk", "rid", "id", "at"))
                at, n = _runs(w, ids > low)
                row = w.row[at]
                s = (place[row] + w.place[at]).astype(np.int32)
                yield pa.record_batch({"key": rid[row], "chunk": chunk[row], "rid": rid[row], "id": own[row], "at": s, "anchor": (s + n + plan.window - 1).astype(np.int32), "seg": pa.nulls(len(row), pa.binary())})
                stay = np.flatnonzero(ids <= low)
                row = w.row[stay]
                key = mix(Prefix(w.buf).of(w.start[stay], w.end[stay]) + np.array([large]).view(np.uint64) * K2).view(np.int64)
                yield pa.record_batch({"key": key, "chunk": chunk[row], "rid": rid[row], "id": own[row], "at": (place[row] + w.place[stay]).astype(np.int32), "anchor": w.offset[stay].astype(np.int32), "seg": slices(w.buf, w.start[stay], w.end[stay])})

    return run


def _cut(plan: Plan):
    """Step 4: what is left of each document."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        units, rid, ids, left = _take(left, right, plan, copies_too=True)
        first, total = units.first, int(units.first[-1])
        delta = np.zeros(total + 1, dtype=np.int32)
        if right.num_rows and left.num_rows:
            s, e = numbers(right.column("s")).astype(np.int64), numbers(right.column("e")).astype(np.int64)
            row, of = _rows_of(rid, ids, numbers(right.column("rid")), numbers(right.column("id")))
            s, e = first[row] + s[of], np.minimum(first[row] + e[of], first[row + 1])
            whole = e - s >= plan.window  # a copy's span is the whole text; one shorter than a window stays
            np.add.at(delta, s[whole], 1)
            np.add.at(delta, e[whole], -1)
        gone = np.cumsum(delta[:-1], dtype=np.int32) > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        starts = first[:-1][np.diff(first) > 0]
        begins[starts] = gone[starts]
        count = lambda x: np.diff(np.concatenate([[0], np.cumsum(x, dtype=np.int32)])[first])
        if plan.kind == "bytes":
            keep = ~gone
            ends = np.concatenate([[0], np.cumsum(keep)])[first]
            kept = units.buf[:total][keep]
            text = slices(kept, ends[:-1], ends[1:])
        else:
            size = np.diff(units.at)
            keep = np.repeat(~gone, size)
            ends = np.concatenate([[0], np.cumsum(np.where(gone, 0, size))])[first]
            kept = units.buf[: units.at[-1]][keep]
            text = slices(kept, ends[:-1], np.maximum(ends[:-1], ends[1:] - 1))
        return pa.table({"id": left.column("id"), "has_id": left.column("has_id"), "n_units": np.diff(first), "n_removed": count(gone), "n_spans": count(begins), "kept": text})

    return run


def remove_repeats(docs: DataFrame, plan: Plan, classes, id_col: str, text_col: str, chunk_mb: int = 4, piece: int = PIECE) -> DataFrame:
    """id, n_units, n_removed, n_spans, kept (binary) of every row of docs."""
    spark = docs.sparkSession
    python_ready(spark)
    text = text_or_empty(text_col)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("id"), F.col(id_col).isNotNull().alias("has_id"), text.alias("text"), F.xxhash64(F.col(id_col), text).alias("rid"))
    chunks = text_chunks(rows, "text", chunk_mb)
    buckets = max(256, chunks // 16)
    place = F.pmod("rid", F.lit(chunks)).cast("int").alias("chunk")
    narrow = rows.filter("has_id").select("id", "rid", place, F.sha2("text", 256).alias("sha"))
    groups = narrow.groupBy("sha").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("high > low")
    copies = narrow.join(groups, "sha").filter("id > low").select("chunk", "rid", "id").distinct()

    dealt = rows.withColumn("chunk", place).repartition(partitions(spark), "chunk")
    by_chunk = lambda df: df.groupBy("chunk")
    # New names for the side's columns: it stems from the same rows, and Spark tells columns apart by origin.
    with_side = lambda side: by_chunk(dealt).cogroup(by_chunk(side.select([F.col(c).alias(c) for c in side.columns])))
    anchors = with_side(copies).applyInArrow(_anchors(plan, buckets), ANCHORS)
    back = anchors.groupBy("bucket").applyInArrow(_repeated(buckets, HOT), BACK)
    side = back.unionByName(copies.withColumn("h", F.lit(None).cast("binary")))
    segments = with_side(side).applyInArrow(_segments(plan), SEGMENTS)
    by_key = lambda df: df.repartition(partitions(spark), "key").sortWithinPartitions("key", "id")
    cut = by_key(segments).mapInArrow(_windows(plan, classes, piece), SEGMENTS)
    spans = by_key(segments).mapInArrow(_spans(plan, classes, piece=piece), SPANS).unionByName(by_key(cut).mapInArrow(_spans(plan, classes, True, piece), SPANS))
    whole = copies.select("chunk", "rid", "id", F.lit(0).alias("s"), F.lit(2**31 - 1).alias("e"))
    out = with_side(spans.unionByName(whole)).applyInArrow(_cut(plan), "id long, has_id boolean, n_units long, n_removed long, n_spans long, kept binary")
    return out.select(F.when(F.col("has_id"), F.col("id")).alias(id_col), "n_units", "n_removed", "n_spans", "kept")


def numbered(order: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of each window, order, where each number starts in order), from an order and where its contents change."""
    starts = np.flatnonzero(fresh)
    number = np.empty(len(order), dtype=np.int64)
    number[order] = np.cumsum(fresh) - 1
    return number, order, starts


def told_apart(w: Windows, order: np.ndarray, fresh: np.ndarray) -> np.ndarray:
    """fresh, with the bytes of all windows compared that hashes found equal; on a collision the run is sorted by its bytes."""
    at = loads(w.buf)
    begin = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    later = np.flatnonzero(~fresh)
    a, b = order[begin[later]], order[later]
    size = w.end - w.start
    same = (size[a] == size[b]) & same_bytes(at, w.start[a], w.start[b], np.minimum(size[a], size[b]))
    for run in np.unique(begin[later[~same]]):
        end = run + 1
        while end < len(order) and not fresh[end]:
            end += 1
        text = lambda i: w.buf[w.start[i] : w.end[i]].tobytes()
        own = sorted(order[run:end].tolist(), key=text)
        order[run:end] = own
        fresh[run + 1 : end] = [text(x) != text(y) for x, y in zip(own, own[1:])]
    return fresh
