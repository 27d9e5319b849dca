"""SentencePiece encoding with seeded merge-dropout, and decoding.

The encoder is byte-pair merging over a SentencePiece model's pieces: of all
neighbours whose joint piece exists, the best-scored, leftmost pair is merged,
until none is left. With dropout, a candidate (two spans of one document that
could merge) is skipped if a keyed hash of seed, document and span ends falls
under ``alpha``. The decision depends on nothing else, so a seed always gives
the same segmentation, on any partitioning, and another seed another one.
Without dropout the pieces are those of SentencePiece itself. Characters without a piece,
and the piece's own space sign where a text contains it, become byte pieces, so
that every text decodes to itself.

No merge crosses a word's beginning, so words are independent; all words of a
batch merge together, one merge each a step. Long stretches without white
space go through a heap instead.
"""

from __future__ import annotations

import heapq
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import python_ready, table, text_or_empty
from ._repeats import K1, K2, K3, mix

SPACE = "▁"
#: Rank of a pair that can't merge.
NEVER = np.int64(1 << 30)
#: Longest word in characters that is merged step by step; longer ones go through a heap.
LONG_WORD = 48
CHARS = 1 << 18
TOKENIZERS = "/opt/tokenizers"


class Model:
    """Tables of a BPE model: piece of each character, merged piece and rank of each pair, bytes of each piece."""

    def __init__(self, proto: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.size = sp.vocab_size()
        pieces = [sp.id_to_piece(i) for i in range(self.size)]
        plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)) for i in range(self.size)]
        self.ids = {p: i for i, p in enumerate(pieces) if plain[i]}
        self.bytes_from = next(i for i in range(self.size) if sp.is_byte(i))
        by_score = sorted((i for i in range(self.size) if plain[i]), key=lambda i: (-sp.get_score(i), i))
        rank = {i: k for k, i in enumerate(by_score)}
        self.char = np.full(0x110000, -1, dtype=np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.char[ord(" ")] = self.char[ord(SPACE)]
        self.char[ord(SPACE)] = -1
        pairs = [(self.ids[p[:k]], self.ids[p[k:]], i) for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids]
        self.pairs = {(a, b): (rank[i], i) for a, b, i in pairs}
        self.bits = max(10, (len(pairs) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.value = np.full((1 << self.bits, 2), (int(NEVER), -1), dtype=np.int64)
        for (a, b), v in self.pairs.items():
            s = int(self._slot(np.array([a << 32 | b], dtype=np.int64))[0])
            while self.keys[s] >= 0:
                s = (s + 1) & ((1 << self.bits) - 1)
            self.keys[s], self.value[s] = a << 32 | b, v
        text = [bytes([i - self.bytes_from]) if sp.is_byte(i) else p.replace(SPACE, " ").encode() if plain[i] else b"" for i, p in enumerate(pieces)]
        self.data = np.frombuffer(b"".join(text), dtype=np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(t) for t in text])])
        self.dtype = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * K1) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """(rank, merged piece) of pairs of pieces."""
        key = a.astype(np.int64) << 32 | b
        key[(a < 0) | (b < 0)] = -2
        slot = self._slot(key)
        out = self.value[slot]
        found = self.keys[slot]
        out[found != key] = (NEVER, -1)
        live = np.flatnonzero((found != key) & (found >= 0))
        while len(live):
            slot[live] = (slot[live] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slot[live]]
            hit = found == key[live]
            out[live[hit]] = self.value[slot[live[hit]]]
            live = live[~hit & (found >= 0)]
        return out

    @property
    def space(self) -> int:
        return int(self.char[ord(" ")])


@lru_cache(maxsize=2)
def load(proto: bytes) -> Model:
    return Model(proto)


def dropped(key: np.ndarray, start: np.ndarray, mid: np.ndarray, end: np.ndarray, alpha: float) -> np.ndarray:
    """Whether the candidate that merges characters start..mid with mid..end of the document with this key is skipped."""
    if alpha <= 0:
        return np.zeros(len(start), dtype=bool)
    u = np.uint64
    x = mix(mix(key + start.astype(u) * K1) + mid.astype(u) * K2) + end.astype(u) * K3
    return (mix(x) >> u(11)).astype(np.float64) * 2.0**-53 < alpha


class Segmenter:
    """Merges symbols in place: piece[i] is the piece that starts at character i, while alive[i]."""

    def __init__(self, model: Model, chars: np.ndarray, doc: np.ndarray, place: np.ndarray, key: np.ndarray, alpha: float):
        self.model, self.doc, self.place, self.key, self.alpha = model, doc, place, key, alpha
        self.piece = model.char[chars]
        self.alive = np.ones(len(chars), dtype=bool)
        self.n = len(chars)

    def _ranks(self, left: np.ndarray, mid: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols that start at left and mid and end before end."""
        rank = self.model.lookup(self.piece[left], self.piece[mid])[:, 0]
        some = np.flatnonzero(rank < NEVER)
        if self.alpha > 0 and len(some):
            x = left[some]
            base = x - self.place[x]
            rank[some[dropped(self.key[self.doc[x]], self.place[x], mid[some] - base, end[some] - base, self.alpha)]] = NEVER
        return rank

    def run(self) -> None:
        n = self.n
        if not n:
            return
        space, piece = self.model.space, self.piece
        head = np.ones(n, dtype=bool)
        head[1:] = (self.doc[1:] != self.doc[:-1]) | (piece[1:] == space) & (piece[:-1] != space) | (piece[1:] < 0) | (piece[:-1] < 0)
        begin = np.flatnonzero(head)
        size = np.diff(np.append(begin, n))
        for k in np.flatnonzero(size > LONG_WORD):
            self._heap(int(begin[k]), int(begin[k] + size[k]))
        some = (size > 1) & (size <= LONG_WORD)
        begin, size = begin[some], size[some]
        if not len(begin):
            return
        # Words as rows of equal width, in a few widths: symbol starts, ends and pair ranks.
        for low, high in ((2, 4), (5, 8), (9, 16), (17, LONG_WORD)):
            of = (size >= low) & (size <= high)
            if of.any():
                self._words(begin[of], size[of], high)

    def _words(self, begin: np.ndarray, size: np.ndarray, width: int) -> None:
        width += 1  # a spare column, so that every row ends with the word's end
        cols = np.arange(width)
        start = begin[:, None] + np.minimum(cols, size[:, None])  # beyond the word: its end
        count = size.copy()
        rank = np.full((len(begin), width), NEVER)
        r, c = np.nonzero(cols[None, :] < size[:, None] - 1)
        rank[r, c] = self._ranks(start[r, c], start[r, c + 1], start[r, c] + 2)
        rows = np.arange(len(begin))
        while True:
            best = rank.argmin(axis=1)  # leftmost on ties
            go = rank[rows[: len(rank)], best] < NEVER
            if not go.all():
                start, count, rank, best = start[go], count[go], rank[go], best[go]
            if not len(rank):
                return
            row = rows[: len(rank)]
            left, mid = start[row, best], start[row, best + 1]
            self.piece[left] = self.model.lookup(self.piece[left], self.piece[mid])[:, 1]
            self.alive[mid] = False
            # Drop the right symbol: shift what follows to the left.
            shift = cols[None, :-1] > best[:, None]
            start[:, :-1] = np.where(shift, start[:, 1:], start[:, :-1])
            rank[:, :-1] = np.where(shift, rank[:, 1:], rank[:, :-1])
            rank[:, -1] = NEVER
            count -= 1
            rank[row, best] = NEVER
            right = np.flatnonzero(best + 1 < count)
            rank[right, best[right]] = self._ranks(start[right, best[right]], start[right, best[right] + 1], start[right, best[right] + 2])
            before = np.flatnonzero(best > 0)
            rank[before, best[before] - 1] = self._ranks(start[before, best[before] - 1], start[before, best[before]], start[before, best[before] + 1])

    def _heap(self, s: int, e: int) -> None:
        """The same merges for one long stretch: an agenda of candidates, best first."""
        nxt, prev = list(range(1, e - s + 1)), list(range(-1, e - s - 1))
        piece = self.piece[s:e].tolist()
        pairs, doc = self.model.pairs, int(self.doc[s])
        key, first = self.key[doc : doc + 1], int(self.place[s])
        agenda: list[tuple[int, int, int, int, int]] = []

        def push(i: int, j: int) -> None:
            if i < 0 or j >= e - s or (v := pairs.get((piece[i], piece[j]))) is None:
                return
            agenda.append((v[0], i, j, nxt[j], v[1]))
            if started:
                fresh = agenda.pop()
                if self.alpha <= 0 or not dropped(key, *(np.array([first + x]) for x in fresh[1:4]), self.alpha)[0]:
                    heapq.heappush(agenda, fresh)

        started = False
        for i in range(e - s - 1):
            push(i, i + 1)
        if self.alpha > 0 and agenda:
            at = np.array([x[1:4] for x in agenda]) + first
            skip = dropped(np.repeat(key, len(at)), at[:, 0], at[:, 1], at[:, 2], self.alpha)
            agenda = [x for x, d in zip(agenda, skip) if not d]
        heapq.heapify(agenda)
        started = True
        alive = [True] * (e - s)
        while agenda:
            _, i, j, end, merged = heapq.heappop(agenda)
            if not (alive[i] and alive[j]) or nxt[i] != j or nxt[j] != end:
                continue
            piece[i] = merged
            alive[j] = False
            nxt[i] = end
            if end < e - s:
                prev[end] = i
            push(prev[i], i)
            push(i, end)
        self.piece[s:e] = piece
        self.alive[s:e] = alive


def encode_texts(model: Model, texts: list[str], keys: np.ndarray, alpha: float) -> list[np.ndarray]:
    """Pieces of each text. keys: a 64-bit key of each, from which dropout is drawn."""
    # A text that isn't empty gets a space in front, as the model's training texts did.
    flat = np.frombuffer("".join(" " + t for t in texts if t).encode("utf-32-le"), dtype="<u4")
    size = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(size)])
    doc = np.repeat(np.arange(len(texts)), size)
    work = Segmenter(model, flat, doc, np.arange(len(flat)) - first[doc], keys, alpha)
    work.run()
    at = np.flatnonzero(work.alive)
    ids, doc = work.piece[at].astype(np.int64), doc[at]
    bare = np.flatnonzero(ids < 0)  # as bytes
    if len(bare):
        own = [np.frombuffer(chr(c).encode(), dtype=np.uint8).astype(np.int64) + model.bytes_from for c in flat[at[bare]]]
        times = np.ones(len(ids), dtype=np.int64)
        times[bare] = [len(x) for x in own]
        where = np.cumsum(times) - times
        ids, doc = np.repeat(ids, times), np.repeat(doc, times)
        for b, x in zip(where[bare], own):
            ids[b : b + len(x)] = x
    ends = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [ids[x:y].astype(model.dtype) for x, y in zip(ends, ends[1:])]


def decode_ids(model: Model, ids: np.ndarray) -> bytes:
    """The text of pieces, without the space in front."""
    ids = ids.astype(np.int64)
    size = model.at[ids + 1] - model.at[ids]
    at = np.repeat(model.at[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return model.data[at][1:].tobytes()


def model_bytes(spark: SparkSession, path: str) -> bytes:
    """The model file, from the driver's disk or any store that Spark reads."""
    if os.path.exists(path):
        with open(path, "rb") as f:
            return f.read()
    return bytes(spark.read.format("binaryFile").load(path).first().content)


def default_model() -> str:
    return os.path.join(TOKENIZERS, "piece_bpe_32k.model")


def _encoded(proto, alpha: float, seed: int):
    def run(batches):
        model = load(proto.value)
        for batch in batches:
            ids = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            keys = mix(ids * K2 + np.uint64(seed & (2**64 - 1)) * K3 + K1)
            size = pa.compute.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, at = np.cumsum(size), 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHARS)))
                part = batch.slice(at, stop - at)
                texts = part.column("text").to_pylist()
                out = encode_texts(model, texts, keys[at:stop], alpha)
                good = [decode_ids(model, x) == t.encode() for x, t in zip(out, texts)]
                at = stop
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([len(x) for x in out], pa.int64()), pa.array([x.tobytes() for x in out], pa.binary()), pa.array(good, pa.bool_())], names=["id", "n_tokens", "ids", "lossless"])

    return run


def encode_pieces(docs: DataFrame, model_path: str | None = None, alpha: float = 0.1, seed: int = 1, id_col: str = "doc_id", text_col: str = "text", vary_copies: bool = False) -> DataFrame:
    """id, n_tokens, ids (binary: little-endian, 2 bytes a piece if all ids fit, else 4), lossless of every row.

    ``lossless``: decoding the ids gave the text back. Null and empty texts have
    no pieces. Dropout is keyed by seed and id (a null id counts as 0), so that
    repeated rows encode alike; with ``vary_copies`` the second and later rows of
    one id and text are keyed by their number too, so each has a segmentation of
    its own. That moves every text to the task of its id and text, so it is for
    tables that hold a few copies of a document, as a mix does. Other columns are
    not read. An empty table gives an empty result. The model's file is broadcast
    (bounded: some MB).
    """
    spark = docs.sparkSession
    python_ready(spark)
    proto = spark.sparkContext.broadcast(model_bytes(spark, model_path or default_model()))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("key"), text_or_empty(text_col).alias("text"))
    kind = dict(rows.dtypes)["id"]
    if vary_copies:
        number = F.row_number().over(Window.partitionBy("id", F.xxhash64("text")).orderBy(F.lit(0)))
        rows = rows.withColumn("n", number).select("id", F.when(F.col("n") == 1, F.col("key")).otherwise(F.xxhash64("id", "n")).alias("key"), "text")
    return rows.mapInArrow(_encoded(proto, alpha, seed), f"id {kind}, n_tokens long, ids binary, lossless boolean").withColumnRenamed("id", id_col)


def decode_pieces(encoded: DataFrame, model_path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, text of encoded rows. Null ids give a null text; bytes that aren't UTF-8 (ids not from a text) become U+FFFD."""
    spark = encoded.sparkSession
    python_ready(spark)
    proto = spark.sparkContext.broadcast(model_bytes(spark, model_path or default_model()))
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    kind = dict(rows.dtypes)["id"]

    def run(batches):
        model = load(proto.value)
        for batch in batches:
            texts = [None if x is None else decode_ids(model, np.frombuffer(x, model.dtype)).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    return rows.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def op3_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = encode_pieces(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), "lossless")


QUERIES = {"op3_piece_codec": op3_piece_codec}
ORACLES: dict[str, str] = {}
