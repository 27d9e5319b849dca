"""Piece encoding against SentencePiece itself, a plain merge loop, and exact round trips."""

import random

import numpy as np
import pytest
import sentencepiece

from waybill.llm import piece_codec as m

TEXTS = ["", " ", "  a  b\n\nc\t ", " lead", "ﬁ ½ Ａ", "é é é", "\x00z", "emoji 😀 中文字", "The quick brown fox jumps over the lazy dog.", "x" * 300, "abc" * 100 + " tail", " " * 90, "a" + " " * 60 + "b", "internationalization antidisestablishmentarianism " * 3, "▁x ▁▁", "<s> </s> <unk> <0x41>", "日本語のテキストはスペースがありません。" * 8, "line\r\nline nbsp sep"]


@pytest.fixture(scope="module")
def proto():
    with open(m.default_model(), "rb") as f:
        return f.read()


def plain(model, text, key, alpha):
    """One merge at a time over the whole text, from the definition."""
    chars = np.frombuffer((" " + text if text else "").encode("utf-32-le"), dtype="<u4")
    sym = [(i, i + 1, int(model.char[c])) for i, c in enumerate(chars)]
    while True:
        best = None
        for k in range(len(sym) - 1):
            (s, d, a), (_, e, b) = sym[k], sym[k + 1]
            if (v := model.pairs.get((a, b))) and (best is None or v[0] < best[0]) and not m.dropped(np.array([key]), np.array([s]), np.array([d]), np.array([e]), alpha)[0]:
                best = (v[0], k, v[1])
        if best is None:
            break
        _, k, piece = best
        sym[k : k + 2] = [(sym[k][0], sym[k + 1][1], piece)]
    out = []
    for s, _, piece in sym:
        out += [piece] if piece >= 0 else [x + model.bytes_from for x in chr(chars[s]).encode()]
    return out


def test_without_dropout_as_sentencepiece(proto):
    model, sp = m.load(proto), sentencepiece.SentencePieceProcessor(model_proto=proto)
    texts = [t for t in TEXTS if m.SPACE not in t]
    got = m.encode_texts(model, texts, np.zeros(len(texts), np.uint64), 0.0)
    assert [x.tolist() for x in got] == sp.encode(texts)


@pytest.mark.parametrize("alpha", [0.0, 0.1, 0.5, 1.0])
def test_against_plain_loop_and_round_trip(proto, alpha):
    model = m.load(proto)
    r = random.Random(int(alpha * 10))
    texts = TEXTS + ["".join(r.choice("abcdeé thein  on") for _ in range(r.randrange(120))) for _ in range(40)]
    keys = np.arange(len(texts), dtype=np.uint64) * np.uint64(977)
    got = m.encode_texts(model, texts, keys, alpha)
    assert [m.decode_ids(model, x).decode() for x in got] == texts
    assert [x.tolist() for x in got] == [plain(model, t, k, alpha) for t, k in zip(texts, keys)]


def test_dropout_varies_by_seed_only(spark):
    rows = [(k, t, "x", 1) for k, t in enumerate(TEXTS)] + [(None, "no id", None, None), (99, None, None, None), (8, TEXTS[8], "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, key int")
    one = m.encode_pieces(docs, alpha=0.3)
    a = {(r.doc_id, r.n_tokens): bytes(r.ids) for r in one.collect()}
    b = {(r.doc_id, r.n_tokens): bytes(r.ids) for r in m.encode_pieces(docs.repartition(3), alpha=0.3).collect()}
    c = {r.doc_id: bytes(r.ids) for r in m.encode_pieces(docs, alpha=0.3, seed=2).collect()}
    assert a == b and {k[0]: v for k, v in a.items()} != c
    assert all(r.lossless for r in one.collect()) and one.count() == len(rows)
    back = sorted(((r.doc_id is not None, r.doc_id or 0), r.text) for r in m.decode_pieces(one).collect())
    assert back == sorted(((k is not None, k or 0), t or "") for k, t, *_ in rows)
    assert m.encode_pieces(docs.limit(0)).collect() == []


def test_copies_vary(spark):
    rows = [(1, TEXTS[8] * 3), (1, TEXTS[8] * 3), (1, TEXTS[8]), (2, TEXTS[12]), (None, TEXTS[12]), (None, TEXTS[12]), (3, None), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def encoded(df, **options):
        return sorted((r.doc_id or 0, bytes(r.ids)) for r in m.encode_pieces(df, alpha=0.3, **options).collect())

    alike, varied = encoded(docs), encoded(docs, vary_copies=True)
    assert varied == encoded(docs.repartition(4), vary_copies=True) and len(varied) == len(rows)
    assert len(set(alike)) == 5 and len(set(varied)) == 7 and set(alike) < set(varied)
    assert all(r.lossless for r in m.encode_pieces(docs, alpha=0.3, vary_copies=True).collect())
    assert encoded(docs.limit(0), vary_copies=True) == []
