"""The pipeline's stages and run() against plain Python on small rows."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_near_dedup import brute
from waybill.llm import piece_codec

pipeline = pytest.importorskip("corpus_pipeline")

EN = "the of and to in that was with for this have not they from which would there their been more when who will other than".split()
FR = "le la les et des est une dans pour que qui pas sur plus avec ce sont mais nous vous être fait comme tout".split()


def rows():
    out = []
    for k in range(80):
        w = (EN, FR)[k % 4 == 3]
        out.append((k, " ".join(w[(k * k + j * j * (k + 3) + j) % len(w)] + str((k * 31 + j) % 97) * (j % 3 == 0) for j in range(60 + k)), "fr" if k % 4 == 3 else "en", ["a", "b", None][k % 3], 0))
    out += [(100 + k, out[k][1], out[k][2], "a", 0) for k in range(5)]  # copies
    out += [(200 + k, out[k + 10][1] + " end", out[k + 10][2], "b", 0) for k in range(5)]  # near copies
    out += [(300, None, "en", "a", 0), (301, "", None, "b", 0), (302, "#### //// ++++ %%%% " * 20, None, "a", 0)]
    return out


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows(), "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{d}/documents.parquet")
    return d


def test_stages(spark, sf_dir):
    docs, columns = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    seen = []
    for k, (name, stage) in enumerate(pipeline.STAGES):
        docs = stage(spark, docs, sf_dir)
        columns = columns or docs.columns
        if k < len(pipeline.STAGES) - 1:
            assert docs.columns == columns == ["doc_id", "text", "lang", "source", "n_chars"]
            seen.append([tuple(r) for r in docs.collect()])
    one, two, three, four = seen
    assert sorted(r[0] for r in one) == [r[0] for r in rows() if r[0] < 300]
    last = {t: i for i, t, *_ in sorted(one)}
    assert sorted(r[0] for r in two) == sorted(last.values())
    assert sorted(r[0] for r in three) == sorted({c for _, c, _ in brute([r[:2] for r in two], False)})
    times = Counter(r[0] for r in four)
    assert max(times.values()) <= 2 and set(four) <= set(three)
    total = sum(len(r[1].split()) for r in three)
    assert abs(sum(len(r[1].split()) for r in four) - 1.5 * total) < 0.05 * total
    with open(piece_codec.default_model(), "rb") as f:
        model = piece_codec.load(f.read())
    out = docs.collect()
    text = {r[0]: r[1] for r in four}
    assert Counter(r.doc_id for r in out) == times
    assert len({(r.doc_id, bytes(r.ids)) for r in out}) == len(out) > len(times)
    assert all(piece_codec.decode_ids(model, np.frombuffer(r.ids, model.dtype)).decode() == text[r.doc_id] for r in out)


def test_run(spark, sf_dir):
    out = pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "lossless"]
    first = sorted(map(tuple, out.collect()))
    assert first and all(r[3] for r in first) and all(len(r[2]) == len(hashlib.sha256().hexdigest()) for r in first)
    assert sorted(map(tuple, pipeline.run(spark, sf_dir).collect())) == first
