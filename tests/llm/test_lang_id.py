"""Language ID: held-out accuracy, rejected rows, and what each piece of evidence does."""

import numpy as np

from waybill.llm.lang_id import DECLARED_TRUST, HOST_WEIGHT, SUFFIX_TRUST, SUFFIXES, TEMPER, UND, fit, grams, identify_languages, identify_pages, keep_identified

WORDS = {
    "en": "the of and to in that was with for this have not they from which would there their been more when who will other than".split(),
    "de": "der die und das ist nicht mit von auf eine sich auch als dem werden haben wurde nach über oder wenn noch durch".split(),
    "fr": "le la les et des est une dans pour que qui pas sur plus avec ce sont mais nous vous être fait comme tout".split(),
}


def text(lang, k, n=30):
    w = WORDS[lang]
    return " ".join(w[(k * 7 + j * j + j * k) % len(w)] for j in range(n))


def train(spark):
    return fit(spark.createDataFrame([(k, text(x, k), x) for x in WORDS for k in range(60)] + [(999, "odd label", "zz")], "doc_id long, text string, lang string"))


def run(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _id int")
    out = identify_languages(docs, train(spark), **options)
    return {r.doc_id: r for r in out.collect()}, out, docs


def test_held_out_accuracy(spark):
    rows = [(k * 10 + j, text(x, 1000 + k), None, None, 1) for j, x in enumerate(WORDS) for k in range(50)]
    got, _, _ = run(spark, rows)
    assert all(got[r[0]].language == list(WORDS)[r[0] % 10] and got[r[0]].kept for r in rows)


def test_rejected_and_odd_rows(spark):
    junk = "".join(chr(33 + (k * 37 + k * k) % 60) for k in range(400))
    rows = [(1, None, "en", "a.example.org", 1), (2, "", "de", None, 1), (3, junk, "en", None, 1), (4, text("en", 3), None, None, 1), (5, text("en", 3) * 2000, "en", "http://u@b.example.org:80/x?y", 1), (6, "ab", "en", None, 1), (None, text("fr", 2), "fr", None, 1), (4, text("en", 3), None, None, 1)]
    got, out, docs = run(spark, rows)
    assert {k: v.language for k, v in got.items()} == {1: "und", 2: "und", 3: "und", 4: "en", 5: "en", 6: "und", None: "fr"}
    assert out.count() == len(rows)
    left = keep_identified(docs, out)
    assert left.columns == docs.columns and sorted((r.doc_id or 0) for r in left.collect()) == [0, 4, 4, 5]
    assert sorted((r.doc_id or 0) for r in keep_identified(docs, out, max_broadcast=1).collect()) == [0, 4, 4, 5]
    assert run(spark, [])[1].collect() == []


def test_evidence(spark):
    mixed = text("de", 1, 2) + " " + text("fr", 1, 2)
    rows = [(1, mixed, "de-AT", None, 1), (2, mixed, "FR_ca", None, 1), (3, mixed, None, "https://x.example.de/1", 1), (4, mixed, None, "x.example.fr", 1)]
    got, _, _ = run(spark, rows)
    assert [got[k].language for k in (1, 2, 3, 4)] == ["de", "fr", "de", "fr"]
    # A host with much text in one language, and a sibling host under the same parent.
    rows = [(k, text("fr", k), None, "news.site.example", 1) for k in range(80)] + [(100, mixed, None, "news.site.example", 1), (101, mixed, None, "blog.site.example", 1), (102, mixed, None, "other.example", 1)]
    got, _, _ = run(spark, rows)
    # Host beats sibling beats no host at all.
    assert got[100].language == "fr" and got[101].language == "fr" and got[100].confidence >= got[101].confidence


def test_model_without_labels(spark):
    names, logs = fit(spark.createDataFrame([(1, "x", None)], "doc_id long, text string, lang string"))
    assert names == [] and logs.shape[1] == 1
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    assert [r.language for r in identify_languages(docs, (names, logs), declared_col=None, address_col=None).collect()] == ["und"]


def test_rare_languages_are_modelled(spark):
    rows = [(k, text("en", k), "en") for k in range(3000)] + [(5000 + k, text("fr", k), "fr") for k in range(8)] + [(6000 + k, text("de", k), "de") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert fit(docs, sample=50)[0] == ["en", "fr"]


def page(body, lang="", attrs=""):
    return f'<!DOCTYPE html><html{attrs}{lang and f" lang={lang}"}><head><title>x</title></head><body><nav><a href="/">the menu of the site</a></nav><article><p>{body}</p></article></body></html>'


def test_pages(spark):
    """Each piece of evidence decides a page whose text fits two languages equally well."""
    mixed = text("de", 1, 2) + " " + text("fr", 1, 2)
    rows = [(1, "http://a.example.org/1", page(mixed, '"de-AT"')), (2, "http://b.example.org/1", page(mixed, "fr", ' class="x"')), (3, "http://c.example.de/1", page(mixed)), (4, "http://d.example.fr:8080/1?x", page(mixed))]
    rows += [(10 + k, f"http://news.site.example/{k}", page(text("fr", k))) for k in range(60)] + [(5, "https://news.site.example/x", page(mixed)), (6, "https://blog.site.example/x", page(mixed))]
    rows += [(200 + k, f"http://zeit.seite.example/{k}", page(text("de", k))) for k in range(60)] + [(7, "https://zeit.seite.example/x", page(mixed)), (8, None, None), (9, "http://z.example", ""), (None, "http://z.example", page(text("en", 4))), (1, "http://a.example.org/1", page(mixed, '"de-AT"'))]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, language string")
    out = identify_pages(pages, train(spark)).collect()
    got = {r.page_id: r for r in out}
    assert len(out) == len(rows) and [got[k].language for k in (1, 2, 3, 4, 5, 6, 7, 8, 9, None)] == ["de", "fr", "de", "fr", "fr", "fr", "de", "und", "und", "en"]
    again = {r.page_id: r for r in identify_pages(pages, train(spark), max_broadcast=0).collect()}
    assert {k: r.language for k, r in again.items()} == {k: r.language for k, r in got.items()}
    assert identify_pages(pages.limit(0), train(spark)).collect() == []


def test_fusion_against_plain_python(spark):
    """Posteriors from the same likelihoods: evidence times smoothed host, parent and overall shares."""
    import math

    model = train(spark)
    hosts = ["a.one.example", "b.one.example", "c.two.de", None]
    rows = [(k, text("de", k, 2 + k % 3) + " " + text("fr", k, 3), ["de", None, "fr-CA", "xx"][k // 4 % 4], hosts[k % 4], 1) for k in range(40)]
    got, _, _ = run(spark, rows)
    names = [*model[0], UND]
    n = len(names)

    def told(value, trust):
        return [0.0] * n if value not in names[:-1] else [math.log(trust if x == value else (1 - trust) / (n - 1)) for x in names]

    logs, soft = {}, lambda v: [math.exp(x - max(v)) / sum(math.exp(y - max(v)) for y in v) for x in v]
    for i, t, declared, host, _ in rows:
        h = grams(np.frombuffer(t.encode(), np.uint8))[: len(t.encode()) - 3]
        sums = model[1][h].astype(float).sum(axis=0)
        lik = TEMPER * (sums - sums[-1])
        suffix = SUFFIXES.get(host.split(".")[-1]) if host else None
        logs[i] = [a + b + c for a, b, c in zip(lik, told(declared and declared.split("-")[0], DECLARED_TRUST), told(suffix, SUFFIX_TRUST))]
    p = {i: soft(v) for i, v in logs.items()}
    add = lambda keep: [sum(p[r[0]][k] for r in rows if r[3] and keep(r[3])) for k in range(n)]
    smooth = lambda c, above: [(x + HOST_WEIGHT * y) / (sum(c) + HOST_WEIGHT) for x, y in zip(c, above)]
    base = smooth(add(lambda h: True), [1 / n] * n)
    for i, _, _, host, _ in rows:
        prior = base
        if host:
            parent = ".".join(host.split(".")[-2:])
            prior = smooth(add(lambda h: h == host), smooth(add(lambda h: h.endswith(parent)), base))
        post = soft([a + math.log(b) for a, b in zip(logs[i], prior)])
        assert got[i].language == names[post.index(max(post))] and abs(got[i].confidence - max(post)) < 1e-6
