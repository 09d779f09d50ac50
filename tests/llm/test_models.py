"""Top-k search, URL filter, toxicity and quality against brute force and held-out labels; the pipeline by its rules."""
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from mendstream.llm import quality, queries, topk, toxicity, urls


def auc(pairs):
    pos, neg = [s for s, y in pairs if y], [s for s, y in pairs if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def test_top_k_equals_all_pairs(spark):
    rows = [(i, [math.sin(i * k) * (1 + i % 3) for k in range(1, 9)]) for i in range(90)]
    rows += [(90, None), (91, [1.0, None] + [0.0] * 6), (92, [float("nan")] * 8), (93, [float("inf")] * 8), (94, rows[5][1]), (None, rows[5][1]), (100, [0.0] * 8)]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, score int")
    fine = {i: [math.floor(64 * x) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in sorted(i for i in fine if i % 20 == 0):
        best = sorted((-sum(a * b for a, b in zip(fine[q], fine[c])), c) for c in fine if c != q)[:20]
        want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    assert sorted(map(tuple, topk.top_k(df).select("query_id", "rank", "vec_id", "score").collect())) == sorted(want)
    assert topk.top_k(df.where("vec_id < 3")).count() == 2
    assert topk.top_k(df.where("false")).count() == 0


def test_url_rules_and_verdicts(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    rows = urls.op10(spark, sf).collect()
    text = {r.page_id: r.url for r in pages.collect()}
    assert sorted(r.page_id for r in rows) == sorted(text)
    for r in rows:
        host = path = ""
        if text[r.page_id] and "://" in text[r.page_id]:
            rest = text[r.page_id].split("://", 1)[1]
            host = re.split("[/?#]", rest, maxsplit=1)[0]
            path = re.split("[?#]", rest[len(host) :], maxsplit=1)[0]
            host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[1:] if fits else (None, r.verdict)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)
        assert r.verdict in ("allow", "block")


def witten_bell(texts, share):
    """Probability of a character after a context, by the recursion over plain dictionaries."""
    n = [{} for _ in range(urls.ORDER + 1)]
    for t in texts:
        padded = [-1] * urls.ORDER + list(t.encode())
        for i in range(urls.ORDER, len(padded)):
            for k in range(urls.ORDER + 1):
                after = n[k].setdefault(tuple(padded[i - k : i]), {})
                after[padded[i]] = after.get(padded[i], 0) + 1
    total = sum(n[0].get((), {}).values())

    def prob(ctx, ch, k=urls.ORDER):
        if k < 0:
            return 1 / 256
        after = n[k].get(tuple(ctx[len(ctx) - k :]), {})
        kept = {c: m for c, m in after.items() if m * share >= total}
        below = prob(ctx, ch, k - 1)
        if not kept:
            return below
        visits = sum(after.values())
        return (kept.get(ch, 0) + (len(kept) + visits - sum(kept.values())) * below) / (visits + len(kept))

    return prob


@pytest.mark.parametrize("share", [1 << 18, 40])
def test_url_models_equal_the_recursion(spark, monkeypatch, share):
    monkeypatch.setattr(urls, "SHARE", share)
    good = ["shop.org/fr/a", "shop.org/fr/bon", "cité.org/fr/", "shop.org/fr/a"]
    bad = ["x.net/zzz", "y.net/zq", "", "x.net/zzzz?"]
    models = urls.learn(spark.createDataFrame([(t, 1) for t in good] + [(t, 0) for t in bad], "_key string, _kind int").repartition(3))
    asked = [*good, *bad, "new.org/fr/z", "\u0001"]
    raw = [t.encode() for t in asked]
    off = np.append(0, np.cumsum([len(r) for r in raw]))
    got = urls.log_ratio(np.frombuffer(b"".join(raw), np.uint8), off, models)
    plain = [witten_bell(bad, share), witten_bell(good, share)]
    for t, ratio in zip(raw, got):
        padded = [-1] * urls.ORDER + list(t)
        logs = [math.log(plain[1](padded[i - 4 : i], padded[i])) - math.log(plain[0](padded[i - 4 : i], padded[i])) for i in range(4, len(padded))]
        assert ratio == pytest.approx(sum(logs) / max(len(logs), 1))
    start = np.arange(256, dtype=np.int64) + 1  # all bytes that may begin a text
    assert all(m.probability(start).sum() == pytest.approx(1) for m in models)


def test_url_verdicts_of_the_models(spark):
    rows = [(i, f"http://a{i}.example.net/en/reading/page{i}") for i in range(60)] + [(100 + i, f"https://b{i}.net/casino/win{i}") for i in range(60)]
    rows += [(1000, "http://library.test/en/reading/page7"), (1001, "http://bets.test/casino/win7"), (1002, None), (1003, "no scheme"), (1000, "http://library.test/en/reading/page7")]
    df = spark.createDataFrame([(i, u, "x", 1) for i, u in rows], "page_id long, url string, _key string, verdict int")
    out = urls.judge(df).collect()
    assert len(out) == len(rows)
    said = {(r.page_id, r.rule, r.verdict) for r in out if r.page_id >= 1000}
    assert {(1000, None, "allow"), (1001, None, "block")} <= said and len(said) == 4
    assert all((r.host, r.path, r.ratio) == ("", "", 0.0) for r in out if r.page_id in (1002, 1003))
    for part in (df.where("page_id < 60 or page_id >= 1000"), df.where("page_id >= 1000")):  # one kind, none
        assert urls.judge(part).where("verdict in ('allow', 'block')").count() == part.count()
    assert urls.judge(df.where("false")).count() == 0


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifier_on_held_out_rows(spark, module, label):
    d = "/root/testdata/sf0.01"
    fn = module.op4 if module is toxicity else module.op8
    rows = fn(spark, d).collect()
    told = {r.doc_id: r[label] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{d}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert auc([(r.score, told[r.doc_id]) for r in rows if r.held_out and told.get(r.doc_id) is not None]) > 0.8


@pytest.mark.parametrize("module,label", [(toxicity, "toxic"), (quality, "quality")])
def test_classifier_edges(spark, module, label):
    rows = [(1, "you are a fool", 1), (2, "a calm report", 1), (3, None, 1), (4, "", 1), (5, "word " * 30000, 1), (None, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1)], f"doc_id long, {label} int")
    for known in (labels, labels.where("false")):
        out = module.score(docs, module.fit(docs, known)).collect()
        assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
        assert {r.doc_id: r.score for r in out}[3] == {r.doc_id: r.score for r in out}[4]
    assert module.score(docs.where("false"), module.fit(docs, labels)).count() == 0


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in queries.NAMES] == [f"op{k}" for k in range(1, 14)]
    assert set(queries.oracle_sql()) <= set(queries.queries())


def test_pipeline_stages(spark, sf):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    toxic = p.toxic(spark, docs, sf).cache()
    score = {r.doc_id: r.predicted for r in toxicity.op4(spark, sf).collect()}
    assert sorted(r.doc_id for r in toxic.collect()) == sorted(i for i, bad in score.items() if not bad)
    single = p.near_duplicates(spark, toxic, sf).cache()
    assert single.count() == single.select("doc_id").distinct().count() <= toxic.count()
    cut = p.repeated_passages(spark, single, sf).cache()
    assert cut.columns == p.COLUMNS and cut.where(F.length("text") != F.col("n_chars")).isEmpty()
    mix = p.mixed(spark, cut, sf).cache()
    assert mix.columns == p.COLUMNS and mix.groupBy("doc_id").count().where("count > 2").isEmpty()
    assert p.tokens(spark, mix, sf).count() == mix.count()
    nothing = docs.where("false")
    for _, step in p.STAGES:
        assert step(spark, nothing, sf).count() == 0
