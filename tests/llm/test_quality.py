import math
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tallyveil.llm.quality import BUCKETS, bradley_terry, bucket_shares, fit, good_documents, quality_scores, quantile_threshold, scored

DOCS = "doc_id long, text string, label int"
LABELS = "doc_id long, quality int"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = quality_scores(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert len(out) > 100 and (out.quality == out.predicted).mean() > 0.97
    good = out[out.quality == 1]
    assert (good.predicted == 1).mean() > 0.99 and out.score.between(0, 1).all()


def test_pairs_order_by_the_telling_feature():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(0, 1, (500, 3)), rng.normal(0, 1, (500, 3))
    good[:, 1] += 2
    w = bradley_terry(good, bad)
    assert w[1] > 0.5 and abs(w[0]) < w[1] / 3 and abs(w[2]) < w[1] / 3
    # the slope vanishes at the minimum
    x = good - bad
    assert np.allclose(-x.T @ (1 / (1 + np.exp(x @ w))) / len(x) + 1e-3 * w, 0, atol=1e-8)


def test_threshold_divides():
    s, g = np.array([0.1, 0.2, 0.8, 0.9, 1.0]), np.array([False, False, True, True, True])
    assert 0.2 < quantile_threshold(s, g) <= 0.8


def test_edge_rows(spark):
    docs = spark.createDataFrame([(i, ("Good words, in order. " if i % 2 else "BAD!! | ### ") * 9, 5) for i in range(60)] + [(60, None, 1), (61, "", 1), (None, "good words", 1), (1, "Good words, in order. " * 9, 5), (62, "word " * 60_000, 2)], DOCS)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, None), (None, 1), (5, 1), (999, 0)], LABELS)
    out = quality_scores(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == 65 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.predicted == r.doc_id % 2 for r in rows if r.doc_id is not None and r.doc_id < 60)
    kept = good_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in rows)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a", 1), (2, None, 2)], DOCS)
    none = spark.createDataFrame([], LABELS)
    one_kind = spark.createDataFrame([(i, 1) for i in range(9)], LABELS)
    for labels in (none, one_kind):
        assert {(r.score, r.predicted) for r in quality_scores(docs, labels).collect()} == {(0.5, 1)}
    assert quality_scores(docs.limit(0), one_kind).collect() == []


def test_the_same_sample_at_every_run(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    assert fit(docs, labels) == fit(docs.orderBy(F.rand()), labels.repartition(7))


def plain_features(text):
    """The features of a text, in plain Python."""
    words = re.split(r"\s+", text.lower())
    n, w = max(len(text), 1), max(len(words), 1)
    share = lambda pattern: math.sqrt(sum(map(len, re.findall(pattern, text))) / n)
    upper = math.sqrt(sum(c.isupper() for c in text) / n)
    count = lambda mark: math.sqrt(text.count(mark) / w)
    return {
        "length": math.log1p(len(text)), "symbols": share(r"[#&$%*~^=<>{}\[\]\\_@+]"), "bars": count("|"), "capitals": upper, "shouts": count("!"), "digits": share("[0-9]"), "stops": count("."),
        "commas": count(","), "distinct": math.log1p(len(set(words))) / math.log1p(w), "word_length": math.log1p(n / w),
    }


def plain_buckets(text):
    words = re.split(r"\s+", text.lower())
    out = [0.0] * BUCKETS
    for x in words:
        h = xxhash.xxh64(x.encode(), seed=42).intdigest()
        out[(h - (1 << 64) if h >> 63 else h) % BUCKETS] += 1 / len(words)
    return out


def test_scores_against_plain_python(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.filter("text IS NOT NULL").select("doc_id", "text").unionByName(spark.createDataFrame([(-1, "  A!b | Ünd 12,3.4  \n##"), (-2, ""), (-3, "one")], "doc_id long, text string"))
    model = fit(docs, labels)
    got = {r.doc_id: r.score for r in scored(docs, model).collect()}
    rows = docs.collect()
    assert len(got) == len(rows) and any(model.words)
    for doc_id, text in rows:
        f = plain_features(text)
        total = sum(model.weights[k] * f[k] for k in model.weights) + sum(a * b for a, b in zip(model.words, plain_buckets(text), strict=True))
        assert abs(got[doc_id] - 1 / (1 + math.exp(-max(-700, min(700, total - model.threshold))))) < 1e-9, doc_id
    shares = {r.id: r.shares for r in bucket_shares(docs.withColumnRenamed("doc_id", "id")).collect()}
    assert all(np.allclose(shares[i], plain_buckets(t)) for i, t in rows)


def test_a_labelled_id_with_many_copies(spark):
    rows = [(i, ("Good words, in order. " if i % 2 else "BAD!! | ### ") * 9, 5) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], LABELS)
    once, often = (fit(spark.createDataFrame(rows + [rows[3]] * n, DOCS), labels) for n in (0, 2000))
    assert once == often


def test_words_alone_can_tell(spark):
    rng = np.random.default_rng(3)
    good, bad = [f"g{i}" for i in range(30)], [f"b{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad, 25).tolist() + rng.choice(good + bad, 15).tolist()), 1) for i in range(300)]
    docs, labels = spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, i % 2) for i in range(300)], LABELS)
    out = quality_scores(docs, labels).filter("held_out").collect()
    assert len(out) > 60 and sum(r.predicted == r.doc_id % 2 for r in out) / len(out) > 0.95
