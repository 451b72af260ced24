import binascii
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyveil.llm import language_id
from tallyveil.llm.language_id import UNKNOWN, fit, grams_of, held_out, identified, predict

ROWS = [(1, "the cat and the dog", "en", 1.0), (2, "le chat et le chien", "fr", 2.0), (3, "the bird", "en", 3.0), (4, "le chien", None, 4.0), (5, None, "fr", 5.0), (6, "", "en", 6.0), (7, "12 34 !!", "en", 7.0), (None, "the", "en", 8.0), (2, "le chat et le chien", "fr", 2.0), (8, "chat " * 50_000, "fr", 9.0)]
SCHEMA = "doc_id long, text string, lang string, score double"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = identified(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert len(out) > 40 and (out.lang == out.lang_pred).mean() > 0.97
    assert out.score.between(0, 1).all()


def test_held_out_rows(spark):
    got = spark.range(200).withColumnRenamed("id", "doc_id").select("doc_id", held_out("doc_id").alias("h")).collect()
    assert all(r.h == (binascii.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)


def test_edge_rows(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    model = fit(docs)
    assert model.langs == ["en", "fr"]
    got = [(r.doc_id, r.lang_pred) for r in predict(docs, model).collect()]
    assert sorted(got, key=str) == sorted([(1, "en"), (2, "fr"), (3, "en"), (4, "fr"), (5, UNKNOWN), (6, UNKNOWN), (7, UNKNOWN), (None, "en"), (2, "fr"), (8, "fr")], key=str)


def test_backoff(spark):
    docs = spark.createDataFrame([(1, "aaab aaac", "x", 0.0), (2, "zzzb zzzc", "y", 0.0)], SCHEMA)
    model = fit(docs)
    unseen = spark.createDataFrame([(1, "aaad", None, 0.0), (2, "zzzzd", None, 0.0), (3, "qq", None, 0.0)], SCHEMA)
    assert [r.lang_pred for r in predict(unseen, model).orderBy("doc_id").collect()] == ["x", "y", "x"]
    assert grams_of("ab", 3) == ["<", "a", "b", ">", "<a", "ab", "b>", "<ab", "ab>"]
    assert [g for at in model.unseen("aaad") for g, k in model.grams.items() if k == at] == ["<aaa", "aaa", "aa", "a", ">"]


@pytest.mark.parametrize("rows", [[], [(1, "text without language", None, 0.0)]])
def test_nothing_to_learn(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    assert [r.lang_pred for r in identified(docs).collect()] == [UNKNOWN] * len(rows)


def test_language_is_no_input(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    changed = docs.withColumn("lang", F.when(held_out("doc_id"), F.lit("xx")).otherwise(F.col("lang")))
    a, b = (sorted(map(tuple, identified(d).select("doc_id", "lang_pred").collect())) for d in (docs, changed))
    assert a == b


def test_against_plain_loops(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang").unionByName(spark.createDataFrame(ROWS, SCHEMA).drop("score"))
    rows = [tuple(r) for r in docs.collect()]
    words, grams = {}, {}
    for i, text, lang in rows:
        if i is not None and binascii.crc32(str(i).encode()) % 3 != 1 and text and lang:
            words.setdefault(lang, Counter()).update(re.findall(r"[^\W\d_]+", text.lower()))
    for lang, c in words.items():
        for w in c:
            for n in range(1, 6):
                grams.setdefault((lang, n), Counter()).update(f"<{w}>"[k : k + n] for k in range(len(w) + 3 - n))
    langs = sorted(words)

    def logs(tables):
        total = [sum(t.values()) for t in tables]
        return lambda x: [math.log(t[x] + sum(u[x] for u in tables) / sum(total)) - math.log(n + 1) for t, n in zip(tables, total, strict=True)]

    of_word = logs([words[lang] for lang in langs])
    of_gram = {n: logs([grams[lang, n] for lang in langs]) for n in range(1, 6)}

    def predicted(text):
        found = re.findall(r"[^\W\d_]+", (text or "").lower())
        if not found:
            return UNKNOWN
        total = [0.0] * len(langs)
        for w in found:
            if any(words[lang][w] for lang in langs):
                total = [a + b for a, b in zip(total, of_word(w), strict=True)]
                continue
            marked = f"<{w}>"
            for k in range(len(marked)):
                for n in range(min(5, len(marked) - k), 0, -1):
                    if any(grams[lang, n][marked[k : k + n]] for lang in langs):
                        total = [a + b / len(marked) for a, b in zip(total, of_gram[n](marked[k : k + n]), strict=True)]
                        break
        return langs[total.index(max(total))]

    got = [(r.doc_id, r.lang_pred) for r in identified(docs).collect()]
    assert sorted(map(str, got)) == sorted(str((i, predicted(text))) for i, text, _ in rows)


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, f"word{i} and", "en" if i % 4 else "fr") for i in range(4000)], "doc_id long, text string, lang string")
    taken = {r.lang: r["count"] for r in language_id._sample(docs, "doc_id", "text", "lang", 300, 10**6).groupBy("lang").count().collect()}
    assert all(230 < n < 370 for n in taken.values()) and len(taken) == 2
    few = language_id._sample(docs, "doc_id", "text", "lang", 10**6, 1200).count()
    assert 100 < few < 320
