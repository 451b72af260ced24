import hashlib
import re

import corpus_pipeline
from tallyveil.llm import quality
from tallyveil.llm.jaccard_join import Join
from tests.llm.test_jaccard_join import plain as components_of

SF = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def windows(text):
    w = words(text)
    n = min(10, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def mix(rows):
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in rows}
    total = {}
    for r in rows:
        total[r[3]] = total.get(r[3], 0) + size[r[0]]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(total))}
    target, rest = {}, 1.5 * sum(total.values())
    open_ = set(total)
    while True:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * total[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2 * total[s] for s in full}
        rest -= sum(2 * total[s] for s in full)
        open_ -= full
    taken = {}
    for s in total:
        own = sorted((hashlib.md5(f"mix:{r[0]}".encode()).hexdigest(), r[0]) for r in rows if r[3] == s)
        epochs, left = divmod(int(target[s]), total[s])
        for _, i in own:
            taken[i] = epochs * size[i] + min(size[i], left)
            left -= min(size[i], left)
    return {i: t for i, t in taken.items() if t}


def test_against_plain_loops(spark):
    docs, labels, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    good = {r.doc_id for r in quality.scored(docs, quality.fit(docs, labels)).filter("predicted = 1").collect()}
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect() if r.doc_id in good]
    last = {}
    for r in rows:
        last[r[1]] = max(last.get(r[1], -1), r[0])
    rows = [r for r in rows if last[r[1]] == r[0]]
    stay = {i for i, _, c, _ in components_of(rows, Join(5, 80, 100)) if i == c}
    rows = [r for r in rows if r[0] in stay]
    known = set().union(*(windows(r.text) for r in benchmark.collect()))
    lengths = {len(k) for k in known}
    rows = [r for r in rows if not any(tuple(words(r[1])[i : i + n]) in known for n in lengths for i in range(len(words(r[1])) - n + 1))]
    want = mix(rows)
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == [*docs.columns, "mix_words"]
    assert {r.doc_id: r.mix_words for r in out.collect()} == want
    assert 0 < len(want) < docs.count()


def test_stages_take_edge_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (-1, "", None, "s", 0), (-2, "same text", "en", None, 9), (-2, "same text", "en", None, 9)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, SF)
        assert out.columns[:5] == docs.columns, name
        assert out.count() <= 4
        assert stage(spark, odd.limit(0), SF).count() == 0
