import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tallyveil.llm import jaccard_join
from tallyveil.llm.components import components
from tallyveil.llm.jaccard_join import OP5_SQL, Join, boundary, first_keys, list_cost, near_copies, one_of_each, shingle_sets, subset_cost, subset_keys

SCHEMA = "doc_id long, text string, cls string"


def sets_of(rows, width):
    out = []
    for _, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    return out


def plain(rows, join):
    """(id, n_shingles, component_id, n_links) by comparing all pairs."""
    sets = sets_of(rows, join.width)
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and join.den * len(sets[i] & sets[j]) >= join.num * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                top[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(find(i)), links[i]) for i, r in enumerate(rows)]


def corpus(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        words = [f"w{rng.randrange(10 ** rng.choice([1, 4]))}" for _ in range(rng.choice([1, 2, 3, 5, 9, 12, 14, 20, 24, 40, 80, 160]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(words)
            for _ in range(rng.randrange(0, 4)):
                i = rng.randrange(len(copy) + 1)
                rng.choice([lambda c=copy, k=i: c.insert(k, f"x{rng.randrange(99)}"), lambda c=copy, k=i: c.pop(min(k, len(c) - 1)) if len(c) > 1 else None, lambda c=copy, k=i: c.__setitem__(min(k, len(c) - 1), "y")])()
            rows.append((len(rows), " ".join(copy), "c"))
    rows += [(len(rows), None, "c"), (len(rows) + 1, "", "c"), (len(rows) + 2, " \n\t", "c"), (5, rows[5][1], "c"), (None, rows[7][1].upper(), "c"), (None, "alone at last", "c"), (1000, "é É word", "c"), (1001, "é é word", "c"), (1002, "long " * 40_000, "c"), (1003, "LONG " * 40_000, "c")]
    return rows


@pytest.mark.parametrize("join", [Join(), Join(5, 80, 100), Join(2, 50, 100)])
def test_against_all_pairs(spark, monkeypatch, join):
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    rows = corpus(join.width)
    got = [(r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in near_copies(spark.createDataFrame(rows, SCHEMA), join=join).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(rows, join)))


def test_against_sql(spark, same_as_sql):
    docs = spark.createDataFrame(corpus(4, 30), SCHEMA)
    same_as_sql(near_copies(docs).drop("body"), OP5_SQL, {"documents": docs})


def test_linked_sets_share_lists():
    rng = np.random.default_rng(3)
    for join in (Join(), Join(5, 80, 100), Join(2, 50, 100)):
        for small in (0, 10) if join.num == 50 else (0, 18, 22):
            for _ in range(100):
                a = rng.integers(0, 2**63, int(rng.integers(1, 120)), dtype=np.uint64)
                a = np.unique(a)
                size = len(a)
                b = np.unique(np.concatenate([rng.permutation(a)[: size - int(rng.integers(0, size // 4 + 1))], rng.integers(0, 2**63, int(rng.integers(0, size // 4 + 1)), dtype=np.uint64)]))
                both = len(np.intersect1d(a, b))
                linked = join.den * both >= join.num * (len(a) + len(b) - both)
                if linked and size <= small and len(b) <= small:
                    assert len(np.intersect1d(subset_keys(a, join, small), subset_keys(b, join, small)))
                elif linked:
                    shared = len(np.intersect1d(first_keys(a, join, small), first_keys(b, join, small)))
                    assert shared >= join.wanted(join.least(size)) and shared >= join.wanted(join.least(len(b)))


def test_words_and_very_long_texts(monkeypatch):
    monkeypatch.setattr(jaccard_join, "SLICE", 40)
    texts = ["", None, " \n", "a", "A b", "a\tb\x0bc  d ", "É é " * 30, "x y z " * 200, "last one here"]
    sizes = [len(s) for s in shingle_sets(pa.array(texts, pa.string()), 3)]
    assert sizes == [len(s) for s in sets_of([(None, t) for t in texts], 3)]


def test_boundary_follows_cost():
    join = Join()
    x = boundary(join, {s: 1 for s in range(1, 41)})
    assert 9 <= x <= 30 and subset_cost(join, x) <= list_cost(join, x)
    assert boundary(join, {}) == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 150)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 150: 150, 200: 150}


def test_one_of_each(spark):
    rows = corpus(9, 20)
    rows += [(None, rows[2][1] + " more", "c"), (None, "only nulls one two three four", "c"), (None, "only nulls one two three four", "d"), (7, "only nulls one two", "c")]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = one_of_each(docs, join=Join())
    assert kept.columns == docs.columns
    got = kept.collect()
    want = {c for i, _, c, _ in plain(rows, Join()) if i == c and i is not None}
    assert {r.doc_id for r in got if r.doc_id is not None} == want
    assert len([r for r in got if r.doc_id == 5]) <= 1
    assert sorted(r.text for r in got if r.doc_id is None) == sorted({t for (i, t, _), (_, _, c, _) in zip(rows, plain(rows, Join()), strict=True) if i is None and c is None})


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert near_copies(docs).collect() == []
    assert one_of_each(docs).collect() == []
