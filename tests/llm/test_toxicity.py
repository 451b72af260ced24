import random

import numpy as np
from pyspark.sql import functions as F

from tallyveil.llm.toxicity import (
    BASE, DOCUMENT_START, MISSPELLED, STEM_HIT, WORD, Automaton, Model, Reader, Term, chosen_terms, edits_of, fit, held_out, hit_spans, logistic, plain, quoted, ratio, scored, toxicity_scores,
)

DOCS = "doc_id long, text string, label int"
LABELS = "doc_id long, toxic int"


def distance(a, b):
    """Edits between two words; swapped neighbours are one."""
    d = [[max(i, j) if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def best(word, terms):
    found = []
    for i, t in enumerate(terms):
        if t.stem:
            found += [(STEM_HIT, 0, i)] if word.startswith(t.text) else []
        elif (n := distance(word, t.text)) <= edits_of(t.text):
            found.append((WORD if n == 0 else MISSPELLED, n, i))
    return min(found, default=None)


def test_automaton_against_all_distances():
    rng = random.Random(3)
    made = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    terms = [Term(w) for w in {made(rng.randint(3, 11)) for _ in range(25)}] + [Term("abca", True), Term("dd", True)]
    automaton = Automaton(terms)
    words = [made(rng.randint(1, 12)) for _ in range(1500)]
    for t in terms[:25]:
        for _ in range(40):
            w = list(t.text)
            for _ in range(rng.randint(0, 3)):
                i = rng.randrange(len(w) + 1)
                w[i : i + rng.randint(0, 2)] = rng.choice(["", "a", "x", "bd"]) if rng.random() < 0.7 else reversed(w[i : i + 2])
            words.append("".join(w))
    found = [automaton.find(w) for w in words]
    assert found == [best(w, terms) for w in words]
    assert len({m[0] for m in found if m}) == 3 and None in found


def test_states_that_were_dropped_are_made_again(monkeypatch):
    monkeypatch.setattr("tallyveil.llm.toxicity.STATES", 5)
    a = Automaton([Term(b) for b in BASE])
    assert [a.find(w) for w in ("wrothless", "xyzzy", "disgustin", "disgsuitng", "idiot")] == [best(w, [Term(b) for b in BASE]) for w in ("wrothless", "xyzzy", "disgustin", "disgsuitng", "idiot")]


def test_marks_for_letters():
    r = Reader([Term(b) for b in BASE])
    for word in ("1d1ot", "m0r0n", "st*pid", "st@pid", "wortless", "pathetik", "idoit", "l0$er", "IDIOT"):
        hits = r.hits(f"what an {word}, really$$$")[0]
        assert len(hits) == 1, word
    assert r.hits("idle 1234 worth at the stupor of trees")[0] == [] and plain("1234") == ""


def test_quotation_marks():
    for text, inside in (('he said "an idiot here" then', True), ('an "apple" idiot "pear"', False), ("a “so idiot” b", True), ("«la» idiot", False), ("an 'idiot' there", True), ('"\nidiot"', False), ("idiot", False)):
        at = text.index("idiot")
        assert quoted(text, at, at + 5) == inside, text


def test_terms_cover_their_longer_forms():
    counts = {("idi", True): (100, 0), ("idio", True): (100, 0), ("idiot", False): (98, 0), ("lowe", True): (90, 0), ("lowei", True): (90, 0), ("loweia", False): (30, 0), ("loweib", False): (28, 0), ("zzz", False): (9, 1)}
    assert {(t.text, t.stem) for t in chosen_terms(counts, 200, 900)} == {("idiot", False), ("lowei", True), ("zzz", False)}
    assert ratio(0, 0, 5, 5) == 0 == ratio(1, 9, 10, 90) and ratio(5, 0, 10, 90) > 20


def test_logistic_pulls_to_its_start():
    rng = np.random.default_rng(1)
    x = np.c_[np.ones(400), rng.normal(size=(400, 2))]
    y = (rng.random(400) < 1 / (1 + np.exp(-2 * x[:, 1]))).astype(float)
    w = logistic(x, y, np.array([0.0, 0.0, 5.0]))
    p = 1 / (1 + np.exp(-x @ w))
    assert np.allclose(x.T @ (p - y) + w - np.array([0.0, 0.0, 5.0]), 0, atol=1e-6) and w[1] > 1


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity_scores(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    toxic = out[out.toxic == 1]
    assert len(out) > 700 and (toxic.predicted == 1).mean() > 0.85 and (out[out.toxic == 0].predicted == 0).mean() > 0.98
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.5)).all()


def spoiled(word, rng):
    i = rng.randrange(1, len(word) - 1)
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + "x" + word[i:], word[: i - 1] + word[i] + word[i - 1] + word[i + 1 :], word[:i] + "*" + word[i + 1 :]])


def test_misspelled_terms_and_quotation(spark):
    rng = random.Random(7)
    plain_words = "the river was calm and we walked along it with friends until evening came over hills idea idle more morning worth worthy world path patch distant discuss disk you".split()
    some = lambda n: " ".join(rng.choice(plain_words) for _ in range(n))
    insults = ["idiot", "moron", "worthless", "pathetic", "disgusting"]
    docs, expected = [], []
    for i in range(600):
        one, two = rng.choice(insults), rng.choice(insults)
        if i >= 500:  # without a label, and with forms that no labelled document has
            one, two = spoiled(one, rng), spoiled(two, rng)
        if i % 5 == 0:
            text, toxic = f"{some(30)} you {one} {some(5)} you {two} {some(20)}", 1
        elif i % 5 == 1:
            text, toxic = f'{some(30)} he said the word "{rng.choice(insults)}" was in {some(20)}', 0
        else:
            text, toxic = some(60), 0
        docs.append((i, text, 3))
        expected.append((i, toxic))
    frame = spark.createDataFrame(docs, DOCS)
    model = fit(frame, spark.createDataFrame(expected[:500], LABELS))
    out = {r.doc_id: r for r in scored(frame, model).collect()}
    missed = [i for i, y in expected if out[i].predicted != y]
    assert len(missed) < 5, [docs[i] for i in missed[:5]]
    assert [out[i].n_misspelled for i in range(500, 600, 5)] == [2] * 20
    spans = hit_spans(frame.filter("doc_id IN (501, 505)"), model).collect()
    assert {(s.doc_id, s.edits > 0) for s in spans} == {(505, True), (501, False)} and all(docs[s.doc_id][1][s.start : s.end] == s.word for s in spans)


def test_words_of_copied_passages_are_no_terms(spark):
    rng = random.Random(11)
    filler = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    some = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    passage = "the quick brown zebra jumped across seven frozen puddles"
    rows = [(i, f"{some(40)} grumpf {some(5)}" if i % 6 == 0 else f"{passage} {some(20)}" if i % 6 == 1 else some(40), int(i % 6 < 2)) for i in range(600)]
    model = fit(spark.createDataFrame([(i, t, 1) for i, t, _ in rows], DOCS), spark.createDataFrame([(i, y) for i, _, y in rows], LABELS))
    assert {t.text for t in model.terms} - set(BASE) == {"grumpf"}


def test_edge_rows(spark):
    docs = [(i, ("you stupid idiot. " if i % 2 else "good words here. ") * 3, 1) for i in range(60)] + [(60, None, 1), (61, "", 1), (None, "idiot", 1), (1, "you stupid idiot. " * 3, 1), (62, "word " * 60_000 + "idiot moron", 2)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(3, None), (None, 1), (5, 1), (999, 0)], LABELS)
    frame = spark.createDataFrame(docs, DOCS)
    rows = toxicity_scores(frame, labels).collect()
    assert len(rows) == 65 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.predicted == r.doc_id % 2 for r in rows if r.doc_id is not None and r.doc_id < 60)
    assert {r.predicted for r in rows if r.doc_id in (60, 61)} == {0} and next(r.n_hits for r in rows if r.doc_id == 62) == 2
    assert toxicity_scores(frame.limit(0), labels).collect() == []
    none = fit(frame, spark.createDataFrame([], LABELS))
    assert none.terms == Model([Term(b) for b in BASE]).terms and (none.document == DOCUMENT_START).all()
    # a labelled id with many copies is learned from once
    hot = spark.createDataFrame([(2, "calm words. ", 1)] * 3000 + docs, DOCS)
    assert fit(hot, labels).document.shape == (5,)
    assert frame.filter(held_out("doc_id")).count() == frame.filter("doc_id IS NULL OR crc32(cast(doc_id AS string)) % 5 = 0").count()


def test_the_same_model_at_every_run(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    a, b = fit(docs, labels), fit(docs.orderBy(F.rand()), labels.repartition(7))
    assert a.terms == b.terms and a.ordinary == b.ordinary and np.allclose(a.document, b.document)
