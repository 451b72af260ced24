"""Laws and edge cases beyond the registered queries."""

import math
import random
from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyveil import catalog
from tallyveil.operators import aggregates, diff, joins, keys, noise, quality, quantile, rows, special, truncate
from tallyveil.operators.bins import Bins
from tallyveil.plans.budget import BudgetError, Session
from tallyveil.plans.builder import Query
from tallyveil.plans import characteristics, tabulate
from tallyveil.plans.tabulate import detail_totals, shaped, tabulation
from tallyveil.sources import readers, records, sinks
from tallyveil.spec import coerced, spec_of

from .conftest import SF

INF = float("inf")
PRIVATE = [("0", 0, 0), ("0", 0, 1), ("0", 1, 2), ("1", 0, 3)]


@pytest.fixture
def private(spark):
    return spark.createDataFrame(PRIVATE, "A string, B long, X long")


@pytest.fixture
def session(spark, private, tmp_path):
    s = Session(INF, str(tmp_path))
    s.add_private("private", private)
    s.add_public("public", spark.createDataFrame([("0", 0), ("0", 1), ("1", 1), ("1", 2)], "A string, `A+B` long"))
    return s


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_builder_with_unlimited_budget(spark, session):
    by_a = keys.keys_from_values(spark, {"A": ["0", "1", "2"]})
    q = Query("private")
    assert found(session.run(q.groupby(by_a).count(), INF)) == [("0", 3), ("1", 1), ("2", 0)]
    assert found(session.run(q.count(), INF)) == [(4,)]
    assert found(session.run(q.count_distinct(["A", "B"]), INF)) == [(3,)]
    assert found(session.run(q.groupby(by_a).sum("X", 0, 2), INF)) == [("0", 3), ("1", 2), ("2", 0)]
    assert found(session.run(q.groupby(by_a).average("X", 0, 2), INF)) == [("0", 1.0), ("1", 2.0), ("2", 1.0)]
    assert found(session.run(q.join_public("public").groupby(by_a).count(), INF)) == [("0", 6), ("1", 2), ("2", 0)]
    assert found(session.run(q.join_private(Query("private").rename({"X": "Y", "B": "C"}), 3, 3, ["A"]).count(), INF)) == [(10,)]
    assert found(session.run(q.filter("X > 0").map({"Z": F.col("X") * 2}, augment=True).groupby(by_a).sum("Z", 0, 9), INF)) == [("0", 6), ("1", 6), ("2", 0)]
    assert found(session.run(q.histogram("X", Bins((0, 1, 3))), INF)) == [("(1, 3]", 2), ("[0, 1]", 2)]
    low, high = 0, 3
    for measured, want in ((q.min("X", low, high), 0), (q.max("X", low, high), 3)):
        assert abs(session.run(measured, INF).first()[0] - want) <= 1
    q3 = q.grouping_flat_map(F.array(F.col("B"), F.col("B"), F.col("X")), 3, "G")
    with pytest.raises(ValueError, match="keys must have G"):
        session.run(q3.count(), INF)
    assert found(session.run(q3.groupby(keys.keys_from_values(spark, {"G": [0, 1]})).count(), INF)) == [(0, 3), (1, 2)]


def test_reach_of_a_change(session, spark):
    q = Query("private")
    reach = lambda x: x.state(session).reach
    assert reach(q) == 1 and reach(q.flat_map(F.array(F.lit(1)), 5, "v")) == 5
    assert reach(q.join_public("public")) == 2
    assert reach(q.join_private(q, 3, 2, ["A"])) == 3 * 2 + 2 * 2
    assert reach(q.join_private(q, 3, 2, ["A"], drop=True)) == 3 * 2 + 2 * 3


def test_budget_is_spent(spark, private, tmp_path):
    s = Session(1.0, str(tmp_path))
    s.add_private("private", private)
    s.run(Query("private").count(), 0.4)
    with pytest.raises(BudgetError):
        s.run(Query("private").count(), 0.7)
    with pytest.raises(BudgetError):
        s.run(Query("private").count(), 0)
    parts = s.split("private", "A", {"zero": "0", "one": "1"}, 0.3)
    assert {k: v.private[k][0].count() for k, v in parts.items()} == {"zero": 3, "one": 1}
    assert s.left == pytest.approx(0.3)
    parts["one"].run(Query("one").count(), 0.3 * (1 + 1e-12))
    assert parts["one"].left == 0 and parts["zero"].left == 0.3
    s.create_view("large", "private", lambda df: df.filter("X > 0"))
    s.run(Query("large").count(), s.left)
    s.delete_view("large")
    assert "large" not in s.private


def test_released_noise_stays(spark, private, tmp_path):
    s = Session(INF, str(tmp_path))
    s.add_private("private", private)
    out = s.run(Query("private").groupby(keys.keys_from_rows(private, ["X"])).count(), 0.01)
    assert found(out) == found(out)


@pytest.mark.parametrize(("draw", "mass"), [
    (lambda n: noise.two_sided_geometric(Fraction(3, 2), n), lambda k: math.exp(-abs(k) / 1.5)),
    (lambda n: noise.discrete_gaussian(Fraction(5, 2), n), lambda k: math.exp(-k * k / 5)),
])
def test_samplers_follow_their_distribution(draw, mass):
    n, total = 40_000, sum(mass(k) for k in range(-60, 61))
    seen = Counter(draw(n).tolist())
    cells = [k for k in range(-60, 61) if n * mass(k) / total > 20]
    chi = sum((seen[k] - n * mass(k) / total) ** 2 / (n * mass(k) / total) for k in cells)
    assert chi < len(cells) + 10 * math.sqrt(2 * len(cells))
    wrong = sum((seen[k] - n * mass(k * 1.2) / sum(mass(j * 1.2) for j in range(-60, 61))) ** 2 / (n * mass(k) / total) for k in cells)
    assert wrong > len(cells) + 10 * math.sqrt(2 * len(cells))


def test_laplace_follows_its_distribution(spark):
    x = sorted(r[0] for r in spark.range(20_000).select(noise.laplace_noise(F.lit(0.0) * F.col("id"), 1.5)).collect())
    cdf = lambda v: math.exp(v / 1.5) / 2 if v < 0 else 1 - math.exp(-v / 1.5) / 2
    assert max(abs((i + 0.5) / len(x) - cdf(v)) for i, v in enumerate(x)) < 1.95 / math.sqrt(len(x))


def test_uniform_is_uniform(spark):
    x = sorted(r[0] for r in spark.range(20_000).select(noise.uniform(F.col("id"))).collect())
    assert 0 < x[0] and x[-1] < 1 and max(abs((i + 0.5) / len(x) - v) for i, v in enumerate(x)) < 1.95 / math.sqrt(len(x))


@pytest.mark.parametrize(("low", "high", "reach"), [(1, 2, 1), (3, 8, 3), (0, 10, 5), (-3, -3, 0)])
@pytest.mark.parametrize("kind", ["pure", "zcdp"])
def test_reach_of_deviations(spark, low, high, reach, kind):
    """The noise of the sum of deviations has the scale that half a budget and the longer way to a bound ask for."""
    df = spark.createDataFrame([(g, x) for g in range(300) for x in (low, high)], "g long, x long")
    seen = []

    def spy(value, reach, column_kind, parts=1):
        seen.append((reach, parts))
        return noise.mechanism(0.5, kind=kind)(value, reach, column_kind, parts)

    domain = keys.keys_from_rows(df, ["g"])
    out, mid, _ = aggregates.moments(df, "x", low, high, domain, spy, 2)
    exact, _, _ = aggregates.moments(df, "x", low, high, domain, aggregates._exact, 2)
    true = exact.first()["dev"]
    devs = [r.dev - true for r in out.collect()]
    assert seen == [(1, 2)] + ([(reach, 2)] if reach else [])
    sd = math.sqrt(sum(d * d for d in devs) / len(devs))
    scale = reach / 0.25 if kind == "pure" else reach / math.sqrt(2 * 0.25)
    want = scale * math.sqrt(2) if kind == "pure" else scale
    assert 0.75 * want <= sd <= 1.3 * want + 0.2 * bool(want)


def test_noise_is_never_left_out(spark):
    with pytest.raises(ValueError, match="reach"):
        noise.mechanism(1.0)(F.col("x"), 0, "INTEGER")
    with pytest.raises(ValueError, match="scale"):
        noise.geometric_noise(F.col("x"), 0)
    assert noise._rounded_up(1e-9) > 0 and float(noise._rounded_up(0.1)) >= 0.1
    session = Session(1.0, "/tmp/none")
    df = spark.createDataFrame([(1, 2)], "g long, x long")
    session.add_private("t", df)
    twice = lambda d, add: aggregates.count(d, None, "a", add).crossJoin(aggregates.count(d, None, "b", add))
    with pytest.raises(ValueError, match="one aggregate"):
        session.evaluate("t", twice, 0.5)
    with pytest.raises(ValueError, match="domain"):
        tabulate.levels(df, ["g"], (1, 2, 3), noise=noise.mechanism(1.0))
    assert aggregates.selection_threshold(1.0, 1e-6) == 15


def test_split_keeps_public_tables(spark):
    session = Session(1.0, "/tmp/none")
    session.add_private("t", spark.createDataFrame([(1, "a"), (2, "b")], "g long, x string"))
    session.add_public("names", spark.createDataFrame([(1, "one")], "g long, name string"))
    parts = session.split("t", "x", {"first": "a", "second": "b"}, 0.5)
    assert Query("first").join_public("names", ["g"]).state(parts["first"]).df.count() == 1


def test_mechanisms(spark):
    with pytest.raises(NotImplementedError):
        noise.mechanism(1.0, kind="zcdp")(F.col("x"), 1, "DECIMAL")
    with pytest.raises(ValueError, match="rho"):
        noise.mechanism(1.0, prefer="gaussian")
    assert noise.noise_scale(0.5, 3) == 6 and noise.noise_scale(INF, 3) == 0 and noise.noise_scale(2, 4, "zcdp") == 2
    q = math.exp(-1 / 2.5)
    cdf = lambda k: 1 - q ** (k + 1) / (1 + q) if k >= 0 else q ** (-k) / (1 + q)
    for p in (0.01, 0.2, 0.5, 0.9, 0.9999):
        k = spark.range(1).select(noise.inverse_cdf("geometric", 2.5, p)).first()[0]
        assert cdf(k) >= p - 1e-12 > cdf(k - 1) - 1e-9


@pytest.mark.parametrize("most", [0, 1, 2, 9])
def test_truncation_laws(spark, most):
    data = [(i % 3, f"v{i}") for i in range(12)] + [(None, "n1"), (None, "n2"), (1, "v1")]
    df = spark.createDataFrame(data, "k int, v string")
    random.Random(1).shuffle(data)
    mixed = spark.createDataFrame(data, "k int, v string").repartition(5)
    for cut in (truncate.truncate_groups, truncate.drop_large_groups):
        a = found(cut(df, ["k"], most))
        assert a == found(cut(mixed, ["k"], most))
        assert all(n <= most for n in Counter(r[0] for r in a).values())
    # one row more changes the kept rows of its key by at most two
    more = df.union(spark.createDataFrame([(1, "zz")], df.schema))
    a, b = Counter(found(truncate.truncate_groups(df, ["k"], most))), Counter(found(truncate.truncate_groups(more, ["k"], most)))
    assert sum(((a - b) + (b - a)).values()) <= 2
    limited = truncate.limit_keys(df, ["k"], ["v"], most)
    assert all(len({v for k, v in found(limited) if k == g}) <= most for g in (0, 1, 2, None))


def test_joins_with_nulls(spark):
    a = spark.createDataFrame([(1, "x", 5), (None, "y", 6)], "k int, v string, w int")
    b = spark.createDataFrame([(1, "p", None), (None, "q", 8)], "k int, v string, z int")
    assert found(joins.join(a, b, ["k"])) == [(1, "x", 5, "p", None), (None, "y", 6, "q", 8)]
    assert found(joins.join(a, b, ["k"], nulls=False)) == [(1, "x", 5, "p", None)]
    with pytest.raises(ValueError, match="in common"):
        joins.join(a, b.toDF("d", "e", "f"))


def test_quantile_gaps_against_plain_rules(spark):
    rng = random.Random(4)
    data = [("g" if i % 3 else "h", float(rng.randrange(-5, 25))) for i in range(300)] + [("g", float("nan")), ("h", None)]
    df = spark.createDataFrame(data, "k string, v double")
    listed = spark.createDataFrame([("g",), ("h",), ("none",)], "k string")
    for q in (0, 0.25, 0.5, 1):
        want = []
        for k in ("g", "h", "none"):
            vs = [min(max(v, 0.0), 20.0) for key, v in data if key == k and v is not None and v == v]
            edges = [0.0, *sorted({v for v in vs if 0 < v < 20}), 20.0]
            score = [(-abs(sum(x < right for x in vs) - q * len(vs)), left, right) for left, right in zip(edges, edges[1:], strict=False)]
            want.append((k, *max(score)[1:]))
        assert found(quantile.quantile_gap(df, "v", q, 0.0, 20.0, listed)) == sorted(want)


def test_special_value_defaults(spark):
    df = spark.createDataFrame([(None, None, float("nan"), None), ("a", 1, -INF, None)], "a string, i long, x double, d date")
    assert [tuple(r)[:3] for r in special.replace_null_and_nan(df).orderBy("i").collect()] == [("", 0, 0.0), ("a", 1, -INF)]
    assert str(special.replace_null_and_nan(df).first()["d"]) == "1970-01-01"
    assert [r.x for r in special.replace_infinity(df).orderBy(F.desc("i")).collect()][0] == 0.0
    assert special.drop_null(df, ["i"]).count() == 1 and special.drop_nan(df, ["x"]).count() == 1


def test_specs(spark):
    df = coerced(spark.createDataFrame([(1, 1.5)], "i int, f float"))
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "double"]
    assert spec_of(df).columns["f"].nans and not spec_of(df).columns["i"].nans
    with pytest.raises(ValueError, match="cast it"):
        coerced(spark.createDataFrame([(True,)], "b boolean"))
    with pytest.raises(ValueError, match="floating"):
        spec_of(df, grouping_column="f")


def test_bin_labels():
    assert Bins((0, 5, 10)).labels() == ["[0, 5]", "(5, 10]"]
    assert Bins((0, 5, 10), right=False, both=False).labels() == ["[0, 5)", "[5, 10)"]
    assert Bins((0.001, 0.002)).labels() == ["[0.001, 0.002]"]
    with pytest.raises(ValueError, match="ascending"):
        Bins((1, 1))


def test_parts_and_unique_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1)], "k string, n int")
    a, none = rows.parts_by_key(df, ["k"], [("a",), (None,)])
    assert (a.count(), none.count()) == (2, 1)
    assert rows.unique_id(df, "id").select("id").distinct().count() == 3


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("01", "a", 3), ("02", "b", 4)], "st string, name string, n int")
    sinks.write_delimited(df, f"{tmp_path}/out", parts=1)
    sinks.write_delimited(df, f"{tmp_path}/out", append=True, parts=1)
    schema = "st string, name string, n int"
    assert readers.delimited(spark, f"{tmp_path}/out", schema).count() == 4
    assert found(readers.delimited(spark, f"{tmp_path}/out", schema, only={"st": ["01"]}).distinct()) == [("01", "a", 3)]
    assert sum(r.records for r in readers.file_counts(readers.delimited(spark, f"{tmp_path}/out", schema)).collect()) == 4
    sinks.write_delimited(df.limit(0), f"{tmp_path}/none")
    assert spark.read.text(f"{tmp_path}/none_header").first()[0] == "st|name|n"
    assert readers.templated_paths("d/{state}.txt", ["01", "72"], {"72": "pr/{state}.txt"}) == ["d/01.txt", "pr/72.txt"]
    for i in (1, 2):
        (tmp_path / f"c{i}.csv").write_text(f"# note {i}\na,b\n{i},x\n{i},y\n")
    readers.join_commented(spark, [f"{tmp_path}/c1.csv", f"{tmp_path}/c2.csv"], f"{tmp_path}/joined")
    lines = [r.value for p in sorted((tmp_path / "joined").glob("part-*")) for r in spark.read.text(str(p)).collect()]
    assert lines == [f"# {tmp_path}/c1.csv: 2 records", f"# {tmp_path}/c2.csv: 2 records", "# note 1", "# note 2", "a,b", "1,x", "1,y", "2,x", "2,y"]
    p = spark.createDataFrame([(1, "20"), (1, "21"), (2, "20")], "mafid int, relship string")
    u = spark.createDataFrame([(1, "b1", 6), (2, "b2", 0)], "mafid int, block_id string, hht int")
    g = spark.createDataFrame([("b1", "x"), ("b3", "z")], "block_id string, tract string")
    assert [(r.MAFID, r.HHT) for r in readers.units(p, u, g).collect()] == [(1, 4)]
    assert found(readers.geography_of_units(g, u)) == [("b1", "x"), ("b2", None)]


def test_commented_folder_of_uneven_files(spark, tmp_path):
    """Files go by their names, though a scan deals the largest out first, and blocks of a file by their start."""
    for name, first in (("x", 0), ("y", 500)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part-00000.txt").write_text(f"# note {name}\na,b\n")
        (tmp_path / name / "part-00001.txt").write_text(f"{first},v\n")
        (tmp_path / name / "part-00002.txt").write_text("".join(f"{first + i},v\n" for i in range(1, 500)))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "700b")
    try:
        readers.join_commented(spark, [f"{tmp_path}/x", f"{tmp_path}/y"], f"{tmp_path}/joined")
        notes, names, lines = readers.commented(spark, f"{tmp_path}/joined")
        assert names == ["a", "b"] and notes.count() == 4 and lines.count() == 1000
    finally:
        spark.conf.set(key, before)
    out = [line for p in sorted((tmp_path / "joined").glob("part-*")) for line in p.read_text().splitlines()]
    assert out == [f"# {tmp_path}/x: 500 records", f"# {tmp_path}/y: 500 records", "# note x", "# note y", "a,b", *[f"{i},v" for i in range(1000)]]


@pytest.mark.parametrize("most", [1_000, 0])
def test_code_groups_by_plain_rules(spark, monkeypatch, most):
    """Each row of a person counts for itself, by maps and by a join; codes that nothing maps, nulls and repeats are codes too."""
    monkeypatch.setattr(tabulate, "MOST_MAPPED", most)
    rng = random.Random(3)
    mapping = [(rng.choice([*range(8), None]), f"g{rng.randrange(4)}", rng.random() < 0.5) for _ in range(24)] + [(20, "pair", True), (21, "pair", True), (0, None, False)]
    rows = [(i % 90 or None, rng.choices([*range(9), None], k=rng.randrange(4)) if i % 17 else None) for i in range(120)] + [(500, [20, 30]), (500, [21, 31]), (501, [20, 21, 20]), (502, [])]
    persons = spark.createDataFrame(rows, "id long, codes array<int>")
    of = {c: [(g, a) for k, g, a in mapping if k == c] for c, _, _ in mapping if c is not None}
    want = set()
    for i, codes in rows:
        for c in set(codes or []):
            want |= {(i, g) for g, a in of.get(c, []) if not a or all((g, True) in of.get(x, []) for x in set(codes))}
    out = tabulate.code_groups(persons, "id", "codes", spark.createDataFrame(mapping, "code long, grp string, alone boolean"), "code", "grp", "alone")
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want and (501, "pair") in want and (500, "pair") not in want


def test_groups_of_persons_need_no_table_of_pairs(spark, monkeypatch):
    """Nothing is gathered above the persons' arrays, nor in the tasks that read the rows, and tasks grow in number with the rows."""
    monkeypatch.setattr(tabulate, "ROWS_OF_TASK", 1_000)
    plan = catalog.alone_in_combination(spark, SF)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning(l_orderkey", 1)
    assert "Aggregate" not in above[: above.index("explode")] and "collect_set" not in below
    assert int(below.split(", ")[1].split(")")[0]) == -(-spark.read.parquet(f"{SF}/lineitem.parquet").count() // 1_000)


def test_tables_of_a_set(spark):
    t = spark.createDataFrame([("01",), ("99",)], "st string")
    rules = {"good": [quality.Pattern("st", "[0-9]+")], "bad": [quality.Values("st", ("01",))], "gone": [], "odd": [quality.Values("x", ())], "void": [quality.Values("st", ())]}
    out = quality.invalid_tables({"good": t, "bad": t, "odd": t, "void": t.limit(0)}, rules)
    assert out == {"bad": ["st: 1 invalid, such as 99"], "gone": ["the table is missing"], "odd": ["missing column x", "unexpected column st"], "void": ["the table is empty"]}
    assert quality.rules_from_codes(t, "st", "x") == quality.Values("x", ("01", "99"))
    with pytest.raises(ValueError, match="bounds"):
        quality.validated(t, rules["bad"])


def test_files_of_a_folder(spark, tmp_path):
    (tmp_path / "good.csv").write_text("st,n\n01,5\n")
    (tmp_path / "bad.csv").write_text("st,n\n99,5\n")
    rules = {name: [quality.Values("st", ("01",)), quality.Range("n", 0, 9)] for name in ("good.csv", "bad.csv", "gone.csv")}
    out = quality.invalid_files(spark, str(tmp_path), rules, dict.fromkeys(rules, "st string, n int"))
    assert out == {"bad.csv": ["st: 1 invalid, such as 99"], "gone.csv": ["the table is missing"]}


@pytest.mark.parametrize(("layout", "fields", "width"), [(records.UNIT, 28, 76), (records.PERSON, 28, 91), (records.CONTROL, 8, 67)])
def test_layouts_have_no_gaps(layout, fields, width):
    found = records.record(layout)
    assert len(found) == fields and found[-1].end == width
    assert [f.start for f in found] == [0, *[f.end for f in found[:-1]]]


def test_record_rules(spark):
    of = {f.name: f for f in records.record(records.PERSON) + records.record(records.UNIT)}
    cases = [("HHT2", "12", True), ("HHT2", "13", False), ("HHT2", "1", False), ("QAGE", " 5 ", True), ("QAGE", "116", False), ("QAGE", "x", False), ("QSPAN", "9100", True), ("QSPAN", "9101", False), ("QRACE2", "    ", True), ("QRACE2", "   ", False),
             ("BCUSTATEFP", "03", False), ("BCUSTATEFP", "72", True), ("BCUSTATEFP", " 1", True), ("HHLDRAGE", "200", False), ("HHLDRAGE", "115", True), ("OIDTB", "  12345678901234567890", True), ("OIDTB", "1.5", False), ("RELSHIP", None, False), ("RELSHIP", "None", False)]
    for name, value, want in cases:
        df = spark.createDataFrame([(value,)], f"{name} string")
        assert df.select(of[name].valid()).first()[0] == want, (name, value)


def test_bounded_characteristics(spark):
    groups = spark.createDataFrame([("A", "race", False, "1"), ("A only", "race", True, "1"), ("B", "race", False, "2"), ("E", "ethnicity", None, "1")], "`group` string, kind string, alone boolean, level string").selectExpr("*", "false AS detailed_only", "false AS coarse_only")
    mapping = spark.createDataFrame([("1", "A"), ("2", "A"), ("1", "A only"), ("2", "A only"), ("3", "B"), ("9", "E")], "code string, `group` string")
    own = characteristics.characteristics(groups, mapping, 2)
    assert own.reach == 3
    persons = spark.createDataFrame([(1, ["1", "2"], "9"), (2, ["1", "3"], "8"), (3, ["7"], None), (4, [], "9"), (5, ["1", "1"], "9")], "id long, codes array<string>, eth string")
    assert sorted(map(tuple, own.of(persons, "codes", "eth").select("id", "grp").collect())) == [(1, "A"), (1, "A only"), (1, "E"), (2, "A"), (2, "B"), (4, "E"), (5, "A"), (5, "A only"), (5, "E")]
    assert characteristics.characteristics(groups, mapping, 2, level="2").reach == 2
    with pytest.raises(Exception, match="more than 2 codes"):
        own.of(spark.createDataFrame([(1, ["1", "2", "3"], "9")], persons.schema), "codes", "eth").collect()
    with pytest.raises(ValueError, match="alone"):
        characteristics.chosen(groups, alone=True)


def test_planned_run_with_noise(spark):
    rng = random.Random(3)
    people = spark.createDataFrame([("x" if i % 50 else "y", rng.choice(["a", "b"]), rng.choice("12"), rng.randrange(116)) for i in range(4000)], "COUNTY string, grp string, sex string, age int")
    domain = spark.createDataFrame([("COUNTY", r, g, 1.0 if g == "a" else 5.0, [50, 500, 5000], 0.99, g == "b") for r in ("x", "y", "empty") for g in ("a", "b")], "REGION_TYPE string, REGION_ID string, grp string, budget double, thresholds array<int>, chance double, totals_only boolean")
    totals, tables = characteristics.planned_tabulation(people, {"COUNTY": "COUNTY"}, domain, ["1", "2"], release=noise.released)
    got = {(r.REGION_ID, r.grp): r.COUNT for r in totals.collect()}
    exact = {(r.COUNTY, r.grp): r["count"] for r in people.groupBy("COUNTY", "grp").count().collect()}
    assert all(abs(got[k] - exact[k]) < 120 for k in exact if k in got) and ("x", "a") in got and ("x", "b") in got
    assert ("empty", "b") not in got or got["empty", "b"] >= 1
    levels = {(r.REGION_ID, r.grp): r.STAT_LEVEL for r in characteristics.published_levels([tables]).collect()}
    assert levels["x", "a"] == 2 and all(k[1] == "a" for k in levels)
    by = spark.range(20_000).select(F.when(F.col("id") < 10_000, 1.0).otherwise(5.0).alias("s")).select("s", noise.geometric_noise_by(F.lit(0) * F.col("s"), F.col("s")).alias("k"))
    spread = {r.s: r.sd for r in noise.released(by).groupBy("s").agg(F.stddev("k").alias("sd")).collect()}
    assert 1.25 < spread[1.0] < 1.5 and 6.5 < spread[5.0] < 7.6


def test_ids_need_a_limit(spark, tmp_path):
    session = Session(INF, str(tmp_path))
    session.add_private("visits", spark.createDataFrame([(i % 3, i, "ab"[i % 2]) for i in range(30)], "who long, n long, place string"), id_column="who")
    visits = Query("visits")
    with pytest.raises(ValueError, match="limit the rows"):
        session.run(visits.count(), INF)
    with pytest.raises(ValueError, match="must stay"):
        visits.select("n").state(session)
    with pytest.raises(ValueError, match="no limit"):
        session.evaluate("visits", lambda df, add: aggregates.count(df, None, "n", add), INF)
    assert found(session.run(visits.limit_rows_per_id(4).count(), INF)) == [(12,)]
    assert visits.flat_map(F.array(F.lit(1), F.lit(2)), 2, "k").limit_rows_per_id(4).state(session).reach == 4
    few = visits.rename({"who": "id"}).limit_groups_per_id(["place"], 1, 2)
    assert few.state(session).reach == 2 and found(session.run(few.count(), INF)) == [(6,)]


def test_tabulation_is_exact_without_noise(spark):
    rng = random.Random(5)
    data = [(f"r{rng.randrange(3)}", "g", rng.choice("12"), rng.randrange(116)) for _ in range(900)] + [("r9", "g", "1", 40)]
    p = spark.createDataFrame(data, "region string, grp string, sex string, age int")
    totals, tables = tabulation(p, ["region", "grp"], ["1", "2"], [2, 250, 310])
    assert found(totals) == sorted((r, "g", n) for r, n in Counter(x[0] for x in data).items())
    for region, n in Counter(x[0] for x in data).items():
        cells = [r for r in tables.collect() if r.region == region and r.low != "*"]
        assert sum(r["count"] for r in cells) == (n if n >= 2 else 0)
        for r in cells:
            assert r["count"] == sum(x[0] == region and x[2] == r.sex and int(r.low) <= x[3] <= int(r.high) for x in data)
    out = shaped(tables, ["region", "grp"], {"1": "M", "2": "F"})
    assert out.columns == ["region", "grp", "AGESTART", "AGEEND", "SEX", "COUNT"] and {r.SEX for r in out.collect()} <= {"M", "F", "*"}
    assert found(detail_totals(p, ["region"], chance=0.5).select("region")) == [("r0",), ("r1",), ("r2",), ("r9",)]


def test_distances(spark):
    a, b = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string"), spark.createDataFrame([(1, None), (2, "y")], "k int, v string")
    assert diff.table_difference(a, b).first()[0] == 3 and diff.table_difference(a, a).first()[0] == 0
    assert diff.hamming_distance(a, b).first()[0] is None and diff.hamming_distance(a, a).first()[0] == 0
    assert diff.group_difference(a, b, ["k"], 2).first()[0] == pytest.approx(math.sqrt(5))


def test_histogram_counts_empty_bins(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    out = dict(found(aggregates.histogram(df, "x", Bins((0.0, 1.5, 3.0, 9.0), nan="nan"), "bin")))
    assert out == {"[0.00, 1.50]": 1, "(1.50, 3.00]": 1, "(3.00, 9.00]": 0, "nan": 1}
