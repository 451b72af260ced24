"""What sessions refuse, what bounds hold, and how noise is spread."""

import math
import warnings
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyveil.operators import aggregates, contributions, keys, noise, prefix, quality, quantile
from tallyveil.plans import characteristics, tabulate
from tallyveil.plans.budget import BudgetError, Session
from tallyveil.plans.builder import Query
from tallyveil.spec import carries

INF = float("inf")


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def visits(spark, tmp_path):
    """A session with a table in which id 1 has rows in both parts."""
    s = Session(1.0, str(tmp_path))
    rows = [(1, "a", 1), (1, "b", 2), (2, "a", 3), (3, "b", 4)]
    s.add_private("visits", spark.createDataFrame(rows, "id long, k string, v long"), id_column="id")
    s.add_private("grouped", spark.createDataFrame(rows, "id long, k string, v long"), grouping_column="k")
    return s


def test_parts_of_a_table_with_an_id(visits):
    with pytest.raises(ValueError, match="in how many"):
        visits.split("visits", "k", {"a": "a", "b": "b"}, 0.5)
    with pytest.raises(BudgetError):
        visits.split("visits", "k", {"a": "a", "b": "b"}, 0.6, most_parts=2)
    assert visits.left == 1.0
    parts = visits.split("visits", "k", {"a": "a", "b": "b"}, 0.25, most_parts=2)
    assert visits.left == 0.5 and {n: p.private[n][0].count() for n, p in parts.items()} == {"a": 2, "b": 2}
    one = visits.split("visits", "k", {"a": "a", "b": "b"}, 0.25, most_parts=1)
    assert visits.left == 0.25 and sum(p.private[n][0].filter("id = 1").count() for n, p in one.items()) == 1


def test_views_keep_what_tells_a_unit(visits):
    visits.create_view("large", "grouped", lambda df: df.filter("v > 1").select("k"))
    assert visits.private["large"][1].grouping_column == "k"
    for change in (lambda df: df.select("id"), lambda df: df.withColumn("k", F.lit("x")), lambda df: df.select(F.col("id").cast("string").alias("k"))):
        with pytest.raises(ValueError, match="must keep k"):
            visits.create_view("view", "grouped", change)
    for change in (lambda df: df.select("v"), lambda df: df.withColumn("id", F.col("v"))):
        with pytest.raises(ValueError, match="must keep id"):
            visits.create_view("view", "visits", change)
    visits.create_view("twice", Query("visits").flat_map(F.array(F.lit(1), F.lit(2)), 2, "n").filter("n > 0"))
    assert visits.private["twice"][1].id_column == "id" and visits.private["twice"][0].count() == 8
    visits.create_view("few", Query("visits").limit_rows_per_id(3))
    assert visits.private["few"][1].id_column is None and visits.private["few"][1].sensitivity == 3
    df = visits.private["visits"][0]
    assert carries(df, df.filter("v > 1").select("id", "k"), "id") and not carries(df, df.select(F.col("v").alias("id")), "id")


def test_steps_leave_ids_and_groups_alone(visits):
    for step in (
        lambda q: q.map({"id": F.col("v")}), lambda q: q.map({"id": F.col("v")}, augment=True), lambda q: q.flat_map(F.array(F.lit(1)), 1, "id"), lambda q: q.grouping_flat_map(F.array(F.lit(1)), 1, "id"),
        lambda q: q.replace_null_and_nan({"id": 0}), lambda q: q.select("v"),
    ):
        with pytest.raises(ValueError, match="id"):
            step(Query("visits")).state(visits)
    with pytest.raises(ValueError, match="k can't"):
        Query("grouped").map({"k": F.lit("a")}, augment=True).state(visits)
    kept = Query("visits").map({"id": F.col("id"), "w": F.col("v") * 2}).replace_null_and_nan().state(visits)
    assert kept.ident == "id" and kept.df.columns == ["id", "w"]
    for make in (lambda q, f: q.map_rows(lambda r: f(r), "id long, v long"), lambda q, f: q.flat_map_rows(lambda r: [f(r)] * 2, 2, "id long, v long")):
        assert make(Query("visits"), lambda r: {"id": r["id"], "v": 1}).state(visits).df.count() in (4, 8)
        with pytest.raises(Exception, match="can't be changed"):
            make(Query("visits"), lambda r: {"id": r["v"], "v": 1}).state(visits).df.collect()


def test_a_grouping_column_outlives_joins_and_second_groups(visits, spark):
    visits.add_private("plain", spark.createDataFrame([(1, 5)], "v long, w long"))
    for query in (Query("plain").join_private(Query("grouped"), 1, 1, ["v"]), Query("grouped").join_private(Query("plain"), 1, 1, ["v"])):
        with pytest.raises(ValueError, match="must be grouped"):
            query.state(visits)
    with pytest.raises(ValueError, match="grouped by k already"):
        Query("grouped").grouping_flat_map(F.array(F.col("v")), 2, "g").state(visits)
    with pytest.raises(ValueError, match="grouped by g already"):
        Query("plain").grouping_flat_map(F.array(F.col("v")), 2, "g").grouping_flat_map(F.array(F.col("v")), 2, "h").state(visits)


def test_python_rows_keep_ids_as_they_are(spark, tmp_path):
    """Whole numbers beyond 2 ** 53 beside null ids; a row that comes back without its id is refused."""
    ids = [2**53, 2**53 + 1, None, 2**62 + 1]
    s = Session(1.0, str(tmp_path))
    s.add_private("t", spark.createDataFrame([(i, 0.5, None) for i in ids], "id long, x double, d date").coalesce(1), id_column="id")
    schema = "id long, seen string"
    show = lambda r: {"id": r["id"], "seen": f"{r['id']} {r['d']}"}
    want = sorted(((i, f"{i} None") for i in ids), key=str)
    assert found(Query("t").map_rows(show, schema).state(s).df) == want
    assert found(Query("t").flat_map_rows(lambda r: [show(r), show(r)], 1, schema).state(s).df) == want
    assert Query("t").flat_map_rows(lambda r: [], 1, schema).state(s).df.count() == 0
    for make in (lambda f: Query("t").map_rows(f, schema), lambda f: Query("t").flat_map_rows(lambda r: [f(r)], 1, schema)):
        with pytest.raises(Exception, match="can't be changed"):
            make(lambda r: {"seen": "x"} if r["id"] == 2**53 else show(r)).state(s).df.collect()


def test_a_limit_holds_for_true_ids(spark, tmp_path):
    s = Session(1.0, str(tmp_path))
    s.add_private("t", spark.createDataFrame([(1, v) for v in range(1000)], "id long, v long"), id_column="id")
    with pytest.raises(ValueError):
        Query("t").map({"id": F.col("v")}).limit_rows_per_id(1).state(s)
    assert Query("t").limit_rows_per_id(1).state(s).df.count() == 1


def test_steps_of_a_sum_stay_inside_its_bounds(spark):
    df = spark.createDataFrame([(0.005,)] * 100, "x double")
    total = lambda low, high, digits: aggregates.bounded_sum(df, "x", low, high, None, "t", scale_digits=digits).first()["t"]
    assert total(0.0, 0.005, 2) == 0 and total(0.0, 0.29, 2) == pytest.approx(1.0) and total(0.0, 0.005, 3) == pytest.approx(0.5)
    with pytest.raises(ValueError, match="digits"):
        total(0.002, 0.004, 2)


@pytest.mark.parametrize("low", [0, -(10**12)])
def test_variance_of_large_whole_numbers(spark, low):
    x = [0, 2_400_000_000, 5_000_000_000, 4_999_999_999, 7]
    df = spark.createDataFrame([(v,) for v in x], "x long")
    assert aggregates.variance(df, "x", low, 5_000_000_000, None, "v").first()["v"] == pytest.approx(np.var(np.array(x, dtype=float)), rel=1e-9)
    with pytest.raises(ValueError, match="apart"):
        aggregates.variance(df, "x", 0, 10**17)
    assert aggregates.variance(df.limit(0), "x", 0, 5_000_000_000, None, "v").count() == 1


def test_ids_of_several_tables(spark, tmp_path):
    a = spark.createDataFrame([(1, i) for i in range(50)] + [(1, 0)] * 5 + [(2, 0), (None, 1), (None, 2), (None, 3)], "id long, x int").repartition(3)
    b = spark.createDataFrame([(1, f"v{i}") for i in range(50)] + [(3, "w")], "who long, y string")
    for most in (1, 3):
        out = contributions.limit_across({"a": a, "b": b}, {"a": "id", "b": "who"}, most)
        n = Counter([r.id for r in out["a"].collect()]) + Counter([r.who for r in out["b"].collect()])
        assert n[1] == most and n[2] == n[3] == 1 and n[None] == min(most, 3) and out["a"].columns == ["id", "x"]
        again = contributions.limit_across({"b": b.repartition(5), "a": a.repartition(7)}, {"a": "id", "b": "who"}, most)
        assert found(again["a"]) == found(out["a"]) and found(again["b"]) == found(out["b"])
    whole = contributions.limit_across({"a": a}, {"a": "id"}, 2, {"a": ["x"]})["a"]
    assert len({r.x for r in whole.filter("id = 1").collect()}) == 2  # all rows of two groups
    assert contributions.parts_reached(a, ["id"], "x").first()["most"] == 50
    s = Session(1.0, str(tmp_path))
    s.add_private("a", a, id_column="id")
    s.add_private("b", b, id_column="who")
    s.bound_ids(["a", "b"], 4)
    assert s.private["a"][1].sensitivity == 4 and s.private["a"][1].id_column is None
    got = s.run_together({"n": Query("a").count(), "m": Query("b").count()}, 0.5)
    assert s.left == 0.5 and set(got) == {"n", "m"}
    with pytest.raises(ValueError, match="bounded together"):
        s.run_together({"n": Query("a").count(), "m": Query("a").count()}, 0.1)


def test_rows_with_bars_are_contributions_of_their_own(spark):
    rows = [(1, "a|b", "c"), (1, "a", "b|c"), (1, "a\\", "b|c"), (1, "a\\|b", "c"), (1, None, "c"), (1, "\\0", "c"), (2, "|", ""), (2, "", "|")]
    df = spark.createDataFrame(rows, "id long, x string, y string")
    assert df.select(contributions.content(["x", "y"])).distinct().count() == len(rows)
    for most in (1, 2):
        for groups in (None, {"t": ["x", "y"]}):
            assert Counter(r.id for r in contributions.limit_across({"t": df}, {"t": "id"}, most, groups)["t"].collect()) == {1: most, 2: most}


def test_tables_in_place_of_bounded_ones(spark, tmp_path):
    """A table that takes a bounded one's name has a reach of its own: one charge doesn't pay for it and others."""
    rows = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "id long, x int")
    s = Session(1.0, str(tmp_path))
    both = {"n": Query("a").count(), "m": Query("b").count()}

    def bounded():
        for name in ("a", "b"):
            s.add_private(name, rows, id_column="id")
        s.bound_ids(["a", "b"], 1)

    bounded()
    s.create_view("a", "a", lambda df: df.unionAll(df).unionAll(df), factor=3)
    with pytest.raises(ValueError, match="bounded together"):
        s.run_together(both, 0.1)
    bounded()
    s.add_private("b", rows, sensitivity=5)
    with pytest.raises(ValueError, match="bounded together"):
        s.run_together(both, 0.1)
    bounded()
    s.delete_view("a")
    s.add_private("a", rows)
    with pytest.raises(ValueError, match="bounded together"):
        s.run_together(both, 0.1)
    assert s.left == 1.0


def test_parts_of_null_and_of_one_value_twice(spark, tmp_path):
    s = Session(1.0, str(tmp_path))
    s.add_private("t", spark.createDataFrame([(1, "a"), (1, None), (2, None), (3, "c")], "id long, k string"), id_column="id")
    parts = s.split("t", "k", {"a": "a", "none": None}, 0.25, most_parts=2)
    assert s.left == 0.5 and {n: p.private[n][0].count() for n, p in parts.items()} == {"a": 1, "none": 2}
    with pytest.raises(ValueError, match="disjoint"):
        s.split("t", "k", {"a": "a", "again": "a"}, 0.1, most_parts=2)
    assert s.left == 0.5


def chi_squared(draws, variance):
    top = math.ceil(9 * math.sqrt(variance)) + 1
    mass = {k: math.exp(-k * k / (2 * variance)) for k in range(-top, top + 1)}
    total, seen = sum(mass.values()), Counter(draws)
    cells = [k for k in mass if len(draws) * mass[k] / total > 20]
    return sum((seen[k] - len(draws) * mass[k] / total) ** 2 / (len(draws) * mass[k] / total) for k in cells), len(cells)


def test_gaussians_of_each_rows_variance(spark):
    variances = [0.0625, 0.7, 2.5, 37.0, 1234.5]
    df = spark.range(20_000 * len(variances)).select((F.col("id") % len(variances)).cast("int").alias("i"))
    drawn = df.withColumn("k", noise.gaussian_noise_by(F.lit(0), F.element_at(F.array(*map(F.lit, variances)), F.col("i") + 1))).collect()
    for i, v in enumerate(variances):
        own = [r.k for r in drawn if r.i == i]
        chi, cells = chi_squared(own, v)
        assert chi < cells + 8 * math.sqrt(2 * cells)
        wrong, cells = chi_squared(own, v * 1.3)
        assert v < 0.5 or wrong > cells + 8 * math.sqrt(2 * cells)


def test_extreme_variances():
    assert set(noise.discrete_gaussian(1e-4, 50).tolist()) == {0}
    for v in (2.0**25, 2.0**40):
        x = noise.discrete_gaussian(v, 2000)
        assert 0.8 < (x / math.sqrt(v)).var() < 1.2
    mixed = noise.gaussians(np.array([1e-4, 4.0, 2.0**40] * 200))
    assert not mixed[::3].any() and np.abs(mixed[2::3]).mean() > 1e5 and 1 < mixed[1::3].std() < 3
    assert noise.as_ratio(Fraction(5, 2)) and noise.as_ratio(2**30) is None
    with pytest.raises(ValueError):
        noise.as_ratio(0)


def test_gaussian_bounds_by_plain_sums(spark, monkeypatch):
    rows = [(v, p) for v in (0.3, 2.5, 100.0, 5e5) for p in (1e-6, 0.2, 0.5, 0.77, 0.999999)]

    def plain(v, p):
        top = math.ceil(9 * math.sqrt(v)) + 1
        mass = [math.exp(-k * k / (2 * v)) for k in range(-top, top + 1)]
        below = np.cumsum(mass) / sum(mass)
        return int(np.searchsorted(below, p)) - top

    df = spark.createDataFrame([*rows, (0.0, 0.3), (None, 0.3), (9.0, None)], "v double, p double")
    want = [plain(v, p) for v, p in rows] + [0, 0, None]
    get = lambda: {(r.v, r.p): r.b for r in noise.gaussian_bounds(df, "v", "p", "b").collect()}
    assert get() == dict(zip([*rows, (0.0, 0.3), (None, 0.3), (9.0, None)], want))
    monkeypatch.setattr(noise, "MOST_MASSES", 10)
    assert get() == dict(zip([*rows, (0.0, 0.3), (None, 0.3), (9.0, None)], want))


@pytest.mark.parametrize(("kind", "draw"), [("gaussian", lambda c: noise.gaussian_noise(c, 9.0)), ("laplace", lambda c: noise.laplace_noise(c.cast("double"), 3.0)), ("geometric", lambda c: noise.geometric_noise(c, 3.0))])
def test_audit_of_draws(spark, kind, draw):
    drawn = noise.released(spark.range(30_000).select(draw(F.col("id") * 0).alias("k")))
    cells = noise.noise_fit(drawn, "k", 3.0, 6, kind).collect()
    assert len(cells) == 13 and sum(r.expected for r in cells) == pytest.approx(30_000) and sum(r.part for r in cells) < 13 + 8 * math.sqrt(26)
    assert sum(r.part for r in noise.noise_fit(drawn, "k", 4.0, 6, kind).collect()) > 200


def test_planned_run_with_rho(spark):
    people = spark.createDataFrame([(g, "x", "M" if i % 2 else "F", i % 90) for g, n in (("g1", 3000), ("g2", 40)) for i in range(n)], "grp string, region string, sex string, age int")
    plan = spark.createDataFrame([("STATE", "1", 0.5, [10, 100, 1000], 0.95)], "REGION_TYPE string, level string, budget double, thresholds array<int>, chance double")
    groups = spark.createDataFrame([("g1", "1", False, False), ("g2", "1", False, False), *[(f"d{i}", "1", True, False) for i in range(400)]], "group string, level string, detailed_only boolean, coarse_only boolean")
    domain = characteristics.population_domain(spark.createDataFrame([("STATE", "x")], "REGION_TYPE string, REGION_ID string"), groups, plan)
    totals, tables = characteristics.planned_tabulation(people, {"STATE": "region"}, domain, ["M", "F"], kind="zcdp", reach=2)
    first, again = found(totals), found(totals)
    assert first == again  # noise is drawn once
    kept = [r for r in first if r[2].startswith("d")]
    assert 2 <= len(kept) <= 50  # of 400 groups of nobody about one in twenty passes
    assert abs(dict((r[2], r[3]) for r in first)["g1"] - 3000) < 400 and tables.filter("grp = 'g1'").count() == 2 * 23 + 2
    exact, _ = characteristics.planned_tabulation(people, {"STATE": "region"}, domain, ["M", "F"], kind="zcdp", noisy=False)
    assert dict((r[2], r[3]) for r in found(exact))["g1"] == 3000
    with pytest.raises(ValueError, match="pure"):
        characteristics.planned_tabulation(people, {"STATE": "region"}, domain, ["M", "F"], kind="rho")
    scale = lambda kind: spark.range(1).select(characteristics.noise_of(F.lit(0.5), 3, kind)).first()[0]
    assert scale("pure") == 6 and scale("zcdp") == 9


def test_a_run_is_written(spark, tmp_path):
    totals = spark.createDataFrame([("STATE", "01", "g", 5)], "REGION_TYPE string, REGION_ID string, grp string, COUNT long")
    tables = spark.createDataFrame([("STATE", "01", "g", "1", "0", "17", 2)], "REGION_TYPE string, REGION_ID string, grp string, sex string, low string, high string, count long")
    characteristics.write_run(totals, tables, f"{tmp_path}/run", {"1": "Male"})
    read = lambda t: found(spark.read.option("header", True).option("sep", "|").csv(f"{tmp_path}/run/{t}"))
    assert read("t1") == [("01", "STATE", "g", "5")] and read("t2") == [("01", "STATE", "g", "0", "17", "Male", "2")]


def test_nested_cells_leave_out_shared_bins(spark):
    row = spark.range(1).select(*[tabulate.nested_cells(F.lit(i), ["M"]).alias(f"l{i}") for i in range(4)]).first()
    assert [len(row[f"l{i}"]) for i in range(4)] == [0, 4, 13, 35]  # 23 bins less the one from 0 to 4
    assert len({(c.low, c.high) for c in row.l3}) == 35 and [c.table for c in row.l3 if (c.low, c.high) == (0, 4)] == [2]
    people = spark.createDataFrame([("a", "M", 3), ("a", "M", 90), ("a", "F", 115), ("b", "M", 1)], "grp string, sex string, age int")
    levels = spark.createDataFrame([("a", 3), ("b", 0), ("empty", 1)], "grp string, level int")
    totals, cells = tabulate.target_cells(people, levels, ["grp"], ["M", "F"])
    assert found(totals) == [("a", 3), ("b", 1), ("empty", 0)]
    got = found(cells)
    assert len(got) == 2 * (35 + 1) + 2 * (4 + 1) and ("a", "M", "*", "*", 2) in got and ("a", "M", "0", "4", 1) in got and ("a", "F", "85", "115", 1) in got and ("empty", "F", "0", "17", 0) in got


def test_numbers_and_ranges_without_a_task_for_a_key(spark):
    rows = [("hot", 1)] * 700 + [("hot", None)] * 50 + [(None, 1), (None, 1), ("one", 2)]
    out = prefix.copy_numbers(spark.createDataFrame(rows, "k string, v int").repartition(6), ["k", "v"], "n").collect()
    by = {}
    for r in out:
        by.setdefault((r.k, r.v), []).append(r.n)
    assert {k: sorted(v) for k, v in by.items()} == {k: list(range(1, n + 1)) for k, n in Counter(rows).items()}
    ranges = [(f"f{i % 2}", low, low + i % 9) for i, low in enumerate(np.random.default_rng(1).integers(0, 3000, 900).tolist())] + [("f0", 5, 2000), (None, 1, 2), (None, 3, 3), (None, 5, 6)]
    want = []
    for f in {r[0] for r in ranges}:
        open_ = None
        for _, a, b in sorted(r for r in ranges if r[0] == f):
            if open_ and a <= open_[2] + 1:
                open_[2] = max(open_[2], b)
            else:
                open_ = [f, a, b]
                want.append(open_)
    assert found(quality.merged_ranges(spark.createDataFrame(ranges, "field string, low long, high long"), ["field"])) == sorted(map(tuple, want), key=str)


def test_exact_quantiles(spark):
    rng = np.random.default_rng(2)
    rows = [("a", float(x)) for x in rng.normal(0, 5, 400).round(1)] + [("hot", 1.0)] * 300 + [("one", 4.0), (None, 2.0), (None, 3.0), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    for q in (0, 0.3, 0.95, 1):
        got = {r.k: r.m for r in quantile.exact_quantile(df, ["k"], F.col("v"), q, "m").collect()}
        assert got == {k: pytest.approx(np.quantile([v for g, v in rows if g == k and v is not None], q)) for k in ("a", "hot", "one", None)}
    assert quantile.exact_quantile(df, [], F.col("v"), 0.5, "m").first()["m"] == pytest.approx(np.median([v for _, v in rows if v is not None]))


def test_groups_in_slices(spark):
    df = spark.createDataFrame([("hot" if i % 3 else f"k{i % 5}", i) for i in range(3000)] + [(None, 1)], "k string, v long").repartition(8)
    listed = keys.keys_from_values(spark, {"k": ["hot", "k0", "none"]})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        def largest(g):
            assert len(g) <= 100
            return g.iloc[:1][["k"]].assign(top=g["v"].max(), n=len(g))

        out = aggregates.apply_to_groups(df, listed, largest, "k string, top long, n long", {"top": -1, "n": 0}, lambda g: g.iloc[:1][["k"]].assign(top=g["top"].max(), n=g["n"].sum()))
        assert found(out) == [("hot", 2999, 2000), ("k0", 2985, 200), ("none", -1, 0)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_tables_have_one_gap(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    for t in (df, df.limit(0)):
        assert [(r.left, r.right, r.rank, r.n) for r in quantile.gaps(t, "x", 1, 5).collect()] == [(1.0, 5.0, 0, 0)]
        assert 1 <= quantile.quantile(t, "x", 0.5, 1, 5, name="q", epsilon=1.0).first()["q"] <= 5


def test_rules_that_hold_tables(spark):
    codes = spark.range(120_000).select(F.concat(F.lit("c"), "id").alias("code"))
    df = spark.createDataFrame([("c1", 1), ("c119999", 2), ("c120000", 3), (None, 4), ("x", 5), ("x", 6)], "code string, v int")
    rule = quality.rules_from_codes(codes, "code", "code")
    assert isinstance(rule, quality.OneOf) and isinstance(quality.rules_from_codes(codes.limit(9), "code", "code"), quality.Values)
    rules = [rule, quality.Range("v", 0, 6)]
    report = {r.column: (r.checked, r.invalid, r.examples) for r in quality.rule_report(df, rules).collect()}
    assert report == {"code": (6, 4, "c120000,null,x"), "v": (6, 1, "6")}
    assert found(quality.validated(df, rules, "remove")) == [("c1", 1), ("c119999", 2)]
    with pytest.raises(ValueError, match="bounds"):
        quality.validated(df, [rule])
    assert quality.validated(df.limit(2), [rule]).count() == 2
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert quality.column_problems(df, [rule], "warn") == [] and "unexpected column v" in str(seen[0].message)


def test_phases_without_rules_or_checks(spark):
    tables = {"t": spark.createDataFrame([(1,)], "x int")}
    assert quality.phased_problems(tables, {}, lambda ts: {}, []).collect() == []
    assert found(quality.phased_problems(tables, {"t": [quality.Range("x", 2, 3)]}, lambda ts: {}, [])) == [(1, "t.x", 1)]


def test_characteristics_of_large_mappings(spark, monkeypatch):
    groups = spark.createDataFrame([("r1", "race", False), ("r1 alone", "race", True), ("r2", "race", False), ("e", "ethnicity", None)], "group string, kind string, alone boolean").withColumns({"detailed_only": F.lit(False), "coarse_only": F.lit(False), "level": F.lit("1")})
    mapping = spark.createDataFrame([("a", "r1"), ("a", "r1 alone"), ("b", "r1"), ("b", "r1 alone"), ("b", "r2"), ("h", "e")], "code string, group string")
    persons = spark.createDataFrame([(1, ["a", "b"], "h"), (2, ["a", "zz"], "n"), (3, [], "h"), (4, ["b", "b"], None), (4, ["b", "b"], None), (5, ["zz"], "n")], "id int, codes array<string>, eth string")
    small = characteristics.characteristics(groups, mapping, 3)
    monkeypatch.setattr(characteristics, "MOST_CODES", 2)
    large = characteristics.characteristics(groups, mapping, 3)
    assert small.lists is None and large.maps is None and small.reach == large.reach
    assert found(small.of(persons, "codes", "eth")) == found(large.of(persons, "codes", "eth")) and len(found(small.of(persons, "codes", "eth"))) == 12
