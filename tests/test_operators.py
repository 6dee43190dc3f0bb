"""Operators on literal rows, and the nearest-site search against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from metrolens.functions import time_of_day
from metrolens.operators import (
    assign_nearest,
    diff_tables,
    except_distinct,
    limit_n,
    nearest_join,
    same_rows,
    share_by,
    topk_per_group,
    union_all,
    with_position,
)


def test_share_by_policies(spark):
    df = spark.createDataFrame(
        [(600, "STREET"), (700, "STREET"), (800, "HOUSE"), (1300, "street"), (None, "STREET")],
        "t int, p string",
    )

    def run(policy):
        out = share_by(df, time_of_day("t", policy), F.col("p") == "STREET", "tod", "pct", policy)
        return {r.tod: r.pct for r in out.collect()}

    assert run("default") == {"Morning": 66.67, "Afternoon": 0.0, "Night": 100.0}
    assert run("group") == {"Morning": 66.67, "Afternoon": 0.0, None: 100.0}
    assert run("drop") == {"Morning": 66.67, "Afternoon": 0.0}


def test_topk_ties(spark):
    # Month numbers as in the fixture: Jan 9, Feb 7, Mar 7, Apr 7, May 1.
    counts = [(2020, 1, 9), (2020, 2, 7), (2020, 3, 7), (2020, 4, 7), (2020, 5, 1),
              (2021, 1, 9), (2021, 2, 9), (2021, 3, 9), (2021, 4, 9),
              (None, 1, 3)]
    df = spark.createDataFrame(counts, "year int, month int, n long")
    ranked = topk_per_group(df, ["year"], [F.col("n").desc()], 3, "rank")
    got = sorted((r.year or 0, r.month, r.ranking) for r in ranked.collect())
    assert [g for g in got if g[0] == 2020] == [(2020, 1, 1), (2020, 2, 2), (2020, 3, 2), (2020, 4, 2)]
    assert [g for g in got if g[0] == 2021] == [(2021, m, 1) for m in (1, 2, 3, 4)]
    assert (0, 1, 1) in got  # NULL year is its own group
    order = [F.col("n").desc(), F.col("month").asc()]
    months = sorted(r.month for r in topk_per_group(df.filter("year = 2020"), ["year"], order, 3, "row_number").collect())
    assert months == [1, 2, 3]  # the tie at 7 is broken by month


def test_set_operations(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(2,), (3,)], "x int")
    assert sorted(r.x for r in except_distinct(a, b).collect()) == [1]
    diff = sorted((r.side, r.x, r.copies) for r in diff_tables(a, b).collect())
    assert diff == [("left_only", 1, 2), ("right_only", 3, 1)]
    assert not same_rows(a, b)
    assert same_rows(a, a.union(spark.createDataFrame([], "x int")))
    assert union_all([a, b]).count() == 5


def test_union_by_name_vs_position(spark):
    a = spark.createDataFrame([(1, "p")], "k int, v string")
    b = spark.createDataFrame([("q", 2)], "v string, k int")
    assert sorted(tuple(r) for r in union_all([a, b]).collect()) == [(1, "p"), (2, "q")]
    with pytest.raises(Exception):
        union_all([a, b], by_position=True).collect()  # ANSI: 'q' does not cast to int


def test_with_position_and_limit(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 500).alias("v"), F.col("id"))
    df = df.repartition(7)
    pos = with_position(df, [F.col("v").desc(), F.col("id")], "pos")
    got = sorted((r.pos, r.v) for r in pos.collect())
    assert [p for p, _ in got] == list(range(1, 501))
    assert [v for _, v in got] == sorted((r.v for r in df.collect()), reverse=True)
    top = limit_n(df, [F.col("v").desc(), F.col("id")], 5)
    assert sorted((r.pos, r.v) for r in top.collect()) == got[:5]


def test_nearest_fixture(spark):
    sites = spark.createDataFrame([("A", 0.0, -5.0), ("B", 0.0, 5.0)], "division string, lat double, lon double")
    pts = spark.createDataFrame(
        [(0.0, -4.0)] * 3 + [(0.0, 4.0), (0.0, 0.0), (None, 1.0), (float("nan"), 1.0)], "lat double, lon double"
    )
    loc = {r.division: r.crime_count for r in nearest_join(pts, sites, "lat", "lon", "division", "lat", "lon", "location").collect()}
    evt = {r.division: r.crime_count for r in nearest_join(pts, sites, "lat", "lon", "division", "lat", "lon", "event").collect()}
    assert loc == {"A": 2, "B": 1}
    assert evt == {"A": 4, "B": 1}


def _brute(points, sites):
    def hav(a, b, c, d):
        p1, p2 = math.radians(a), math.radians(c)
        s1 = math.sin((p2 - p1) / 2)
        s2 = math.sin((math.radians(d) - math.radians(b)) / 2)
        x = min(1.0, s1 * s1 + math.cos(p1) * math.cos(p2) * s2 * s2)
        return 6371.0 * 2 * math.atan2(math.sqrt(x), math.sqrt(1 - x))

    out = {}
    for lat, lon in set(points):
        out[(lat, lon)] = min((hav(lat, lon, s[1], s[2]), s[0]) for s in sites)
    return out


@pytest.mark.parametrize(
    "seed,n_sites,region",
    [(1, 25, "city"), (2, 3, "globe"), (3, 40, "globe"), (4, 6, "antimeridian"), (5, 5, "poles"), (6, 1, "globe")],
)
def test_nearest_matches_brute_force(spark, seed, n_sites, region):
    rng = random.Random(seed)

    def point():
        if region == "city":
            return round(33.7 + rng.random() * 0.7, 4), round(-118.6 + rng.random() * 0.6, 4)
        if region == "antimeridian":
            return round(rng.uniform(-30, 30), 3), round(rng.choice([rng.uniform(170, 179.999), rng.uniform(-180, -170)]), 3)
        if region == "poles":
            return round(rng.choice([rng.uniform(80, 90), rng.uniform(-90, -80)]), 3), round(rng.uniform(-180, 179.99), 3)
        return round(rng.uniform(-89, 89), 3), round(rng.uniform(-180, 179.99), 3)

    sites = [(f"S{i:02d}",) + point() for i in range(n_sites)]
    points = [point() for _ in range(400)]
    points += points[:50]  # repeated coordinates
    sdf = spark.createDataFrame(sites, "site string, slat double, slon double")
    pdf = spark.createDataFrame(points, "lat double, lon double")
    got = {(r.lat, r.lon): (r.km, r.site) for r in assign_nearest(pdf, sdf, "lat", "lon", "site", "slat", "slon").collect()}
    want = _brute(points, sites)
    assert set(got) == set(want)
    for key, (km, site) in want.items():
        assert got[key][1] == site, key
        assert got[key][0] == pytest.approx(km, abs=1e-6)


def _nearest(spark, points, sites, key="string", **options):
    sdf = spark.createDataFrame(sites, f"site {key}, slat double, slon double")
    pdf = spark.createDataFrame(points, "lat double, lon double")
    return assign_nearest(pdf, sdf, "lat", "lon", "site", "slat", "slon", **options)


def _same_as_brute_force(spark, points, sites, **options):
    got = {(r.lat, r.lon): (r.km, r.site) for r in _nearest(spark, points, sites, **options).collect()}
    want = _brute(points, sites)
    assert set(got) == set(want)
    for place, (km, site) in want.items():
        assert got[place][1] == site, place
        assert got[place][0] == pytest.approx(km, abs=1e-6)


@pytest.mark.parametrize("strategy", ["DEFAULT", "broadcast", "merge", "shuffle_hash"])
def test_nearest_strategies_agree(spark, strategy):
    rng = random.Random(11)
    sites = [(f"S{i:03d}", round(rng.uniform(-60, 60), 3), round(rng.uniform(-180, 179.9), 3)) for i in range(300)]
    points = [(round(rng.uniform(-70, 70), 3), round(rng.uniform(-180, 179.9), 3)) for _ in range(200)]
    _same_as_brute_force(spark, points, sites, strategy=strategy)


def test_nearest_with_a_crowd_of_sites(spark):
    # 300 sites within metres of each other, some closer than the curve can tell apart, and some far away.
    rng = random.Random(21)
    sites = [(f"C{i:03d}", 34.05 + rng.uniform(0, 0.0002), -118.25 + rng.uniform(0, 0.0002)) for i in range(250)]
    sites += [(f"D{i:03d}", 34.05 + i * 1e-9, -118.25) for i in range(50)]
    sites += [(f"S{i:03d}", round(rng.uniform(20, 50), 3), round(rng.uniform(-125, -70), 3)) for i in range(80)]
    points = [(34.05 + rng.uniform(-0.01, 0.01), -118.25 + rng.uniform(-0.01, 0.01)) for _ in range(100)]
    points += [(34.05 + rng.uniform(0, 0.0002), -118.25 + rng.uniform(0, 0.0002)) for _ in range(60)]
    points += [(round(rng.uniform(20, 50), 3), round(rng.uniform(-125, -70), 3)) for _ in range(60)]
    got = {(r.lat, r.lon): r.km for r in _nearest(spark, points, sites).collect()}
    want = _brute(points, sites)
    assert set(got) == set(want)
    assert all(got[p] == pytest.approx(want[p][0], abs=1e-7) for p in want)


def test_nearest_sites_on_one_spot(spark):
    # A third of the sites share one coordinate: only the least key there can win.
    from metrolens.operators.nearest import distinct_sites

    rng = random.Random(8)
    sites = [(f"H{i:03d}", 34.05, -118.25) for i in range(60)]
    sites += [(f"S{i:03d}", round(rng.uniform(33, 35), 3), round(rng.uniform(-119.5, -117), 3)) for i in range(120)]
    points = [(round(rng.uniform(33.5, 34.5), 3), round(rng.uniform(-119, -117.5), 3)) for _ in range(200)]
    points += [(34.05, -118.25)] * 5
    sdf = spark.createDataFrame(sites, "site string, slat double, slon double")
    spot = distinct_sites(sdf, "site", "slat", "slon").filter("slat = 34.05 AND slon = -118.25").collect()
    assert [r.site for r in spot] == ["H000"]
    _same_as_brute_force(spark, points, sites)


def test_nearest_far_points(spark):
    # Sites crowd into one city; points lie all over the globe, poles and antimeridian included.
    rng = random.Random(17)
    sites = [(f"S{i:03d}", round(34 + rng.uniform(0, 0.3), 4), round(-118.4 + rng.uniform(0, 0.3), 4)) for i in range(200)]
    sites += [("FAR1", -33.9, 151.2), ("FAR2", 51.5, -0.1)]
    points = [(round(rng.uniform(-89.9, 89.9), 3), round(rng.uniform(-180, 179.99), 3)) for _ in range(150)]
    points += [(34.1, -118.3), (34.15, -118.2), (90.0, 10.0), (-89.99, -170.0), (0.0, 179.999), (0.0, -179.999)]
    _same_as_brute_force(spark, points, sites)


def test_nearest_longitudes_beyond_180(spark):
    # The same places written from 0 to 360, and beyond: nothing is lost and the distances are the same.
    rng = random.Random(4)
    sites = [(f"S{i:03d}", round(rng.uniform(-80, 80), 3), round(rng.uniform(0, 360), 3)) for i in range(200)]
    points = [(round(rng.uniform(-80, 80), 3), round(rng.uniform(-180, 180), 3)) for _ in range(100)]
    points += [(0.5, 359.9), (0.5, 719.9), (-85.746, -40.839)]
    _same_as_brute_force(spark, points, sites)


@pytest.mark.parametrize("key,value", [("long", 7), ("string", "x")])
def test_nearest_unusable_coordinates_and_no_sites(spark, key, value):
    nan, inf = float("nan"), float("inf")
    odd = [(None, 1.0), (1.0, None), (nan, 1.0), (1.0, nan), (inf, 1.0), (1.0, -inf), (90.5, 1.0)]
    got = _nearest(spark, odd + [(0.0, 0.0)], [(value, 1.0, 1.0), (value, inf, 0.0), (value, 0.0, nan)], key).collect()
    assert [(r.lat, r.lon, r.site) for r in got] == [(0.0, 0.0, value)]
    none = _nearest(spark, [(0.0, 0.0)], [], key)
    assert dict(none.dtypes)["site"] == ("bigint" if key == "long" else key) and none.count() == 0
    assert _nearest(spark, [], [(value, 1.0, 1.0)], key).count() == 0


def test_nearest_ties_go_to_the_least_key(spark):
    sites = [("B", 0.0, 1.0), ("A", 0.0, -1.0), ("C", 1.0, 0.0), ("D", -1.0, 0.0)] + [(f"Z{i}", 50.0, i * 1.0) for i in range(40)]
    (got,) = _nearest(spark, [(0.0, 0.0)], sites).collect()
    assert got.site == "A"


def test_index_nodes_are_small_and_hold_every_site(spark, monkeypatch):
    from metrolens.operators import nearest
    from metrolens.operators.nearest import BOX, distinct_sites, site_index

    monkeypatch.setattr(nearest, "FAN", 16)
    rng = random.Random(2)
    sites = [(i, 10 + rng.random() * 1e-7, 20.0) for i in range(700)] + [(1000 + i, -i / 10, i * 1.0) for i in range(100)]
    sdf = spark.createDataFrame(sites, "site long, slat double, slon double")
    levels = [level.collect() for level, _, _ in site_index(distinct_sites(sdf, "site", "slat", "slon"))]
    assert [len(level) for level in levels] == [50, 4, 1]
    assert sorted(s for node in levels[0] for s in node.site) == sorted(s[0] for s in sites)
    assert all(1 <= len(node.site) <= 16 for node in levels[0])
    for below, above in zip(levels, levels[1:]):
        boxes = {n.node: n for n in below}
        for node in above:
            assert 1 <= len(node.child) <= 16
            for i, child in enumerate(node.child):
                for c in BOX:
                    own, theirs = node[f"own_{c}"], node[c][i]
                    assert theirs == boxes[child][f"own_{c}"]
                    assert own <= theirs if c.startswith("lo") else own >= theirs


def test_nearest_over_many_levels_and_blocks(spark, monkeypatch):
    from metrolens.operators import nearest

    monkeypatch.setattr(nearest, "FAN", 3)
    monkeypatch.setattr(nearest, "BLOCK", 5)
    rng = random.Random(11)
    sites = [(f"s{i:03d}", rng.uniform(-80, 80), rng.uniform(-170, 170)) for i in range(150)]
    sites += [(f"t{i:03d}", 10.0 + i * 1e-9, 20.0) for i in range(30)]
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)] + [(10.0, 20.0), (-10.0, -160.0)]
    got = {(r.lat, r.lon): r.km for r in _nearest(spark, points, sites).collect()}
    assert len(got) == 302
    for p in points:
        want = min(_brute_km(p, s) for s in sites)
        assert got[p] == pytest.approx(want, rel=1e-9, abs=1e-6)


def _brute_km(point, site):
    (a, b), (_, c, d) = point, site
    p, q = math.radians(a), math.radians(c)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0 * math.atan2(math.sqrt(min(1.0, h)), math.sqrt(max(0.0, 1 - h)))
