import math
import random

import pytest
from pyspark.sql import functions as F

from peerlight.operators import peers, skew

SCHEMA = "id int, t string, s string, x double, z double"
MEASURES = {"px": "x", "pz": "z"}
KEYS = ["t", "s"]


def awkward_rows(n=3000, seed=7):
    """Values with many ties, every sign and size, and NULL in the group columns."""
    rng = random.Random(seed)
    pools = [
        lambda: 0.0,
        lambda: float(rng.randint(-3, 3)),
        lambda: rng.uniform(-1, 1),
        lambda: rng.uniform(1, 1 + 1e-6),
        lambda: rng.choice([1, -1]) * 10 ** rng.uniform(-320, 308),
        lambda: rng.choice([math.inf, -math.inf, -0.0, 5e-324, -5e-324, 1.7976931348623157e308, 2.0**-900]),
    ]
    rows = []
    for i in range(n):
        t, s = ("hot", "A") if rng.random() < 0.4 else (rng.choice(["a", "b", None]), rng.choice(["A", None]))
        rows.append((i, t, s, rng.choice(pools)(), rng.choice(pools)()))
    rows.append((n, "alone", "A", 1.0, 1.0))
    return rows


def by_id(df):
    return {r.id: (r.px, r.pz) for r in df.collect()}


def test_counted_ranks_equal_window_ranks(spark):
    df = spark.createDataFrame(awkward_rows(), SCHEMA).repartition(6)
    window = by_id(peers.window_percent_ranks(df, MEASURES, KEYS))
    counted = by_id(peers.counted_percent_ranks(df, MEASURES, KEYS))
    assert counted == window
    assert window[3000] == (0.0, 0.0)


def test_counted_ranks_with_shuffled_cold_keys(spark, monkeypatch):
    # Nothing counts as hot and nothing is small enough to broadcast.
    monkeypatch.setattr(skew, "HOT_SHARE", 1)
    df = spark.createDataFrame(awkward_rows(1500, 3), SCHEMA)
    window = by_id(peers.window_percent_ranks(df, MEASURES, KEYS))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert by_id(peers.counted_percent_ranks(df, MEASURES, KEYS)) == window
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_auto_switches_on_the_largest_group(spark, monkeypatch):
    df = spark.createDataFrame(awkward_rows(200), SCHEMA)
    used = []
    for name in ("window_percent_ranks", "counted_percent_ranks"):
        monkeypatch.setattr(peers, name, lambda df, *_, name=name: used.append(name) or df)
    peers.peer_percentiles(df, MEASURES, KEYS)
    monkeypatch.setattr(peers, "WINDOW_ROWS", 10)
    peers.peer_percentiles(df, MEASURES, KEYS)
    assert used == ["window_percent_ranks", "counted_percent_ranks"]


def test_running_totals_against_brute_force(spark):
    rng = random.Random(1)
    rows = {}
    for _ in range(800):
        rows[(rng.choice("ab"), rng.choice([rng.uniform(-5, 5), rng.uniform(1, 1.001), rng.expovariate(1e-9)]))] = (
            rng.randint(1, 9), rng.randint(0, 9),
        )
    df = spark.createDataFrame([(g, v, n, m) for (g, v), (n, m) in rows.items()], "g string, v double, n bigint, m bigint")
    for row in skew.running_totals(df, ["g"], "v", ["n", "m"]).collect():
        below = [c for (g, v), c in rows.items() if g == row.g and v < row.v]
        whole = [c for (g, _v), c in rows.items() if g == row.g]
        assert (row.n_below, row.m_below) == (sum(c[0] for c in below), sum(c[1] for c in below))
        assert (row.n_total, row.m_total) == (sum(c[0] for c in whole), sum(c[1] for c in whole))


def test_buckets_keep_order(spark):
    values = sorted({r[3] for r in awkward_rows()} | {2.0**k for k in range(-60, 60)} | {math.nextafter(2.0**k, 0) for k in range(-60, 60)})
    df = spark.createDataFrame([(v,) for v in values], "v double")
    coarse, fine = skew._magnitude_buckets(F.col("v"))
    found = [(r.c, r.f) for r in df.select("v", coarse.alias("c"), fine.alias("f")).orderBy("v").collect()]
    assert found == sorted(found)


def behavior(spark, rates, **extra):
    rows = [(i, "T", "S", float(r), float(r), 0, 0) for i, r in enumerate(rates)]
    schema = "id int, Prscrbr_Type string, Prscrbr_State_Abrvtn string, Opioid_Prscrbr_Rate double, payment_per_claim double, high_payment_flag int, high_cost_flag int"
    return peers.add_behavioral_risk_flags(spark.createDataFrame(rows, schema), **extra)


@pytest.mark.parametrize("method", ["window", "counted"])
def test_exactly_the_99th_percentile_is_an_outlier(spark, method):
    rows = {r.id: r for r in behavior(spark, range(101), method=method).collect()}
    assert rows[99].opioid_peer_percentile == 0.99
    assert [i for i, r in rows.items() if r.opioid_outlier_flag] == [99, 100]
    assert [i for i, r in rows.items() if r.behavioral_risk_flag] == [99, 100]


def test_all_tied_or_zero_is_no_outlier(spark):
    assert {r.payment_outlier_flag for r in behavior(spark, [5] * 30).collect()} == {0}
    assert {r.payment_outlier_flag for r in behavior(spark, [-1, -2, 0]).collect()} == {0}


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="Opioid_Prscrbr_Rate"):
        peers.add_behavioral_risk_flags(spark.createDataFrame([("T", "S")], "Prscrbr_Type string, Prscrbr_State_Abrvtn string"))


def test_missing_and_huge_measures_rank_alike_by_both_methods(spark):
    rows = [(i, "a" if i % 3 else None, None if i % 4 == 0 else i % 7, 2**53 + i % 3) for i in range(200)] + [(900, "z", None, None)]
    df = spark.createDataFrame(rows, "id long, g string, x int, y long")
    measures = {"px": "x", "py": "y"}
    window = {r.id: (r.px, r.py) for r in peers.window_percent_ranks(df, measures, ["g"]).collect()}
    counted = peers.counted_percent_ranks(df, measures, ["g"])
    assert {r.id: (r.px, r.py) for r in counted.collect()} == window and counted.columns == [*df.columns, "px", "py"]
    assert window[0][0] == 0.0 and all(value is not None for pair in window.values() for value in pair)
