"""Change points against every possible cut, smoothing against plain loops."""

import datetime as dt
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from waitband.operators import features as FE
from waitband.operators import models as MD
from waitband.operators import series as SE


def month(k):
    return dt.date(2020 + k // 12, k % 12 + 1, 1)


def panel(spark, series):
    rows = [(p, "C_100", month(k), v) for p, vs in series.items() for k, v in enumerate(vs)]
    return spark.createDataFrame(rows, "provider_org_code string, treatment_function_code string, period_date date, pct_within_18_weeks double").withColumn(
        "total_incomplete", F.col("pct_within_18_weeks")).repartition(5)


def best_cut(vs, penalty, least):
    best = None
    for k in range(len(vs)):
        for cuts in combinations(range(1, len(vs)), k):
            starts = [0, *cuts]
            parts = [vs[a:b] for a, b in zip(starts, [*starts[1:], len(vs)])]
            if min(map(len, parts)) < least:
                continue
            cost = sum(sum(v * v for v in p) - sum(p) ** 2 / len(p) for p in parts) + penalty * k
            at = (round(cost, 6), starts[::-1])
            if best is None or at < best[0]:
                best = (at, starts, [sum(p) / len(p) for p in parts])
    return best


@pytest.mark.parametrize("least", [1, 2, 3])
def test_change_points_equal_the_best_of_all_cuts(spark, least):
    rng = random.Random(least)
    series = {f"P{i}": [float(rng.choice([60, 60, 61, 75, 90])) + rng.random() for _ in range(rng.randint(1, 9))] for i in range(25)}
    series |= {"flat": [5.0] * 8, "gap": [1.0, None, 1.0, 40.0, None, 40.0, 40.0], "none": [None, None], "tie": [0.0, 10.0] * 4}
    want = []
    for p, vs in series.items():
        known = [(month(k), v) for k, v in enumerate(vs) if v is not None]
        if len(known) < 2 * least:
            continue
        _, starts, means = best_cut([v for _, v in known], 30.0, least)
        want += [(p, known[starts[k]][0], round(means[k - 1], 3), round(means[k], 3)) for k in range(1, len(starts))]
    got = SE.change_points(panel(spark, series), penalty=30.0, least=least).collect()
    got = sorted((r["provider_org_code"], r["period_date"], r["mean_before"], r["mean_after"]) for r in got)
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want)]
    for g, w in zip(got, sorted(want)):
        assert g[2:] == pytest.approx(w[2:], abs=2e-3)


def test_planted_shifts_are_found_in_long_series(spark):
    rng = random.Random(9)
    planted = {}
    series = {}
    for i in range(20):
        at, up = rng.randint(12, 48), rng.choice([-12, 12])
        planted[f"P{i}"] = month(at)
        series[f"P{i}"] = [70 + up * (k >= at) + rng.gauss(0, 1.5) for k in range(60)]
    got = {}
    for r in SE.change_points(panel(spark, series), penalty=60.0).collect():
        got.setdefault(r["provider_org_code"], []).append(r["period_date"])
    assert got == {p: [m] for p, m in planted.items()}


def test_smoothing_equals_a_plain_loop(spark):
    rng = random.Random(2)
    series = {f"P{i}": [float(rng.randint(50, 900)) for _ in range(rng.randint(3, 14))] for i in range(15)} | {"flat": [7.0] * 6}
    want = []
    for p, vs in series.items():
        if len(vs) < 4:
            continue
        tried = []
        for a in SE.ALPHAS:
            level, off = vs[0], 0.0
            for v in vs[1:]:
                off += abs(v - level)
                level += a * (v - level)
            tried.append((round(off / (len(vs) - 1), 6), a, round(level, 6)))
        mae, a, level = min(tried)
        want += [(p, month(len(vs) - 1 + h), a, mae, level) for h in (1, 2, 3)]
    got = [(r["provider_org_code"], r["period_date"], r["alpha"], r["mae"], r["forecast"]) for r in SE.smoothing_forecast(panel(spark, series)).collect()]
    assert len(got) == len(want)
    for g, w in zip(sorted(got), sorted(want)):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:], abs=1e-5)


def test_revised_months_stay_out_of_training(spark):
    from waitband.operators.fact import fact_performance
    from waitband.operators.pathways import incomplete_pathways
    from waitband.operators.staging import staging
    from tests.test_metrics import raw_frame
    rows = [{"Period": f"RTT-{m}", "Provider Org Code": f"P{i}", "bands": {1: 5, 30: i}} for m in ("October-2025", "November-2025", "December-2025", "January-2026") for i in range(3)]
    raw = raw_frame(spark, rows).withColumn("_is_revised", F.col("Period") == "RTT-November-2025")
    fact = fact_performance(incomplete_pathways(staging(raw)))
    feats = FE.breach_features(FE.entity_month_panel(fact))
    assert {(r["period_date"].month, r["_is_revised"]) for r in feats.collect()} == {(10, False), (11, True), (12, False), (1, False)}
    assert {r["period_date"].month for r in MD.breach_training_rows(feats).collect()} == {10, 12}
    assert "_is_revised" not in fact_performance(incomplete_pathways(staging(raw_frame(spark, rows)))).columns
