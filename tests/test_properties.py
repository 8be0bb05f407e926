"""Property tests: Spark operators vs brute-force Python on random bands."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.test_metrics import raw_frame
from waitband.config import BANDS
from waitband.operators.distribution import distribution_stats
from waitband.operators.pathways import incomplete_pathways
from waitband.operators.staging import staging

band_vectors = st.lists(
    st.dictionaries(st.integers(0, BANDS.count - 1), st.integers(0, 5000), max_size=12),
    min_size=1, max_size=25)


def _round1(x: float) -> float:
    return float(Decimal(repr(x)).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))


def _expected(bands: dict):
    total = sum(bands.values())
    within = sum(v for i, v in bands.items() if i < 18)
    beyond = total - within
    plus52 = sum(v for i, v in bands.items() if i >= 52)
    if total == 0:
        return total, within, beyond, plus52, None, None
    ratio = within * 100.0 / total
    return total, within, beyond, plus52, _round1(ratio), ratio >= 92.0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=band_vectors)
def test_metrics_match_brute_force(spark, rows):
    data = [{"Provider Org Code": f"P{i:04d}", "bands": b} for i, b in enumerate(rows)]
    out = incomplete_pathways(staging(raw_frame(spark, data), loaded_at=dt.datetime(2026, 2, 1)))
    got = {r.provider_org_code: (r.total_incomplete, r.patients_within_18_weeks, r.patients_beyond_18_weeks,
                                 r.patients_waiting_52_plus_weeks, r.pct_within_18_weeks, r.meets_18_week_standard)
           for r in out.collect()}
    for i, b in enumerate(rows):
        assert got[f"P{i:04d}"] == _expected(b)


def _dist_expected(bands: dict):
    p = [bands.get(i, 0) for i in range(BANDS.count)]
    n = sum(p)
    if n == 0:
        return None, None
    cum, med = 0, None
    for i, v in enumerate(p):
        cum += v
        if 2 * cum >= n:
            med = i + 0.5
            break
    mids = [i + 0.5 for i in range(BANDS.count)]
    wealth = sum(v * m for v, m in zip(p, mids))
    g, s_prev = 0.0, 0.0
    for v, m in zip(p, mids):
        s = s_prev + v * m / wealth
        g += (v / n) * (s_prev + s)
        s_prev = s
    return med, 1.0 - g


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=band_vectors)
def test_distribution_matches_brute_force(spark, rows):
    data = [{"Provider Org Code": f"P{i:04d}", "bands": b} for i, b in enumerate(rows)]
    stg = staging(raw_frame(spark, data), loaded_at=dt.datetime(2026, 2, 1))
    out = distribution_stats(stg, ["provider_org_code"])
    got = {r.provider_org_code: (r.median_wait_weeks, r.wait_gini, r.n) for r in out.collect()}
    for i, b in enumerate(rows):
        med, gini = _dist_expected(b)
        g_med, g_gini, g_n = got[f"P{i:04d}"]
        assert g_n == sum(b.values())
        assert g_med == med
        assert (g_gini is None and gini is None) or abs(g_gini - gini) < 1e-9


def test_quartile_shares_sum_to_one(spark):
    data = [{"Provider Org Code": "A", "bands": {0: 3, 30: 4, 60: 5, 100: 6}}]
    stg = staging(raw_frame(spark, data), loaded_at=dt.datetime(2026, 2, 1))
    r = distribution_stats(stg, ["provider_org_code"]).first()
    assert (r.share_q1, r.share_q2, r.share_q3, r.share_q4) == (3 / 18, 4 / 18, 5 / 18, 6 / 18)
    assert abs(sum([r.share_q1, r.share_q2, r.share_q3, r.share_q4]) - 1.0) < 1e-12
    assert stg.select(F.col("wks_over_104")).first()[0] == 0


def test_gini_at_ten_billion_patients(spark):
    """The fold holds sums that 64 bits do not."""
    from waitband.config import BANDS
    from waitband.operators.distribution import distribution_stats
    n = 10_000_000_000
    half = {BANDS.name(0): n // 2, BANDS.name(100): n // 2}
    df = spark.range(1).selectExpr("'g' as g", *[f"cast({half.get(b, 0)} as bigint) as {b}" for b in BANDS.names()])
    r = distribution_stats(df, ["g"]).first()
    small = df.selectExpr("g", *[f"cast({b} / 1000000000 as bigint) as {b}" for b in BANDS.names()])
    assert abs(r.wait_gini - distribution_stats(small, ["g"]).first().wait_gini) < 1e-9 and r.n == n


def test_planted_outlier_in_five_months_is_an_anomaly(spark):
    import datetime as dt

    from waitband.operators.features import performance_anomalies
    rows = [("A", "C_100", dt.date(2025, m, 1), p) for m, p in zip(range(1, 6), (80.0, 81.0, 80.5, 79.5, 40.0))]
    rows += [("B", "C_100", dt.date(2025, m, 1), 80.0) for m in range(1, 6)] + [("C", "C_100", dt.date(2025, m, 1), 50.0 + m) for m in range(1, 4)]
    df = spark.createDataFrame(rows, "provider_org_code string, treatment_function_code string, period_date date, pct_within_18_weeks double")
    got = {(r.provider_org_code, r.period_date.month): r for r in performance_anomalies(df).collect()}
    assert got["A", 5].is_anomaly and got["A", 5].z_score < -50
    assert not any(r.is_anomaly for k, r in got.items() if k != ("A", 5))
    assert got["B", 1].z_score is None and got["C", 1].z_score is None


def test_links_in_any_markup(spark):
    from pyspark.sql import functions as F

    from waitband.sources.pages import anchors, release_links, resolve_url
    html = ("<a href=\"/a/x.zip\">Get it</a><A HREF='../y.zip'>get IT &amp; more</A><a class=q href=z.zip>get it</a><a\nid=1 href = \"//h/w.zip\" >Get <b>it</b></a >"
            "<a href=\"mailto:a@b\">get it</a><abbr href=\"no\">get it</abbr><a name=n>get it</a>")
    page = spark.createDataFrame([(1, "https://s.org/d/e/p.html?q=1#f", html)], "page_id bigint, url string, html string")
    assert [r.href for r in anchors(page).orderBy("anchor_pos").collect()] == ["/a/x.zip", "../y.zip", "z.zip", "//h/w.zip", "mailto:a@b"]
    got = [(r.link, r.filename) for r in release_links(page, "get it").orderBy("anchor_pos").collect()]
    assert got == [("https://s.org/a/x.zip", "x.zip"), ("https://s.org/d/y.zip", "y.zip"), ("https://s.org/d/e/z.zip", "z.zip"),
                   ("https://h/w.zip", "w.zip"), ("mailto:a@b", "RTT_Full_CSV_.zip")]
    from urllib.parse import urljoin
    base = "http://h.org/a/b/c;x?y#z"
    hrefs = ["g", "./g", "g/", "/g", "//g", "?y2", "g?y/./x", "#s", "", ".", "./", "..", "../", "../g", "../..", "../../g", "../../../g", "http://o/x", "mailto:x"]
    df = spark.createDataFrame([(h,) for h in hrefs], "h string").select("h", resolve_url(F.lit(base), F.col("h")).alias("l"))
    bad = {r.h: (r.l, urljoin(base, r.h)) for r in df.collect() if r.l != urljoin(base, r.h) and r.h}
    assert not bad

