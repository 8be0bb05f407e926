"""State kept per month: sketches, suite states, maintained roll-ups."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from waitband.config import BANDS
from waitband.operators import quality as DQ
from waitband.operators import rollup as RU
from waitband.operators import sketches as SK
from waitband.plans import pipeline as P
from waitband.session import scratch_path
from tests.test_metrics import raw_frame

M1, M2, M3 = (dt.date(2025, m, 1) for m in (10, 11, 12))


def banded(spark, rows):
    """(period, provider, {week: patients}) rows."""
    schema = "period_date date, provider string, " + ", ".join(f"{n} bigint" for n in BANDS.names())
    return spark.createDataFrame([(m, p, *[b.get(i, 0) for i in range(BANDS.count)]) for m, p, b in rows], schema)


def read_files(df):
    """The files whose rows a query gets."""
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def waits(bands):
    return sorted(w for w, n in bands.items() for _ in range(n))


def test_wait_sketches_are_exact_while_small_and_bounded_when_merged(spark):
    rng = random.Random(3)
    rows = [(m, f"P{i}", {rng.randrange(BANDS.count): rng.randint(1, 400) for _ in range(12)}) for m in (M1, M2) for i in range(30)]
    rows += [(M1, "small", {3: 2, 9: 1}), (M1, "none", {}), (M2, "P0", {5: 25_000})]  # more than one generated array
    sketches = SK.wait_sketches(banded(spark, rows), ["period_date", "provider"])
    path = scratch_path(spark, "test-sketch")
    SK.store(sketches, path)
    stored = spark.read.parquet(path)
    assert stored.filter("provider = 'none'").count() == 0
    small = SK.roll_up_waits(stored.filter("provider = 'small'"), ["provider"], {"lo": 0.5, "hi": 0.9}).first()
    assert (small["patients"], small["lo"], small["hi"]) == (3, 3, 9)
    got = SK.roll_up_waits(stored, [], {"q10": 0.1, "q50": 0.5, "q92": 0.92}).first()
    every = sorted(w for _, _, b in rows for w in waits(b))
    assert got["patients"] == len(every)
    for name, q in (("q10", 0.1), ("q50", 0.5), ("q92", 0.92)):
        lo = sum(w < got[name] for w in every) / len(every)
        hi = sum(w <= got[name] for w in every) / len(every)
        assert lo <= q + 2 * SK.rank_error() and hi >= q - 2 * SK.rank_error()


def test_exact_quantiles_and_the_bound_on_ranks(spark):
    df = banded(spark, [(M1, "A", {0: 1, 10: 1, 20: 2}), (M1, "B", {}), (M1, "C", {104: 7})])
    df = df.withColumn("n", F.expr(" + ".join(BANDS.names())))
    got = {r["provider"]: (r["m"], r["p"], r["far"], r["near"]) for r in df.select(
        "provider", SK.band_quantile(0.5).alias("m"), SK.band_quantile(0.92).alias("p"),
        SK.rank_within(F.lit(20), 0.1, 0.05).alias("far"), SK.rank_within(F.lit(10), 0.5, 0.01).alias("near")).collect()}
    assert got["A"] == (10, 20, False, True) and got["B"][:2] == (None, None) and got["C"][:2] == (104, 104)


def test_a_revised_month_replaces_its_sketches_alone(spark):
    path = scratch_path(spark, "test-sketch")
    SK.store(SK.wait_sketches(banded(spark, [(M1, "A", {1: 5}), (M2, "A", {2: 5})]), ["period_date", "provider"]), path)
    before = read_files(spark.read.parquet(path).filter(F.col("period_date") == M1))
    SK.store(SK.wait_sketches(banded(spark, [(M2, "A", {9: 3})]), ["period_date", "provider"]), path)
    after = spark.read.parquet(path)
    assert read_files(after.filter(F.col("period_date") == M1)) == before
    got = {r["period_date"]: (r["patients"], r["m"]) for r in SK.roll_up_waits(after, ["period_date"], {"m": 0.5}).collect()}
    assert got == {M1: (5, 1), M2: (3, 9)}


def test_distinct_sketches_union_and_intersect(spark):
    rows = [(M1, f"P{i % 700}", "x") for i in range(3000)] + [(M2, f"P{i}", None) for i in range(350, 1000)]
    s = SK.distinct_sketches(spark.createDataFrame(rows, "period_date date, p string, q string"), ["period_date"], ["p", "q"])
    whole = SK.roll_up_distinct(s, [], ["p", "q"]).first()
    assert whole["rows"] == 3650 and whole["n_q"] == 3000 and whole["distinct_q"] == 1
    assert abs(whole["distinct_p"] - 1000) <= 1000 * SK.distinct_error()
    overlap = {r["period_date"]: tuple(r)[1:] for r in SK.month_overlap(s, "p").collect()}
    assert overlap[M1] == (None, None, None)
    for got, want in zip(overlap[M2], (350, 300, 350)):
        assert abs(got - want) <= 1000 * SK.distinct_error()


def test_suite_states_merge(spark):
    rules = DQ.raw_extract_rules()
    jan = raw_frame(spark, [{"Provider Org Code": f"P{i}", "bands": {1: i}} for i in range(4)] + [{"Provider Org Code": None, "bands": {2: -1}}])
    dec = raw_frame(spark, [{"Period": "RTT-December-2025", "Provider Org Code": f"P{i}", "bands": {1: i}} for i in range(2, 9)])
    key = lambda df: sorted(map(tuple, df.collect()))
    merged = DQ.suite_states(jan, rules).unionByName(DQ.suite_states(dec, rules))
    assert key(DQ.fold_states(merged, jan, rules)) == key(DQ.run_suite(jan.unionByName(dec), rules))
    # merging is associative and the state of no rows changes nothing
    more = merged.unionByName(DQ.suite_states(jan.limit(0), rules))
    assert key(DQ.fold_states(more, jan, rules)) == key(DQ.fold_states(merged, jan, rules))


def test_states_of_other_months_are_not_read(spark):
    rules, path = DQ.raw_extract_rules(), scratch_path(spark, "test-states")
    rows = lambda p, n: raw_frame(spark, [{"Period": p, "Provider Org Code": f"P{i}", "bands": {1: i}} for i in range(n)]).withColumn("m", F.col("Period"))
    both = rows("RTT-December-2025", 3).unionByName(rows("RTT-January-2026", 5))
    DQ.store_states(DQ.suite_states(both, rules, by=["m"]), path, "m")
    kept = read_files(spark.read.parquet(path).filter("m = 'RTT-December-2025'"))
    revised = DQ.suite_states(rows("RTT-January-2026", 2), rules, by=["m"])
    DQ.store_states(revised, path, "m")
    states = spark.read.parquet(path)
    assert read_files(states.filter("m = 'RTT-December-2025'")) == kept
    # the suite's plan scans the states and nothing else
    assert {f.rsplit("/m=", 1)[0].split(":")[-1].strip("/") for f in DQ.fold_states(states, both, rules).inputFiles()} == {path.split(":")[-1].strip("/")}
    got = sorted(map(tuple, DQ.fold_states(states, both, rules).collect()))
    want = sorted(map(tuple, DQ.run_suite(rows("RTT-December-2025", 3).unionByName(rows("RTT-January-2026", 2)).drop("m"), rules).collect()))
    assert [g for g in got if g[0] != "column_count_equals_121"] == [w for w in want if w[0] != "column_count_equals_121"]


def facts(spark, rows):
    return spark.createDataFrame(rows, "period_date date, g string, h string, v bigint")


MEASURES = {"v": "v", "seen": "cast(v is not null as bigint)"}


def published(spark, base, rows, months):
    RU.publish(spark, base, facts(spark, rows), months, dims=["g", "h"], total_dims=["g"], measures=MEASURES)


def test_rollup_equals_a_rebuild_after_any_revisions(spark):
    rng, base = random.Random(5), scratch_path(spark, "test-rollup")
    now = {}
    for step in range(6):
        months = rng.sample([M1, M2, M3], rng.randint(1, 2))
        for m in months:
            now[m] = [(m, rng.choice(["a", "b", None]), rng.choice("xy"), rng.choice([None, -3, 5, 10 ** 12])) for _ in range(rng.choice([0, 1, 8]))]
        published(spark, base, [r for m in months for r in now[m]], months)
        rows = [r for m in now for r in now[m]]
        want_total, want_month = {}, {}
        for m, g, h, v in rows:
            for at, k in ((want_total, (g,)), (want_month, (m, g, h))):
                x = at.setdefault(k, [0, 0, 0])
                x[0] += v or 0
                x[1] += v is not None
                x[2] += 1
        got = {(r["g"],): [r["v"], r["seen"], r[RU.ROWS]] for r in RU.totals(spark, base).collect()}
        assert got == want_total, step
        got = {(r["period_date"], r["g"], r["h"]): [r["v"], r["seen"], r[RU.ROWS]] for r in RU.month_sums(spark, base).collect()}
        assert got == want_month, step


def test_rollup_reads_only_the_months_it_replaces_and_outlives_a_broken_step(spark):
    base = scratch_path(spark, "test-rollup")
    published(spark, base, [(M1, "a", "x", 1), (M2, "a", "x", 2)], [M1, M2])
    assert all(f"period_date={M2}" in f for f in RU.month_sums(spark, base, [str(M2)]).inputFiles())
    # a step that broke off before its marker
    facts(spark, [(M2, "a", "x", 99)]).write.partitionBy("period_date").parquet(f"{base}/v=2/months")
    assert RU.versions(spark, base) == [1]
    published(spark, base, [(M2, "b", "x", 7)], [M2])
    assert {(r["g"], r["v"]) for r in RU.totals(spark, base).collect()} == {("a", 1), ("b", 7)}
    assert {m: f.rsplit("=", 1)[1] for m, f in RU.month_folders(spark, base).items()} == {str(M1): "1", str(M2): "2"}


@pytest.mark.parametrize("name", ["national_monthly", "icb_monthly", "surgical_vs_medical"])
def test_reports_from_the_rollup_equal_those_from_the_fact(spark, name):
    from waitband.plans import published as Q
    fact = P.fact(spark, "/root/testdata/sf0.001")
    base, months = scratch_path(spark, "test-rollup"), [r[0] for r in fact.select("period_date").distinct().collect()]
    RU.publish(spark, base, fact, months)
    run = getattr(Q, name)
    key = lambda r: str(tuple(r))
    assert sorted(run(RU.month_sums(spark, base)).collect(), key=key) == sorted(run(fact).collect(), key=key)
