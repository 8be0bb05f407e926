"""The wide monthly extract, derived from the base tables.

The published pipeline ingests monthly files with 13 identity columns, 105
week-of-wait band columns and 3 totals.  For tests and benchmarks we derive a
table of exactly that shape from the TPC-H-style driver tables, so its size
grows with them:

* provider      = supplier (``l_suppkey``); parent board = provider mod 42
* commissioner  = customer region; region 0 has no parent (national hub)
* specialty     = ``l_partkey`` mod 8 (one code is unmapped, one is a summary row)
* pathway type  = return flag / line status
* month         = order month mod 6 -> six reporting months Aug 2025 .. Jan 2026
* week of wait  = |ship date - order date| in weeks; a third of providers
  keep every wait under 18 weeks
* patients      = line quantity

Some providers are renamed or move board in the last months (for SCD2).

``raw_extract`` is the distributed Spark build; ``raw_extract_sql`` renders the
same definition as SQL (used by the DuckDB oracle).  Plan: orders ⋈ customer
(shuffle on custkey, or broadcast if Spark's size estimate allows) ⋈ nation
(broadcast: 25 rows by definition) → lineitem ⋈ that on orderkey (sort-merge,
which can spill; never broadcast) → one aggregation per (group, band), then a
spread of the bands into columns.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BANDS, RAW_TOTAL_COLUMNS, BandSpec, raw_columns
from .tables import table

# Fixed values of the derived extract layout.
MONTHS = ("August-2025", "September-2025", "October-2025", "November-2025",
          "December-2025", "January-2026")  # index = month(order date) mod 6
SPECIALTY_CODES = ("C_999", "C_110", "C_130", "C_100", "C_120", "C_502", "X02", "X06")
N_PARENTS = 42
WEEK_CYCLE = 110
RENAME_EVERY, MOVE_EVERY = 7, 11
RENAMED_MONTHS = ("December-2025", "January-2026")
MOVED_MONTH = "January-2026"


def _case(key: Column, values) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = F.when(key == i, F.lit(v)) if expr is None else expr.when(key == i, F.lit(v))
    return expr


#: Pathway types, by the code that a line carries.
PART_TYPES = ("Part_2", "Part_1A", "Part_1B", "Part_2A", "Part_3")


def _code(key: Column, values) -> Column:
    """``key`` as a byte where it numbers one of ``values``, else NULL."""
    return F.when(key.between(0, len(values) - 1), key).cast("tinyint")


def _line_rows(spark: SparkSession, sf_dir: str, parts: int) -> DataFrame:
    """A row per line, narrow (numbers for the texts that ``raw_extract`` puts in
    once per group): three shuffles carry as many rows as there are lines."""
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    part_type = F.when(rf == "N", 0).when((rf == "A") & (ls == "F"), 1).when(rf == "A", 2).when(ls == "F", 3).otherwise(4)
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_suppkey").alias("pk"), _code(F.col("l_partkey") % 8, SPECIALTY_CODES).alias("tf"),
        part_type.cast("tinyint").alias("pt"), "l_quantity", F.col("l_linenumber").alias("ln"), F.to_date("l_shipdate").alias("shipped"))
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("ordered"))
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")

    order_dim = (
        od.join(cu, od.o_custkey == cu.c_custkey)
        .join(F.broadcast(na), F.col("c_nationkey") == na.n_nationkey)
        .select("o_orderkey", "ordered", F.col("n_regionkey").alias("rk"))
    )
    days = F.abs(F.datediff("shipped", "ordered"))
    # Both sides grow with the data, so neither is broadcast (Spark's static
    # estimate of a pruned lineitem can fall under the broadcast threshold).
    # A sort-merge join spills where a partition outgrows memory.  An order key
    # is one order with its few lines.
    li, order_dim = li.repartition(parts, "l_orderkey"), order_dim.repartition(parts, "o_orderkey")
    line = li.join(order_dim.hint("merge"), li.l_orderkey == order_dim.o_orderkey).select(
        _code(F.month("ordered") % 6, MONTHS).alias("pm"), "pk", "rk", "tf", "pt", F.col("l_quantity").cast("bigint").alias("patients"), "ln",
        (F.floor(days / 7).cast("int") % WEEK_CYCLE).alias("w"),
    )
    pk, w = F.col("pk"), F.col("w")
    band = (F.when(((pk % 3) == 0) | (((pk % 3) == 1) & (F.col("ln") < 7)), w % 18)
            .when(w > 104, 104).otherwise(w))
    return line.select("pm", "pk", "rk", "tf", "pt", "patients", band.cast("tinyint").alias("band"))


#: Lines that one task joins, or spreads into columns.
SPREAD_ROWS = 250_000


def spread_partitions(rows: int, cores: int) -> int:
    """Partitions for ``rows`` lines: what a task holds does not grow with them;
    fewer lines still go to all cores, down to a tenth of a full task."""
    return max(1, -(-rows // SPREAD_ROWS), min(cores, 10 * rows // SPREAD_ROWS))


def raw_extract(spark: SparkSession, sf_dir: str, bands: BandSpec = BANDS) -> DataFrame:
    """Wide extract (121 columns, raw names with spaces), one row per
    month x provider x commissioner x pathway x specialty."""
    parts = spread_partitions(table(spark, sf_dir, "lineitem").count(), spark.sparkContext.defaultParallelism)
    line = _line_rows(spark, sf_dir, parts)
    # Two-phase band spread.  (1) Sum per (group, band), whose lines a task takes
    # in as they come.  (2) Re-partition the per-band rows by ranges of month and
    # provider - at most 105 rows per group and a group per combination of codes,
    # so no provider can skew a task; a task holds one month, or the end of one and
    # the next, so a write by month needs no shuffle of the wide rows; what is
    # summed per provider, as in the suite, is in one task - and spread the bands
    # into columns inside each task.  Spreading before that shuffle would move
    # mostly-empty 106-wide partial rows instead.  The total is a real aggregate,
    # not a 105-term expression.  The spread turns a narrow row into one of 1 KB
    # in the task's hash table, so tasks are numbered by rows: sized by shuffled
    # bytes, as AQE does, each would hold millions of groups.
    keys = ["pm", "pk", "rk", "pt", "tf"]
    sums = line.repartition(parts, *keys, "band").groupBy(*keys, "band").agg(F.sum("patients").alias("p"))
    per_band = sums.repartitionByRange(parts, "pm", "pk")
    agg = per_band.groupBy(*keys).agg(
        *[F.expr(f"cast(sum(case when band = {i} then p end) as bigint) as `{bands.raw_name(i)}`")
          for i in range(bands.count)],
        F.sum("p").cast("bigint").alias("__total"))

    pk, rk = F.col("pk"), F.col("rk")
    pm, tf, pt = _case(F.col("pm"), MONTHS), _case(F.col("tf"), SPECIALTY_CODES), _case(F.col("pt"), PART_TYPES)
    parent_idx = F.when(((pk % MOVE_EVERY) == 0) & (pm == MOVED_MONTH), (pk + 1) % N_PARENTS) \
        .otherwise(pk % N_PARENTS)
    s = lambda c: c.cast("string")
    renamed = ((pk % RENAME_EVERY) == 0) & pm.isin(*RENAMED_MONTHS)
    return agg.select(
        F.concat(F.lit("RTT-"), pm).alias("Period"),
        F.concat(F.lit("Q"), F.lpad(s(parent_idx), 2, "0")).alias("Provider Parent Org Code"),
        F.concat(F.lit("Board "), s(parent_idx)).alias("Provider Parent Name"),
        F.concat(F.lit("P"), F.lpad(s(pk), 5, "0")).alias("Provider Org Code"),
        F.concat(F.lit("Trust "), s(pk), F.when(renamed, " (renamed)").otherwise("")).alias("Provider Org Name"),
        F.when(rk == 0, None).otherwise(F.concat(F.lit("R"), s(rk), F.lit("0"))).alias("Commissioner Parent Org Code"),
        F.when(rk == 0, None).otherwise(F.concat(F.lit("Region "), s(rk))).alias("Commissioner Parent Name"),
        F.concat(F.lit("C"), s(rk), F.lit("0")).alias("Commissioner Org Code"),
        F.when(rk == 1, None).otherwise(F.concat(F.lit("Sub-board "), s(rk))).alias("Commissioner Org Name"),
        pt.alias("RTT Part Type"),
        F.concat(F.lit("Desc "), pt).alias("RTT Part Description"),
        tf.alias("Treatment Function Code"),
        F.concat(F.lit("Service "), tf).alias("Treatment Function Name"),
        *bands.raw_names(),
        F.col("__total").alias("Total"),
        F.lit(None).cast("bigint").alias("Patients with unknown clock start date"),
        F.col("__total").alias("Total All"),
    )


# ---------------------------------------------------------------------------
# The same extract as dirty text: what monthly files hold besides clean counts.
# Each case is a condition on codes, so both engines build the same rows.
# ---------------------------------------------------------------------------
def _dirty_cases(q: str) -> dict[str, str]:
    """Raw column -> SQL expression (codes of the clean row, counts as text)."""
    prov, comm, tf, period = (f"{q}{c}{q}" for c in ("Provider Org Code", "Commissioner Org Code", "Treatment Function Code", "Period"))
    ends = lambda d: f"right({prov}, 1) = '{d}'"
    text = lambda c: f"cast({q}{c}{q} as string)"
    zero = f"{ends(5)} and {tf} = 'C_502'"
    out = {
        "Commissioner Org Code": f"case when {ends(3)} and {comm} = 'C20' then null else {comm} end",
        "Provider Org Code": f"case when {ends(7)} and {tf} = 'X06' then null else {prov} end",
        "Treatment Function Code": f"case when {ends(9)} and {tf} = 'X06' then 'King''s' else {tf} end",
        "Period": f"case when {ends(6)} then concat(left({period}, length({period}) - 5), ' ', right({period}, 4)) "
                  f"when {ends(8)} and {tf} = 'X02' then 'RTT-Smarch-2026' else {period} end",
    }
    for c in BANDS.raw_names():
        out[c] = f"case when {zero} then null else {text(c)} end"
    for c in ("Total", "Total All"):
        out[c] = f"case when {zero} then '0' when {comm} = 'C30' then concat({text(c)}, '.0') else {text(c)} end"
    first, second, third = BANDS.raw_names()[:3]
    out[first] = f"case when {ends(2)} then '*' else {out[first]} end"
    out[second] = f"case when {ends(4)} and {tf} = 'C_100' then '-5' else {out[second]} end"
    out[third] = f"case when {ends(1)} and {tf} = 'C_130' then 'NaN' else {out[third]} end"
    return out


def dirty_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_extract`` as text with a null provider or commissioner code, zero
    totals without bands, ``*``, ``NaN``, ``12.0`` and negative cells, space-form
    and unparseable periods, and a code with an apostrophe."""
    raw = raw_extract(spark, sf_dir)
    return raw.selectExpr(*[f"{e} as `{c}`" for c, e in _dirty_exprs("`", raw.columns)])


def _dirty_exprs(q: str, columns: list[str]) -> list[tuple[str, str]]:
    cases = _dirty_cases(q)
    plain = lambda c: f"cast({q}{c}{q} as string)" if c in RAW_TOTAL_COLUMNS else f"{q}{c}{q}"
    return [(c, cases.get(c, plain(c))) for c in columns]


def dirty_extract_sql() -> str:
    """``dirty_extract`` for DuckDB."""
    cols = ", ".join(f'{e} as "{c}"' for c, e in _dirty_exprs('"', raw_columns()))
    return f"select {cols} from ({raw_extract_sql('duckdb')}) clean"


def raw_extract_sql(dialect: str = "duckdb", bands: BandSpec = BANDS) -> str:
    """The same derived extract as one SQL query (``duckdb`` or ``spark``)."""
    q = '"' if dialect == "duckdb" else "`"
    days = ("date_diff('day', o.o_orderdate, l.l_shipdate)" if dialect == "duckdb"
            else "datediff(l.l_shipdate, o.o_orderdate)")
    months = " ".join(f"when {i} then '{m}'" for i, m in enumerate(MONTHS))
    specs = " ".join(f"when {i} then '{c}'" for i, c in enumerate(SPECIALTY_CODES))
    band_cols = ",\n ".join(
        f"cast(sum(case when band = {i} then patients end) as bigint) as {q}{bands.raw_name(i)}{q}"
        for i in range(bands.count))
    pidx = (f"(case when pk % {MOVE_EVERY} = 0 and pm = '{MOVED_MONTH}' "
            f"then (pk + 1) % {N_PARENTS} else pk % {N_PARENTS} end)")
    renamed_in = ", ".join(f"'{m}'" for m in RENAMED_MONTHS)
    return f"""
with line as (
 select case month(o.o_orderdate) % 6 {months} end as pm,
  l.l_suppkey as pk, n.n_regionkey as rk,
  case l.l_partkey % 8 {specs} end as tf,
  case when l.l_returnflag = 'N' then 'Part_2'
       when l.l_returnflag = 'A' and l.l_linestatus = 'F' then 'Part_1A'
       when l.l_returnflag = 'A' then 'Part_1B'
       when l.l_linestatus = 'F' then 'Part_2A' else 'Part_3' end as pt,
  cast(l.l_quantity as bigint) as patients, l.l_linenumber as ln,
  cast(floor(abs({days}) / 7) as int) % {WEEK_CYCLE} as w
 from lineitem l join orders o on l.l_orderkey = o.o_orderkey
  join customer cu on o.o_custkey = cu.c_custkey
  join nation n on cu.c_nationkey = n.n_nationkey),
banded as (
 select *, case when pk % 3 = 0 or (pk % 3 = 1 and ln < 7) then w % 18
                when w > 104 then 104 else w end as band from line),
grouped as (
 select pm, pk, rk, pt, tf,
 {band_cols},
 cast(sum(patients) as bigint) as __total
 from banded group by pm, pk, rk, pt, tf)
select concat('RTT-', pm) as {q}Period{q},
 concat('Q', lpad(cast({pidx} as varchar), 2, '0')) as {q}Provider Parent Org Code{q},
 concat('Board ', cast({pidx} as varchar)) as {q}Provider Parent Name{q},
 concat('P', lpad(cast(pk as varchar), 5, '0')) as {q}Provider Org Code{q},
 concat('Trust ', cast(pk as varchar),
        case when pk % {RENAME_EVERY} = 0 and pm in ({renamed_in}) then ' (renamed)' else '' end) as {q}Provider Org Name{q},
 case when rk = 0 then null else concat('R', cast(rk as varchar), '0') end as {q}Commissioner Parent Org Code{q},
 case when rk = 0 then null else concat('Region ', cast(rk as varchar)) end as {q}Commissioner Parent Name{q},
 concat('C', cast(rk as varchar), '0') as {q}Commissioner Org Code{q},
 case when rk = 1 then null else concat('Sub-board ', cast(rk as varchar)) end as {q}Commissioner Org Name{q},
 pt as {q}RTT Part Type{q}, concat('Desc ', pt) as {q}RTT Part Description{q},
 tf as {q}Treatment Function Code{q}, concat('Service ', tf) as {q}Treatment Function Name{q},
 {", ".join(f"{q}{bands.raw_name(i)}{q}" for i in range(bands.count))},
 __total as {q}Total{q},
 cast(null as bigint) as {q}Patients with unknown clock start date{q},
 __total as {q}Total All{q}
from grouped"""
