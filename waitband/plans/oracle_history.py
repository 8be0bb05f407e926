"""DuckDB SQL for the queries served from kept state: always a full rebuild from
the revised extract, so a match says that the state lost nothing."""

from __future__ import annotations

from ..config import BANDS, raw_columns
from ..sources.extract import raw_extract_sql
from . import oracle as O

REVISED_RAW = (f"select * from ({raw_extract_sql('duckdb')}) where not (\"Period\" = 'RTT-January-2026' "
               "and coalesce(\"Commissioner Org Code\", '') = 'C40')")


def rebuilt(select: str, extra: str = "") -> str:
    return O.with_base(select, extra, REVISED_RAW)


def q_wait_sketch_rollups() -> str:
    long = " union all ".join(f"select period_date, provider_parent_org_code, treatment_function_code, {i} as week, sum({n}) as p from stg "
                              "where rtt_part_type = 'Part_2' group by all" for i, n in enumerate(BANDS.names()))
    levels = {"national": ("period_date", "null"), "board": ("period_date", "provider_parent_org_code"), "specialty": ("period_date", "treatment_function_code"),
              "board_history": ("null::date", "provider_parent_org_code"), "history": ("null::date", "null")}
    each = " union all ".join(f"select '{k}' as level, {m} as period_date, {e}::varchar as entity, week, p from bands" for k, (m, e) in levels.items())
    hit = lambda q: f"min(week) filter (cast(cum as double) >= {q} * cast(n as double))"
    return rebuilt(f"""select level, period_date, entity, cast(max(n) as bigint) as patients, true as all_seen,
 cast({hit(0.5)} as bigint) as exact_median_week, true as median_week_in_bound,
 cast({hit(0.92)} as bigint) as exact_p92_week, true as p92_week_in_bound
from cums where n > 0 group by level, period_date, entity""", f"""bands as ({long}),
per_week as (select level, period_date, entity, week, sum(p) as p from ({each}) group by all),
cums as (select *, sum(p) over (partition by level, period_date, entity) as n,
  sum(p) over (partition by level, period_date, entity order by week) as cum from per_week)""")


def q_profile_from_sketches() -> str:
    cols = ("provider_org_code", "provider_parent_org_code", "treatment_function_code")
    exact = ", ".join(f"cast(count(distinct {c}) as bigint) as exact_{c}, true as {c}_in_bound" for c in cols)
    return rebuilt(f"""select period_date, cast(count(*) as bigint) as rows, true as rows_exact, {exact} from fact group by period_date
union all select null::date, cast(count(*) as bigint), true, {exact} from fact""")


def q_providers_across_months() -> str:
    return rebuilt("""select period_date, cast(count(*) filter (a and b) as bigint) as exact_stayed, cast(count(*) filter (a and not b) as bigint) as exact_came,
 cast(count(*) filter (b and not a) as bigint) as exact_left, true as stayed_in_bound, true as came_in_bound, true as left_in_bound
from (select coalesce(n.period_date, t.period_date) as period_date, n.period_date is not null as a, t.period_date is not null as b
  from pairs n full join (select cast(period_date + interval 1 month as date) as period_date, x, y from pairs) t
   on n.period_date = t.period_date and n.x is not distinct from t.x and n.y is not distinct from t.y) j
where period_date in (select cast(period_date + interval 1 month as date) from pairs) and period_date in (select period_date from pairs)
group by period_date""", "pairs as (select distinct period_date, provider_org_code as x, treatment_function_code as y from fact)")


def over_revised(query) -> str:
    """A published query's SQL over the revised extract."""
    text = query()
    plain = raw_extract_sql("duckdb")
    if plain not in text:
        raise ValueError("the query does not read the raw extract")
    return text.replace(plain, REVISED_RAW)


def q_stateful_publication() -> str:
    cols = ", ".join(f'cast("{c}" as varchar) as "{c}"' for c in raw_columns())
    day = "strptime(replace(replace(\"Period\", 'RTT-', ''), '-', ' '), '%B %Y')"
    return f"select {cols}, strftime({day}, '%b%y') as _month_code, \"Period\" = 'RTT-January-2026' as _is_revised from ({REVISED_RAW})"


def q_asof_latest_order() -> str:
    hot = "cast(case when o_custkey % 3 = 0 then 0 else o_custkey end as bigint)"
    return f"""with o as (select o_orderkey, {hot} as customer, cast(o_orderdate as date) as day from orders),
v as (select customer, day, min(o_orderkey) as order_key from o group by customer, day),
f as (select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, cast(l_shipdate as date) as shipped, customer from lineitem join o on l_orderkey = o_orderkey)
select f.l_orderkey, f.l_linenumber, f.shipped, f.customer, v.order_key as asof_order_key
from f asof left join v on f.customer = v.customer and f.shipped >= v.day"""


def _asof_provider() -> str:
    return O.ORACLES["asof_provider_name"]()


def _raw_text(more: str) -> str:
    cols = ", ".join(f'cast("{c}" as varchar) as "{c}"' for c in raw_columns())
    return f"select {cols}, {more} from ({raw_extract_sql('duckdb')})"


def q_zip_csv_rows() -> str:
    return _raw_text("strftime(strptime(replace(replace(\"Period\", 'RTT-', ''), '-', ' '), '%B %Y'), '%b%y') || '.csv' as _csv_member")


def q_breach_training_unrevised() -> str:
    from .oracle_loads import q_breach_training_rows
    text, labelled = q_breach_training_rows(), "where target_meets_next_month is not null"
    if labelled not in text:
        raise ValueError("the training rows are not where they were")
    return text.replace(labelled, f"{labelled} and period_date <> date '2025-10-01'")


def q_change_points() -> str:
    """Every way to cut every series: a bit of ``m`` for each month after the first
    says that a segment begins there."""
    return O.with_base("""select provider_org_code, treatment_function_code, ps[starts[k] + 1] as period_date, round(means[k - 1], 4) as mean_before,
 round(means[k], 4) as mean_after, round(means[k] - means[k - 1], 4) as shift
from (select * from scored qualify row_number() over (partition by provider_org_code, treatment_function_code
  order by round(total, 6), list_reverse(starts)) = 1) best, unnest(generate_series(2, len(starts))) as u(k)""", O._panel_cte() + """,
ser as (select provider_org_code, treatment_function_code, list(period_date order by period_date) as ps, list(pct_within_18_weeks order by period_date) as vs
 from panel where pct_within_18_weeks is not null group by all having count(*) >= 4),
cut as (select ser.*, m, len(vs) as n, list_prepend(0, [i for i in generate_series(1, len(vs) - 1) if (m >> (i - 1)) & 1 = 1]) as starts
 from ser, unnest(generate_series(0, (1 << (len(vs) - 1)) - 1)) as u(m)),
part as (select *, [starts[k + 1] - starts[k] for k in generate_series(1, len(starts) - 1)] as own, n - starts[len(starts)] as tail from cut),
fit as (select * from part where tail >= 2 and len([x for x in own if x < 2]) = 0),
scored as (select *, [list_sum(vs[starts[k] + 1 : case when k < len(starts) then starts[k + 1] else n end])
    / (case when k < len(starts) then starts[k + 1] else n end - starts[k]) for k in generate_series(1, len(starts))] as means,
  25.0 * (len(starts) - 1) + list_sum([list_sum([v * v for v in vs[starts[k] + 1 : case when k < len(starts) then starts[k + 1] else n end]])
    - list_sum(vs[starts[k] + 1 : case when k < len(starts) then starts[k + 1] else n end])
      * list_sum(vs[starts[k] + 1 : case when k < len(starts) then starts[k + 1] else n end])
      / (case when k < len(starts) then starts[k + 1] else n end - starts[k]) for k in generate_series(1, len(starts))]) as total from fit)""")


def q_smoothing_forecast() -> str:
    return O.with_base("""select provider_org_code, treatment_function_code, cast(last + to_months(h::int) as date) as period_date, alpha, mae, forecast
from (select provider_org_code, treatment_function_code, max(period_date) as last, alpha, round(sum(abs(v - before)) / (count(*) - 1), 6) as mae,
   round(max(case when k = n then level end), 6) as forecast
  from steps group by provider_org_code, treatment_function_code, alpha
  qualify row_number() over (partition by provider_org_code, treatment_function_code order by mae, alpha) = 1) b, unnest([1, 2, 3]) as u(h)""",
                       O._panel_cte() + """,
pts as (select provider_org_code, treatment_function_code, period_date, cast(total_incomplete as double) as v,
  row_number() over w as k, count(*) over (partition by provider_org_code, treatment_function_code) as n
 from panel where total_incomplete is not null window w as (partition by provider_org_code, treatment_function_code order by period_date)),
steps as (select p.*, a.alpha, l.level, lag(l.level) over (partition by p.provider_org_code, p.treatment_function_code, a.alpha order by p.k) as before
 from pts p, (select x / 10.0::double as alpha from generate_series(1, 9) as g(x)) a,
 lateral (select list_reduce(list_prepend(min(q.v) filter (q.k = 1), list(q.v order by q.k) filter (q.k between 2 and p.k)), lambda x, y: x + a.alpha * (y - x)) as level
  from pts q where q.provider_org_code = p.provider_org_code and q.treatment_function_code = p.treatment_function_code) l
 where p.n >= 4)""")


ORACLES = {
    "zip_csv_rows": q_zip_csv_rows,
    "raw_csv_typed": lambda: O.with_base("select * from stg2"),
    "breach_training_unrevised": q_breach_training_unrevised,
    "change_points": q_change_points,
    "smoothing_forecast": q_smoothing_forecast,
    "asof_latest_order": q_asof_latest_order,
    "asof_provider_sorted": _asof_provider,
    "stateful_publication": q_stateful_publication,
    "wait_sketch_rollups": q_wait_sketch_rollups,
    "profile_from_sketches": q_profile_from_sketches,
    "providers_across_months": q_providers_across_months,
    "dq_suite_from_states": lambda: O._raw_suite_sql(None, REVISED_RAW),
    "dq_suite_from_states_by_month": lambda: O._raw_suite_sql("Period", REVISED_RAW),
    "rollup_national_monthly": lambda: over_revised(O.q_national_monthly),
    "rollup_icb_monthly": lambda: over_revised(O.q_icb_monthly),
    "rollup_surgical_vs_medical": lambda: over_revised(O.q_surgical_vs_medical),
    "rollup_specialty_perf": lambda: over_revised(O.q_specialty_performance),
}
