"""Reference SQL for cross-engine checks (DuckDB dialect).

Each string runs on DuckDB against views named after the base tables.  The
SQL is written independently of the DataFrame code (plain CTEs), so a match
means two engines agree on the semantics.  Casts pin types to the ones the
Spark side produces (bigint, double, varchar, boolean, date).
"""

from __future__ import annotations

from ..config import BANDS, SOURCE_LABEL, SURROGATE_NULL_TOKEN
from ..sources.extract import raw_extract_sql
from ..sources.seed import seed_values_sql


def _q(name: str) -> str:
    return '"' + name + '"'


def _bsum(lo: int, hi: int | None = None) -> str:
    return " + ".join(BANDS.names_between(lo, hi))


def _count(name: str) -> str:
    """A raw count, typed or text, as bigint (no number: NULL)."""
    return f"try_cast(try_cast(trim(cast({_q(name)} as varchar)) as double) as bigint)"


def base_ctes(raw_sql: str | None = None) -> str:
    """raw -> stg -> int_ip -> seed -> fact, as DuckDB CTEs (no leading WITH)."""
    b = BANDS
    bands_sel = ",\n  ".join(f"coalesce({_count(b.raw_name(i))}, 0) as {b.name(i)}" for i in range(b.count))
    pd = "try_strptime(replace(regexp_replace(\"Period\", '^RTT-', ''), '-', ' '), '%B %Y')::date"
    tok = SURROGATE_NULL_TOKEN
    return f"""raw as ({raw_sql or raw_extract_sql('duckdb')}),
stg as (
 select timestamp '2026-02-15 06:00:00' as _loaded_at,
  '{SOURCE_LABEL}' as _source,
  "Period" as period_raw, {pd} as period_date,
  "Provider Parent Org Code" as provider_parent_org_code, "Provider Parent Name" as provider_parent_name,
  "Provider Org Code" as provider_org_code, "Provider Org Name" as provider_org_name,
  coalesce("Commissioner Parent Org Code", 'NATIONAL') as commissioner_parent_org_code,
  coalesce("Commissioner Parent Name", 'National Commissioning') as commissioner_parent_name,
  "Commissioner Org Code" as commissioner_org_code,
  coalesce("Commissioner Org Name", 'Unknown Commissioner') as commissioner_org_name,
  "RTT Part Type" as rtt_part_type, "RTT Part Description" as rtt_part_description,
  "Treatment Function Code" as treatment_function_code, "Treatment Function Name" as treatment_function_name,
  {_count("Total All")} as total_all, coalesce({_count("Total")}, 0) as total_pathways,
  coalesce({_count("Patients with unknown clock start date")}, 0) as patients_unknown_clock_start,
  {bands_sel}
 from raw),
stg2 as (
 select *, cast(year(period_date - interval 3 month) as varchar) || '-'
   || lpad(cast((year(period_date - interval 3 month) + 1) % 100 as varchar), 2, '0') as financial_year
 from stg),
int_ip as (
 select period_date, financial_year, provider_parent_org_code, provider_parent_name, provider_org_code,
  provider_org_name, commissioner_parent_org_code, commissioner_parent_name, commissioner_org_code,
  commissioner_org_name, treatment_function_code, treatment_function_name,
  total_all as total_incomplete,
  {_bsum(0, 18)} as patients_within_18_weeks,
  {_bsum(18)} as patients_beyond_18_weeks,
  {_bsum(52)} as patients_waiting_52_plus_weeks,
  {b.name(104)} as patients_waiting_over_104_weeks,
  case when total_all = 0 then null
       else round(cast({_bsum(0, 18)} as double) * 100.0 / cast(total_all as double), 1) end
   as pct_within_18_weeks,
  case when total_all = 0 then null
       else cast({_bsum(0, 18)} as double) * 100.0 / cast(total_all as double) >= 92.0 end
   as meets_18_week_standard,
  _loaded_at, _source
 from stg2
 where rtt_part_type = 'Part_2' and treatment_function_code != 'C_999'),
seed(treatment_function_code, treatment_function_name, specialty_group, is_surgical) as (
 values {seed_values_sql()}),
fact as (
 select md5(concat_ws('-',
    coalesce(cast(ip.period_date as varchar), '{tok}'), coalesce(ip.provider_org_code, '{tok}'),
    coalesce(ip.commissioner_org_code, '{tok}'), coalesce(ip.treatment_function_code, '{tok}')))
    as rtt_performance_id,
  ip.period_date, ip.financial_year,
  cast(year(ip.period_date) as bigint) as calendar_year, cast(month(ip.period_date) as bigint) as calendar_month,
  strftime(ip.period_date, '%B') as month_name, strftime(ip.period_date, '%b %Y') as month_label,
  ip.provider_parent_org_code, ip.provider_parent_name, ip.provider_org_code, ip.provider_org_name,
  ip.commissioner_parent_org_code, ip.commissioner_parent_name, ip.commissioner_org_code,
  ip.commissioner_org_name, ip.treatment_function_code, ip.treatment_function_name,
  tf.specialty_group, tf.is_surgical,
  ip.total_incomplete, ip.patients_within_18_weeks, ip.patients_beyond_18_weeks,
  ip.patients_waiting_52_plus_weeks, ip.patients_waiting_over_104_weeks,
  ip.pct_within_18_weeks, ip.meets_18_week_standard,
  case when ip.pct_within_18_weeks is null then 'Unknown' when ip.pct_within_18_weeks >= 92.0 then 'Green'
       when ip.pct_within_18_weeks >= 85.0 then 'Amber' else 'Red' end as rag_status,
  case when ip.patients_waiting_over_104_weeks > 0 then 'Over 2 Years'
       when ip.patients_waiting_52_plus_weeks > 0 then 'Over 1 Year'
       when ip.patients_beyond_18_weeks > 0 then 'Over 18 Weeks' else 'Within Standard' end as breach_severity,
  ip._loaded_at, ip._source
 from int_ip ip left join seed tf on ip.treatment_function_code = tf.treatment_function_code)"""


def with_base(select_sql: str, extra_ctes: str = "", raw_sql: str | None = None) -> str:
    extra = (",\n" + extra_ctes) if extra_ctes else ""
    return f"with {base_ctes(raw_sql)}{extra}\n{select_sql}"


def _ratio(num: str, den: str) -> str:
    return f"(cast({num} as double) * 100.0 / nullif(cast({den} as double), 0))"


# ---------------------------------------------------------------------------
# Published queries
# ---------------------------------------------------------------------------

def q_national_monthly() -> str:
    r = _ratio("sum(patients_within_18_weeks)", "sum(total_incomplete)")
    return with_base(f"""select month_label, period_date,
 cast(sum(total_incomplete) as bigint) as total_waiting,
 cast(sum(patients_within_18_weeks) as bigint) as within_18_weeks,
 cast(sum(patients_beyond_18_weeks) as bigint) as beyond_18_weeks,
 round({r}, 1) as pct_within_18_weeks,
 cast(sum(patients_waiting_52_plus_weeks) as bigint) as over_1_year,
 cast(sum(patients_waiting_over_104_weeks) as bigint) as over_2_years
from fact group by month_label, period_date order by period_date""")


def q_trust_league() -> str:
    r = _ratio("sum(patients_within_18_weeks)", "sum(total_incomplete)")
    return with_base(f"""select provider_org_name, provider_parent_name as icb,
 cast(sum(total_incomplete) as bigint) as total_waiting,
 round({r}, 1) as pct_within_18_weeks,
 cast(sum(patients_waiting_52_plus_weeks) as bigint) as over_1_year,
 cast(sum(patients_waiting_over_104_weeks) as bigint) as over_2_years,
 case when {r} >= 92 then 'Green' when {r} >= 85 then 'Amber' else 'Red' end as rag_status
from fact where period_date = date '2026-01-01'
group by provider_org_name, provider_parent_name order by pct_within_18_weeks asc""")


def q_specialty_performance() -> str:
    return with_base("""select treatment_function_name, specialty_group, is_surgical,
 round(cast(sum(cast(round(pct_within_18_weeks * 10) as bigint)) as double)
       / nullif(cast(count(pct_within_18_weeks) as double) * 10.0, 0), 1) as avg_pct_within_18_weeks,
 cast(sum(total_incomplete) as bigint) as total_waiting_all_months,
 cast(sum(patients_waiting_over_104_weeks) as bigint) as total_over_2_years
from fact group by treatment_function_name, specialty_group, is_surgical
order by avg_pct_within_18_weeks asc""")


def q_icb_monthly() -> str:
    r = _ratio("sum(patients_within_18_weeks)", "sum(total_incomplete)")
    return with_base(f"""select provider_parent_name as icb_name, provider_parent_org_code as icb_code,
 period_date, month_label, cast(sum(total_incomplete) as bigint) as total_waiting,
 round({r}, 1) as pct_within_18_weeks,
 cast(sum(patients_waiting_over_104_weeks) as bigint) as over_2_years
from fact group by provider_parent_name, provider_parent_org_code, period_date, month_label
order by period_date, pct_within_18_weeks asc""")


def q_over_two_years() -> str:
    return with_base("""select period_date, month_label, provider_org_name, provider_parent_name as icb,
 treatment_function_name,
 cast(sum(patients_waiting_over_104_weeks) as bigint) as patients_over_2_years,
 cast(sum(total_incomplete) as bigint) as total_waiting
from fact where patients_waiting_over_104_weeks > 0
group by period_date, month_label, provider_org_name, provider_parent_name, treatment_function_name
order by patients_over_2_years desc""")


def q_trust_trend() -> str:
    return with_base("""select month_label, period_date, treatment_function_name, total_incomplete,
 patients_within_18_weeks, pct_within_18_weeks, patients_waiting_52_plus_weeks,
 patients_waiting_over_104_weeks, rag_status
from fact where provider_org_name = 'Trust 1' order by period_date, treatment_function_name""")


def q_rag_distribution() -> str:
    return with_base("""select month_label, period_date, rag_status, cast(count(*) as bigint) as count,
 round(cast(count(*) as double) * 100.0 / cast(sum(count(*)) over (partition by period_date) as double), 1)
   as pct_of_total
from fact group by month_label, period_date, rag_status order by period_date, rag_status""")


def q_surgical_vs_medical() -> str:
    r = _ratio("sum(patients_within_18_weeks)", "sum(total_incomplete)")
    return with_base(f"""select specialty_group, is_surgical, period_date, month_label,
 cast(sum(total_incomplete) as bigint) as total_waiting, round({r}, 1) as pct_within_18_weeks,
 cast(sum(patients_waiting_over_104_weeks) as bigint) as over_2_years
from fact group by specialty_group, is_surgical, period_date, month_label
order by period_date, specialty_group""")


def q_month_on_month() -> str:
    return with_base("""select month_label, period_date, total_waiting,
 total_waiting - lag(total_waiting) over (order by period_date) as mom_change,
 round(cast(total_waiting - lag(total_waiting) over (order by period_date) as double) * 100.0
       / nullif(cast(lag(total_waiting) over (order by period_date) as double), 0), 2) as mom_pct_change,
 within_18_weeks, over_2_years
from monthly_totals order by period_date""", """monthly_totals as (
 select period_date, month_label, cast(sum(total_incomplete) as bigint) as total_waiting,
  cast(sum(patients_within_18_weeks) as bigint) as within_18_weeks,
  cast(sum(patients_waiting_over_104_weeks) as bigint) as over_2_years
 from fact group by period_date, month_label)""")


def q_trust_scorecard() -> str:
    r = _ratio("sum(patients_within_18_weeks)", "sum(total_incomplete)")
    return with_base(f"""select provider_org_code, provider_org_name, provider_parent_name as icb,
 cast(sum(total_incomplete) as bigint) as total_waiting,
 cast(sum(patients_within_18_weeks) as bigint) as within_18_weeks,
 cast(sum(patients_beyond_18_weeks) as bigint) as beyond_18_weeks,
 round({r}, 1) as pct_within_18_weeks,
 cast(sum(patients_waiting_52_plus_weeks) as bigint) as over_1_year,
 cast(sum(patients_waiting_over_104_weeks) as bigint) as over_2_years,
 case when {r} >= 92 then 'Green — Meeting standard' when {r} >= 85 then 'Amber — Underperforming'
      else 'Red — Formal breach' end as performance_status,
 cast(count(distinct treatment_function_code) as bigint) as specialties_reported
from fact where period_date = date '2026-01-01'
group by provider_org_code, provider_org_name, provider_parent_name order by pct_within_18_weeks asc""")


def q_fact_performance() -> str:
    return with_base("select * from fact")


def q_int_incomplete() -> str:
    return with_base("select * from int_ip")


ORACLES = {
    "fact_performance": q_fact_performance,
    "int_incomplete": q_int_incomplete,
    "national_monthly": q_national_monthly,
    "trust_league": q_trust_league,
    "specialty_perf": q_specialty_performance,
    "icb_monthly": q_icb_monthly,
    "over_2_years": q_over_two_years,
    "trust_trend": q_trust_trend,
    "rag_distribution": q_rag_distribution,
    "surgical_vs_medical": q_surgical_vs_medical,
    "month_on_month": q_month_on_month,
    "trust_scorecard": q_trust_scorecard,
}


def oracle_sql() -> dict[str, str]:
    from .oracle_history import ORACLES as history
    from .oracle_loads import ORACLES as loads
    return {k: f() for k, f in (ORACLES | loads | history).items()}


# ---------------------------------------------------------------------------
# Data-quality suite
# ---------------------------------------------------------------------------

def _dq_union(checks, source: str, group: str | None = None) -> str:
    """checks: list of (name, severity, passed_sql, affected_sql, observed_sql)
    evaluated over one aggregate row per group of ``source``."""
    parts = []
    g = f"{group}, " if group else ""
    for name, sev, passed, affected, observed in checks:
        parts.append(
            f"select {g}'{name}' as check_name, ({passed}) as passed, "
            f"case when ({passed}) then 'info' else '{sev}' end as severity, "
            f"cast({affected} as bigint) as affected_rows, cast({observed} as double) as observed_value "
            f"from {source}")
    return "\nunion all\n".join(parts)


def _raw_suite_sql(group: str | None, raw_sql: str | None = None) -> str:
    b = BANDS
    parts = "'Part_1A', 'Part_1B', 'Part_2', 'Part_2A', 'Part_3'"
    numeric = [b.raw_name(i) for i in range(b.count)] + ["Total", "Patients with unknown clock start date",
                                                         "Total All"]
    anyneg = " or ".join(f'{_count(c)} < 0' for c in numeric)
    cells = " + ".join(f"coalesce((trim(cast({_q(c)} as varchar)) <> '' and {_count(c)} is null)::int, 0)" for c in numeric)
    bsum = " + ".join(f"coalesce(cast({_count(c)} as double), 0)" for c in b.raw_names())
    tot = f'coalesce(cast({_count("Total All")} as double), 0)'
    core = ["C_110", "C_130", "C_100", "C_120", "C_999"]
    has_core = ",\n  ".join(f"max(case when \"Treatment Function Code\" = '{c}' then 1 else 0 end) as core_{i}"
                            for i, c in enumerate(core))
    has_part = ",\n  ".join(f"max(case when \"RTT Part Type\" = '{p}' then 1 else 0 end) as part_{i}"
                            for i, p in enumerate(["Part_1A", "Part_1B", "Part_2", "Part_2A", "Part_3"]))
    sel_group = f'"Period" as period, ' if group else ""
    grp = ' group by "Period"' if group else ""
    agg = f"""dq as (
 select {sel_group}count(*) as n,
  sum(case when "Period" is null then 1 else 0 end) as period_nulls,
  sum(case when "Period" is not null and not regexp_matches("Period", '^RTT-[A-Za-z]+[ -][0-9]{{4}}$') then 1 else 0 end) as period_bad,
  {has_part},
  sum(case when "RTT Part Type" is not null and "RTT Part Type" not in ({parts}) then 1 else 0 end) as part_extra,
  sum(case when "RTT Part Type" is null or "RTT Part Type" not in ({parts}) then 1 else 0 end) as part_unknown,
  sum(case when "Provider Org Code" is null then 1 else 0 end) as prov_nulls,
  count(distinct "Provider Org Code") as prov_d, count("Provider Org Code") as prov_n,
  sum(case when "Total All" is null then 1 else 0 end) as total_nulls,
  sum(case when try_cast("Total All" as double) < 0 or try_cast("Total All" as double) > 500000 then 1 else 0 end) as total_out,
  sum(case when "Treatment Function Code" is null then 1 else 0 end) as tf_nulls,
  count(distinct "Period") as period_d, max(case when "Period" is null then 1 else 0 end) as period_z,
  count(distinct "Provider Parent Org Code") as parent_d,
  {has_core},
  sum(case when {anyneg} then 1 else 0 end) as neg_rows,
  sum({cells}) as cells, sum(case when ({cells}) > 0 then 1 else 0 end) as cells_rows,
  sum(case when "RTT Part Type" = 'Part_2' and abs(({bsum}) - {tot}) / (case when {tot} = 0 then 1 else {tot} end) * 100 > 5.0 then 1 else 0 end) as band_bad,
  sum(case when "Provider Org Code" is not null and not regexp_matches("Provider Org Code", '^[A-Z0-9]{{3,6}}$') then 1 else 0 end) as code_bad
 from raw{grp})"""
    ratio = "cast(prov_d as double) / nullif(cast(prov_n as double), 0)"
    part_present = " + ".join(f"part_{i}" for i in range(5))
    core_present = " + ".join(f"core_{i}" for i in range(5))
    checks = [
        ("row_count_in_expected_range", "warning", "n between 50000 and 300000", "0", "n"),
        ("column_count_equals_121", "error", "true", "0", "121"),
        ("period_not_null", "error", "period_nulls = 0", "period_nulls", "period_nulls"),
        ("period_matches_format", "error", "period_bad = 0", "period_bad", "period_bad"),
        ("part_types_equal_set", "error", f"({part_present}) = 5 and part_extra = 0", "part_extra", f"({part_present})"),
        ("rtt_part_types_are_known_values", "error", "part_unknown = 0", "part_unknown", "part_unknown"),
        ("provider_org_code_not_null", "error", "prov_nulls = 0", "prov_nulls", "prov_nulls"),
        ("provider_org_code_unique_ratio", "warning", f"coalesce({ratio} between 0.001 and 0.01, false)", "0", ratio),
        ("total_all_never_null", "error", "total_nulls = 0", "total_nulls", "total_nulls"),
        ("total_all_between", "warning", "total_out = 0", "total_out", "total_out"),
        ("treatment_function_code_not_null", "error", "tf_nulls = 0", "tf_nulls", "tf_nulls"),
        ("single_period_per_file", "error", "least(period_d, 2) + period_z = 1", "0", "least(period_d, 2) + period_z"),
        ("icb_count_equals_42", "warning", "parent_d = 42", "0", "parent_d"),
        ("core_specialties_present", "warning", f"5 - ({core_present}) = 0", "0", f"5 - ({core_present})"),
        ("no_negative_patient_counts", "error", "neg_rows = 0", "neg_rows", "neg_rows"),
        ("suppressed_cells", "warning", "cells_rows = 0", "cells_rows", "cells"),
        ("week_band_sum_consistency", "warning", "band_bad = 0", "band_bad", "band_bad"),
        ("provider_code_format_valid", "warning", "code_bad = 0", "code_bad", "code_bad"),
    ]
    out_group = '"period" as "Period"' if group else None
    return with_base(_dq_union(checks, "dq", out_group), agg, raw_sql)


def q_dq_raw_suite() -> str:
    return _raw_suite_sql(None)


def q_dq_suite_by_month() -> str:
    return _raw_suite_sql("Period")


def q_dq_gate() -> str:
    inner = _raw_suite_sql(None)
    return f"""with res as ({inner})
select (sum(case when not passed and severity = 'error' then 1 else 0 end) = 0) as passed,
 cast(sum(case when not passed and severity = 'error' then 1 else 0 end) as bigint) as errors,
 cast(sum(case when not passed and severity = 'warning' then 1 else 0 end) as bigint) as warnings,
 cast(sum(case when passed then 1 else 0 end) as bigint) as checks_passed,
 cast(count(*) as bigint) as checks_total
from res"""


def q_dq_gate_by_month() -> str:
    inner = _raw_suite_sql("Period")
    return f"""with res as ({inner})
select "Period", (sum(case when not passed and severity = 'error' then 1 else 0 end) = 0) as passed,
 cast(sum(case when not passed and severity = 'error' then 1 else 0 end) as bigint) as errors,
 cast(sum(case when not passed and severity = 'warning' then 1 else 0 end) as bigint) as warnings,
 cast(sum(case when passed then 1 else 0 end) as bigint) as checks_passed,
 cast(count(*) as bigint) as checks_total
from res group by "Period"
"""


def q_dq_staging_suite() -> str:
    cols = ["period_date", "financial_year", "provider_org_code", "provider_org_name", "rtt_part_type",
            "treatment_function_code", "total_all", "_loaded_at", "_source"]
    nulls = ",\n  ".join(f"sum(case when {c} is null then 1 else 0 end) as n_{c}" for c in cols)
    agg = f"""dq as (
 select {nulls},
  sum(case when rtt_part_type is not null and rtt_part_type not in ('Part_1A', 'Part_1B', 'Part_2', 'Part_2A', 'Part_3') then 1 else 0 end) as bad_part
 from stg2)"""
    checks = [(f"not_null_{c}", "error", f"n_{c} = 0", f"n_{c}", f"n_{c}") for c in cols]
    checks.append(("accepted_values_rtt_part_type", "error", "bad_part = 0", "bad_part", "bad_part"))
    return with_base(_dq_union(checks, "dq"), agg)


def q_dq_key_unique() -> str:
    return with_base("""select 'key_unique' as check_name, (count(*) = 0) as passed,
 case when count(*) = 0 then 'info' else 'error' end as severity,
 cast(coalesce(sum(n), 0) as bigint) as affected_rows, cast(count(*) as double) as observed_value
from (select rtt_performance_id, count(*) as n from fact
      group by period_date, provider_org_code, commissioner_org_code, treatment_function_code, rtt_performance_id
      having count(*) > 1) d""")


ORACLES.update({
    "dq_raw_suite": q_dq_raw_suite,
    "dq_suite_by_month": q_dq_suite_by_month,
    "dq_gate": q_dq_gate,
    "dq_gate_by_month": q_dq_gate_by_month,
    "dq_staging_suite": q_dq_staging_suite,
    "dq_key_unique": q_dq_key_unique,
})


# ---------------------------------------------------------------------------
# Calendar, backfill, freshness, loads
# ---------------------------------------------------------------------------

def _month_cols(d: str) -> str:
    return (f"{d} as period_date, cast(year({d}) as bigint) as year, cast(month({d}) as bigint) as month, "
            f"strftime({d}, '%b%y') as month_code, "
            f"cast(year({d} - interval 3 month) as varchar) || '-' || "
            f"lpad(cast((year({d} - interval 3 month) + 1) % 100 as varchar), 2, '0') as financial_year")


def q_month_spine_orders() -> str:
    return f"""select {_month_cols('cast(m as date)')}
from (select date_trunc('month', min(o_orderdate)) as s, date_trunc('month', max(o_orderdate)) as e from orders) b,
 generate_series(b.s, b.e, interval 1 month) g(m)"""


def q_month_spine_lastn() -> str:
    return f"""select {_month_cols('cast(m as date)')}
from (select date_trunc('month', max(o_orderdate)) as a from orders) b,
 generate_series(b.a - interval 6 month, b.a - interval 1 month, interval 1 month) g(m)"""


def _backfill_ctes() -> str:
    return f"""spine as (select {_month_cols('cast(m as date)')}
 from generate_series(timestamp '2024-02-01', timestamp '2026-01-01', interval 1 month) g(m)),
loaded as (select distinct period_date from stg2),
plan as (select s.*, (l.period_date is not null) as already_loaded,
 case when l.period_date is not null then 'skipped' else 'pending' end as status
 from spine s left join loaded l on s.period_date = l.period_date)"""


def q_backfill_plan() -> str:
    return with_base("select * from plan", _backfill_ctes())


def q_backfill_summary() -> str:
    return with_base("""select status, cast(count(*) as bigint) as months, min(period_date) as first_month,
 max(period_date) as last_month from plan group by status""", _backfill_ctes())


def q_freshness_events() -> str:
    return """select max(ts) as max_loaded_at, cast(count(*) as bigint) as rows,
 cast(date_diff('day', cast(max(ts) as date), date '2024-03-01') as bigint) as age_days,
 case when max(ts) is null then 'error'
      when date_diff('day', cast(max(ts) as date), date '2024-03-01') > 40 then 'error'
      when date_diff('day', cast(max(ts) as date), date '2024-03-01') > 35 then 'warn' else 'pass' end as status
from events"""


def _reconcile_sql() -> str:
    return with_base("""select strftime(period_date, '%b%y') as _month_code, cast(count(*) as bigint) as rows_expected,
 cast(count(*) as bigint) as rows_loaded, true as success
from stg2 group by 1""")


def q_month_overwrite_idempotent() -> str:
    return _reconcile_sql()


def q_load_summary() -> str:
    return f"""with r as ({_reconcile_sql()})
select cast(count(*) as bigint) as months, cast(sum(case when success then 1 else 0 end) as bigint) as succeeded,
 cast(sum(case when success then 0 else 1 end) as bigint) as failed, cast(sum(rows_loaded) as bigint) as total_rows
from r"""


ORACLES.update({
    "month_spine_orders": q_month_spine_orders,
    "month_spine_lastn": q_month_spine_lastn,
    "backfill_plan": q_backfill_plan,
    "backfill_summary": q_backfill_summary,
    "freshness_events": q_freshness_events,
    "month_overwrite_idempotent": q_month_overwrite_idempotent,
    "load_summary": q_load_summary,
})


# ---------------------------------------------------------------------------
# SCD2 and as-of join
# ---------------------------------------------------------------------------

_TOK = SURROGATE_NULL_TOKEN
_ATTRS = ["provider_org_name", "provider_parent_org_code", "provider_parent_name"]


def _history_ctes() -> str:
    order = ", ".join(f"{a} nulls first" for a in _ATTRS)
    attrs = ", ".join(_ATTRS)
    chg = " or ".join(f"{a} is distinct from lag({a}) over w" for a in _ATTRS)
    return f"""pp as (select provider_org_code, period_date, {attrs} from (
  select *, row_number() over (partition by provider_org_code, period_date order by {order}) as rn
  from stg2 where provider_org_code is not null) where rn = 1),
fl as (select *, case when lag(period_date) over w is null then 1 when {chg} then 1 else 0 end as chg
  from pp window w as (partition by provider_org_code order by period_date)),
nb as (select *, sum(chg) over (partition by provider_org_code order by period_date
  rows between unbounded preceding and current row) as version from fl),
vs as (select provider_org_code, version, {attrs}, min(period_date) as valid_from, max(period_date) as last_seen
  from nb group by provider_org_code, version, {attrs}),
hist as (select provider_org_code, {attrs}, cast(version as bigint) as version,
  md5(concat_ws('-', coalesce(provider_org_code, '{_TOK}'), coalesce(cast(valid_from as varchar), '{_TOK}'))) as scd_id,
  valid_from, lead(valid_from) over (partition by provider_org_code order by version) as valid_to,
  (lead(valid_from) over (partition by provider_org_code order by version)) is null as is_current, last_seen
  from vs)"""


def q_scd2_from_history() -> str:
    return with_base("select * from hist", _history_ctes())


def q_scd2_current() -> str:
    return with_base("select * from hist where valid_to is null", _history_ctes())


def q_scd2_check() -> str:
    attrs = ", ".join(_ATTRS)
    order = ", ".join(f"{a} nulls first" for a in _ATTRS)
    same = " and ".join(f"c.{a} is not distinct from i.{a}" for a in _ATTRS)

    def latest(where: str) -> str:
        return (f"select provider_org_code, {attrs} from (select *, row_number() over (partition by provider_org_code "
                f"order by period_date desc, {order}) as rn from stg2 where provider_org_code is not null {where}) "
                f"where rn = 1")

    def sid(d: str) -> str:
        return f"md5(concat_ws('-', coalesce(provider_org_code, '{_TOK}'), '{d}'))"
    ctes = f"""lp1 as ({latest("and period_date <= date '2025-11-01'")}),
snap1 as (select provider_org_code, {attrs}, {sid('2025-12-01')} as scd_id, date '2025-12-01' as valid_from,
  cast(null as date) as valid_to, true as is_current from lp1),
lp2 as ({latest("")})"""
    cattrs = ", ".join(f"c.{a}" for a in _ATTRS)
    sel = f"""select c.provider_org_code, {cattrs}, c.scd_id, c.valid_from,
 case when i.provider_org_code is null or not ({same}) then date '2026-02-01' else c.valid_to end as valid_to,
 case when i.provider_org_code is null or not ({same}) then false else c.is_current end as is_current
from snap1 c left join lp2 i on c.provider_org_code = i.provider_org_code
union all
select i.provider_org_code, {", ".join(f"i.{a}" for a in _ATTRS)},
 md5(concat_ws('-', coalesce(i.provider_org_code, '{_TOK}'), '2026-02-01')) as scd_id,
 date '2026-02-01' as valid_from, cast(null as date) as valid_to, true as is_current
from lp2 i left join snap1 c on c.provider_org_code = i.provider_org_code
where c.provider_org_code is null or not ({same})"""
    return with_base(sel, ctes)


def q_asof_provider_name() -> str:
    return with_base("""select f.rtt_performance_id, f.period_date, f.provider_org_code, f.provider_org_name,
 h.provider_org_name as asof_provider_org_name, h.provider_parent_org_code as asof_provider_parent_org_code
from fact f left join hist h on f.provider_org_code = h.provider_org_code and f.period_date >= h.valid_from
 and (h.valid_to is null or f.period_date < h.valid_to)""", _history_ctes())


ORACLES.update({
    "scd2_from_history": q_scd2_from_history,
    "scd2_current": q_scd2_current,
    "scd2_check": q_scd2_check,
    "asof_provider_name": q_asof_provider_name,
})


# ---------------------------------------------------------------------------
# Windows, features, distributions
# ---------------------------------------------------------------------------

def q_pct_of_partition_orders() -> str:
    return """select order_month, o_orderstatus, orders,
 round(cast(orders as double) * 100.0 / cast(sum(orders) over (partition by order_month) as double), 1) as pct_of_total
from (select cast(date_trunc('month', o_orderdate) as date) as order_month, o_orderstatus,
      cast(count(*) as bigint) as orders from orders group by 1, 2) g"""


def q_lag_change_orders() -> str:
    return """select order_month, orders, orders - lag(orders) over (order by order_month) as mom_change,
 round(cast(orders - lag(orders) over (order by order_month) as double) * 100.0
       / nullif(cast(lag(orders) over (order by order_month) as double), 0), 2) as mom_pct_change
from (select cast(date_trunc('month', o_orderdate) as date) as order_month, cast(count(*) as bigint) as orders
      from orders group by 1) g"""


def _panel_cte() -> str:
    return """panel0 as (select provider_org_code, treatment_function_code, period_date,
  cast(sum(total_incomplete) as bigint) as total_incomplete,
  cast(sum(patients_within_18_weeks) as bigint) as patients_within_18_weeks,
  cast(sum(patients_waiting_52_plus_weeks) as bigint) as patients_waiting_52_plus_weeks,
  cast(max(cast(is_surgical as int)) as boolean) as is_surgical
 from fact group by provider_org_code, treatment_function_code, period_date),
panel as (select *,
  round(cast(patients_within_18_weeks as double) * 100.0 / nullif(cast(total_incomplete as double), 0), 1)
    as pct_within_18_weeks,
  (cast(patients_within_18_weeks as double) * 100.0 / nullif(cast(total_incomplete as double), 0)) >= 92.0
    as meets_18_week_standard
 from panel0)"""


def q_breach_features() -> str:
    return with_base("""select *,
 case when count(pct_within_18_weeks) over w3 = 3
      then cast(sum(cast(round(pct_within_18_weeks * 10) as bigint)) over w3 as double) / 30.0 end as rolling_3m_pct,
 total_incomplete - lag(total_incomplete) over w as mom_list_change,
 cast(patients_waiting_52_plus_weeks as double) / nullif(cast(total_incomplete as double), 0) as long_waiter_ratio,
 case when lead(period_date) over w = cast(period_date + interval 1 month as date)
      then lead(meets_18_week_standard) over w end as target_meets_next_month,
 case when lead(period_date) over w = cast(period_date + interval 1 month as date)
      then lead(total_incomplete) over w end as target_total_next_month
from panel
window w as (partition by provider_org_code, treatment_function_code order by period_date),
 w3 as (partition by provider_org_code, treatment_function_code order by period_date
        rows between 3 preceding and 1 preceding)""", _panel_cte())


def q_perf_anomalies() -> str:
    return with_base("""select provider_org_code, treatment_function_code, period_date, total_incomplete,
 patients_within_18_weeks, patients_waiting_52_plus_weeks, is_surgical, pct_within_18_weeks, meets_18_week_standard,
 round(mean / 10.0, 4) as history_mean_pct, round(z, 4) as z_score, coalesce(abs(round(z, 4)) > 2.0, false) as is_anomaly
from (select *, (cast(t as double) - mean) / case when var > 0 then sqrt(var) end as z
 from (select *, s / nullif(n, 0) as mean, case when n >= 3 then (s2 - s * s / n) / (n - 1.0) end as var
  from (select p.provider_org_code, p.treatment_function_code, p.period_date, any_value(p.t) as t,
          cast(count(o.t) as double) as n, cast(coalesce(sum(o.t), 0) as double) as s, cast(coalesce(sum(o.t * o.t), 0) as double) as s2
        from pt p left join pt o on p.provider_org_code = o.provider_org_code
         and p.treatment_function_code = o.treatment_function_code and p.period_date <> o.period_date
        group by 1, 2, 3) q
  join panel using (provider_org_code, treatment_function_code, period_date)))""",
                     _panel_cte() + ",\npt as (select *, cast(round(pct_within_18_weeks * 10) as bigint) as t from panel)")


def _gaps_ctes() -> str:
    return """present as (select distinct provider_org_code, treatment_function_code, period_date from fact),
ents as (select distinct provider_org_code, treatment_function_code from present),
bounds as (select min(period_date) as s, max(period_date) as e from fact),
expected as (select n.provider_org_code, n.treatment_function_code, cast(g.m as date) as period_date
 from ents n, bounds b, generate_series(b.s, b.e, interval 1 month) g(m)),
gaps as (select x.* from expected x anti join present p on x.provider_org_code = p.provider_org_code
 and x.treatment_function_code = p.treatment_function_code and x.period_date = p.period_date)"""


def q_submission_gaps() -> str:
    return with_base("select * from gaps", _gaps_ctes())


def q_completeness_by_month() -> str:
    return with_base("""select coalesce(r.period_date, g.period_date) as period_date,
 coalesce(r.reporting, 0) as reporting, coalesce(g.missing, 0) as missing
from (select period_date, cast(count(*) as bigint) as reporting from present group by 1) r
full join (select period_date, cast(count(*) as bigint) as missing from gaps group by 1) g
 on r.period_date = g.period_date""", _gaps_ctes())


def _band_agg_cte(grain: str) -> str:
    sums = ", ".join(f"cast(sum({n}) as bigint) as {n}" for n in BANDS.names())
    return f"agg as (select {grain}, {sums} from stg2 where rtt_part_type = 'Part_2' group by {grain})"


def _band_unnest(grain: str) -> str:
    return (f"select {grain}, cast(unnest(range(0, {BANDS.count})) as bigint) as week, "
            f"unnest([{', '.join(BANDS.names())}]) as patients from agg")


def q_band_long_national() -> str:
    return with_base(_band_unnest("period_date"), _band_agg_cte("period_date"))


def q_wait_distribution() -> str:
    g = "period_date, provider_org_code, treatment_function_code"
    tot = " + ".join(BANDS.names())
    shares = []
    for q, (lo, hi) in enumerate([(0, 26), (26, 52), (52, 78), (78, None)], start=1):
        shares.append(f"cast({_bsum(lo, hi)} as double) / nullif(cast({tot} as double), 0) as share_q{q}")
    ctes = f"""{_band_agg_cte(g)},
lng as ({_band_unnest(g)}),
lw as (select *, patients * (2 * week + 1) as w2,
  sum(patients) over r as cum_n, sum(patients * (2 * week + 1)) over r as cum_w2,
  sum(patients) over (partition by {g}) as n_all
 from lng window r as (partition by {g} order by week rows between unbounded preceding and current row)),
per as (select {g}, cast(sum(patients) as bigint) as n, sum(cast(w2 as hugeint)) as w2_total,
  sum(cast(patients as hugeint) * cast(2 * cum_w2 - w2 as hugeint)) as gini_num,
  min(case when n_all > 0 and 2 * cum_n >= n_all then week end) as median_band
 from lw group by {g}),
shares as (select {g}, {", ".join(shares)} from agg)"""
    return with_base(f"""select s.*, p.n, cast(p.median_band as double) + 0.5 as median_wait_weeks,
 case when p.n > 0 and p.w2_total > 0
      then 1.0 - cast(p.gini_num as double) / (cast(p.n as double) * cast(p.w2_total as double)) end as wait_gini
from shares s join per p using ({g})""", ctes)


ORACLES.update({
    "pct_of_partition_orders": q_pct_of_partition_orders,
    "lag_change_orders": q_lag_change_orders,
    "breach_features": q_breach_features,
    "perf_anomalies": q_perf_anomalies,
    "submission_gaps": q_submission_gaps,
    "completeness_by_month": q_completeness_by_month,
    "band_long_national": q_band_long_national,
    "wait_distribution": q_wait_distribution,
})


# ---------------------------------------------------------------------------
# Archives and incremental ingestion: the national series must come out the
# same after the CSV/ZIP round trip and the streaming ingest.
# ---------------------------------------------------------------------------

def q_late_revision_replace() -> str:
    sql = q_national_monthly()
    return sql.replace("from fact group by", "from fact where not (period_date = date '2026-01-01' and "
                       "commissioner_org_code = 'C40') group by")


ORACLES.update({
    "zip_csv_scan": q_national_monthly,
    "incremental_ingest": q_national_monthly,
    "late_revision_replace": q_late_revision_replace,
})


def q_trend_forecast() -> str:
    ctes = _panel_cte() + """,
pts as (select provider_org_code, treatment_function_code, period_date,
  cast(date_diff('month', date '2000-01-01', date_trunc('month', period_date)) as bigint) as x,
  cast(total_incomplete as bigint) as y from panel),
fit as (select provider_org_code, treatment_function_code, count(y) as n, sum(x) as sx, sum(y) as sy,
  sum(x * y) as sxy, sum(x * x) as sxx, max(period_date) as last_period, max(x) as x_last
 from pts group by provider_org_code, treatment_function_code),
f2 as (select *, cast(n * sxy - sx * sy as double) / nullif(cast(n * sxx - sx * sx as double), 0) as slope from fit),
f3 as (select *, (cast(sy as double) - slope * cast(sx as double)) / cast(n as double) as intercept from f2)"""
    return with_base("""select provider_org_code, treatment_function_code,
 cast(last_period + to_months(cast(h as integer)) as date) as forecast_period, cast(h as bigint) as horizon,
 cast(n as bigint) as points, round(slope, 4) as trend_per_month,
 round(intercept + slope * cast(x_last + h as double), 4) as forecast_total_incomplete
from f3, range(1, 4) r(h)""", ctes)


ORACLES.update({"trend_forecast": q_trend_forecast})


def q_fact_profile() -> str:
    return with_base("""select min(period_date) as first_period, max(period_date) as last_period,
 cast(count(*) as bigint) as rows, cast(count(distinct provider_org_code) as bigint) as distinct_trusts,
 cast(count(distinct treatment_function_code) as bigint) as distinct_specialties from fact""")


def q_unexpected_part_types() -> str:
    return with_base("""select distinct "RTT Part Type" as part_type from raw
where "RTT Part Type" not in ('Part_1A', 'Part_2') or "RTT Part Type" is null""")


def q_missing_core_specialties() -> str:
    return with_base("""select g.period_date, r.c as treatment_function_code
from (select distinct period_date from fact) g,
 (values ('C_110'), ('C_130'), ('C_100'), ('C_120'), ('C_999')) r(c)
where not exists (select 1 from fact f where f.period_date = g.period_date and f.treatment_function_code = r.c)""")


ORACLES.update({
    "fact_profile": q_fact_profile,
    "unexpected_part_types": q_unexpected_part_types,
    "missing_core_specialties": q_missing_core_specialties,
    "scorecard_from_table": q_trust_scorecard,
})


def q_scd2_supplier() -> str:
    tok = SURROGATE_NULL_TOKEN
    return f"""with s1 as (select s_suppkey, s_name, s_nationkey from supplier),
s2 as (select s_suppkey, s_name,
  case when s_acctbal > 9000 then (s_nationkey + 1) % 25 else s_nationkey end as s_nationkey
 from supplier where s_acctbal >= 0)
select c.s_suppkey, c.s_name, c.s_nationkey,
 md5(concat_ws('-', coalesce(cast(c.s_suppkey as varchar), '{tok}'), '2024-01-01')) as scd_id,
 date '2024-01-01' as valid_from,
 case when n.s_suppkey is null or c.s_name is distinct from n.s_name or c.s_nationkey is distinct from n.s_nationkey
      then date '2024-02-01' end as valid_to,
 not (n.s_suppkey is null or c.s_name is distinct from n.s_name or c.s_nationkey is distinct from n.s_nationkey)
   as is_current
from s1 c left join s2 n on c.s_suppkey = n.s_suppkey
union all
select n.s_suppkey, n.s_name, n.s_nationkey,
 md5(concat_ws('-', coalesce(cast(n.s_suppkey as varchar), '{tok}'), '2024-02-01')) as scd_id,
 date '2024-02-01' as valid_from, cast(null as date) as valid_to, true as is_current
from s2 n left join s1 c on c.s_suppkey = n.s_suppkey
where c.s_suppkey is null or c.s_name is distinct from n.s_name or c.s_nationkey is distinct from n.s_nationkey"""


ORACLES["scd2_supplier"] = q_scd2_supplier
