"""DuckDB SQL for loading: the dirty text extract, quarantine, archives with
bad files, revision flags, whole runs, release links and model inputs."""

from __future__ import annotations

from ..config import BANDS
from ..sources.extract import SPECIALTY_CODES, dirty_extract_sql
from .oracle import _month_cols, _panel_cte, _q, _raw_suite_sql, q_breach_features, q_trust_scorecard, with_base


def _links_cte() -> str:
    """One release anchor per page, its kind by page number: the expected links
    are put together from the page's URL, without reading any markup."""
    origin = "regexp_extract(url, '^([^:]+://[^/?#]+)', 1)"
    return f"""base as (select page_id, page_id % 5 as kind, regexp_extract(url, '^([^:]+):', 1) as scheme, {origin} as origin,
  regexp_replace(regexp_replace(substr(url, length({origin}) + 1), '[?#].*$', ''), '[^/]*$', '') as folder
 from pages),
links as (select page_id,
  case kind when 0 then 'Full CSV data file Aug25 (ZIP, 3M)' when 1 then 'FULL CSV DATA FILE Sep25' when 2 then 'Full CSV data file Oct25'
   when 3 then 'Full CSV data file Nov25 & notes' else 'Full CSV data file help' end as anchor_text,
  case kind when 0 then 'https://files.example.org/rtt/Full-CSV-Aug25.zip' when 1 then origin || '/data/Full-CSV-Sep25-revised.zip'
   when 2 then scheme || '://cdn.example.com/get?id=7&v=2'
   when 3 then origin || regexp_replace(case when folder = '' then '/' else folder end, '[^/]+/$', '') || 'files/Full-CSV-Nov25.zip#top'
   else 'mailto:rtt@example.org' end as link,
  case kind when 0 then 'Full-CSV-Aug25.zip' when 1 then 'Full-CSV-Sep25-revised.zip' when 2 then 'RTT_Full_CSV_Oct25.zip'
   when 3 then 'Full-CSV-Nov25.zip' else 'RTT_Full_CSV_.zip' end as filename,
  kind = 1 as is_revised,
  case kind when 0 then 'Aug25' when 1 then 'Sep25' when 2 then 'Oct25' when 3 then 'Nov25' else '' end as month_code
 from base)"""


def q_release_links() -> str:
    return f"with {_links_cte()}\nselect * from links"


def q_publication_status() -> str:
    return f"""with {_links_cte()},
spine as (select {_month_cols('cast(m as date)')}
 from generate_series(date '2025-08-01', date '2026-01-01', interval 1 month) g(m)),
found as (select month_code, cast(count(*) as bigint) as links, cast(max(cast(is_revised as int)) as boolean) as rv
 from links group by month_code)
select s.*, coalesce(f.links, 0) as links, coalesce(f.links, 0) > 0 as published, coalesce(f.rv, false) as has_revision
from spine s left join found f on s.month_code = f.month_code"""


def q_staging_rows() -> str:
    return with_base("select * from stg2", raw_sql=dirty_extract_sql())


def q_fact_performance_dirty() -> str:
    return with_base("select * from fact", raw_sql=dirty_extract_sql())


def q_dq_suite_text_raw() -> str:
    return _raw_suite_sql(None, dirty_extract_sql())


def q_dq_failing_values() -> str:
    parts = ("Part_1A", "Part_1B", "Part_2", "Part_2A", "Part_3")
    core = ("C_110", "C_130", "C_100", "C_120", "C_999")
    bad = [("period_matches_format", "Period", "not regexp_matches(v, '^RTT-[A-Za-z]+[ -][0-9]{4}$')"),
           ("part_types_equal_set", "RTT Part Type", f"v not in {parts}"),
           ("rtt_part_types_are_known_values", "RTT Part Type", f"(v is null or v not in {parts})"),
           ("provider_code_format_valid", "Provider Org Code", "not regexp_matches(v, '^[A-Z0-9]{3,6}$')"),
           ("known_specialties", "Treatment Function Code", f"(v is null or v not in {SPECIALTY_CODES})")]
    out = [f"select '{n}' as check_name, v as value, cast(count(*) as bigint) as rows from (select \"{c}\" as v from raw) where {w} group by v"
           for n, c, w in bad]
    for n, c, values in (("part_types_equal_set", "RTT Part Type", parts), ("core_specialties_present", "Treatment Function Code", core),
                         ("apostrophes_present", "Treatment Function Code", ("King''s", "Queen''s"))):
        wanted = ", ".join(f"('{v}')" for v in values)
        out.append(f"select '{n}' as check_name, w.v as value, 0::bigint as rows from (values {wanted}) w(v) "
                   f"where not exists (select 1 from raw where \"{c}\" = w.v)")
    return with_base("\nunion all\n".join(out), raw_sql=dirty_extract_sql())


def q_load_quarantine() -> str:
    return with_base("""select m as _month_code, cast(count(*) - sum(held) as bigint) as rows_expected,
 cast(count(*) - sum(held) as bigint) as rows_loaded, true as success, cast(sum(held) as bigint) as rows_quarantined
from (select m, case when own is null or own <> m then 1 else 0 end as held
 from (select strftime(period_date, '%b%y') as own,
   case when provider_org_code like '%0' then 'Jan26' else strftime(period_date, '%b%y') end as m from stg2))
group by m""", raw_sql=dirty_extract_sql())


def q_late_revision_flags() -> str:
    return with_base("""select strftime(period_date, '%b%y') as _month_code, financial_year as _financial_year,
 period_date = date '2026-01-01' as _is_revised, case when period_date = date '2026-01-01' then '2' else '1' end as landing_version,
 cast(count(*) as bigint) as rows
from stg2 where not (period_date = date '2026-01-01' and commissioner_org_code = 'C40') group by all""")


def q_run_pipeline_months() -> str:
    of = lambda what, name: f"case when stop then null else {what} end as {name}"
    return with_base(f"""select strftime(period_date, '%b%y') as _month_code, {of('cast(n as bigint)', 'rows_expected')},
 {of('cast(n as bigint)', 'rows_loaded')}, {of('true', 'success')}, {of('0::bigint', 'rows_quarantined')}, {of('f.fact_rows', 'fact_rows')},
 case when stop then 'blocked' else 'loaded' end as status
from (select period_date, count(*) as n,
  period_date = date '2025-11-01' and count(*) filter (rtt_part_type = 'Part_2') > 0 as stop from stg2 group by period_date) m
left join (select period_date, cast(count(*) as bigint) as fact_rows from fact group by period_date) f using (period_date)""")


def _archive_files() -> str:
    """The mixed folder: a full file per month, a revised January and three bad files."""
    torn = "BadZipFile: Bad CRC-32 for file ''a.csv''"
    return with_base("select * from files", f"""mon as (select strftime(period_date, '%b%y') as m, any_value(financial_year) as fy, cast(count(*) as bigint) as n,
  cast(count(*) filter (commissioner_org_code <> 'C40') as bigint) as n_rev from stg2 group by 1),
files as (
 select m || '_full.zip' as filename, m as month_code, fy as financial_year, true as is_zip, 1::bigint as csv_files, null as broken,
  false as is_revised, m not in ('Jan26', 'Oct25') as chosen, n, null as scan_error from mon
 union all select 'Jan26_revised.zip', m, fy, true, 1, null, true, true, n_rev, null from mon where m = 'Jan26'
 union all select 'Dec25_revised_no.zip', m, fy, false, 0, 'Not a valid ZIP file', true, false, 0, null from mon where m = 'Dec25'
 union all select 'Nov25_revised_readme.zip', m, fy, true, 0, 'No CSV file inside archive', true, false, 0, null from mon where m = 'Nov25'
 union all select 'Oct25_revised_torn.zip', m, fy, true, 1, null, true, true, 0, '{torn}' from mon where m = 'Oct25')""")


def q_file_manifest() -> str:
    return f"""select filename, month_code, financial_year, 'raw/rtt/' || financial_year || '/' || month_code || '/' || filename as raw_path,
 is_zip, csv_files, broken as error_message, broken is null as success, is_revised from ({_archive_files()})"""


def q_pick_month_file() -> str:
    return f"select month_code, filename, is_revised from ({_archive_files()}) where chosen"


def q_archive_load_audit() -> str:
    return f"""select month_code, financial_year, filename, is_revised, chosen,
 case when chosen and scan_error is null then n else 0 end as rows_loaded, case when chosen and scan_error is null then n else 0 end as rows_expected,
 0::bigint as rows_quarantined, chosen and scan_error is null as success,
 coalesce(broken, scan_error, case when not chosen then 'Superseded by another file of the month' end) as error_message
from ({_archive_files()})"""


def q_archive_load_summary() -> str:
    return f"""select cast(count(*) as bigint) as months, cast(count(*) filter (success) as bigint) as succeeded,
 cast(count(*) filter (not success) as bigint) as failed, cast(sum(rows_loaded) as bigint) as total_rows,
 cast(count(*) filter (is_revised) as bigint) as revised,
 coalesce(string_agg(month_code || ': ' || error_message, '; ' order by month_code) filter (not success), '') as failures
from ({q_archive_load_audit()}) where chosen"""


def _results_cte() -> str:
    return """res as (select m, n, n < avg(n) over () as short from (
  select cast(date_trunc('month', o_orderdate) as date) as m, count(*) as n from orders group by 1))"""


def q_backfill_results() -> str:
    return f"""with {_results_cte()}
select case when short then 'failed' else 'success' end as status, cast(count(*) as bigint) as months, cast(sum(n) as bigint) as bytes,
 cast(count(*) filter (month(m) % 2 = 0) as bigint) as revised,
 coalesce(string_agg(strftime(m, '%b%y') || ': too small', '; ' order by strftime(m, '%b%y')) filter (short), '') as failures,
 min(m) as first_month, max(m) as last_month
from res group by 1"""


def q_backfill_success() -> str:
    return f"""with {_results_cte()}
select count(*) filter (short) = 0 as success, cast(count(*) as bigint) as months, cast(count(*) filter (short) as bigint) as failed from res"""


def q_trust_features() -> str:
    return with_base("""select provider_org_code, coalesce(cast(w as double) * 100.0 / nullif(cast(t as double), 0), 0.0) as pct_within_18_weeks,
 cast(t as double) / cast(m as double) as total_incomplete, coalesce(cast(l as double) / nullif(cast(t as double), 0), 0.0) as long_waiter_ratio,
 coalesce(cast(s as double) / nullif(cast(t as double), 0), 0.0) as surgical_share
from (select provider_org_code, sum(total_incomplete) as t, sum(patients_within_18_weeks) as w, sum(patients_waiting_52_plus_weeks) as l,
  count(distinct period_date) as m, sum(case when is_surgical then total_incomplete else 0 end) as s from panel group by 1)""", _panel_cte())


def q_breach_training_rows() -> str:
    return f"""with feats as ({q_breach_features()}),
lab as (select provider_org_code, treatment_function_code, period_date, cast(target_meets_next_month as int)::double as label,
  cast(rolling_3m_pct as double) as rolling_3m_pct, cast(mom_list_change as double) as mom_list_change, cast(long_waiter_ratio as double) as long_waiter_ratio,
  cast(pct_within_18_weeks as double) as pct_within_18_weeks, cast(total_incomplete as double) as total_incomplete
 from feats where target_meets_next_month is not null),
t as (select max(period_date) as last from lab),
w as (select (count(*) - sum(label)) / nullif(sum(label), 0) as pos from lab, t where period_date < last)
select lab.*, period_date = last as is_test, case when label = 1 then coalesce(pos, 1.0) else 1.0 end as weight from lab, t, w"""


def q_trust_specialty_series() -> str:
    return with_base("select * from panel where provider_org_code = 'P00001' and treatment_function_code = 'C_110'", _panel_cte())


def q_week_row_sums() -> str:
    total = " + ".join(f"coalesce(cast({_q(c)} as double), 0)" for c in BANDS.raw_names())
    return with_base(f"""select "Period", cast(sum(n) as bigint) as patients, cast(max(n) as bigint) as largest_row
from (select "Period", {total} as n from raw) group by 1""")


ORACLES = {
    "release_links": q_release_links,
    "publication_status": q_publication_status,
    "staging_rows": q_staging_rows,
    "fact_performance_dirty": q_fact_performance_dirty,
    "dq_suite_text_raw": q_dq_suite_text_raw,
    "dq_failing_values": q_dq_failing_values,
    "load_quarantine": q_load_quarantine,
    "late_revision_flags": q_late_revision_flags,
    "run_pipeline_months": q_run_pipeline_months,
    "file_manifest": q_file_manifest,
    "pick_month_file": q_pick_month_file,
    "archive_load_audit": q_archive_load_audit,
    "archive_load_summary": q_archive_load_summary,
    "backfill_results": q_backfill_results,
    "backfill_success": q_backfill_success,
    "trust_features": q_trust_features,
    "breach_training_rows": q_breach_training_rows,
    "feature_order": q_breach_features,
    "trust_specialty_series": q_trust_specialty_series,
    "scorecard_export": q_trust_scorecard,
    "week_row_sums": q_week_row_sums,
}
