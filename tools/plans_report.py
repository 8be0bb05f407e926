"""Write the physical plan trees of the key queries to PLANS.md.

Usage: python tools/plans_report.py [sf_dir]   (default /root/testdata/sf0.01)
Plans are AQE initial plans (before runtime re-planning) from
``explain("formatted")``, tree part plus scan details.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from waitband.operators import quality as DQ  # noqa: E402
from waitband.operators.distribution import distribution_stats  # noqa: E402
from waitband.operators.load import month_overwrite, with_audit  # noqa: E402
from waitband.operators.scd2 import scd2_from_history  # noqa: E402
from waitband.operators.staging import staging  # noqa: E402
from waitband.plans import pipeline as P  # noqa: E402
from waitband.plans import published as Q  # noqa: E402
from waitband.session import local_session, scratch_path  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n")[0]
    scans = re.findall(r"\(\d+\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?ReadSchema: [^\n]*", text)
    keep = []
    for s in scans:
        keep += [line[:220] for line in s.splitlines()
                 if line.startswith(("(", "Location", "PartitionFilters", "PushedFilters", "ReadSchema"))]
    return head + "\n\n" + "\n".join(keep)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    raw_path = scratch_path(spark, "plans-raw")
    month_overwrite(with_audit(P.raw(spark, sf), P.loaded_at_literal(), source_file="x"), raw_path)
    paths = P.materialise(spark.read.parquet(raw_path), scratch_path(spark, "plans-layers"))
    raw = spark.read.parquet(raw_path)
    fact = spark.read.parquet(paths["fact"])
    stg = staging(raw, loaded_at=P.loaded_at_literal())
    items = [
        ("Derived extract from the base tables (lineitem x orders x customer x nation, band spread)", P.raw(spark, sf)),
        ("Fact table end to end (extract -> staging -> pathways -> fact, broadcast seed)", P.fact(spark, sf)),
        ("Q1 national monthly on the written fact", Q.national_monthly(fact)),
        ("Q10 one-month scorecard on the written fact (partition pruning)", Q.trust_scorecard(fact)),
        ("Q9 month-on-month (global LAG on month aggregates only)", Q.month_on_month(fact)),
        ("DQ suite per month on the landed raw layer (one scan)", DQ.run_suite(raw, DQ.raw_extract_rules(),
                                                                             by=["_month_code"])),
        ("SCD2 provider history from staging", scd2_from_history(
            stg, "provider_org_code", ["provider_org_name", "provider_parent_org_code", "provider_parent_name"])),
        ("Wait distribution stats (pushed pathway filter, one fold per row)", distribution_stats(
            stg.filter(F.col("rtt_part_type") == "Part_2"),
            ["period_date", "provider_org_code", "treatment_function_code"])),
    ]
    out = ["# Physical plans of the key queries", "",
           f"Generated by `tools/plans_report.py` at `{sf}` (AQE initial plans; at run time AQE may",
           "coalesce partitions, switch small joins to broadcast and split skewed partitions).", ""]
    for title, df in items:
        out += [f"## {title}", "", "```", tree(df), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
