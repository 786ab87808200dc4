"""Summarise the physical plan of every registered query (``python -m homestats.plans.explain``).

Runs the queries from materialised silver tables (as the benchmark does) and
counts, per plan: shuffles, broadcasts, join strategies, scalar subqueries,
codegen stages and what reached the scan (partition filters, pushed filters,
read columns). Writes ``PLANS.md``.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(text: str) -> dict:
    tree = text.split("\n\n")[0]
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    return {
        "shuffles": len(re.findall(r"\bExchange\b", tree)) - len(re.findall(r"BroadcastExchange", tree)),
        "broadcasts": len(re.findall(r"BroadcastExchange", tree)),
        "bhj": len(re.findall(r"BroadcastHashJoin", tree)),
        "smj": len(re.findall(r"SortMergeJoin", tree)),
        "subqueries": len(re.findall(r"^Subquery:", text, re.M)),
        "partition_filters": sorted({re.sub(r"#\d+", "", p) for p in re.findall(r"PartitionFilters: \[([^\]]+)\]", text)}),
        "scan_columns": max((len(s.split(",")) for s in scans), default=0),
        "python": len(re.findall(r"MapInPandas|ArrowEvalPython|BatchEvalPython", text)),
    }


def main(sf_dir: str = "/root/testdata/sf0.01", out: str = "PLANS.md") -> None:
    sys.path.insert(0, os.getcwd())
    from homestats.plans import filequeries  # noqa: F401  (registers the file-side queries)
    from homestats.plans.catalog import BODIES
    from homestats.plans.relations import Relations
    from homestats.session import local_session, release_scratch, scratch_path
    from homestats.sources.testrel import relation

    spark = local_session(shuffle_partitions=16)
    d = scratch_path(spark, "plans-silver")
    for n in ("sold", "listed", "rates"):
        w = relation(spark, sf_dir, n).write.mode("overwrite")
        (w.partitionBy("PropertyType") if n != "rates" else w).parquet(f"{d}/{n}")

    def rel() -> Relations:
        return Relations.from_tables(spark, *(spark.read.parquet(f"{d}/{n}") for n in ("sold", "listed", "rates")))

    lines = [
        "# Physical plans of the registered queries",
        "",
        f"Generated by `python -m homestats.plans.explain` from silver tables built at `{sf_dir}`",
        "(partitioned by `PropertyType`), 16 shuffle partitions, AQE on; initial plans before",
        "runtime re-optimisation. Jobs run while a query is built (column pruning's null counts, the",
        "quantiles' pairs and chunk tables, exports of the file side; Parquet schema reads too) are",
        "counted in the second column; the other columns show the plan that is left.",
        "",
        "| query | jobs while built | shuffles | broadcasts | BHJ | SMJ | scalar subqueries | max scan columns | Python | partition filters |",
        "|---|---|---|---|---|---|---|---|---|---|",
    ]
    for name in sorted(BODIES):
        spark.sparkContext.setJobGroup(name, name)
        df = BODIES[name](rel())
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        s = summarise(plan_text(df))
        pf = "; ".join(p.replace("|", "/") for p in s["partition_filters"]) or "—"
        lines.append(f"| `{name}` | {jobs} | {s['shuffles']} | {s['broadcasts']} | {s['bhj']} | {s['smj']} | {s['subqueries']} | "
                     f"{s['scan_columns']} | {s['python']} | {pf} |")
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    release_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
