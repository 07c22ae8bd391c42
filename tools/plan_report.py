"""Summarise the physical plan of every registered query (PLANS.md).

For each query: shuffle exchanges (with their partitioning keys), broadcast
exchanges, joins, partial window-group limits, scans with their pushed
filters and read columns, and the steps a query stores in the checkpoint folder
before its final plan.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from ledgerlens import session as session_mod  # noqa: E402
from ledgerlens.queries import QUERIES  # noqa: E402
from ledgerlens.session import local_session  # noqa: E402


def explain(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(plan: str) -> dict:
    shuffles = re.findall(r"Arguments: (hashpartitioning|rangepartitioning|SinglePartition)\(?([^\]]*?)\)?, "
                          r"(?:\d+, )?(ENSURE_REQUIREMENTS|REPARTITION_BY_COL|REPARTITION_BY_NUM)", plan)
    keys = []
    for kind, args, _ in shuffles:
        cols = [re.sub(r"#\d+L?", "", a).strip() for a in args.split(",")]
        cols = [c for c in cols if c and not c.isdigit()]
        keys.append(f"{kind.replace('partitioning', '')}({', '.join(cols)})")
    single = plan.count("Arguments: SinglePartition")
    scans = re.findall(r"\(\d+\) Scan parquet[^\n]*\n(.*?)\n\n", plan, re.S)
    scan_info = []
    for s in scans:
        loc = re.search(r"Location: \w+ \[?([^\]\n]*)", s)
        name = loc.group(1).rsplit("/", 1)[-1] if loc else "?"
        if "ledgerlens/" in s:
            name = "checkpoint:" + re.sub(r"-[0-9a-f]{32}.*", "", s.split("ledgerlens/")[1].split("]")[0])
        pushed = re.search(r"PushedFilters: \[(.*?)\]\n", s)
        schema = re.search(r"ReadSchema: struct<(.*)>", s)
        ncols = schema.group(1).count(":") if schema else 0
        scan_info.append(f"{name} ({ncols} cols" + (f"; pushed: {pushed.group(1)}" if pushed and pushed.group(1) else "") + ")")
    return {
        "shuffles": keys,
        "single_partition": single,
        "broadcasts": plan.count("BroadcastExchange ("),
        "joins": re.findall(r"\((?:\d+)\) (\w*Join)", plan),
        "partial_limits": len(re.findall(r"row_number\(\), 1, Partial", plan)),
        "codegen_stages": len(set(re.findall(r"\[codegen id : (\d+)\]", plan))),
        "scans": scan_info,
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    writes: list[str] = []
    original = session_mod.materialize

    def recording(df, label):
        writes.append(label)
        return original(df, label)

    for mod in ("ledgerlens.queries", "ledgerlens.plans.models"):
        sys.modules[mod].materialize = recording

    print("# Physical plans of the registered queries\n")
    print(f"Generated by `python tools/plan_report.py {sf_dir}` (AQE on; the final plans are "
          "shown before AQE's runtime changes). `hash(k)` is a hash exchange on `k`, `range(k)` a "
          "range exchange; *writes* are the steps stored in the checkpoint folder before the final "
          "plan (each is one job).\n")
    print("| Query | Shuffles | Broadcasts / joins | Partial dedup limits | Scans (columns read; pushed filters) | Writes first |")
    print("|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        writes.clear()
        df = fn(spark, sf_dir)
        info = summarise(explain(df))
        shuffles = "; ".join(info["shuffles"]) or "none"
        if info["single_partition"]:
            shuffles += f" (+{info['single_partition']} to one partition, on aggregated rows)"
        joins = ", ".join(info["joins"]) or "—"
        bc = f"{info['broadcasts']} broadcast; {joins}" if info["broadcasts"] else joins
        print(f"| `{name}` | {shuffles} | {bc} | {info['partial_limits'] or '—'} | "
              f"{'<br>'.join(info['scans'])} | {', '.join(writes) or '—'} |")
    spark.stop()


if __name__ == "__main__":
    main()
