"""Physical-plan summary of every registered query (writes PLANS.md).

``python -m fleetframe.plans.report [sf_dir] > PLANS.md``

Per query: shuffles (exchange kind and keys), joins (strategy), aggregation
operators, windows, and what each scan reads (columns, pushed filters).
Plans are the initial adaptive plans; queries that write intermediate results
(lineage cuts) show the plan that reads them back.
"""

from __future__ import annotations

import re
import sys

from fleetframe.plans.inspect import plan_text

_ID = re.compile(r"#\d+L?")


def _clean(s: str) -> str:
    s = _ID.sub("", s)
    s = re.sub(r"knownfloatingpointnormalized\(normalizenanandzero\((\w+)\)\)", r"\1", s)
    return s.strip()


def summarize(df) -> dict:
    simple = plan_text(df, "simple")
    formatted = plan_text(df, "formatted")
    lines = [l.strip().lstrip(":+- ").strip() for l in simple.splitlines()]
    exchanges = []
    for l in lines:
        if l.startswith("Exchange "):
            body = re.split(r", (?:ENSURE_REQUIREMENTS|REPARTITION\w*|REBALANCE\w*|SHUFFLE\w*)", l)[0]
            body = _clean(body[len("Exchange "):])
            exchanges.append(re.sub(r", \d+\)$", ")", body))
        elif l.startswith("BroadcastExchange"):
            exchanges.append("broadcast")
    join_kinds = []
    for l in lines:
        m = re.match(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                     r"CartesianProduct).*?\b(Inner|LeftSemi|LeftAnti|LeftOuter|RightOuter|FullOuter|Cross)\b", l)
        if m:
            join_kinds.append(f"{m.group(1)} {m.group(2)}")
    aggs = sorted({w for l in lines for w in ("HashAggregate", "SortAggregate", "ObjectHashAggregate")
                   if l.startswith(w)})
    windows = sum(1 for l in lines if l.startswith("Window "))
    scans = []
    for block in formatted.split("\n\n"):
        if not re.match(r"\(\d+\) Scan parquet", block.strip()):
            continue
        schema = re.search(r"ReadSchema: (.*)", block)
        pushed = re.search(r"PushedFilters: \[(.*)\]", block)
        location = re.search(r"Location: \w+ \[([^\]]*)\]", block)
        where = location.group(1).rsplit("/", 1)[-1] if location else "?"
        where = re.sub(r"-[0-9a-f]{12}$", "", where)  # scratch folders: drop the unique suffix
        scans.append((where, schema.group(1) if schema else "", pushed.group(1) if pushed else ""))
    return {"exchanges": exchanges, "joins": join_kinds, "aggregates": aggs,
            "windows": windows, "scans": scans}


def main(argv=None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    from fleetframe.plans.queries import REGISTRY
    from fleetframe.session import build_session
    spark = build_session(shuffle_partitions=8)
    print("# PLANS\n")
    print(f"Physical plans of every registered query (input `{sf_dir}`, AQE on, initial plans).")
    print("Generated by `python -m fleetframe.plans.report`. Scans of `fleetframe/*` folders read")
    print("intermediate results the query wrote to the checkpoint folder (lineage cuts).\n")
    print("| query | shuffles | joins | aggregation | windows |")
    print("| --- | --- | --- | --- | --- |")
    details = []
    for name, fn in REGISTRY.items():
        s = summarize(fn(spark, sf_dir))
        shuffles = "<br>".join(s["exchanges"]) or "none"
        joins = "<br>".join(s["joins"]) or "none"
        print(f"| `{name}` | {shuffles} | {joins} | {', '.join(s['aggregates']) or 'none'} | {s['windows']} |")
        details.append((name, s["scans"]))
    print("\n## Scans (columns read, filters pushed to Parquet)\n")
    for name, scans in details:
        for where, schema, pushed in scans:
            print(f"* `{name}` ← `{where}`: `{schema}`" + (f"; pushed: `{pushed}`" if pushed else ""))
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
