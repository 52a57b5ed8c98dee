"""Write the physical plans of chosen queries as Markdown (scan pushdown,
read schemas, exchanges, join strategies), e.g.::

    python -m tavolo.plans.explain /root/testdata/sf0.1 docs/PLANS.md client_features ...
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

KEEP = re.compile(r"(Scan parquet|PushedFilters|ReadSchema|Exchange|Join|HashAggregate|TakeOrderedAndProject|"
                  r"MapInPandas|FlatMapGroupsInPandas|Window|Generate|Sort \(|InMemoryTableScan|Scan ExistingRDD)")


def main(argv: list[str]) -> None:
    from tavolo.plans.registry import QUERIES
    from tavolo.session import local_session

    sf_dir, out_path, names = argv[0], argv[1], argv[2:]
    spark = local_session()
    parts = ["# Physical plans\n",
             f"Generated by `python -m tavolo.plans.explain {sf_dir} {out_path} ...` (initial plans; AQE may\n"
             "switch join strategies and coalesce partitions at run time). Only the lines about scans,\n"
             "exchanges, joins and aggregates are kept.\n"]
    for n in names:
        df = QUERIES[n](spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0]
        details = [ln for ln in text.splitlines() if ln.startswith(("PushedFilters", "ReadSchema"))]
        lines = [ln for ln in tree.splitlines() if KEEP.search(ln)]
        parts.append(f"\n## {n}\n\n```\n" + "\n".join(lines) + "\n" + "\n".join(sorted(set(details))) + "\n```\n")
    with open(out_path, "w") as f:
        f.write("".join(parts))


if __name__ == "__main__":
    main(sys.argv[1:])
