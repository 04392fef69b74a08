"""Write PLANS.md: for every catalogue query, the physical plan tree from
``explain("formatted")`` and the scan details (ReadSchema, PushedFilters).
Plans are the initial adaptive plans; AQE may still switch a sort-merge join
to a broadcast join or coalesce partitions from runtime statistics.

usage: python tools/plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from basketry.plans.catalog import QUERIES  # noqa: E402
from basketry.session import build_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", 16)
    print(f"# Physical plans ({sf.rstrip('/').split('/')[-1]}, local[8], 16 shuffle partitions)\n")
    print("Generated by `tools/plans.py`. Eager steps of a query (quantile search, "
          "vocabulary, model fits, sequence stitching) have already run; the plan "
          "shown is the final DataFrame's.\n")
    for name, fn in QUERIES.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            fn(spark, sf).explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0].replace("== Physical Plan ==\n", "")
        scans = [ln.strip() for ln in text.splitlines()
                 if ln.startswith(("ReadSchema", "PushedFilters", "Location"))]
        print(f"## {name}\n\n```\n{tree.rstrip()}\n```\n")
        for ln in scans:
            if ln.startswith("Location"):
                ln = "Location: " + ln.split("[")[-1].rstrip("]").split("/")[-1]
            print(f"- `{ln[:300]}`")
        print()


if __name__ == "__main__":
    main()
