"""Print the physical plans of driver queries.

Usage: python tools/explain_queries.py [--trees] [sf_dir] [query ...]   (default: all)
``--trees`` prints only each operator tree, as Markdown (used for PLANS.md).
Queries with setup jobs (key histogram, scratch writes) run those jobs first.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sftforge.queries import QUERIES  # noqa: E402
from sftforge.session import local_session  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    lines = buf.getvalue().splitlines()
    start = next(i for i, line in enumerate(lines) if line.startswith("== Physical Plan =="))
    out = []
    for line in lines[start + 1:]:
        if not line.strip():
            break
        out.append(line)
    return "\n".join(out)


def main() -> None:
    args = sys.argv[1:]
    trees = "--trees" in args
    args = [a for a in args if a != "--trees"]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = local_session(8, 16, app_name="sftforge-explain")
    if trees:
        print("# Physical plans of the driver queries\n")
        print(f"Operator trees from `explain(\"formatted\")` at `{sf}` (AQE initial plans),")
        print("generated by `python tools/explain_queries.py --trees`.\n")
    for name in names:
        df = QUERIES[name](spark, sf)
        if trees:
            print(f"## {name}\n\n```\n{tree(df)}\n```\n")
        else:
            print(f"\n===== {name} =====")
            df.explain("formatted")


if __name__ == "__main__":
    main()
