"""Write PLANS.md: the physical plan tree of every batch query (sf0.01).

usage: python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from navedge.plans.catalog import QUERIES
    from navedge.session import get_session
    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    out = ["# Physical plans", "",
           f"Generated by `tools/dump_plans.py` on `{sf_dir}` with `local[8]`. The tree of each batch",
           "query, before adaptive re-planning (AQE may still coalesce partitions, reuse an exchange",
           "or turn a sort-merge join into a broadcast join at run time). Streaming keys run a stream first,",
           "so they are listed by their batch twin.", ""]
    for name, fn in QUERIES.items():
        if name.startswith("stream_"):
            continue
        df = fn(spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0].replace("== Physical Plan ==\n", "")
        pushed = sorted({line.strip() for line in text.splitlines()
                         if line.startswith("PushedFilters") and line.strip() != "PushedFilters: []"})
        schemas = sorted({line.strip() for line in text.splitlines() if line.startswith("ReadSchema")})
        exch = sum(1 for line in text.splitlines() if line.startswith("Arguments: hashpartitioning")
                   or line.startswith("Arguments: rangepartitioning")
                   or line.startswith("Arguments: SinglePartition"))
        out += [f"## {name}", "", f"exchanges: {exch}", "", "```", tree.rstrip(), "```", ""]
        out += [f"- {s}" for s in schemas + pushed] + [""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"),
              "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
