"""Print the physical plans of registered queries as Markdown.

    python -m ludex.plans.show /root/testdata/sf0.01 q19_ratings q45_recommend > docs/PLANS.md

Plans are the initial adaptive plans (AQE may still switch join strategies
at run time by measured size). Queries that checkpoint run those jobs while
their plan is built, so their plans start at the checkpoint.
"""

from __future__ import annotations

import sys

from ludex.plans.queries import QUERIES
from ludex.session import get_session


def main(argv: list[str]) -> int:
    sf_dir, names = argv[1], argv[2:]
    spark = get_session("local[8]", 8)
    print("# Physical plans\n")
    print(f"Generated with `python -m ludex.plans.show {sf_dir} {' '.join(names)}`.\n")
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"## {name}\n\n```\n{plan.rstrip()}\n```\n")
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
