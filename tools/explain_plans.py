"""Print the physical plan of registered queries (``explain("formatted")``).

    python tools/explain_plans.py [sf_dir] [name ...]

With no names, every registered query is explained. Nothing is executed
except the small size-check jobs some queries run while being built.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedlens.plans.catalog import queries  # noqa: E402
from feedlens.session import local_session  # noqa: E402

# queries that land data while being built (not useful to explain)
SIDE_EFFECTS = {"stream_entity_counts", "entity_counts_post_lines"}


def main(argv: list[str]) -> int:
    sf = argv[1] if len(argv) > 1 and not argv[1].isidentifier() else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if a.isidentifier()]
    spark = local_session()
    qs = queries()
    for name in names or [n for n in qs if n not in SIDE_EFFECTS]:
        print(f"===== {name}")
        qs[name](spark, sf).explain("formatted")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
