"""Command-line front end: ``python -m feedlens [--subscription-file F] [--entities-dir D] [--top-k K]``.

Same three parameters and defaults as the reference; prints the three
reports, or the reference's error line for a fatal guard (exit code 1).
"""

from __future__ import annotations

import argparse
import sys

from feedlens.plans.analysis import run_analysis
from feedlens.plans.quality import NoValidPosts, write_quarantine
from feedlens.session import local_session


def _print_warnings(result, quarantine: str | None) -> None:
    """Per-row warnings (Q6, Q7, Q8, S6), all of them, a partition at a time; the records behind
    them go to ``quarantine``."""
    for row in result.warnings.toLocalIterator():
        print(row["message"])
    if quarantine:
        print(f"Quarantine: {write_quarantine(result.quarantine, quarantine)}")


def main(argv: list[str] | None = None, spark=None) -> int:
    """Run from arguments; stops the session only when it created it."""
    p = argparse.ArgumentParser(prog="feedlens")
    p.add_argument("--subscription-file", default="data/valid_subscriptions.json",
                   help="JSON array of {name, url} subscriptions (default: %(default)s)")
    p.add_argument("--entities-dir", default="data/valid_entities",
                   help="directory with the dictionary .txt files (default: %(default)s)")
    p.add_argument("--top-k", type=int, default=10, help="number of top entities to report (default: %(default)s)")
    p.add_argument("--master", default="local[*]", help="Spark master (default: %(default)s); a cluster needs spark.checkpoint.dir in its configuration")
    p.add_argument("--quarantine", metavar="PATH", help="write rejected entries and failed feeds, with reason and source position, as a table there")
    p.add_argument("--run-id", help="name of the run: the same call again goes on from what a broken one has landed")
    a = p.parse_args(argv)
    if a.top_k <= 0:
        p.error("--top-k must be positive")
    owned = spark is None
    if owned:
        spark = local_session(master=a.master)
    try:
        with run_analysis(spark, a.subscription_file, a.entities_dir, a.top_k, run_id=a.run_id) as result:
            _print_warnings(result, a.quarantine)
            print(result.report())
        return 0
    except NoValidPosts as e:
        with e.result as result:
            _print_warnings(result, a.quarantine)
            print(result.report() + "\n")
        print(f"Error: {e}")
        return 1
    except (FileNotFoundError, ValueError) as e:
        print(f"Error: {e}")
        return 1
    finally:
        if owned:
            spark.stop()


if __name__ == "__main__":
    sys.exit(main())
