"""Compare every registered query with its DuckDB oracle (local gate).

    python tools/check_oracle.py [sf_dir] [name ...]

Prints one line per query: match flags, row counts and Spark seconds.
Exit code 1 when any query with an oracle mismatches.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedlens.plans.catalog import oracle_sql, queries  # noqa: E402
from feedlens.session import local_session  # noqa: E402
from feedlens.sources.tables import TABLE_NAMES  # noqa: E402


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def main(argv):
    sf = argv[1] if len(argv) > 1 and not argv[1].isidentifier() else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if a.isidentifier()]
    spark = local_session()
    con = duckdb.connect()
    for t in TABLE_NAMES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf)
            scols = df.columns
            stypes = [f.dataType.simpleString() for f in df.schema.fields]
            srows = df.collect()
        except Exception as e:  # report and continue
            print(f"{name:48s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in sqls:
            print(f"{name:48s} rows={len(srows)} (no oracle) {dt:.2f}s")
            continue
        try:
            rel = con.sql(sqls[name])
            dcols, dtypes = rel.columns, [str(t) for t in rel.types]
            drows = rel.fetchall()
        except Exception as e:
            print(f"{name:48s} DUCKDB ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        same_cols = sorted(scols) == sorted(dcols)
        same_n = len(srows) == len(drows)
        same_v = same_cols and _rows(scols, srows) == _rows(dcols, drows)
        ok = same_cols and same_n and same_v
        bad += not ok
        types = ",".join(f"{c}:{t}" for c, t in sorted(zip(scols, stypes)))
        dty = ",".join(f"{c}:{t}" for c, t in sorted(zip(dcols, dtypes)))
        print(
            f"{name:48s} {'OK ' if ok else 'BAD'} cols={same_cols} n={len(srows)}/{len(drows)} "
            f"values={same_v} {dt:.2f}s"
        )
        if not ok or os.environ.get("SHOW_TYPES"):
            print(f"    spark : {types}\n    duckdb: {dty}")
            if same_cols and not same_v:
                a, b = _rows(scols, srows), _rows(dcols, drows)
                sa, sb = set(a), set(b)
                print("    only spark :", list(sa - sb)[:3])
                print("    only duckdb:", list(sb - sa)[:3])
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
