"""Run a registered query (see ``rivulet.plans.catalog``).

    spark-submit jobs/query.py --list
    spark-submit jobs/query.py enrich_lookup --sf-dir /data/sf1 --out /results/enrich_lookup
    spark-submit jobs/query.py latest_enrichment --sf-dir /data/sf1 --show 20
    spark-submit jobs/query.py enrich_lookup --sf-dir /data/sf1 --sql   # its DuckDB oracle

Results are written as Parquet (``--out``) or a few rows are shown; nothing
else is brought to the driver.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from rivulet.plans import catalog  # noqa: E402
from rivulet.session import RECOMMENDED_CONF  # noqa: E402


def parse(argv=None):
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("name", nargs="?", choices=sorted(catalog.QUERIES))
    p.add_argument("--list", action="store_true", help="list the registered queries")
    p.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    p.add_argument("--out", help="write the result as Parquet here")
    p.add_argument("--show", type=int, default=0, help="show this many rows")
    p.add_argument("--explain", action="store_true", help="print the formatted plan")
    p.add_argument("--sql", action="store_true", help="print the DuckDB oracle SQL")
    return p.parse_args(argv)


def main(argv=None) -> int:
    a = parse(argv)
    if a.list or not a.name:
        for name, fn in catalog.QUERIES.items():
            doc = (fn.__doc__ or "").strip().splitlines()
            print(f"{name:32s} {doc[0] if doc else ''}")
        return 0
    if a.sql:
        print(catalog.ORACLE_SQL[a.name])
        return 0
    builder = SparkSession.builder.appName(f"rivulet-{a.name}")
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    df = catalog.QUERIES[a.name](spark, a.sf_dir)
    if a.explain:
        df.explain("formatted")
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
        print(f"wrote {a.name} to {a.out}")
    if a.show:
        df.show(a.show, truncate=False)
    if not (a.out or a.show or a.explain):
        df.write.format("noop").mode("overwrite").save()
        print(f"ran {a.name}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
