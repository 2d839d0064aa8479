"""Run the refresh as a job.

    python -m skuflow.plans.cli --testdata /root/testdata/sf0.01 \\
        --stage <shared>/stage --out <shared>/reports [--brands ABC,DEF] [--master local[8]]
    python -m skuflow.plans.cli --jdbc ABC=jdbc:mysql://host/crm_abc,DEF=... --properties user=..,password=.. \\
        --stage <shared>/stage --out <shared>/reports

With ``--testdata`` the source tables are built from the test tables, with ``--jdbc``
they are read from the brands' databases (the database is the URL's last part), and
snapshotted into ``--stage`` (ledger -> stage -> audit -> gate -> promote); the reports
then read the live snapshot.  Without either, the reports read whatever is live
under ``--stage``.  A brand that fails the gate ends the job with an error
before any report is written (the other brands have been promoted).  Prints
the gate and the rows written per report as JSON.
"""

from __future__ import annotations

import argparse
import json

from skuflow.brands import validate_brands
from skuflow.plans import pipeline
from skuflow.session import build_session
from skuflow.sources import jdbc, snapshot
from skuflow.sources.fixtures import shop_from_testdata


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(prog="skuflow")
    ap.add_argument("--stage", required=True, help="snapshot root (shared storage)")
    ap.add_argument("--out", required=True, help="report root (shared storage)")
    ap.add_argument("--testdata", help="build sources from this test-table folder and snapshot them")
    ap.add_argument("--jdbc", help="brand=url pairs, comma-separated: snapshot the brands' databases")
    ap.add_argument("--properties", default="", help="key=value pairs, comma-separated, for the databases' driver")
    ap.add_argument("--splits", type=int, default=16, help="parallel reads of a database table")
    ap.add_argument("--database", default="default", help="catalogue database of the report views")
    ap.add_argument("--brands", help="comma-separated brand codes (default: all)")
    ap.add_argument("--master", help="Spark master (default: from the launcher)")
    args = ap.parse_args(argv)

    brands = validate_brands(args.brands.split(",")) if args.brands else None
    spark = build_session(args.master)
    result: dict = {}
    if args.testdata and args.jdbc:
        ap.error("--testdata or --jdbc, not both")
    if args.testdata or args.jdbc:
        if args.jdbc:
            urls = dict(pair.split("=", 1) for pair in args.jdbc.split(","))
            brands = brands or validate_brands(urls)
            props = dict(pair.split("=", 1) for pair in args.properties.split(",") if pair)
            named = {b: (urls[b], urls[b].split("?")[0].rstrip("/").rsplit("/", 1)[-1]) for b in brands}
            sources = jdbc.read_sources(spark, named, props, args.splits)
        else:
            sources = shop_from_testdata(spark, args.testdata)
        run_id, gate = snapshot.snapshot_and_promote(spark, sources, args.stage, brands)
        result["run_id"] = run_id
        result["gate"] = {r["brand"]: bool(r["passed"]) for r in gate.collect()}
    live = snapshot.read_live(spark, args.stage, brands)
    result["rows"] = pipeline.run(spark, live, args.out, brands, args.database)
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
