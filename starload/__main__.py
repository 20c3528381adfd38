"""Command line: ``python -m starload refresh --daily ... --series ... --warehouse ...``.

``transform`` writes the processed CSV files, ``load`` loads them, ``refresh``
does both in one plan, ``report`` writes the BI aggregates of the published
version as CSV, every row of them, and prints where and how many. ``view`` points the
catalog view at the newest version, ``clean`` removes what the newest versions do not
need. The session runs on the cluster it is submitted to.
"""

from __future__ import annotations

import argparse
import json

from starload.plans.catalog_view import DATABASE, publish_view
from starload.plans.marts import report_tables
from starload.plans.refresh import load_processed, refresh, transform_daily, transform_weather, weather_globs
from starload.session import build_session
from starload.sources.csv_io import write_csv
from starload.sources.warehouse import Warehouse


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="starload")
    ap.add_argument("command", choices=["transform", "load", "refresh", "report", "view", "clean"])
    ap.add_argument("--daily", help="daily tab-separated series (file, folder or glob)")
    ap.add_argument("--series", help="root of the monthly series folders")
    ap.add_argument("--processed", help="folder for the processed CSV hand-over")
    ap.add_argument("--warehouse", help="warehouse root folder")
    ap.add_argument("--state", help="folder of the monthly state: refresh then reads new daily files only")
    ap.add_argument("--database", default=DATABASE, help="database of the catalog view")
    ap.add_argument("--keep", type=int, default=2, help="versions that clean keeps")
    ap.add_argument("--out", help="folder for the report's CSV files")
    ap.add_argument("--master", default=None, help="Spark master (default: from the environment)")
    a = ap.parse_args(argv)
    if a.command == "report" and not a.out:
        ap.error("report needs --out")
    spark = build_session(master=a.master)
    if a.command == "transform":
        transform_daily(spark, a.daily, f"{a.processed}/monthly_facts")
        run = transform_weather(spark, weather_globs(a.series), f"{a.processed}/monthly_weather")
        print(json.dumps({"weather": run.summary.asDict(), "first_months": [r.asDict() for r in run.preview]}))
    elif a.command == "load":
        res = load_processed(spark, f"{a.processed}/monthly_facts", f"{a.processed}/monthly_weather", a.warehouse)
        print(json.dumps({"version": res.version, **res.report}))
    elif a.command == "refresh":
        res = refresh(spark, a.daily, weather_globs(a.series), a.warehouse, a.state)
        print(json.dumps({"version": res.version, **res.report}))
    elif a.command == "view":
        print(json.dumps({"version": publish_view(Warehouse(spark, a.warehouse), a.database)}))
    elif a.command == "clean":
        print(json.dumps({"removed": Warehouse(spark, a.warehouse).clean(a.keep)}))
    else:
        wh = Warehouse(spark, a.warehouse)
        print(wh.describe())
        for name, df in report_tables(wh).items():
            write_csv(df, f"{a.out.rstrip('/')}/{name}")
            print(json.dumps({"table": name, "path": f"{a.out.rstrip('/')}/{name}", "rows": df.count()}))


if __name__ == "__main__":
    main()
