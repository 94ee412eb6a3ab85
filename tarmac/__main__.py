"""Command line: ``python -m tarmac <command> ...``.

  cleanup IN OUT [--csv] [--raw-csv] [--lineage]  archives (or raw CSV) -> cleaned flights
  results FLIGHTS OUT [--year Y] [--n N] [--csv]  all result tables from stored flights or cleaned CSV
  publish CLEAN --format kafka --option k=v ...   cleaned CSV rows -> topic
  stream QUESTION --out PATH --checkpoint PATH --format kafka --option k=v ...
                                           running result table (one-second batches)
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):  # run as a script (e.g. by spark-submit): find the package
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tarmac.session import build_session  # noqa: E402


def _options(pairs):
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tarmac")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)

    c = sub.add_parser("cleanup")
    c.add_argument("inp")
    c.add_argument("out")
    c.add_argument("--csv", action="store_true")
    c.add_argument("--raw-csv", action="store_true")
    c.add_argument("--lineage", action="store_true", help="keep the archive and member, or file, of every row")

    r = sub.add_parser("results")
    r.add_argument("flights")
    r.add_argument("out")
    r.add_argument("--year", type=int, default=2008)
    r.add_argument("--all-years", action="store_true")
    r.add_argument("--n", type=int, default=10)
    r.add_argument("--csv", action="store_true", help="FLIGHTS is a folder of cleaned CSV files")

    p = sub.add_parser("publish")
    p.add_argument("clean")
    p.add_argument("--format", default="kafka")
    p.add_argument("--option", action="append")
    p.add_argument("--path", default=None)

    s = sub.add_parser("stream")
    s.add_argument("question", choices=["popularity", "carrier_delay", "top_carriers",
                                        "top_destinations", "route_delay", "best_flights"])
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--format", default="kafka")
    s.add_argument("--option", action="append")
    s.add_argument("--path", default=None)
    s.add_argument("--trigger", default="1 second")
    s.add_argument("--year", type=int, default=2008)
    s.add_argument("--retain", type=int, default=None,
                   help="complete-mode tables: keep only this many finished batches")
    s.add_argument("--compact-every", type=int, default=None,
                   help="update-mode tables: fold into a base every N batches")

    s.add_argument("--snapshot-prefix", default=None, help="also write each batch as CSV text below this folder")

    a = ap.parse_args(argv)
    spark = build_session(master=a.master, shuffle_partitions=None)

    if a.cmd == "cleanup":
        from tarmac.plans.jobs import cleanup

        rejects = cleanup(spark, a.inp, a.out, "csv" if a.csv else "parquet",
                          "csv" if a.raw_csv else "zip", a.lineage)
        path = a.out.rstrip("/") + "_rejects"
        rejects.write.mode("overwrite").parquet(path)
        n = spark.read.parquet(path).count()
        if n:
            print(f"{n} unreadable archives, members or records, listed in {path}", file=sys.stderr)
    elif a.cmd == "results":
        from tarmac.plans.jobs import results

        results(spark, a.flights, a.out, None if a.all_years else a.year, a.n, source="csv" if a.csv else "parquet")
    elif a.cmd == "publish":
        from tarmac.sinks.files import publish
        from tarmac.sources.files import read_clean

        publish(read_clean(spark, a.clean, strict=True), a.format, _options(a.option), a.path)
    elif a.cmd == "stream":
        from tarmac.streaming import jobs
        from tarmac.streaming.source import stream_clean

        src = stream_clean(spark, a.format, _options(a.option), a.path)
        build = jobs.JOBS[f"stream_{a.question}"]
        job = build(src, year=a.year) if a.question == "best_flights" else build(src)
        job.retain = a.retain
        job.compact_every = a.compact_every
        job.snapshot_prefix = a.snapshot_prefix
        q = job.start(a.out, a.checkpoint, trigger={"processingTime": a.trigger}, name=a.question)
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
