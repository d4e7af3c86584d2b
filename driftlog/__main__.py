"""Command line: run the pipeline, the stream, a search or the alert rules as Spark jobs.

  python -m driftlog pipeline --raw DIR --out DIR [--batch-id N]
  python -m driftlog stream   --raw DIR --out DIR --checkpoint DIR [--available-now]
  python -m driftlog search   --out DIR --tenant T [--service S --level L --q TEXT --from TS --to TS
                              --page N --page-size N --hot-days 30]
  python -m driftlog alerts   --out DIR --rules FILE.json --result DIR

Uses the active SparkSession (spark-submit) or a local one.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession


def _spark() -> SparkSession:
    from driftlog.session import apply_conf, local_session

    active = SparkSession.getActiveSession()
    return apply_conf(active) if active is not None else local_session()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="driftlog")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("pipeline", help="raw batch files -> normalized, hot, cold, dead letter")
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--batch-id", type=int, default=0)
    p.add_argument("--ttl", type=float, default=300)
    s = sub.add_parser("stream", help="the same as a streaming query over a folder of raw batch files")
    s.add_argument("--raw", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--ttl", type=float, default=300)
    s.add_argument("--available-now", action="store_true")
    q = sub.add_parser("search", help="one search request against the hot or cold tier")
    q.add_argument("--out", required=True)
    q.add_argument("--tenant", required=True)
    for name in ("service", "level", "q", "from", "to", "page", "page-size"):
        q.add_argument(f"--{name}", default="")
    q.add_argument("--hot-days", type=int, default=30)
    a = sub.add_parser("alerts", help="evaluate alert rules over the hot table")
    a.add_argument("--out", required=True)
    a.add_argument("--rules", required=True, help="JSON list of rule objects")
    a.add_argument("--result", required=True, help="folder for the alert rows (Parquet)")
    c = sub.add_parser("compact", help="merge the hot table's generations into one, index its terms, delete old ones")
    c.add_argument("--out", required=True)
    b = sub.add_parser("batches", help="line files -> JSON batches, one file for each (as ``pipeline`` reads them)")
    for name in ("lines", "out", "agent", "tenant", "service"):
        b.add_argument(f"--{name}", required=True)
    b.add_argument("--host", default="")
    b.add_argument("--environment", default="")
    b.add_argument("--size", type=int, default=100)
    args = ap.parse_args(argv)

    spark = _spark()
    now = datetime.now(timezone.utc)
    if args.cmd == "pipeline":
        from driftlog.plans.pipeline import run
        from driftlog.sources.files import read_spool

        counts = run(read_spool(spark, args.raw), args.out, now, args.batch_id, args.ttl)
        print(json.dumps(counts))
    elif args.cmd == "stream":
        from pyspark.sql import functions as F

        from driftlog.streaming.pipeline import stream_pipeline

        raw = (spark.readStream.option("wholetext", "true").text(args.raw)
               .select(F.col("value")))
        query = stream_pipeline(raw, args.out, args.checkpoint, args.ttl, available_now=args.available_now)
        query.awaitTermination()
    elif args.cmd == "search":
        from driftlog.operators.search import SearchRequest, run_search
        from driftlog.sources.archive import read_archive
        from driftlog.sources.hot import HotTable

        params = {k: getattr(args, k.replace("-", "_")) for k in ("service", "level", "q", "from", "to", "page")}
        params["page_size"] = args.page_size
        req = SearchRequest.parse(args.tenant, params, now)
        if req.tier(now, args.hot_days) == "hot":
            hot = HotTable(spark, f"{args.out}/hot")
            table = hot.read_terms(req.terms) if req.q else hot.read()
        else:
            table = read_archive(spark, f"{args.out}/cold", tenant=args.tenant)
        print(json.dumps(run_search(table, req), default=str))
    elif args.cmd == "alerts":
        from driftlog.operators.alerts import evaluate_rules
        from driftlog.schemas import RULE
        from driftlog.sources.hot import read_hot

        with open(args.rules) as f:
            rules = spark.createDataFrame([tuple(r.get(k.name) for k in RULE.fields) for r in json.load(f)], RULE)
        alerts = evaluate_rules(read_hot(spark, f"{args.out}/hot"), rules)
        alerts.write.mode("overwrite").parquet(args.result)
        print(json.dumps({"alerts": spark.read.parquet(args.result).count()}))
    elif args.cmd == "compact":
        from driftlog.sources.hot import HotTable

        table = HotTable(spark, f"{args.out}/hot")
        table.compact()
        table.index_terms()
        table.vacuum()
        print(json.dumps({"generations": len(table.manifest()["live"])}))
    elif args.cmd == "batches":
        from pyspark.sql import functions as F

        from driftlog.operators.ingest import assemble_batches, parse_lines
        from driftlog.sources.files import read_lines

        lines = read_lines(spark, args.lines).withColumns({
            "agent_id": F.lit(args.agent), "ts": F.lit(now), "__line_no": F.monotonically_increasing_id()}).checkpoint(eager=True)
        entries = parse_lines(lines, args.tenant, args.service, args.host, args.environment)
        out = assemble_batches(entries, args.size, order=["source_file", "__line_no"], sent_at=F.lit(now))
        value = F.to_json(F.struct("agent_id", "entries", "sent_at"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
        out.select("batch_no", value.alias("value")).repartition("batch_no").write.mode("overwrite") \
            .option("partitionOverwriteMode", "static").partitionBy("batch_no").text(args.out)
        print(json.dumps({"batches": spark.read.text(args.out).count()}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
