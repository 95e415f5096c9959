"""The command line.

    python -m forktide [--config FILE] head
    python -m forktide backfill --from-block A --to-block B [--address HEX] [--verify-url URL]
    python -m forktide live [--start-block N] [--steps N] [--series FOLDER]
    python -m forktide dispatch [--folder PATH] [--once]
    python -m forktide redecode | compact | vacuum | status
    python -m forktide check --step N

Settings come from defaults, the file, FORKTIDE__ variables and these arguments, later ones first.  Each command prints one JSON object; a run
that ends without having done its work exits with 1.
"""

from __future__ import annotations

import argparse
import json
import sys
import time
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forktide.functions.scalars import redacted_url
from forktide.operators import canonical, decoder
from forktide.plans import assemble, config
from forktide.plans.compaction import Compactor, vacuum
from forktide.plans.snapshot import Store
from forktide.plans.status import QueryMetrics, Series
from forktide.sources import rpc


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="forktide")
    p.add_argument("--config")
    p.add_argument("--store")
    p.add_argument("--url", help="of the node")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("head")
    b = sub.add_parser("backfill")
    b.add_argument("--from-block", type=int, required=True)
    b.add_argument("--to-block", type=int, required=True)
    b.add_argument("--address")
    b.add_argument("--verify-url")
    b.add_argument("--workers", type=int)
    live = sub.add_parser("live")
    live.add_argument("--start-block", type=int)
    live.add_argument("--steps", type=int, help="end after so many; without it, run until a stop")
    live.add_argument("--series", help="a folder for a table of metrics")
    d = sub.add_parser("dispatch")
    d.add_argument("--folder", help="write messages there as JSON instead of to the broker")
    d.add_argument("--once", action="store_true", help="end when nothing waits")
    sub.add_parser("redecode")
    sub.add_parser("compact")
    sub.add_parser("vacuum")
    sub.add_parser("status")
    c = sub.add_parser("check")
    c.add_argument("--step", type=int, default=25)
    return p


def settings(args: argparse.Namespace) -> config.Config:
    more: dict = {"store": args.store} if args.store else {}
    if args.url:
        more["rpc"] = {"url": args.url}
    if getattr(args, "workers", None):
        more["backfill"] = {"workers": args.workers}
    return config.load(args.config, overrides=more)


def head(spark: SparkSession, c: config.Config, args) -> tuple[dict, bool]:
    found = rpc.Client(c.rpc.url).head()
    url = spark.range(1).select(redacted_url(F.lit(c.rpc.url))).first()[0]
    return found | {"url": url}, found["chain_id"] == c.chain_id


def backfill(spark: SparkSession, c: config.Config, args) -> tuple[dict, bool]:
    job = assemble.backfill_of(spark, c, args.from_block, args.to_block, args.address)
    report = job.run()
    if args.verify_url:
        job.verify(args.verify_url, report)
    bounds = canonical.range_summary(job.store.blocks(args.from_block, args.to_block), args.from_block, args.to_block).first().asDict()
    whole = bounds["n"] == args.to_block - args.from_block + 1
    return asdict(report) | {"blocks_per_second": report.blocks_per_second, "calls_per_1k_blocks": report.calls_per_1k_blocks, "contiguous": whole}, whole and not report.only_here and not report.only_there


def live(spark: SparkSession, c: config.Config, args) -> tuple[dict, bool]:
    run = assemble.live_of(spark, c, args.start_block)
    if args.series:
        run.series = Series(spark, args.series)
        spark.streams.addListener(QueryMetrics(run.series))
    try:
        if args.steps is None:
            run.stream(c.indexer.poll_seconds).awaitTermination()
        for n in range(args.steps or 0):
            if n:
                time.sleep(c.indexer.poll_seconds)
            run.step()
            if run.health.stopped:
                break
    finally:
        if run.series is not None:
            run.series.flush()
    return asdict(run.status) | {"lag": run.status.lag}, run.health.ok


def dispatch(spark: SparkSession, c: config.Config, args) -> tuple[dict, bool]:
    def to_folder(part: DataFrame) -> None:
        part.select("event_id", "key", "value").write.mode("append").json(args.folder)

    d = assemble.dispatcher_of(spark, c, to_folder if args.folder else None)
    if args.once:
        return {"parts": d.drain(), "segments": len(d.read)}, True
    d.stream(spark, c.broker.poll_seconds).awaitTermination()
    return {"segments": len(d.read)}, True


def redecode(spark: SparkSession, c: config.Config, args) -> tuple[dict, bool]:
    contracts = assemble.contracts_of(spark, c)
    if contracts is None:
        raise config.ConfigError("redecoding needs contracts in the settings")
    store = Store(spark, c.store)
    logs = store.logs().drop("decoded_event", "decoder_version").withColumn("topics", F.array_compact(F.array("topic0", "topic1", "topic2", "topic3")))
    return {"changed": store.redecode(decoder.decode(logs, contracts))}, True


def compact(spark: SparkSession, c: config.Config, args) -> tuple[dict, bool]:
    worker = Compactor(Store(spark, c.store))
    worker.run()
    return {"done": worker.done}, True


def removed(spark: SparkSession, c: config.Config, args) -> tuple[dict, bool]:
    return {"removed": vacuum(Store(spark, c.store))}, True


def status(spark: SparkSession, c: config.Config, args) -> tuple[dict, bool]:
    store = Store(spark, c.store)
    m = store.manifest()
    left = sum(s["high"] - max(s["low"] - 1, m.published_upto) for s in store.unpublished(m))
    return {"version": m.version, "chain_id": m.chain_id, "checkpoint": m.checkpoint, "deltas": len(m.deltas), "segments": len(m.journal), "published_upto": m.published_upto, "waiting_at_most": left}, True


def check(spark: SparkSession, c: config.Config, args) -> tuple[dict, bool]:
    """The stored chain against itself and, at every step-th height and the tip, against the node."""
    store, client = Store(spark, c.store), rpc.Client(c.rpc.url, budget=assemble.budget_of(c))
    blocks = store.blocks()
    missing = canonical.first_missing(blocks, 20).first()
    sample = canonical.sampled_hashes(blocks, args.step).select("height", "block_hash").toLocalIterator()
    checked, wrong = 0, []
    for r in sample:
        found = client.find_block(r["height"])
        checked += 1
        if found is None or found[1] != r["block_hash"].lower():
            wrong.append(r["height"])
    return {"missing": missing["n_missing"], "first_missing": missing["first_heights"], "checked": checked, "different": wrong[:20], "n_different": len(wrong)}, not (missing["n_missing"] or wrong)


COMMANDS = {"head": head, "backfill": backfill, "live": live, "dispatch": dispatch, "redecode": redecode, "compact": compact, "vacuum": removed, "status": status, "check": check}


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("forktide").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        found, good = COMMANDS[args.command](spark, settings(args), args)
    except (ValueError, RuntimeError, OSError) as e:
        found, good = {"error": f"{type(e).__name__}: {e}"}, False
    print(json.dumps(found, default=str))
    return 0 if good else 1


if __name__ == "__main__":
    sys.exit(main())
