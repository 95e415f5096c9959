"""The journal of applies and rollbacks: backlog, next row, totals, depth, dedup of deliveries, payloads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .canonical import same_block

PAYLOAD_VERSION = 1
#: What a payload says of a log; they are in order by the first two.
PAYLOAD_LOG = ("transaction_index", "log_index", "tx_hash", "address", "topic0", "topic1", "topic2", "topic3", "data")


def backlog(outbox: DataFrame, now: datetime) -> DataFrame:
    """n unpublished rows and the age in seconds of the oldest at a given time; 0 and 0 if there is none."""
    left = outbox.where("published_at IS NULL")
    age = (F.unix_micros(F.lit(now)) - F.unix_micros(F.min("created_at").cast("timestamp"))) / 1_000_000
    return left.agg(F.count("*").alias("n_unpublished"), F.coalesce(age, F.lit(0.0)).alias("oldest_age_s"))


def next_unpublished(outbox: DataFrame, n: int = 1) -> DataFrame:
    return outbox.where("published_at IS NULL").orderBy("event_id").limit(n)


def first_deliveries(deliveries: DataFrame) -> DataFrame:
    """One row for each event id, the first delivery: a minimum, summed before the shuffle."""
    rest = [c for c in deliveries.columns if c not in ("event_id", "attempt")]
    return deliveries.groupBy("event_id").agg(F.min("attempt").alias("attempt"), *(F.min_by(c, "attempt").alias(c) for c in rest))


def totals(outbox: DataFrame) -> DataFrame:
    return outbox.groupBy("event_kind").agg(F.count("*").alias("n"), F.min("block_height").alias("lowest"), F.max("block_height").alias("highest"))


def reorg_runs(outbox: DataFrame) -> DataFrame:
    """Each run of rollbacks with the run of applies behind it: first event id, both lengths, depth = the greater.

    A run begins where the next lower row is of the other kind; ids may have gaps, so lengths are differences of rows' places, not of
    ids.  Places and run starts are found within buckets of ids, and across buckets by each bucket's size, last row and
    first start: no window spans the table.
    """
    e = outbox.select("event_id", "event_kind", F.floor(F.col("event_id") / 65536).alias("bucket"))
    sizes = e.groupBy("bucket").agg(F.count("*").alias("n"), F.max_by("event_kind", "event_id").alias("last"))  # a row for 65,536 ids
    before = sizes.withColumns({
        "before": F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "carried": F.lag("last").over(Window.orderBy("bucket")),
        "end": F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })
    inner = Window.partitionBy("bucket").orderBy("event_id")
    placed = e.withColumns({"rank": F.row_number().over(inner) - 1, "inner": F.lag("event_kind").over(inner)}).join(before, "bucket")
    changed = ~F.coalesce("inner", "carried").eqNullSafe(F.col("event_kind"))
    starts = placed.where(changed).select("event_id", "event_kind", "bucket", (F.col("before") + F.col("rank")).alias("place"), "end")
    firsts = starts.groupBy("bucket").agg(F.min("place").alias("first"))
    after = firsts.withColumn("after", F.lead("first").over(Window.orderBy("bucket"))).select("bucket", "after")
    following = F.lead("place").over(Window.partitionBy("bucket").orderBy("place"))
    lined = starts.join(after, "bucket").withColumn("stop", F.coalesce(following, "after", "end"))
    rolled = lined.where("event_kind = 'rollback'").select(F.col("event_id").alias("first_id"), "stop", (F.col("stop") - F.col("place")).alias("n_rollback"))
    applied = lined.where("event_kind = 'apply'").select(F.col("place").alias("stop"), (F.col("stop") - F.col("place")).alias("n_apply"))
    out = rolled.join(applied, "stop", "left").withColumn("n_apply", F.coalesce("n_apply", F.lit(0)))
    return out.select("first_id", "n_rollback", "n_apply", F.greatest("n_rollback", "n_apply").alias("depth"))


def messages(outbox: DataFrame, chain_id: int) -> DataFrame:
    """key, value and headers of each row for a broker: one key for the chain keeps the order; ids are the journal's."""
    body = F.struct(
        F.lit(PAYLOAD_VERSION).alias("schema_version"), "event_id", F.lit(str(chain_id)).alias("chain_id"), F.col("event_kind").alias("transition_kind"),
        "block_height", F.col("event_id").alias("ordering"), "payload",
    )
    header = (lambda name, value: F.struct(F.lit(name).alias("key"), value.cast("string").cast("binary").alias("value")))
    headers = F.array(header("event_id", F.col("event_id")), header("schema_version", F.lit(PAYLOAD_VERSION)))
    return outbox.select("event_id", F.lit(f"chain:{chain_id}").alias("key"), F.to_json(body).alias("value"), headers.alias("headers"))


def payloads(events: DataFrame, logs: DataFrame) -> DataFrame:
    """Journal payloads: an apply carries its logs in order, a rollback an empty list and no status.

    Logs are grouped and joined by height, which a block's hash fixes: those that are partitioned by height stay where they are.
    """
    from pyspark.sql.functions import array_sort, collect_list, struct

    at = [F.col("block_number").alias("_height"), F.col("block_hash").alias("_hash")]
    grouped = logs.groupBy(*at).agg(array_sort(collect_list(struct(*(c for c in PAYLOAD_LOG if c in logs.columns)))).alias("logs"))
    both = events.join(grouped, (F.col("height") == F.col("_height")) & same_block("block_hash", "_hash"), "left")
    empty = F.array().cast(grouped.schema["logs"].dataType)
    applied = F.col("event_kind") == "apply"
    body = struct(
        F.lit(PAYLOAD_VERSION).alias("schema_version"), F.col("event_kind").alias("transition_kind"), "block_hash", "height",
        F.when(applied, F.col("status")).alias("status"), F.when(applied, F.coalesce("logs", empty)).otherwise(empty).alias("logs"),
    )
    return both.select("seq", "event_kind", "block_hash", "height", F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"))
