"""Merging a batch of events into blocks, logs and the journal, as joins over whole tables.

A batch is (seq, event_kind, block_hash, parent_hash, height, ts, status, status_source).  The last event of a block decides its
flag; the journal keeps each event that flips the flag, so the flag before an event is that of the event before it, or
the stored one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .compare import row_digest


def effective_events(batch: DataFrame, blocks: DataFrame) -> DataFrame:
    """The events that change a flag.  A rollback of a block that is not stored and not applied before is an error."""
    stored = blocks.select("block_hash", F.col("is_canonical").alias("stored"))
    seen = batch.join(stored, "block_hash", "left").withColumn("after", F.col("event_kind") == "apply")
    before = F.coalesce(F.lag("after").over(Window.partitionBy("block_hash").orderBy("seq")), F.col("stored"))
    known = F.when((F.col("event_kind") == "rollback") & F.col("before").isNull(), F.raise_error(F.concat(F.lit("rollback of an unknown block "), F.col("block_hash")))).otherwise(F.lit(True))
    return seen.withColumn("before", before).where(known).where(F.coalesce("before", F.lit(False)) != F.col("after")).drop("stored", "after", "before")


def merge_blocks(blocks: DataFrame, batch: DataFrame) -> DataFrame:
    """blocks after the batch.  New blocks are added; a flip to canonical takes the new time and status; parent and height stay."""
    flips = effective_events(batch, blocks)
    last = flips.groupBy("block_hash").agg(
        F.max_by("event_kind", "seq").alias("kind"),
        *(F.max_by(F.when(F.col("event_kind") == "apply", F.col(c)), F.when(F.col("event_kind") == "apply", F.col("seq"))).alias(f"new_{c}") for c in ("parent_hash", "height", "ts", "status", "status_source")),
    )
    both = blocks.join(last, "block_hash", "full")
    pick = {c: F.coalesce(F.col(f"new_{c}"), F.col(c)) for c in ("ts", "status", "status_source")}
    keep = {c: F.coalesce(F.col(c), F.col(f"new_{c}")) for c in ("parent_hash", "height")}
    flag = F.when(F.col("kind").isNull(), F.col("is_canonical")).otherwise(F.col("kind") == "apply")
    values = pick | keep | {"is_canonical": flag}
    return both.select(*(values.get(c, F.col(c)).alias(c) for c in blocks.columns))


RAW = ("block_number", "transaction_index", "tx_hash", "address", "topic0", "topic1", "topic2", "topic3", "data")


def merge_logs(logs: DataFrame, new: DataFrame) -> DataFrame:
    """logs after new ones by (block_hash, log_index): raw fields are never overwritten; a decode is replaced only if
    all raw fields are equal, and then only by one that exists.  A key stands once in the new ones.

    Both sides are laid together and meet in a window of the key and its block's height, so what is partitioned by height stays where it is.
    Raw fields are compared by digests of 128 bits.
    """
    key, raw, decode = ["block_hash", "log_index"], [c for c in RAW if c in logs.columns], ["decoded_event", "decoder_version"]
    taken = {*key, *raw, *decode}
    h1, h2 = row_digest(raw)
    own = {c: F.col(c) if c in taken else F.lit(None).cast(logs.schema[c].dataType) for c in logs.columns}
    sides = logs.withColumns({"_h1": h1, "_h2": h2, "_old": F.lit(True)}).unionAll(new.select(*(x.alias(c) for c, x in own.items()), h1, h2, F.lit(False)))
    one = Window.partitionBy(*(c for c in ("block_number",) if c in raw), *key)
    fresh = F.when(~F.col("_old"), F.struct("_h1", "_h2", *decode))
    both = sides.withColumns({"_new": F.max(fresh).over(one), "_known": F.max("_old").over(one)}).where("_old OR NOT _known")
    same = F.col("_old") & (F.col("_h1") == F.col("_new._h1")) & (F.col("_h2") == F.col("_new._h2"))
    out = {c: F.when(same, F.coalesce(F.col(f"_new.{c}"), F.col(c))).otherwise(F.col(c)).alias(c) for c in decode}
    return both.select(*(out.get(c, F.col(c)) for c in logs.columns))


def changed_decodes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows whose decode differs, nulls counted as values; a log that is no longer decoded is cleared."""
    n = new.select("block_hash", "log_index", F.col("decoded_event").alias("new_event"), F.col("decoder_version").alias("new_version"))
    both = old.join(n, ["block_hash", "log_index"])
    return both.where(~F.col("decoded_event").eqNullSafe(F.col("new_event")) | ~F.col("decoder_version").eqNullSafe(F.col("new_version")))


def _first_fault(rules: dict[str, Column]) -> Column:
    """The name of the first rule that holds; a rule that is null does not."""
    out = None
    for name, rule in rules.items():
        out = F.when(rule, name) if out is None else out.when(rule, name)
    return out


STATUSES = ("unsafe", "safe", "finalized")


def block_fault_of(row: dict) -> str | None:
    """``block_faults`` for one row that is on the driver."""
    rules = {"block_hash": len(row["block_hash"]) != 64, "parent_hash": len(row["parent_hash"]) != 64, "height": row["height"] < 0, "status": row["status"] not in STATUSES}
    return next((name for name, broken in rules.items() if broken), None)


def block_faults(blocks: DataFrame) -> DataFrame:
    """Blocks out of their domain, with the fault."""
    rules = {
        "block_hash": F.length("block_hash") != 64, "parent_hash": F.length("parent_hash") != 64, "height": F.col("height") < 0,
        "status": ~F.col("status").isin(*STATUSES),
    }
    return blocks.withColumn("fault", _first_fault(rules)).where("fault IS NOT NULL")


def _topic_faults(topics: list[str]) -> Column:
    """A topic of another size than 32 bytes, or one behind an absent one."""
    out = F.lit(False)
    for below, c in zip([None, *topics], topics):
        out = out | F.coalesce(F.length(c) != 64, F.lit(False))
        if below:
            out = out | (F.col(below).isNull() & F.col(c).isNotNull())
    return out


def log_fault(columns: list[str]) -> Column:
    """What is out of its domain in a log: sizes of hashes and addresses, signs of places, order of topics, decodes without a version."""
    rules = {
        "block_hash": F.length("block_hash") != 64, "tx_hash": F.length("tx_hash") != 64, "address": F.length("address") != 40, "data": F.length("data") % 2 != 0,
        "place": (F.col("block_number") < 0) | (F.col("transaction_index") < 0) | (F.col("log_index") < 0),
        "topics": _topic_faults([c for c in ("topic0", "topic1", "topic2", "topic3") if c in columns]),
    }
    if "decoded_event" in columns:
        rules["decode"] = F.col("decoded_event").isNotNull() != F.col("decoder_version").isNotNull()
    return _first_fault(rules)


def log_faults(logs: DataFrame) -> DataFrame:
    """Logs out of their domain, with the fault."""
    return logs.withColumn("fault", log_fault(logs.columns)).where("fault IS NOT NULL")


def check_unique(blocks: DataFrame) -> DataFrame:
    """Heights with more than one canonical block: must be empty before a snapshot is published."""
    return blocks.where("is_canonical").groupBy("height").count().where("count > 1")
