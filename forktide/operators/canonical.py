"""Reads of the canonical view: which blocks and logs the accepted branch holds.

Logs have no flag of their own; their block's flag decides.  Every function is a plan over DataFrames, so filters on heights and
addresses reach the scan, and Spark picks the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOG_ORDER = ("block_number", "transaction_index", "log_index")


def canonical(blocks: DataFrame) -> DataFrame:
    return blocks.where("is_canonical")


def orphans(blocks: DataFrame) -> DataFrame:
    return blocks.where("NOT is_canonical")


def in_heights(df: DataFrame, low: int, high: int, column: str = "height") -> DataFrame:
    """low to high, both included."""
    return df.where(F.col(column).between(low, high))


def canonical_logs(logs: DataFrame, blocks: DataFrame, low: int | None = None, high: int | None = None, address: str | None = None) -> DataFrame:
    """Logs of canonical blocks; the optional bounds go to both scans.

    A block's hash fixes its height, and the join is on the height alone, at which few blocks stand: logs that are partitioned by height stay where they are.
    """
    if low is not None:
        logs, blocks = in_heights(logs, low, high, "block_number"), in_heights(blocks, low, high)
    if address is not None:
        logs = logs.where(F.col("address") == address)
    held = canonical(blocks).select(F.col("height").alias("_height"), F.col("block_hash").alias("_hash"))
    return logs.join(held, (F.col("block_number") == F.col("_height")) & same_block("block_hash", "_hash")).select(*logs.columns)


def same_block(a: str, b: str) -> Column:
    """Equality that a join does not take for one of its keys, so it moves no rows by it."""
    return F.col(a).between(F.col(b), F.col(b))


def with_topic0(logs: DataFrame, topic: str) -> DataFrame:
    return logs.where(F.col("topic0") == topic)


def header_at(blocks: DataFrame, height: int) -> DataFrame:
    return canonical(blocks).where(F.col("height") == height)


def header_by_hash(blocks: DataFrame, block_hash: str) -> DataFrame:
    return blocks.where(F.col("block_hash") == block_hash)


def headers_descending(blocks: DataFrame, low: int, high: int) -> DataFrame:
    """Canonical headers above low and up to high, highest first."""
    return canonical(blocks).where((F.col("height") > low) & (F.col("height") <= high)).orderBy(F.desc("height"))


def range_summary(blocks: DataFrame, low: int, high: int) -> DataFrame:
    """n, first and last height; first and last are null if the range is empty."""
    return in_heights(canonical(blocks), low, high).agg(F.count("*").alias("n"), F.min("height").alias("first_height"), F.max("height").alias("last_height"))


def contiguity(blocks: DataFrame, width: int) -> DataFrame:
    """For each bucket of width heights whether none is missing; one canonical block at a height makes a count enough."""
    bucket = F.floor(F.col("height") / width).alias("bucket")
    out = canonical(blocks).groupBy(bucket).agg(F.count("*").alias("n"), F.min("height").alias("first_height"), F.max("height").alias("last_height"))
    return out.withColumn("contiguous", (F.col("n") == width) & (F.col("first_height") == F.col("bucket") * width) & (F.col("last_height") == F.col("bucket") * width + width - 1))


def missing_heights(blocks: DataFrame) -> DataFrame:
    """Heights between the first and the last without a canonical block.

    A gap is the step from one height to the next, so only gaps are expanded, not the whole range.  Heights meet
    their successor within buckets and across them by each bucket's ends; no window spans the table.
    """
    heights = canonical(blocks).select("height").distinct().withColumn("bucket", F.floor(F.col("height") / 65536))
    inner = heights.withColumn("next", F.lead("height").over(Window.partitionBy("bucket").orderBy("height"))).where("next IS NOT NULL").select("height", "next")
    ends = heights.groupBy("bucket").agg(F.min("height").alias("lo"), F.max("height").alias("hi"))  # a row for 65,536 heights
    across = ends.withColumn("next", F.lead("lo").over(Window.orderBy("bucket"))).where("next IS NOT NULL").select(F.col("hi").alias("height"), "next")
    gaps = inner.unionAll(across).where("next > height + 1")
    steps = gaps.select(F.explode(F.sequence(F.col("height") + 1, F.col("next") - 1, F.lit(65536))).alias("low"), (F.col("next") - 1).alias("high"))  # a wide gap is no one row's array
    return steps.select(F.explode(F.sequence("low", F.least(F.col("low") + 65535, "high"))).alias("height"))


def first_missing(blocks: DataFrame, n: int = 20) -> DataFrame:
    """n_missing and the first n missing heights as a list in text, empty if none is missing."""
    gone = missing_heights(blocks)
    first = gone.orderBy("height").limit(n).agg(F.coalesce(F.concat_ws(",", F.transform(F.array_sort(F.collect_list("height")), lambda x: x.cast("string"))), F.lit("")).alias("first_heights"))
    return gone.agg(F.count("*").alias("n_missing")).crossJoin(first)


def checkpoint_ok(checkpoint: DataFrame, blocks: DataFrame) -> DataFrame:
    """Whether each checkpoint (last_height, last_hash) is a canonical block at that height."""
    at = canonical(blocks).select(F.col("height").alias("last_height"), F.col("block_hash").alias("last_hash"), F.lit(1).alias("hit"))
    return checkpoint.join(at, ["last_height", "last_hash"], "left").groupBy("last_height", "last_hash").agg((F.count("hit") == 1).alias("ok"))


def sampled_hashes(blocks: DataFrame, step: int) -> DataFrame:
    """Every step-th canonical block by its place in the order of heights, and the tip.

    A block's place is its rank in its bucket of heights plus the number of blocks in buckets before, so no window holds
    the whole table; the table of buckets has a row for 65,536 heights.
    """
    chain = canonical(blocks).select("height", "block_hash").withColumn("bucket", F.floor(F.col("height") / 65536))
    sizes = chain.groupBy("bucket").agg(F.count("*").alias("n"), F.max("height").alias("hi"))
    before = sizes.withColumns({
        "before": F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "tip": F.max("hi").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("height")) - 1
    placed = chain.withColumn("rank", rank).join(before.select("bucket", "before", "tip"), "bucket").withColumn("row_offset", F.col("before") + F.col("rank"))
    return placed.where((F.col("row_offset") % step == 0) | (F.col("height") == F.col("tip"))).select("row_offset", "height", "block_hash")


def broken_links(blocks: DataFrame) -> DataFrame:
    """Blocks whose parent is not a stored block one height below (the first height has no parent here)."""
    parents = blocks.select(F.col("block_hash").alias("parent_hash"), (F.col("height") + 1).alias("height"), F.lit(True).alias("linked")).distinct()
    first = blocks.agg(F.min("height").alias("lowest"))
    return blocks.join(parents, ["parent_hash", "height"], "left").where("linked IS NULL").join(F.broadcast(first), F.col("height") > F.col("lowest")).select("height", "block_hash", "parent_hash")


def lag_parent_check(blocks: DataFrame) -> DataFrame:
    """Canonical blocks whose parent hash is not that of the next lower canonical block, also where heights between are missing.

    The block below is found within buckets of heights, and by each bucket's last block for the first one of the next bucket.
    """
    chain = canonical(blocks).withColumn("bucket", F.floor(F.col("height") / 65536))
    ends = chain.groupBy("bucket").agg(F.max_by("block_hash", "height").alias("last"))  # a row for 65,536 heights
    carried = ends.withColumn("carried", F.lag("last").over(Window.orderBy("bucket"))).select("bucket", "carried")
    inner = F.lag("block_hash").over(Window.partitionBy("bucket").orderBy("height"))
    lined = chain.withColumn("inner", inner).join(carried, "bucket").withColumn("below_hash", F.coalesce("inner", "carried"))
    return lined.where("parent_hash <> below_hash").select("height", "block_hash", "parent_hash", "below_hash")


def attached_logs(blocks: DataFrame, logs: DataFrame) -> DataFrame:
    """Each block with its logs, sorted, in an array; blocks without logs have an empty one.

    A log whose height is a block's but whose hash is none of the blocks' there is an error of the source and fails the query; one
    at a height without a block is left out.
    """
    order = F.struct("transaction_index", "log_index", "tx_hash", "address")
    grouped = logs.groupBy(F.col("block_number").alias("height"), "block_hash").agg(F.array_sort(F.collect_list(order)).alias("logs"))
    hashes = blocks.groupBy("height").agg(F.collect_set("block_hash").alias("hashes"))  # a height's forks
    wrong = F.raise_error(F.concat(F.lit("a log at height "), F.col("height"), F.lit(" names block "), F.col("block_hash"), F.lit(", which is not there")))
    grouped = grouped.join(hashes, "height").where(F.when(F.array_contains("hashes", F.col("block_hash")), True).otherwise(wrong.cast("boolean"))).drop("hashes")
    return blocks.join(grouped, ["height", "block_hash"], "left").withColumn("logs", F.coalesce("logs", F.array().cast(grouped.schema["logs"].dataType)))


def stray_logs(blocks: DataFrame, logs: DataFrame) -> DataFrame:
    """Logs at a height with blocks, of none of those blocks: what a node returns that has changed branches between two answers."""
    off = logs.join(blocks.select(F.col("height").alias("block_number"), "block_hash"), ["block_number", "block_hash"], "left_anti")
    return off.join(blocks.select(F.col("height").alias("block_number")), "block_number", "left_semi")


def normalised(logs: DataFrame, *more: str) -> DataFrame:
    """The six fields by which logs of two sources are compared, as prefixed hex; ``more`` columns stay as they are."""
    from forktide.functions.scalars import prefixed

    hexed = {c: prefixed(F.col(c)) for c in ("block_hash", "tx_hash", "address", "data")}
    topics = F.concat_ws(",", prefixed(F.col("topic0")), prefixed(F.col("topic1")))
    return logs.select(hexed["block_hash"].alias("block_hash"), hexed["tx_hash"].alias("tx_hash"), "log_index", hexed["address"].alias("address"), topics.alias("topics"), hexed["data"].alias("data"), *more)
