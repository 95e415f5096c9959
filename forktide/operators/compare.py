"""Comparisons of two sources: headers, logs as multisets, events with their payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def header_mismatches(a: DataFrame, b: DataFrame) -> DataFrame:
    """Heights where both have a canonical block with different hashes."""
    left = a.where("is_canonical").select("height", F.col("block_hash").alias("hash_a"))
    right = b.where("is_canonical").select("height", F.col("block_hash").alias("hash_b"))
    return left.join(right, "height").where("hash_a <> hash_b")


def common_ancestor(stored: DataFrame, source: DataFrame, max_depth: int) -> DataFrame:
    """The highest height where the whole header is equal, with how many stored heights lie above it.

    ``ok`` is false if a stored height above has no counterpart, or more than max_depth differ.
    """
    left = stored.where("is_canonical").select("height", "block_hash", "parent_hash")
    right = source.where("is_canonical").select("height", F.col("block_hash").alias("h"), F.col("parent_hash").alias("p"))
    both = left.join(right, "height", "left").withColumn("same", (F.col("block_hash") == F.col("h")) & (F.col("parent_hash") == F.col("p")))
    found = both.agg(
        F.max(F.when(F.col("same"), F.col("height"))).alias("ancestor_height"), F.max("height").alias("top"),
        F.max(F.when(F.col("h").isNull(), F.col("height"))).alias("absent"),
    )
    depth = F.col("top") - F.col("ancestor_height")
    return found.select("ancestor_height", depth.alias("depth"), (F.col("ancestor_height").isNotNull() & (depth <= max_depth) & (F.coalesce("absent", F.lit(-1)) <= F.col("ancestor_height"))).alias("ok"))


def row_digest(columns: list[str]) -> list[Column]:
    """Two hashes of 64 bits of a row.  A hash passes over nulls, so where they stand is hashed too."""
    values = [*columns, *(F.isnull(c) for c in columns)]
    return [F.xxhash64(*values), F.xxhash64(F.lit("second"), *values)]


def multiset_difference(a: DataFrame, b: DataFrame, place: str | None = None) -> DataFrame:
    """Rows of a that b lacks and of b that a lacks, counted with repetition; equal if both are 0.

    Rows are told apart by digests of 128 bits, so texts are not shuffled; of ``place``, a column such as the height, by its value: sources that are partitioned by it stay where they are.
    """
    near = [place] if place else []
    h1, h2 = row_digest(a.columns)
    sides = (x.select(*near, h1.alias("_h1"), h2.alias("_h2"), F.lit(n).alias("_d")) for x, n in ((a, 1), (b.select(*a.columns), -1)))
    counted = next(sides).unionAll(next(sides)).groupBy(*near, "_h1", "_h2").agg(F.sum("_d").alias("d"))
    out = counted.agg(F.coalesce(F.sum(F.greatest("d", F.lit(0))), F.lit(0)).alias("only_a"), F.coalesce(F.sum(F.greatest(-F.col("d"), F.lit(0))), F.lit(0)).alias("only_b"))
    return out.withColumn("equal", (F.col("only_a") == 0) & (F.col("only_b") == 0))


def payload_mismatches(events: DataFrame, payloads: DataFrame) -> DataFrame:
    """Events without a payload (missing) and payloads without an event (surplus), by block hash."""
    e, p = events.select("block_hash", F.lit(1).alias("e")), payloads.select("block_hash", F.lit(1).alias("p"))
    both = e.join(p, "block_hash", "full").where("e IS NULL OR p IS NULL")
    return both.select("block_hash", F.when(F.col("p").isNull(), "missing").otherwise("surplus").alias("problem"))


def differing_buckets(a: DataFrame, b: DataFrame, span: int, height: str, columns: list[str]) -> DataFrame:
    """Buckets of ``span`` heights whose rows are not the same multiset.  Only digests are shuffled.

    Of each bucket, in any order: how many rows, and sums of two hashes of 64 bits in halves, which do not overflow; b's count below 0.
    """
    halves = [x for h in row_digest(columns) for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    bucket = F.floor(F.col(height) / span).alias("bucket")
    sides = (x.select(bucket, F.lit(n).cast("long").alias("n"), *((n * x).alias(f"h{i}") for i, x in enumerate(halves))) for x, n in ((a, 1), (b, -1)))
    names = ("n", "h0", "h1", "h2", "h3")
    more = next(sides).unionAll(next(sides)).groupBy("bucket").agg(*(F.sum(c).alias(c) for c in names))
    return more.where(" OR ".join(f"{c} <> 0" for c in names)).select("bucket")


#: Heights of a bucket: a row of digests for so many is little beside the rows, and wider ones would only be read before them.
SPANS = (64,)


def differences(a: DataFrame, b: DataFrame, height: str, columns: list[str], spans: tuple[int, ...] = SPANS) -> DataFrame:
    """The columns of rows that one side has more often than the other, with only_a and only_b, how often.

    The sides are compared by digests of buckets of heights, with several ``spans`` of wide buckets first; rows are compared in those that differ.
    Equal sources are read once and shuffle a row a bucket.
    """
    a, b = a.select(*columns), b.select(*columns)
    for span in spans:
        wrong = differing_buckets(a, b, span, height, columns)
        a, b = (x.withColumn("bucket", F.floor(F.col(height) / span)).join(wrong, "bucket", "left_semi").drop("bucket") for x in (a, b))
    both = a.withColumn("_side", F.lit(1)).unionAll(b.withColumn("_side", F.lit(-1)))
    more = both.groupBy(*columns).agg(F.sum("_side").alias("_more")).where("_more <> 0")
    return more.select(*columns, F.greatest("_more", F.lit(0)).alias("only_a"), F.greatest(-F.col("_more"), F.lit(0)).alias("only_b"))
