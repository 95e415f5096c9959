"""The first canonical ancestor of every orphan, by path doubling.

A block that is not canonical points to its parent; in each round a pointer to another such block is replaced by that block's own pointer, so
after k rounds pointers reach 2 ** k steps.  A fork of 2,048 blocks takes 12 joins of the orphans with themselves, whatever the
chain's length; canonical blocks are joined once at the beginning and once at the end.  Each round is a table, so plans stay small and a lost executor reads
it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .transition import MAX_DEPTH


def orphan_ancestors(blocks: DataFrame, keep: Callable[[DataFrame], DataFrame], max_depth: int = MAX_DEPTH) -> DataFrame:
    """block_hash, height, depth, ancestor_hash, ancestor_height of each orphan.

    depth is the number of steps.  The ancestor is null where the way leaves the stored blocks or is longer than max_depth.  A parent counts only at the height
    below.  keep writes a DataFrame as a table and reads it again.
    """
    orphans = blocks.where("NOT is_canonical").select("block_hash", "height", F.col("parent_hash").alias("to"), F.lit(1).cast("long").alias("steps"))
    at = keep(orphans)
    reach = 1
    while reach <= max_depth:
        other = at.select(F.col("block_hash").alias("to"), (F.col("height") + 1).alias("above"), F.col("to").alias("further"), F.col("steps").alias("more"))
        # the block that is pointed to stands ``steps`` below
        hop = at.withColumn("above", F.col("height") - F.col("steps") + 1).join(other, ["to", "above"], "left")
        after = keep(hop.select("block_hash", "height", F.coalesce("further", "to").alias("to"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("further").isNotNull().alias("moved")))
        at, reach = after.drop("moved"), 2 * reach
        if after.where("moved").isEmpty():
            break
    main = blocks.where("is_canonical").select(F.col("block_hash").alias("ancestor_hash"), F.col("height").alias("ancestor_height"))
    found = at.join(main, (F.col("to") == F.col("ancestor_hash")) & (F.col("ancestor_height") == F.col("height") - F.col("steps")) & (F.col("steps") <= max_depth), "left")
    return found.select("block_hash", "height", F.col("steps").alias("depth"), "ancestor_hash", "ancestor_height")
