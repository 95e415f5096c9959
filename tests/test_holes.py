"""Links and runs above missing heights and ids, also at the ends of buckets."""

from forktide.operators import canonical, journal


def test_a_broken_link_above_a_hole_is_found(spark):
    heights = [0, 1, 3, 4, 65530, 65540, 200000, 200001]
    bad = {3, 65540, 200001}
    rows, below = [], "none"
    for h in heights:
        rows.append((h, f"b{h}", "x" if h in bad else below, True))
        below = f"b{h}"
    blocks = spark.createDataFrame(rows, "height long, block_hash string, parent_hash string, is_canonical boolean")
    got = {(r["height"], r["below_hash"]) for r in canonical.lag_parent_check(blocks).collect()}
    assert got == {(3, "b1"), (65540, "b65530"), (200001, "b200000")}


def test_runs_go_on_over_missing_ids(spark):
    ids = [(0, "apply"), (2, "rollback"), (5, "rollback"), (65535, "rollback"), (65540, "rollback"), (65541, "apply"), (200000, "apply"), (200005, "rollback"), (200006, "apply"), (300000, "rollback"), (300009, "rollback")]
    outbox = spark.createDataFrame(ids, "event_id long, event_kind string")
    got = {tuple(r) for r in journal.reorg_runs(outbox).select("first_id", "n_rollback", "n_apply", "depth").collect()}
    assert got == {(2, 4, 2, 4), (200005, 1, 1, 1), (300000, 2, 0, 2)}
