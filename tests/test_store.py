"""The snapshot store: replay, reorg of a reorg, conflicts, crashes before the rename, the live tracker."""

import datetime

import pytest
from pyspark.sql import functions as F

from forktide.operators.transition import Header, plan_transition, state_of
from forktide.plans.live import Tracker, startup_batch
from forktide.plans.snapshot import BLOCKS, LOGS, Store, StoreError
from forktide.streaming.journal import dispatch


def hx(v):
    return f"{v:02x}" * 32


def header(v, parent):
    return Header(hx(v), hx(parent), v % 10 if v >= 10 else v)


def rows(spark, headers):
    ts = datetime.datetime(2027, 1, 15)
    blocks = [(h.block_hash, h.parent_hash, h.height, ts, True, "unsafe", "observed") for h in headers]
    logs = [(h.height, h.block_hash, 0, 0, "aa" * 32, "bb" * 20, "cc" * 32, "dd" * 32, h.block_hash[:2], None, None, "ab" * 32, None) for h in headers]
    return spark.createDataFrame(blocks, BLOCKS), spark.createDataFrame(logs, LOGS)


class Memory:
    """A source of headers in memory."""

    def __init__(self, spark, headers):
        self.spark, self.all = spark, {h.block_hash: h for h in headers}
        self.tip = headers[-1]

    def head(self):
        return self.tip

    def header_by_hash(self, block_hash):
        return self.all.get(block_hash)

    def header_at(self, height):
        at = self.tip
        while at and at.height > height:
            at = self.all.get(at.parent_hash)
        return at if at and at.height == height else None

    def payload(self, headers):
        return rows(self.spark, headers)


MAIN = [header(0, 99), header(1, 0), header(2, 1), header(3, 2)]
FORK = [header(12, 1), header(13, 12)]


def advance(store, spark, head, known):
    at = store.checkpoint()
    from forktide.operators.transition import ChainState

    s = state_of(store.blocks(), at.height) if at else ChainState()
    batch = plan_transition(s, head, {h.block_hash: h for h in known}.get)
    store.commit(batch, *rows(spark, [e.header for e in batch.events if e.kind == "apply"]))
    return batch


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "store"))
    s.identify(1, hx(0))
    return s


def canonical(store):
    return [r["block_hash"][:2] for r in store.blocks().where("is_canonical").orderBy("height").collect()]


def test_reorg_replay_and_journal(spark, store):
    advance(store, spark, MAIN[0], MAIN)
    advance(store, spark, MAIN[3], MAIN)
    batch = advance(store, spark, FORK[1], [*MAIN, *FORK])
    assert canonical(store) == ["00", "01", "0c", "0d"] and store.blocks().count() == 6 and store.checkpoint() == FORK[1]
    kinds = [(r["event_id"], r["event_kind"], r["block_hash"][:2]) for r in store.journal().orderBy("event_id").collect()]
    assert kinds == [(1, "apply", "00"), (2, "apply", "01"), (3, "apply", "02"), (4, "apply", "03"), (5, "rollback", "03"), (6, "rollback", "02"), (7, "apply", "0c"), (8, "apply", "0d")]
    store.commit(batch, *rows(spark, FORK))  # again: no flag flips, so no row
    assert store.journal().count() == 8 and canonical(store) == ["00", "01", "0c", "0d"]
    with pytest.raises(StoreError):
        store.identify(1, hx(5))
    with pytest.raises(StoreError):
        store.commit(batch, *rows(spark, FORK[:1]))


def test_a_crash_before_the_rename_leaves_the_old_state(spark, store):
    advance(store, spark, MAIN[0], MAIN)
    before = store.manifest()
    batch = plan_transition(state_of(store.blocks(), 0), MAIN[1], lambda _: None)

    def die():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        store.commit(batch, *rows(spark, [MAIN[1]]), before_publish=die)
    assert store.manifest() == before and canonical(store) == ["00"]
    store.commit(batch, *rows(spark, [MAIN[1]]))
    assert canonical(store) == ["00", "01"] and store.journal().count() == 2


def test_redecode_and_publish_marks(spark, store, tmp_path):
    advance(store, spark, MAIN[0], MAIN)
    advance(store, spark, MAIN[3], MAIN)
    decoded = store.logs().select("block_hash", "log_index", F.when(F.col("block_number") > 1, '{"v":1}').alias("decoded_event"), F.when(F.col("block_number") > 1, "v1").alias("decoder_version"))
    assert store.redecode(decoded) == 2 and store.redecode(decoded) == 0 and store.journal().count() == 4
    out = []
    store.journal().write.parquet(str(tmp_path / "j"))
    stream = spark.readStream.schema(store.journal().schema).parquet(str(tmp_path / "j"))
    stream = stream.select("event_id", "event_kind", F.col("height").alias("block_height"), "payload", "created_at", "published_at")
    dispatch(stream, 1, lambda m: out.extend(m.collect()), store.mark_published, str(tmp_path / "c")).awaitTermination()
    assert [r["event_id"] for r in out] == [1, 2, 3, 4] and store.journal().where("published_at IS NULL").count() == 0


def test_tracker(spark, store):
    assert Tracker(store, Memory(spark, MAIN)).reconcile().state == "halted"
    report = Tracker(store, Memory(spark, MAIN), start=0).reconcile()
    assert report.state == "ready" and report.applied == [0, 1, 2, 3]
    assert Tracker(store, Memory(spark, MAIN[:3])).reconcile().state == "degraded"
    source = Memory(spark, [*MAIN, *FORK])
    halted = Tracker(store, source, max_depth=1).reconcile()
    assert halted.state == "unavailable" and canonical(store) == ["00", "01", "02", "03"]
    assert Tracker(store, source, finalized_depth=1).reconcile().state == "unavailable"
    report = Tracker(store, source, verifier=Memory(spark, MAIN)).reconcile()
    assert (report.rolled_back, report.applied, report.disagreements) == ([3, 2], [2, 3], 1) and canonical(store) == ["00", "01", "0c", "0d"]


def test_startup_batch(spark):
    from forktide.operators.transition import ChainState

    stored = ChainState({h.height: h for h in MAIN}, MAIN[3])
    longer = [*FORK, header(14, 13)]
    batch = startup_batch(stored, Memory(spark, [*MAIN[:2], *longer]), 10)
    assert [(e.kind, e.header.height) for e in batch.events] == [("rollback", 3), ("rollback", 2), ("apply", 2), ("apply", 3), ("apply", 4)]
    assert startup_batch(stored, Memory(spark, MAIN[:3]), 10).label == "duplicate"
