"""Errors that must not pass in silence: logs of another branch, plans without an ancestor, replays, pushed addresses, wide gaps."""

import pytest
from test_rpc import A, B, node  # noqa: F401
from test_store import FORK, MAIN, advance, canonical, header, rows, store  # noqa: F401

from forktide.operators import canonical as can
from forktide.operators import transition
from forktide.operators.transition import Batch, Event
from forktide.plans.ranges import BackfillError, Retry
from forktide.plans.snapshot import LOGS, StoreError
from forktide.sources import rpc

BLOCK = "height long, block_hash string, parent_hash string, is_canonical boolean"


def test_logs_of_another_branch_fail(spark):
    blocks = spark.createDataFrame([(1, "a", "0", True), (1, "a2", "0", False), (2, "b", "a", True)], BLOCK)
    schema = "block_number long, block_hash string, transaction_index int, log_index int, tx_hash string, address string"
    good = [(1, "a", 0, 1, "t", "x"), (1, "a", 0, 0, "t", "x"), (1, "a2", 0, 0, "t", "x"), (9, "z", 0, 0, "t", "x")]
    out = {r["block_hash"]: [x["log_index"] for x in r["logs"]] for r in can.attached_logs(blocks, spark.createDataFrame(good, schema)).collect()}
    assert out == {"a": [0, 1], "a2": [0], "b": []}
    with pytest.raises(Exception, match="names block c"):
        can.attached_logs(blocks, spark.createDataFrame([*good, (2, "c", 0, 0, "t", "x")], schema)).collect()


def test_a_plan_needs_an_ancestor_within_the_depth(spark):
    main = [(h, f"m{h}", f"m{h - 1}", True) for h in range(8)]
    side = [(h, f"s{h}", f"s{h - 1}" if h > 4 else "m3", False) for h in range(4, 9)]
    blocks = spark.createDataFrame([*main, *side, (20, "lone", "nobody", False)], BLOCK)
    plan = [(r["event_kind"], r["height"]) for r in transition.reorg_plan(spark, blocks, "s8", 7).orderBy("seq").collect()]
    assert plan == [("rollback", h) for h in (7, 6, 5, 4)] + [("apply", h) for h in (4, 5, 6, 7, 8)]
    for head, depth, words in (("lone", 2048, "no canonical ancestor"), ("s8", 4, "no canonical ancestor"), ("unknown' OR 'a' = 'a", 2048, "no canonical ancestor")):
        with pytest.raises(Exception, match=words):
            transition.reorg_plan(spark, blocks, head, 7, depth).collect()
    short = spark.createDataFrame([*main, (4, "s4", "m3", False)], BLOCK)
    with pytest.raises(Exception, match="roll back"):
        transition.reorg_plan(spark, short, "s4", 7, 3).collect()


def test_a_replay_changes_nothing(spark, store):  # noqa: F811
    batches = [advance(store, spark, MAIN[0], MAIN), advance(store, spark, MAIN[2], MAIN), advance(store, spark, MAIN[3], MAIN)]
    before = store.manifest()
    for b in batches:
        store.commit(b, *rows(spark, [e.header for e in b.events]))
        assert store.manifest() == before and store.checkpoint() == MAIN[3]
    for batch in (Batch("extend", FORK[0], (Event("apply", FORK[1]),)), Batch("bootstrap", None, (Event("apply", header(5, 4)),))):
        with pytest.raises(StoreError, match="ancestor"):
            store.commit(batch, *rows(spark, [batch.events[0].header]))
    assert canonical(store) == ["00", "01", "02", "03"]


@pytest.mark.parametrize("change", [{"tx_hash": "aa"}, {"address": "bb" * 19}, {"topic0": "cc"}, {"topic0": None}, {"log_index": -1}, {"data": "abc"}, {"decoded_event": "{}"}])
def test_logs_out_of_their_domain(spark, store, change):  # noqa: F811
    blocks, logs = rows(spark, MAIN[:1])
    bad = spark.createDataFrame([r.asDict() | change for r in logs.collect()], LOGS)
    with pytest.raises(StoreError, match="out of its domain"):
        store.commit(Batch("bootstrap", None, (Event("apply", MAIN[0]),)), blocks, bad)
    assert store.checkpoint() is None


def test_an_address_is_a_hint_only(spark, node):  # noqa: F811
    rpc.register(spark)
    logs = spark.read.format("evm_logs").options(url=node.url, span=4)
    assert logs.load().where(f"address = '{A.upper()}'").count() == 0
    assert logs.options(address=A).load().where(f"address = '{B}'").count() == 0
    assert logs.options(address=A).load().where(f"address = '{A}'").count() == 10


def test_blocks_and_logs_by_hash(spark, node):  # noqa: F811
    rpc.register(spark)
    fifth = f"{6:064x}"
    node.asked.clear()
    found = spark.read.format("evm_logs").options(url=node.url).load().where(f"block_hash = '{fifth}'").collect()
    assert [(r["block_number"], r["log_index"]) for r in found] == [(5, 0), (5, 1)] and node.asked == [{"blockHash": "0x" + fifth}]
    assert spark.read.format("evm_logs").options(url=node.url, low=6).load().where(f"block_hash = '{fifth}'").count() == 0
    assert [r["height"] for r in spark.read.format("evm_blocks").options(url=node.url).load().where(f"block_hash = '{fifth}'").collect()] == [5]
    assert spark.read.format("evm_blocks").options(url=node.url).load().where(f"block_hash = '{'f' * 64}'").count() == 0
    head, logs = rpc.Client(node.url).block_with_logs(fifth)
    assert head.height == 5 and [r[3] for r in logs] == [0, 1] and rpc.Client(node.url).block_with_logs("f" * 64) is None


def test_a_wide_gap_is_cut_into_steps(spark):
    blocks = spark.createDataFrame([(h, "x", "y", True) for h in (0, 200_001, 200_003)], BLOCK)
    gone = can.missing_heights(blocks)
    assert gone.count() == gone.distinct().count() == 200_001 and gone.agg({"height": "sum"}).first()[0] == sum(range(1, 200_001)) + 200_002


def test_waits_double_up_to_a_cap_and_part_askers():
    r = Retry(9, 1.0, 16.0)
    for who in ("a", "b"):
        waits = [r.delay("transient", n, who=who) for n in range(1, 9)]
        assert all(top / 2 <= w <= top for w, top in zip(waits, (1, 2, 4, 8, 16, 16, 16, 16))) and waits == [r.delay("transient", n, who=who) for n in range(1, 9)]
    assert len({r.delay("transient", 3, who=str(i)) for i in range(50)}) == 50
    assert r.delay("transient", 9) is None and r.delay("permanent", 1) is None and r.delay("provider_limit", 1) is None
    assert r.delay("rate_limited", 1, 5.0) == 5.0 and r.delay("rate_limited", 1, 99.0) == 16.0
    with pytest.raises(BackfillError):
        Retry(0)


def test_dispatch_is_ordered_over_files_and_stops_at_the_first_error(spark, store, tmp_path):  # noqa: F811
    from forktide.operators.journal import messages
    from forktide.streaming.journal import dispatch_ordered, drain

    for h in MAIN:
        advance(store, spark, h, MAIN)
    pending = lambda: store.journal().withColumnRenamed("height", "block_height")
    out, fail = [], [1]

    def sink(m):
        got = [r["event_id"] for r in m.collect()]
        if 3 in got and fail:
            fail.pop()
            raise OSError("the broker is gone")
        out.extend(got)

    with pytest.raises(OSError):
        drain(pending, 1, sink, store.mark_published, rows=1)
    assert out == [1, 2] and [r["event_id"] for r in store.journal().where("published_at IS NULL").orderBy("event_id").collect()] == [3, 4]
    spark.range(3).repartition(3).write.parquet(str(tmp_path / "wake"))
    wake = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "wake"))
    dispatch_ordered(wake, pending, 1, sink, store.mark_published, str(tmp_path / "c"), rows=3).awaitTermination()
    assert out == [1, 2, 3, 4] and drain(pending, 1, sink, store.mark_published) == 0
    headers = messages(pending(), 1).where("event_id = 2").first()["headers"]
    assert [(h["key"], bytes(h["value"])) for h in headers] == [("event_id", b"2"), ("schema_version", b"1")]


def test_deliveries_are_checked(spark):
    from forktide.streaming.journal import deliveries

    good = '{"event_id": 3, "transition_kind": "apply", "block_height": 9, "payload": "{}"}'
    rows = deliveries(spark.createDataFrame([(good,), ("",), (None,), ("  ",)], "value string")).collect()
    assert [tuple(r) for r in rows] == [(3, "apply", 9, "{}")]
    for bad in ("no json", '{"transition_kind": "apply"}'):
        with pytest.raises(Exception, match="without an event id"):
            deliveries(spark.createDataFrame([(good,), (bad,)], "value string")).collect()


def test_another_schema_is_refused(spark, store, monkeypatch):  # noqa: F811
    from forktide.plans import manifest

    advance(store, spark, MAIN[0], MAIN)
    monkeypatch.setattr(manifest, "SCHEMA_VERSION", 3)
    with pytest.raises(StoreError, match="schema"):
        store.checkpoint()
