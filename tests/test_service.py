"""Dispatch by position, dedup with bounded state, budgets that hold, fetching without a barrier, a live run that survives, the command line."""

import json
import random
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from test_backfill import QUICK, Chain, heights, live
from test_rpc import A, block
from test_store import MAIN, advance, store  # noqa: F401

from forktide import __main__ as cli
from forktide.plans.backfill import Backfill
from forktide.plans.config import ConfigError, load
from forktide.plans.ranges import BackfillError, BlockRange, LifetimeBudget, RangeSizer, SharedBudget
from forktide.plans.runner import RpcSource
from forktide.plans.snapshot import Store, StoreError
from forktide.plans.status import QueryMetrics, Series
from forktide.sources import rpc
from forktide.streaming.dispatch import Dispatcher, FolderJournal, StoreJournal, deduplicated_bounded, dispatched_once, first_seen
from forktide.streaming.journal import broker_options

COST = {"eth_getLogs": 5}


class Counting(Chain):
    """A node of many threads that notes when it was asked for how many units, can wait before it answers and refuse wide batches as one object."""

    def __init__(self, head=99):
        super().__init__(head)
        self.server.shutdown()
        self.units, self.before, self.asked_from, self.lock = [], {}, set(), threading.Lock()
        self.refuse_wide, self.down = None, False
        outer = self

        class Handler(BaseHTTPRequestHandler):
            def do_POST(self):
                calls = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                with outer.lock:
                    outer.units.append((time.monotonic(), sum(COST.get(c["method"], 1) for c in calls)))
                    failing = outer.fail > 0
                    outer.fail -= failing
                if outer.down or failing:
                    self.send_error(503)
                    return
                numbers = [int(c["params"][0], 16) for c in calls if c["method"] == "eth_getBlockByNumber" and c["params"][0] != "latest"]
                if numbers:
                    outer.asked_from.add(numbers[0])
                    outer.before.pop(numbers[0], lambda: None)()
                if outer.refuse_wide and len(calls) > outer.refuse_wide:
                    body = json.dumps({"jsonrpc": "2.0", "id": None, "error": {"code": -32005, "message": "block range limit exceeded"}})
                else:
                    body = json.dumps([{"id": c["id"], "result": outer.answer(c["method"], c["params"])} for c in calls])
                self.send_response(200)
                self.end_headers()
                self.wfile.write(body.encode())

            def log_message(self, *_):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_port}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def until_asked(self, heights):
        """Wait until batches from these heights have been asked for."""
        until = time.monotonic() + 90
        while not set(heights) <= self.asked_from and time.monotonic() < until:
            time.sleep(0.05)

    def busiest(self, window):
        """The most units in any span of a window."""
        return max(sum(n for t, n in self.units if begin <= t < begin + window) for begin, _ in self.units)


@pytest.fixture
def many():
    n = Counting()
    yield n
    n.server.shutdown()


@pytest.fixture
def empty(spark, tmp_path):
    rpc.register(spark)
    return Store(spark, str(tmp_path / "other"))


def test_a_backfill_never_sends_more_than_a_window_holds(empty, many):
    many.fail = 2  # attempts that fail are paid too
    budget = SharedBudget(60, 1.5)
    report = Backfill(empty, many.url, 0, 79, workers=32, sizer=RangeSizer(5, 1, 5), retry=QUICK, budget=budget).run()
    assert heights(empty) == list(range(80)) and many.busiest(1.5) <= 60
    assert report.cost == sum(n for _, n in many.units) == budget.lifetime.cost and budget.out == 0 and report.cost > 80 + 16 * 5


def test_live_catch_up_pays_for_each_request(spark, empty, many):
    many.head = 12
    budget = SharedBudget(30, 1.0)
    from forktide.plans.live import Tracker
    from forktide.plans.runner import Live

    run = Live(Tracker(empty, RpcSource(empty, rpc.Client(many.url, retry=QUICK, budget=budget)), start=0))
    assert run.step().applied == list(range(13)) and many.busiest(1.0) <= 30 and budget.lifetime.cost == sum(n for _, n in many.units) > 13 * 7


def test_leases():
    now = [0.0]
    b = SharedBudget(100, 10.0, LifetimeBudget(max_cost=250), clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    one, two = b.try_lease(60), b.try_lease(40)
    assert one and two and b.try_lease(1) is None
    b.give_back(one, 3, 10)
    assert b.try_lease(60) is None and (three := b.try_lease(50))
    now[0] = 9.9
    b.give_back(two, 1, 40)
    b.give_back(three, 1, 50)
    now[0] = 10.1
    assert b.try_lease(20) is None and b.try_lease(10) is not None  # what came back at 9.9 counts until 19.9
    b.out = 0
    b.spend(1, 30)
    assert now[0] >= 19.9 and b.lifetime.cost == 130
    with pytest.raises(BackfillError, match="more than a window"):
        b.try_lease(101)
    with pytest.raises(BackfillError, match="spent"):
        now[0] += 100
        b.spend(1, 100)
        b.try_lease(50)


def test_a_slow_range_delays_no_other_fetch(empty, many):
    others, seen = [h for h in range(0, 100, 5) if h != 20], []
    many.before = {20: lambda: (many.until_asked(others), seen.append(set(others) <= many.asked_from))}
    report = Backfill(empty, many.url, 0, 99, workers=4, sizer=RangeSizer(5, 5, 5), retry=QUICK).run()
    assert seen == [True] and report.ranges == 20 and heights(empty) == list(range(100))
    assert not [n for n in empty.files.names(empty.path) if n.startswith("staging")]


def test_a_batch_refused_as_one_object_comes_again_in_halves(empty, many):
    many.refuse_wide = 6
    report = Backfill(empty, many.url, 0, 30, workers=3, sizer=RangeSizer(16, 1, 16), retry=QUICK).run()
    assert heights(empty) == list(range(31)) and report.refused >= 2
    with pytest.raises(rpc.RpcError, match="limit exceeded"):
        rpc.Client(many.url, retry=QUICK).blocks(0, 9)


def test_a_chain_that_changes_amid_a_backfill(empty, many):
    """Ranges above were fetched from the old branch, the one below from the new: what does not follow is fetched again."""
    many.before = {20: lambda: (many.until_asked([30, 40, 50, 60]), time.sleep(0.5), setattr(many, "fork", 25))}
    report = Backfill(empty, many.url, 0, 60, workers=6, sizer=RangeSizer(10, 10, 10), retry=QUICK).run()
    assert heights(empty) == list(range(61)) and report.refetched == 1 and empty.checkpoint().block_hash == many.block(60)["hash"][2:]


def test_a_live_run_survives_node_and_verifier(spark, empty, many, tmp_path):
    other = Counting(8)
    many.head = 3
    run = live(empty, many, verifier=RpcSource(empty, rpc.Client(other.url, retry=QUICK)))
    run.series = Series(spark, str(tmp_path / "series"), flush=4)
    assert run.step().state == "ready" and run.health.ok
    other.down = True
    many.head = 5
    for _ in range(3):
        report = run.step()  # a verifier that is down is a disagreement, and commits go on
        assert report.state == "ready" and report.disagreements == 1 and run.health.state == "degraded"
    assert heights(empty) == list(range(6))
    many.down = True
    for _ in range(5):
        assert run.step().state == "degraded" and not run.health.stopped
    many.down = other.down = False
    many.head = 6
    assert run.step().state == "ready" and run.health.ok and heights(empty) == list(range(7))
    with empty.lease():  # another writer at work
        empty.patience, many.head = 0.1, 7
        assert run.step().state == "degraded" and not run.health.stopped
    assert run.step().state == "ready" and run.health.ok
    rows = run.series.frame().orderBy("at").collect()
    assert [r["state"] for r in rows] == ["ready"] * 4 + ["degraded"] * 5 + ["ready", "degraded", "ready"] and rows[-1]["checkpoint_height"] == 7 and rows[5]["reason"]
    other.server.shutdown()


def test_an_error_while_noting_does_not_leave_the_step(empty, many, monkeypatch):
    many.head = 2
    run = live(empty, many)
    real, calls = RpcSource.head, []

    def head(self):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("gone")
        return real(self)

    monkeypatch.setattr(RpcSource, "head", head)
    assert run.step().state == "degraded" and run.health.state == "degraded" and heights(empty) == [0, 1, 2]
    assert run.step().state == "ready"


def test_streaming_queries_are_in_the_series(spark, tmp_path):
    series = Series(spark, str(tmp_path / "series"))
    listener = QueryMetrics(series)
    spark.streams.addListener(listener)
    try:
        spark.range(10).write.parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        stream.writeStream.foreachBatch(lambda df, _: df.count() and None).trigger(availableNow=True).queryName("good").start().awaitTermination()
        with pytest.raises(Exception, match="spoiled"):
            stream.writeStream.foreachBatch(lambda df, _: (_ for _ in ()).throw(ValueError("spoiled"))).trigger(availableNow=True).queryName("bad").start().awaitTermination()
        for _ in range(100):
            if sum(r.get("kind") == "ended" for r in series.rows) + series.frame().where("kind = 'ended'").count() >= 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    rows = series.frame().collect()
    assert {r["kind"] for r in rows} == {"started", "progress", "ended"} and sum(r["input_rows"] or 0 for r in rows if r["kind"] == "progress" and r["name"] == "good") == 10
    assert [r["state"] for r in rows if r["kind"] == "ended"].count("unavailable") == 1


def test_each_segment_of_a_journal_is_read_once(spark, store):  # noqa: F811
    for h in MAIN:
        advance(store, spark, h, MAIN)
    out, fail = [], [1]

    def sink(part):
        got = [r["event_id"] for r in part.collect()]
        if 3 in got and fail:
            fail.pop()
            raise OSError("the broker is gone")
        out.extend(got)

    d = Dispatcher(StoreJournal(store), 1, sink, ids=1)
    with pytest.raises(OSError):
        d.drain()
    assert out == [1, 2] and store.manifest().published_upto == 2
    assert d.drain() == 2 and out == [1, 2, 3, 4] and d.read == [(1, 1), (2, 2), (3, 3), (3, 3), (4, 4)] and d.step() is None
    assert store.journal().where("published_at IS NULL").isEmpty()


def test_a_dispatch_ends_at_an_error_and_goes_on_with_the_same_id(spark, store, tmp_path):  # noqa: F811
    for h in MAIN:
        advance(store, spark, h, MAIN)
    out = []

    def sink(part):
        if len(out) == 2:
            out.append(None)
            raise OSError("the broker is gone")
        out.extend((r["event_id"], r["key"], bytes(r["headers"][0]["value"])) for r in part.collect())

    d = Dispatcher(StoreJournal(store), 1, sink, ids=2)
    with pytest.raises(Exception, match="broker is gone"):
        d.stream(spark, 0.1, str(tmp_path / "c")).awaitTermination(60)
    query = d.stream(spark, 0.1, str(tmp_path / "c2"))
    for _ in range(200):
        if store.manifest().published_upto == 4:
            break
        time.sleep(0.1)
    query.stop()
    assert [x for x in out if x] == [(i, "chain:1", str(i).encode()) for i in (1, 2, 3, 4)]


def test_a_folder_of_segments_in_any_order(spark, tmp_path):
    rows = [(i, "apply", i, None if i % 3 else "2027-01-01", "{}") for i in range(40)]
    random.Random(1).shuffle(rows)
    journal = spark.createDataFrame(rows, "event_id long, event_kind string, block_height long, published_at string, payload string")
    j, out = FolderJournal.staged(journal.repartition(5), str(tmp_path / "j"), 8), []
    d = Dispatcher(j, 5, lambda part: out.extend(r["event_id"] for r in part.collect()), ids=16)
    assert d.drain() == 3 and out == [i for i in range(40) if i % 3] and d.read == [(8 * i, 8 * i + 7) for i in range(5)]
    assert FolderJournal(spark, j.path, j.schema, 8).waiting() == []


def test_a_part_of_a_dispatch_takes_many_ids(spark, tmp_path):
    journal = spark.range(300_000).selectExpr("id AS event_id", "'apply' AS event_kind", "id AS block_height", "CASE WHEN id % 100 > 0 THEN '2027-01-01' END AS published_at", "'{}' AS payload")
    out = dispatched_once(spark, journal, str(tmp_path)).select("event_id", "in_order").collect()
    assert sorted(r["event_id"] for r in out) == list(range(0, 300_000, 100)) and all(r["in_order"] for r in out)
    assert spark.read.parquet(str(tmp_path / "published")).select("part").distinct().count() == 1
    again = dispatched_once(spark, journal, str(tmp_path / "small"), span=1 << 13, ids=1 << 15).collect()
    assert len(again) == 3000 and all(r["in_order"] for r in again)
    assert spark.read.parquet(str(tmp_path / "small" / "published")).select("part").distinct().count() == 10


def test_the_state_of_a_dedup_does_not_grow(spark, tmp_path):
    upto, beyond, seen, rnd = -1, [], [], random.Random(3)
    ids = list(range(20_000))
    order = [i for low in range(0, 20_000, 50) for i in rnd.sample(ids[low : low + 50], 50) + rnd.choices(ids[: low + 50], k=20)]
    most = 0
    for at in range(0, len(order), 97):
        new, upto, beyond = first_seen(upto, beyond, order[at : at + 97])
        seen += new
        most = max(most, len(beyond))
    assert sorted(seen) == ids and upto == 19_999 and beyond == [] and most < 60
    rows = [(i, f"p{i}") for i in [*range(5, 300), *range(200, 400), 7, 7, 900, 905, 900]]
    spark.createDataFrame(rows, "event_id long, payload string").repartition(6).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("event_id long, payload string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    done = deduplicated_bounded(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    done.awaitTermination()
    got = sorted((r["event_id"], r["payload"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted({(i, f"p{i}") for i, _ in rows})


def test_a_dedup_of_many_single_ids_takes_no_square_of_them():
    ids, upto, beyond, seen = list(range(0, 420_000, 7)), -1, [], []
    random.Random(2).shuffle(ids)
    began = time.perf_counter()
    for at in range(0, 60_000, 10_000):
        new, upto, beyond = first_seen(upto, beyond, ids[at : at + 10_000])
        seen += new
    assert sorted(seen) == sorted(ids) and upto == 0 and beyond == [x for i in sorted(ids)[1:] for x in (i, i)]
    new, upto, beyond = first_seen(upto, beyond, [*range(420_000), *ids])
    assert new == [i for i in range(420_000) if i % 7] and (upto, beyond) == (419_999, []) and first_seen(upto, [], []) == ([], upto, [])
    assert time.perf_counter() - began < 5


def test_settings_of_the_broker(tmp_path):
    options = broker_options("a:1,b:2", "t", 12.0)
    assert options["kafka.delivery.timeout.ms"] == "12000" and int(options["kafka.request.timeout.ms"]) < 12000 and options["kafka.acks"] == "all"
    for bad in ({"broker": {"topic": " "}}, {"broker": {"servers": "a:1,,"}}, {"broker": {"poll_seconds": 0.0}}):
        with pytest.raises(ConfigError):
            load(overrides=bad, env={})


def test_the_command_line(spark, many, tmp_path, capsys):
    many.head = 25
    (tmp_path / "c.toml").write_text(f'chain_id = 5\nstore = "{tmp_path / "s"}"\n[rpc]\nurl = "{many.url}"\n[[contracts]]\naddress = "0x{A}"\nstandard = "ERC-20"\n[indexer]\npoll_seconds = 0.05\n')

    def run(*args, code=0):
        assert cli.main(["--config", str(tmp_path / "c.toml"), *args]) == code
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    assert run("head")["height"] == 25
    report = run("backfill", "--from-block", "0", "--to-block", "20", "--verify-url", many.url, "--workers", "2")
    assert report["blocks"] == 21 and report["contiguous"] and (report["only_here"], report["only_there"]) == (0, 0)
    assert run("live", "--steps", "2", "--series", str(tmp_path / "m"))["checkpoint_height"] == 25
    assert run("check", "--step", "7") == {"missing": 0, "first_missing": "", "checked": 5, "different": [], "n_different": 0}
    assert run("redecode")["changed"] == 0 and run("status")["waiting_at_most"] == 26
    assert run("dispatch", "--once", "--folder", str(tmp_path / "out"))["parts"] >= 1 and run("status")["published_upto"] == 26
    ids = [r["event_id"] for r in spark.read.json(str(tmp_path / "out")).collect()]
    assert sorted(ids) == list(range(1, 27)) and run("compact") is not None and run("vacuum") == {"removed": []}
    many.fork = 20
    assert run("check", "--step", "7", code=1)["different"] == [21, 25]
    assert "servers" in run("dispatch", code=1)["error"]


def test_a_store_of_the_first_schema_is_refused(spark, tmp_path):
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "manifest.json").write_text('{"version": 3, "schema_version": 1}')
    with pytest.raises(StoreError, match="schema 1"):
        Store(spark, str(tmp_path / "old")).checkpoint()
    assert BlockRange(0, 3) and block(1)
