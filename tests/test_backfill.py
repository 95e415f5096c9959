"""Backfill and live run against a local node."""

import pytest
from test_rpc import A, Node, block, log

from forktide.operators.transition import Header
from forktide.plans.backfill import Backfill
from forktide.plans.live import Tracker
from forktide.plans.ranges import BackfillError, LifetimeBudget, RangeSizer, Retry, SharedBudget
from forktide.plans.runner import Live, RpcSource, recent_disagreements
from forktide.plans.snapshot import Store
from forktide.sources import rpc

QUICK = Retry(3, 0.01, 0.02)


class Chain(Node):
    """A node that can refuse wide ranges, mix branches in logs, and switch to a fork."""

    def __init__(self, head=99):
        super().__init__()
        self.head, self.most, self.mixed, self.fork = head, None, 0, None

    def block(self, h):
        if self.fork is None or h < self.fork:
            return block(h)
        own = 1000 * (self.fork + 1)
        return block(h) | {"hash": f"0x{h + 1 + own:064x}", "parentHash": f"0x{(h + own if h > self.fork else h):064x}"}

    def by_hash(self, value):
        return next((b for b in map(self.block, range(self.head + 1)) if b["hash"] == value), None)

    def answer(self, method, params):
        if method == "eth_getBlockByNumber":
            h = self.head if params[0] == "latest" else int(params[0], 16)
            return self.block(h) if h <= self.head else None
        if method == "eth_getBlockByHash":
            return self.by_hash(params[0])
        if method != "eth_getLogs":
            return super().answer(method, params)
        q = params[0]
        self.asked.append(q)
        if "blockHash" in q:
            b = self.by_hash(q["blockHash"])
            low = high = int(b["number"], 16) if b else -1
        else:
            low, high = int(q["fromBlock"], 16), int(q["toBlock"], 16)
        rows = [log(h, 0, A) | {"blockHash": self.block(h)["hash"]} for h in range(max(0, low), high + 1) if h % 3 == 0]
        if self.mixed and rows:
            self.mixed -= 1
            rows[0] = rows[0] | {"blockHash": "0x" + "ee" * 32}
        return rows


@pytest.fixture
def node():
    n = Chain()
    yield n
    n.server.shutdown()


@pytest.fixture
def store(spark, tmp_path):
    rpc.register(spark)
    return Store(spark, str(tmp_path / "store"))


def heights(store):
    return [r["height"] for r in store.blocks().where("is_canonical").orderBy("height").collect()]


def test_backfill_in_order_with_a_second_node(spark, store, node):
    job = Backfill(store, node.url, 10, 75, workers=3, sizer=RangeSizer(8, 1, 16), retry=QUICK, budget=SharedBudget(1 << 60, lifetime=LifetimeBudget(500)))
    report = job.run()
    assert heights(store) == list(range(9, 76)) and store.checkpoint().height == 75
    assert (report.blocks, report.logs) == (66, 22) and report.requests == 1 + 66 + report.ranges and report.cost == 67 + 5 * report.ranges
    assert report.blocks_per_second > 0 and report.calls_per_1k_blocks == pytest.approx(1000 * report.requests / 66)
    other = Chain()
    job.verify(other.url, report)
    assert (report.only_here, report.only_there) == (0, 0)
    other.fork = 70
    job.verify(other.url, report)
    assert report.only_here == report.only_there == 2
    other.server.shutdown()
    again = Backfill(store, node.url, 10, 80, retry=QUICK).run()
    assert again.blocks == 5 and heights(store)[-1] == 80


def test_refused_ranges_come_again_in_halves(spark, store, node, monkeypatch):
    real = rpc.Client.logs

    def refusing(self, low, high, address=None):
        if high - low >= 5:
            self.requests += 1
            raise rpc.RpcError("query returned more than 10000 results")
        return real(self, low, high, address)

    import forktide.plans.backfill as module

    class Refusing(rpc.Client):
        logs = refusing

    monkeypatch.setattr(module, "Client", Refusing)
    report = Backfill(store, node.url, 0, 60, workers=4, sizer=RangeSizer(16, 1, 16), retry=QUICK).run()
    assert heights(store) == list(range(61)) and report.refused > 3 and report.blocks == 61
    with pytest.raises(BackfillError, match="refuses"):
        Backfill(store, node.url, 0, 90, workers=2, sizer=RangeSizer(16, 8, 16), retry=QUICK).run()


def test_logs_of_another_branch_are_fetched_once_more(spark, store, node):
    node.mixed = 1
    assert Backfill(store, node.url, 0, 9, retry=QUICK).run().blocks == 10
    node.mixed = 2
    with pytest.raises(Exception, match="belong"):
        Backfill(store, node.url, 0, 19, retry=QUICK).run()
    assert store.checkpoint().height == 9


def test_budgets_hold(spark, store, node):
    with pytest.raises(BackfillError, match="budget"):
        Backfill(store, node.url, 0, 50, retry=QUICK, budget=SharedBudget(1200, lifetime=LifetimeBudget(max_requests=20))).run()
    client = rpc.Client(node.url, retry=QUICK, lifetime=LifetimeBudget(max_cost=6))
    client.logs(0, 3)
    assert (client.requests, client.cost) == (1, 5)
    with pytest.raises(BackfillError):
        client.blocks(0, 1)


def test_a_chain_that_does_not_follow_the_store_is_an_error(spark, store, node):
    Backfill(store, node.url, 0, 20, retry=QUICK).run()
    node.fork = 15
    with pytest.raises(BackfillError, match="do not follow"):
        Backfill(store, node.url, 0, 30, retry=QUICK).run()
    assert heights(store) == list(range(21))


def live(store, node, **more):
    return Live(Tracker(store, RpcSource(store, rpc.Client(node.url, retry=QUICK)), start=0, **more))


def test_live_run_follows_a_fork(spark, store, node):
    node.head = 3
    run = live(store, node)
    assert run.step().applied == [0, 1, 2, 3] and run.health.ok and run.status.lag == 0
    node.head, node.fork = 5, 3
    report = run.step()
    assert (report.rolled_back, report.applied) == ([3], [3, 4, 5]) and (run.status.reorgs, run.status.reorg_depth) == (1, 3)
    assert store.logs().where("block_number = 3").count() == 2 and run.status.n_unpublished == store.journal().count() == 8
    node.fail = 9
    assert run.step().state == "degraded" and not run.health.ok
    node.fail = 0
    assert run.step().state == "ready" and run.health.ok


def test_start_brings_a_stored_chain_in_line(spark, store, node):
    Backfill(store, node.url, 0, 12, retry=QUICK).run()
    node.head, node.fork = 14, 10
    run = live(store, node)
    run.start()
    assert heights(store) == list(range(15)) and store.checkpoint() == Header(f"{11015:064x}", f"{11014:064x}", 14)
    node.head, node.fork = 16, 5
    guarded = live(store, node, finalized_depth=4)
    assert guarded.step().state == "unavailable" and guarded.health.stopped and store.checkpoint().height == 14
    assert guarded.step().state == "unavailable"


def test_the_verifier_counts_committed_headers(spark, store, node):
    node.head = 8
    other = Chain(8)
    other.fork = 7
    verifier = RpcSource(store, rpc.Client(other.url, retry=QUICK))
    run = live(store, node, verifier=verifier)
    assert run.step().disagreements == 2 and run.status.disagreements == 2 and not run.health.ok
    assert recent_disagreements(store, verifier, 1) == 1
    other.fork = None
    assert run.step().disagreements == 0 and run.health.ok
    other.server.shutdown()


def test_the_trigger_steps_until_it_is_stopped(spark, store, node, tmp_path):
    node.head = 2
    run = live(store, node)
    query = run.stream(0.2, str(tmp_path / "wake"))
    try:
        for _ in range(100):
            if store.checkpoint() and store.checkpoint().height == 2:
                break
            query.awaitTermination(0.3)
    finally:
        query.stop()
    assert heights(store) == [0, 1, 2]


def test_runs_from_settings(spark, node, tmp_path):
    from forktide.plans import assemble, config

    text = f"""chain_id = 5
store = "{tmp_path / 's'}"
[rpc]
url = "{node.url}"
verifier_url = "{node.url}"
[backfill]
workers = 2
max_requests = 200
[[contracts]]
address = "0x{A}"
standard = "ERC-20"
version = "7"
"""
    (tmp_path / "c.toml").write_text(text)
    settings = config.load(tmp_path / "c.toml", {})
    node.head = 25
    assert assemble.backfill_of(spark, settings, 0, 20).run().blocks == 21
    run = assemble.live_of(spark, settings)
    assert run.step().state == "ready" and heights(run.tracker.store) == list(range(26)) and run.health.ok and run.status.disagreements == 0
    with pytest.raises(config.ConfigError, match="chain"):
        assemble.live_of(spark, config.load(tmp_path / "c.toml", {}, {"chain_id": 6}))
    with pytest.raises(config.ConfigError, match="first block"):
        assemble.live_of(spark, config.load(tmp_path / "c.toml", {}, {"genesis_hash": "0x" + "ab" * 32}))
    for bad in ({"rpc": {"url": "ws://h"}}, {"contracts": [{"address": A}]}):
        with pytest.raises(config.ConfigError):
            config.load(tmp_path / "c.toml", {}, bad)
