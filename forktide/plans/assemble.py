"""A store, a backfill and a live run from the settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from forktide.operators import decoder
from forktide.sources import rpc

from .backfill import Backfill
from .compaction import Compactor
from .config import Config, ConfigError
from .live import Tracker
from .ranges import LifetimeBudget, RangeSizer, SharedBudget
from .runner import Live, RpcSource
from .snapshot import Store


def contracts_of(spark: SparkSession, config: Config) -> DataFrame | None:
    rows = [(c["address"], c["standard"], c.get("version", "1")) for c in config.contracts]
    return decoder.registry(spark, rows) if rows else None


def store_of(spark: SparkSession, config: Config, client: rpc.Client) -> Store:
    """The store, bound to the node's chain; a node of another chain than the settings expect is an error."""
    rpc.register(spark)
    found = client.head()
    if found["chain_id"] != config.chain_id:
        raise ConfigError(f"the node is on chain {found['chain_id']}, not {config.chain_id}")
    if config.genesis_hash is not None and found["genesis_hash"] != rpc.hexed(config.genesis_hash, 32):
        raise ConfigError("the node's first block is not the expected one")
    store = Store(spark, config.store)
    store.identify(found["chain_id"], found["genesis_hash"])
    return store


def budget_of(config: Config) -> SharedBudget:
    """One budget for all that a process sends to the node."""
    return SharedBudget(config.rpc.window_cost, config.rpc.window_seconds, LifetimeBudget(config.backfill.max_requests, config.backfill.max_cost))


def backfill_of(spark: SparkSession, config: Config, low: int, high: int, address: str | None = None) -> Backfill:
    b = config.backfill
    budget = budget_of(config)
    store = store_of(spark, config, rpc.Client(config.rpc.url, budget=budget))
    sizer = RangeSizer(b.initial_blocks, b.min_blocks, b.max_blocks)
    return Backfill(store, config.rpc.url, low, high, address, b.workers, sizer, contracts=contracts_of(spark, config), budget=budget)


def live_of(spark: SparkSession, config: Config, start: int | None = None) -> Live:
    client = rpc.Client(config.rpc.url, budget=SharedBudget(config.rpc.window_cost, config.rpc.window_seconds))
    store, contracts, i = store_of(spark, config, client), contracts_of(spark, config), config.indexer
    verifier = RpcSource(store, rpc.Client(config.rpc.verifier_url)) if config.rpc.verifier_url else None
    tracker = Tracker(store, RpcSource(store, client, contracts), start, i.max_reorg_depth, i.finalized_depth, verifier)
    return Live(tracker, verify_last=i.safe_depth, compactor=Compactor(store))


def dispatcher_of(spark: SparkSession, config: Config, sink=None):
    """The dispatch of the store's journal to the broker of the settings, or to any sink that takes a DataFrame of messages."""
    from forktide.streaming.dispatch import Dispatcher, StoreJournal
    from forktide.streaming.journal import broker_sink

    b = config.broker
    if sink is None:
        if b.servers is None:
            raise ConfigError("a dispatch needs the broker's servers")
        sink = broker_sink(b.servers, b.topic, b.delivery_timeout_seconds)
    return Dispatcher(StoreJournal(Store(spark, config.store)), config.chain_id, sink, b.part_ids)
