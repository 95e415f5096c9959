"""Blocks and logs of a JSON-RPC node as Spark data sources, batch and streaming.

    register(spark)
    spark.read.format("evm_blocks").options(url=..., low=0, high=999, span=100).load()
    spark.read.format("evm_logs").options(url=..., low=0, high=999).load().where("address = '...'")

A partition is a range of ``span`` heights: one JSON-RPC batch of blocks, or one log request.  Bounds on the height and an equality on the
address go to the node (with ``spark.sql.python.filterPushdown.enabled``).  Rows are checked where they arrive: a removed log, a height out of range, a missing field,
an index beyond 32 bits or a chain of blocks that does not hold together is an error, not a row.  A failed request is tried again by
``plans.ranges.Retry``; a lost task is read again by Spark.
"""

from __future__ import annotations

import datetime
import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual,
)

from forktide.operators.transition import Header
from forktide.plans.ranges import COST, Allowance, LifetimeBudget, Retry, SharedBudget, WindowBudget, plan_ranges

BLOCKS = "height bigint, block_hash string, parent_hash string, ts timestamp"
LOGS = "block_number bigint, block_hash string, transaction_index int, log_index int, tx_hash string, address string, topics array<string>, data string"


class RpcError(RuntimeError):
    pass


def number(value, bits: int = 63) -> int:
    n = value if isinstance(value, int) else int(value, 16 if str(value).lower().startswith("0x") else 10)
    if not 0 <= n < 1 << bits:
        raise RpcError(f"{value} does not fit {bits} bits")
    return n


def hexed(value: str, size: int | None = None) -> str:
    out = value.lower().removeprefix("0x")
    if size is not None and len(out) != 2 * size:
        raise RpcError(f"{value} is not {size} bytes")
    return out


def error_class(e: Exception) -> str:
    """The driver-side twin of functions.scalars: what may be tried again."""
    from forktide.functions.scalars import ERROR_WORDS

    if isinstance(e, urllib.error.HTTPError):
        return "transient" if e.code in (408, 425) or e.code >= 500 else "rate_limited" if e.code == 429 else "permanent"
    if isinstance(e, RpcError):
        low = str(e).lower()
        return next((name for name, words in ERROR_WORDS.items() if any(w in low for w in words)), "permanent")
    return "transient" if isinstance(e, OSError) else "permanent"


@dataclass
class Client:
    url: str
    timeout: float = 30.0
    retry: Retry = Retry()
    #: All are paid before each attempt: the first two hold for one client, ``budget`` for all clients of a process, ``allowance`` is what a task was leased.
    lifetime: LifetimeBudget | None = None
    window: WindowBudget | None = None
    budget: SharedBudget | None = None
    allowance: Allowance | None = None
    requests: int = 0
    cost: int = 0

    def __post_init__(self):
        if not self.url.startswith(("http://", "https://")):
            raise RpcError("the URL must use http or https")

    def send(self, calls: list[tuple[str, list]]) -> list:
        """The results of a batch, in the order of its calls."""
        body = json.dumps([{"jsonrpc": "2.0", "id": i, "method": m, "params": p} for i, (m, p) in enumerate(calls)]).encode()

        costs = ["logs" if m == "eth_getLogs" else "block" for m, _ in calls]

        def once():
            if self.allowance is not None:
                self.allowance.pay(len(costs), sum(COST[c] for c in costs))
            if self.budget is not None:
                self.budget.spend(len(costs), sum(COST[c] for c in costs))
            if self.window is not None and (wait := self.window.wait(sum(COST[c] for c in costs))):
                time.sleep(wait)
            for c in costs:
                if self.lifetime is not None:
                    self.lifetime.spend(c)
                self.requests, self.cost = self.requests + 1, self.cost + COST[c]
            request = urllib.request.Request(self.url, body, {"Content-Type": "application/json"})
            try:
                with urllib.request.urlopen(request, timeout=self.timeout) as r:
                    answers = json.loads(r.read())
            except urllib.error.HTTPError as e:
                asked = e.headers.get("Retry-After", "")
                e.retry_after = float(asked) if asked.isdigit() else None
                raise
            if isinstance(answers, dict):  # a batch that was refused as a whole
                raise RpcError((answers.get("error") or {}).get("message", "the node answered a batch with one object"))
            by = {a["id"]: a for a in answers}
            for a in answers:
                if a.get("error"):
                    raise RpcError(a["error"].get("message", "error"))
            return [by[i]["result"] for i in range(len(calls))]

        return self.retry.run(once, error_class, who=f"{self.url} {calls[0]}")

    def call(self, method: str, *params):
        return self.send([(method, list(params))])[0]

    def head(self) -> dict:
        """Chain id, height, and the hashes of the latest and the first block, the latest of one answer."""
        chain, latest, first = self.send([("eth_chainId", []), ("eth_getBlockByNumber", ["latest", False]), ("eth_getBlockByNumber", ["0x0", False])])
        return {"chain_id": number(chain, 64), "height": number(latest["number"]), "block_hash": hexed(latest["hash"], 32), "genesis_hash": hexed(first["hash"], 32)}

    def block_at(self, height: int) -> tuple:
        return self.blocks(height, height)[0]

    def find_block(self, height: int) -> tuple | None:
        """The block at a height, None if the node has none."""
        b = self.call("eth_getBlockByNumber", hex(height), False)
        return b and block_row(b)

    def blocks(self, low: int, high: int) -> list[tuple]:
        """(height, hash, parent, seconds) of an inclusive range in one batch, checked as a chain."""
        found = self.send([("eth_getBlockByNumber", [hex(h), False]) for h in range(low, high + 1)])
        rows = []
        for h, b in zip(range(low, high + 1), found):
            if b is None:
                raise RpcError(f"no block at height {h}")
            rows.append(block_row(b))
            if rows[-1][0] != h or len(rows) > 1 and rows[-1][2] != rows[-2][1]:
                raise RpcError(f"the block at {h} does not follow its predecessor")
        return rows

    def block_by_hash(self, block_hash: str) -> list[tuple]:
        """The block's row, or none."""
        b = self.call("eth_getBlockByHash", "0x" + hexed(block_hash, 32), False)
        rows = [] if b is None else [block_row(b)]
        if any(r[1] != hexed(block_hash) for r in rows):
            raise RpcError("the node answered with another block")
        return rows

    def header_by_hash(self, block_hash: str) -> Header | None:
        return next((Header(found, parent, height) for height, found, parent, _ in self.block_by_hash(block_hash)), None)

    def block_with_logs(self, block_hash: str) -> tuple[Header, list[tuple]] | None:
        """A block by its hash with the logs of that very block."""
        header = self.header_by_hash(block_hash)
        return header and (header, self.logs_of(header))

    def logs(self, low: int, high: int, address: str | None = None) -> list[tuple]:
        query = {"fromBlock": hex(low), "toBlock": hex(high)} | ({"address": "0x" + hexed(address, 20)} if address else {})
        return sorted((log_row(x, low, high) for x in self.call("eth_getLogs", query)), key=lambda r: (r[0], r[2], r[3]))

    def logs_of(self, header: Header) -> list[tuple]:
        """Logs anchored to one block's hash, so never those of a fork."""
        rows = [log_row(x, header.height, header.height) for x in self.call("eth_getLogs", {"blockHash": "0x" + header.block_hash})]
        if any(r[1] != header.block_hash for r in rows):
            raise RpcError("a log belongs to another block")
        return sorted(rows, key=lambda r: (r[2], r[3]))


def block_row(b: dict) -> tuple:
    return number(b["number"]), hexed(b["hash"], 32), hexed(b["parentHash"], 32), number(b["timestamp"])


def log_row(x: dict, low: int, high: int) -> tuple:
    if x.get("removed"):
        raise RpcError("a removed log")
    missing = [k for k in ("blockNumber", "blockHash", "transactionIndex", "logIndex", "transactionHash", "address", "topics", "data") if x.get(k) is None]
    if missing:
        raise RpcError(f"a log without {', '.join(missing)}")
    height = number(x["blockNumber"])
    if not low <= height <= high or len(x["topics"]) > 4:
        raise RpcError(f"a log at height {height} outside {low} to {high}, or of more than four topics")
    return (
        height, hexed(x["blockHash"], 32), number(x["transactionIndex"], 31), number(x["logIndex"], 31), hexed(x["transactionHash"], 32),
        hexed(x["address"], 20), [hexed(t, 32) for t in x["topics"]], hexed(x["data"]),
    )


@dataclass
class Heights(InputPartition):
    low: int
    high: int


class _Ranges:
    """What the batch and the stream readers share; Spark tells the two apart by their classes."""

    column = "height"

    def __init__(self, options: dict):
        self.options, self.address, self.block_hash = options, options.get("address"), None
        self.low, self.high = int(options.get("low", 0)), None if options.get("high") is None else int(options["high"])

    def client(self) -> Client:
        return Client(self.options["url"], float(self.options.get("timeout", 30)))

    def split(self, low: int, high: int) -> list[Heights]:
        return [Heights(r.low, r.high) for r in plan_ranges(low, high, int(self.options.get("span", 100)))] or [Heights(0, -1)]

    def inside(self, rows: list[tuple]) -> list[tuple]:
        return [r for r in rows if self.low <= r[0] and (self.high is None or r[0] <= self.high)]

    def read(self, partition: Heights) -> Iterator[tuple]:
        if partition.low <= partition.high:
            yield from self.rows(partition)


class _Blocks(_Ranges):
    def rows(self, p: Heights) -> Iterator[tuple]:
        client = self.client()
        for height, block_hash, parent, seconds in client.blocks(p.low, p.high) if self.block_hash is None else self.inside(client.block_by_hash(self.block_hash)):
            yield height, block_hash, parent, datetime.datetime.fromtimestamp(seconds, datetime.timezone.utc)


class _Logs(_Ranges):
    column = "block_number"

    def rows(self, p: Heights) -> Iterator[tuple]:
        client = self.client()
        if self.block_hash is None:
            yield from client.logs(p.low, p.high, self.address)
        elif header := client.header_by_hash(self.block_hash):
            yield from (r for r in self.inside(client.logs_of(header)) if self.address is None or r[5] == hexed(self.address))


class _Batch(DataSourceReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Bounds and an address are taken as hints, and Spark filters again.  An address that is not written as rows have it is no hint."""
        for f in filters:
            name = getattr(f, "attribute", ("",))[-1]
            if name == "address" and isinstance(f, EqualTo) and self.column == "block_number" and self.address is None and re.fullmatch("[0-9a-f]{40}", str(f.value)):
                self.address = f.value
            if name == "block_hash" and isinstance(f, EqualTo) and re.fullmatch("[0-9a-f]{64}", str(f.value)):
                self.block_hash = f.value
            if name == self.column:
                low = {GreaterThan: 1, GreaterThanOrEqual: 0, EqualTo: 0}.get(type(f))
                high = {LessThan: -1, LessThanOrEqual: 0, EqualTo: 0}.get(type(f))
                if low is not None:
                    self.low = max(self.low, f.value + low)
                if high is not None:
                    self.high = f.value + high if self.high is None else min(self.high, f.value + high)
            yield f

    def partitions(self) -> list[Heights]:
        if self.block_hash is not None:
            return [Heights(0, 0)]  # one request by hash; Spark filters heights and address
        return self.split(self.low, self.high if self.high is not None else self.client().head()["height"])


class _Stream(DataSourceStreamReader):
    """An offset is the next height to read."""

    def initialOffset(self) -> dict:
        return {"height": self.low}

    def latestOffset(self) -> dict:
        return {"height": self.client().head()["height"] + 1}

    def partitions(self, start: dict, end: dict) -> list[Heights]:
        return self.split(start["height"], end["height"] - 1)


class BlockReader(_Blocks, _Batch):
    pass


class BlockStream(_Blocks, _Stream):
    pass


class LogReader(_Logs, _Batch):
    pass


class LogStream(_Logs, _Stream):
    pass


class BlockSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "evm_blocks"

    def schema(self) -> str:
        return BLOCKS

    def reader(self, schema) -> BlockReader:
        return BlockReader(dict(self.options))

    def streamReader(self, schema) -> BlockStream:
        return BlockStream(dict(self.options))


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "evm_logs"

    def schema(self) -> str:
        return LOGS

    def reader(self, schema) -> LogReader:
        return LogReader(dict(self.options))

    def streamReader(self, schema) -> LogStream:
        return LogStream(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BlockSource)
    spark.dataSource.register(LogSource)
