"""A backfill: ranges of heights fetched by Spark tasks side by side, committed in order, compared with a second node, and measured.

A range is a Spark job of one task, and as many jobs run at a time as there are workers; what one fetches is a table of one row before anything is
decided.  Results are taken as they come: a range that the node refuses as too large comes back as refused and its halves are next;
the coordinator puts ranges in order, and those that are ready are committed as one batch while others are fetched.  So a slow range keeps
nothing waiting but the commits behind it.  Only headers come to the driver: those of ranges that wait for their turn, AHEAD at most.

Requests are paid from leases.  The driver leases a range's units before its job starts, with some to spare for attempts that fail; a task that runs
out, or that Spark starts once more, comes back short and gets a larger lease; what is left over is given back.
"""

from __future__ import annotations

import datetime
import time
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from forktide.operators import decoder
from forktide.operators.compare import differences
from forktide.operators.transition import Batch, Event, Header
from forktide.sources.rpc import BLOCKS, LOGS, Client, RpcError, error_class

from . import snapshot
from .ranges import COST, Allowance, BackfillError, BlockRange, BudgetSpent, Coordinator, RangeSizer, Retry, SharedBudget

ROW = f"low long, high long, refused string, short boolean, requests long, cost long, blocks array<struct<{BLOCKS.replace(' ', ':')}>>, logs array<struct<{LOGS.replace(' ', ':')}>>".replace(",:", ", ")
#: Ranges that may wait for their turn.
AHEAD = 1000
#: Units to spare in a lease, as a share of what is foreseen.
SPARE = 0.25


def matched(blocks: list[tuple], logs: list[tuple]) -> bool:
    """Whether every log names the block at its height."""
    hashes = {height: block_hash for height, block_hash, *_ in blocks}
    return all(hashes.get(x[0]) == x[1] for x in logs)


def fetch_range(client: Client, r: BlockRange, address: str | None = None) -> tuple[list[tuple], list[tuple]]:
    """A range's blocks and logs.  Logs of another branch than the blocks are asked for once more, with the blocks; then it is an error."""
    for _ in range(2):
        blocks, logs = client.blocks(r.low, r.high), client.logs(r.low, r.high, address)
        if matched(blocks, logs):
            return blocks, logs
    raise RpcError(f"the logs of heights {r.low} to {r.high} don't belong to the blocks there")


def fetched(spark: SparkSession, ranges: list[BlockRange], url: str, address: str | None = None, timeout: float = 30.0, retry: Retry = Retry(), units: int | None = None) -> DataFrame:
    """A row for each range, a task each; refused has the node's words if it takes the range for too large, short says that ``units`` were too few."""
    arrow = to_arrow_schema(StructType.fromDDL(ROW))

    def run(batches):
        from pyspark import TaskContext

        for b in batches:
            for i in b.column(0).to_pylist():
                r, refused, short, found = ranges[i], None, False, ([], [])
                allowance = None if units is None else Allowance(units)
                client = Client(url, timeout, retry, allowance=allowance)
                if units is not None and TaskContext.get().attemptNumber():
                    short, client.cost = True, units  # another attempt may have spent it all
                else:
                    try:
                        found = fetch_range(client, r, address)
                    except BudgetSpent:
                        short = True
                    except RpcError as e:
                        if error_class(e) != "provider_limit":
                            raise
                        refused = str(e)
                row = (r.low, r.high, refused, short, client.requests, client.cost, timed(found[0]), found[1])
                values = [pa.array([_structs(v, f.type) if pa.types.is_list(f.type) else v], f.type) for v, f in zip(row, arrow)]
                yield pa.RecordBatch.from_arrays(values, schema=arrow)

    return spark.range(0, len(ranges), 1, len(ranges)).mapInArrow(run, ROW)


def timed(blocks: list[tuple]) -> list[tuple]:
    """A client's blocks with their time as a timestamp."""
    return [(h, block_hash, parent, datetime.datetime.fromtimestamp(seconds, datetime.timezone.utc)) for h, block_hash, parent, seconds in blocks]


def _structs(rows: list[tuple], kind: pa.ListType) -> list[dict]:
    names = [f.name for f in kind.value_type]
    return [dict(zip(names, r)) for r in rows]


def store_rows(blocks: DataFrame, logs: DataFrame, status: str, contracts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Blocks and logs of a source in the store's columns; logs of known contracts are decoded."""
    logs = logs.withColumns({"decoded_event": F.lit(None).cast("string"), "decoder_version": F.lit(None).cast("string")}) if contracts is None else decoder.decode(logs, contracts)
    logs = logs.withColumns({f"topic{i}": F.get("topics", F.lit(i)) for i in range(4)})
    blocks = blocks.withColumns({"is_canonical": F.lit(True), "status": F.lit(status), "status_source": F.lit("observed")})
    return tuple(df.select(*(F.col(f.name).cast(f.dataType) for f in StructType.fromDDL(s))) for df, s in ((blocks, snapshot.BLOCKS), (logs, snapshot.LOGS)))


@dataclass
class BackfillReport:
    blocks: int = 0
    logs: int = 0
    ranges: int = 0
    refused: int = 0
    refetched: int = 0
    requests: int = 0
    cost: int = 0
    seconds: float = 0.0
    #: Of the comparison with a second node: logs that only one of the two has.
    only_here: int | None = None
    only_there: int | None = None

    @property
    def blocks_per_second(self) -> float:
        return self.blocks / self.seconds if self.seconds else 0.0

    @property
    def calls_per_1k_blocks(self) -> float:
        return 1000 * self.requests / self.blocks if self.blocks else 0.0


@dataclass
class Backfill:
    store: snapshot.Store
    url: str
    low: int
    high: int
    address: str | None = None
    workers: int = 8
    sizer: RangeSizer = field(default_factory=lambda: RangeSizer(100, 1, 100))
    status: str = "unsafe"
    contracts: DataFrame | None = None
    budget: SharedBudget = field(default_factory=lambda: SharedBudget(1 << 60))
    retry: Retry = Retry()
    #: How often a range that does not follow the store may be fetched again.
    invalidations: int = 3
    clock: Callable[[], float] = time.monotonic

    def run(self) -> BackfillReport:
        """Fill the store up to ``high``; a store that has a checkpoint goes on behind it."""
        self.report, began = BackfillReport(), self.clock()
        self.staging = f"{self.store.path}/staging-{uuid.uuid4().hex}"
        self.coordinator = self._coordinator(self.report)
        #: Ranges to fetch before new ones, each with how often its lease was too small.
        self.waiting: list[tuple[BlockRange, int]] = []
        self.planned, self.held, self.again = self.coordinator.next_height, {}, 0
        running: dict[Future, tuple[BlockRange, int, Allowance]] = {}
        stale: set[Future] = set()  # of ranges that were asked for before the chain changed
        try:
            with ThreadPoolExecutor(self.workers) as pool:
                try:
                    while not self.coordinator.done:
                        pause = self._submit(pool, running)
                        done, _ = wait(running, pause, FIRST_COMPLETED)
                        if self._take(done, running, stale):
                            stale |= running.keys()
                except BaseException:
                    self.store.spark.sparkContext.cancelJobsWithTag(self.staging)
                    raise
        finally:
            self.store.files.remove(self.staging)
        self.report.seconds = self.clock() - began
        return self.report

    def _submit(self, pool: ThreadPoolExecutor, running: dict[Future, tuple[BlockRange, int, Allowance]]) -> float | None:
        """Start what workers and budget allow; seconds until the budget may allow more, None if it does not matter."""
        while len(running) < self.workers and len(self.coordinator.pending) < AHEAD:
            r, short = self.waiting[0] if self.waiting else (self.sizer.next(self.planned, self.high), 0)
            if r is None:
                return None
            cost = len(r) * COST["block"] + COST["logs"]
            spare = max(COST["logs"], int(cost * SPARE), min(3 * cost, self.budget.limit // (2 * self.workers) - cost))  # where the window is wide, enough to ask for all again
            units = min(self.budget.limit, (cost + spare) << short) if cost <= self.budget.limit else cost
            lease = self.budget.try_lease(units, len(r) + 1)
            if lease is None:
                pause = self.budget.wait()
                if running:
                    return pause
                self.budget.sleep(pause)
                continue
            if self.waiting:
                self.waiting.pop(0)
            else:
                self.planned = r.high + 1
            running[pool.submit(self._fetch, r, lease)] = (r, short, lease)
        return None

    def _fetch(self, r: BlockRange, lease: Allowance):
        """Headers and counts of a range whose row has been written."""
        spark, folder = self.store.spark, f"{self.staging}/{uuid.uuid4().hex}"
        spark.sparkContext.addJobTag(self.staging)
        fetched(spark, [r], self.url, self.address, retry=self.retry, units=lease.units).write.parquet(folder)
        columns = "refused", "short", "requests", "cost", "blocks.height", "blocks.block_hash", "blocks.parent_hash"
        return folder, spark.read.schema(ROW).parquet(folder).select(*columns).first()

    def _take(self, done: set[Future], running: dict[Future, tuple[BlockRange, int, Allowance]], stale: set[Future]) -> bool:
        """Results as they come; whether the chain turned out to have changed, so that what is still running is of no use."""
        report, ready, lost = self.report, [], None
        for f in done:
            r, short, lease = running.pop(f)
            try:
                folder, row = f.result()
            except BaseException:
                self.budget.give_back(lease, lease.foreseen, lease.units)
                raise
            self.budget.give_back(lease, row["requests"], row["cost"])
            report.requests, report.cost = report.requests + row["requests"], report.cost + row["cost"]
            if f in stale or lost is not None:
                stale.discard(f)
            elif row["short"]:
                if lease.units >= self.budget.limit:
                    raise BackfillError(f"a window of {self.budget.limit} units does not hold the range from {r.low} to {r.high}")
                self.waiting.insert(0, (r, short + 1))
            elif row["refused"] is not None:
                report.refused += 1
                self.waiting[:0] = [(half, 0) for half in self._smaller(r, row["refused"])]
            else:
                self.sizer.succeeded()
                self.held[r.low] = folder
                lost = self.coordinator.offer(r, [Header(*h) for h in zip(row["block_hash"], row["parent_hash"], row["height"])], lambda *x: ready.append(x))
        self.waiting.sort(key=lambda x: x[0].low)
        self._commit(ready)
        if lost is None:
            return False
        self.again, report.refetched = self.again + 1, report.refetched + 1
        if self.again > self.invalidations:
            raise BackfillError(f"heights from {lost.low} on do not follow the store")
        self.waiting, self.planned, self.held = [], lost.low, {}
        return True

    def verify(self, url: str, report: BackfillReport) -> BackfillReport:
        """Compare the store's canonical logs with those of a second node, as multisets."""
        spark = self.store.spark
        theirs = spark.read.format("evm_logs").options(url=url, low=self.low, high=self.high, span=self.sizer.current, **({"address": self.address} if self.address else {})).load()
        columns = ("block_number", "block_hash", "transaction_index", "log_index", "tx_hash", "address", "topic0", "topic1", "topic2", "topic3", "data")
        theirs = theirs.withColumns({f"topic{i}": F.get("topics", F.lit(i)) for i in range(4)}).select(*columns)
        chain = self.store.blocks(self.low, self.high).where("is_canonical").select("block_hash")
        ours = self.store.logs(self.low, self.high).join(chain, "block_hash", "left_semi").select(*columns)
        # the node is asked once: its rows are a table before they are compared
        staged = f"{self.store.path}/staging-{uuid.uuid4().hex}"
        theirs.write.parquet(staged)
        found = differences(ours, spark.read.schema(theirs.schema).parquet(staged), "block_number", list(columns)).agg(F.sum("only_a").alias("a"), F.sum("only_b").alias("b")).first()
        self.store.files.remove(staged)
        report.only_here, report.only_there = found["a"] or 0, found["b"] or 0
        return report

    def _coordinator(self, report: BackfillReport) -> Coordinator:
        at = self.store.checkpoint()
        if at is None and self.low > 0:  # the block below is the store's first
            client = Client(self.url, retry=self.retry, budget=self.budget)
            rows = client.blocks(self.low - 1, self.low - 1)
            at = Header(rows[0][1], rows[0][2], rows[0][0])
            report.requests, report.cost = report.requests + client.requests, report.cost + client.cost
            spark = self.store.spark
            blocks, logs = store_rows(spark.createDataFrame(timed(rows), BLOCKS), spark.createDataFrame([], LOGS), self.status)
            self.store.commit(Batch("bootstrap", None, (Event("apply", at),)), blocks, logs)
        return Coordinator(self.high, self.low if at is None else at.height + 1, at)

    def _smaller(self, r: BlockRange, words: str) -> list[BlockRange]:
        if len(r) <= self.sizer.least:
            raise BackfillError(f"the node refuses {len(r)} heights: {words}")
        self.sizer.refused()
        middle = r.low + len(r) // 2
        return [BlockRange(r.low, middle - 1), BlockRange(middle, r.high)]

    def _commit(self, ready: list[tuple[BlockRange, list[Header]]]) -> None:
        if not ready:
            return
        report, headers = self.report, [h for _, found in ready for h in found]
        folders = [self.held.pop(r.low) for r, _ in ready]
        rows = self.store.spark.read.schema(ROW).parquet(*folders)
        blocks, logs = (rows.select(F.explode(c).alias("x")).select("x.*") for c in ("blocks", "logs"))
        anchor = self.store.checkpoint()
        label = "bootstrap" if anchor is None else "extend" if len(headers) == 1 else "gap"
        blocks, logs = store_rows(blocks, logs, self.status, self.contracts)
        self.store.commit(Batch(label, anchor, tuple(Event("apply", h) for h in headers)), blocks, logs)
        report.blocks, report.ranges, report.logs = report.blocks + len(headers), report.ranges + len(ready), report.logs + rows.agg(F.sum(F.size("logs"))).first()[0]
        for folder in folders:
            self.store.files.remove(folder)
