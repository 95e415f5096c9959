"""An atomic store of chain state in Parquet: small deltas a commit, merged when they are read, compacted in the background.

A commit writes what it changes and no more: the blocks whose state changes, new logs, journal rows; then it publishes a manifest that names
them (``manifest.py``).  Readers resolve the manifest once, so they see all of a commit or nothing.  A writer that dies
earlier leaves files that no manifest names.

* Compacted tables hold blocks and logs by buckets of heights.  Rows of deltas carry the number of their commit; of the rows of a key
  the one with the highest number counts.  The manifest knows the heights and rows of each delta, and whether it is ``fresh``: it has keys
  that no one had before.  Reading leaves out what lies at other heights, and compares numbers only with deltas that are not fresh.
* ``compaction.py`` merges deltas of like size to larger ones and, when they make up a share of the table, folds them into the buckets.
* The journal is segments of consecutive ids.  What is published is a position, ``published_upto``, with ranges of ids ahead of it, so a
  dispatcher reads each segment once.

Of a commit the driver sees what the batch already names: its headers, at most two branches of max_depth or one window of a backfill.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forktide.operators import journal, merge
from forktide.operators.transition import Batch, Header

from .manifest import Files, Lease, Manifest, StoreBusy, StoreError, Versions

__all__ = ["BLOCKS", "BUCKET", "JOURNAL", "LOGS", "Manifest", "Store", "StoreBusy", "StoreError"]

BUCKET = 100_000
BLOCKS = "block_hash string, parent_hash string, height bigint, ts timestamp, is_canonical boolean, status string, status_source string"
LOGS = "block_number bigint, block_hash string, transaction_index int, log_index int, tx_hash string, address string, topic0 string, topic1 string, data string, decoded_event string, decoder_version string, topic2 string, topic3 string"
JOURNAL = "event_id bigint, event_kind string, block_hash string, height bigint, payload string, created_at timestamp"
MARKS = "low bigint, high bigint, published_at timestamp"
#: Each table's schema, key, column of heights and order in a file.
TABLES = {
    "blocks": (BLOCKS, ("block_hash",), "height", ("height", "block_hash")),
    "logs": (LOGS, ("block_hash", "log_index"), "block_number", ("address", "block_number", "transaction_index", "log_index")),
}
#: Applied blocks of a commit whose logs go to one file.
ONE_FILE = 64
#: Ranges of published ids that the manifest itself holds.
INLINE_MARKS = 256
#: Ids by which ranges of published ids are joined to the journal.
MARK_BUCKET = 4096


def overlaps(part: dict, low: int | None, high: int | None) -> bool:
    return (low is None or part["high"] >= low) and (high is None or part["low"] <= high)


class Store:
    def __init__(self, spark: SparkSession, path: str, lease_seconds: float = 600.0, patience: float = 5.0):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = Files(spark, self.path)
        self.versions = Versions(self.files)
        self.lease_seconds, self.patience = lease_seconds, patience

    def manifest(self) -> Manifest:
        return self.versions.latest()

    def lease(self) -> Lease:
        return Lease(self.files, self.lease_seconds, self.patience)

    def publish(self, m: Manifest, lease: Lease) -> None:
        lease.hold()
        m.token = lease.token
        self.versions.publish(m)

    def folder(self, kind: str) -> str:
        return f"{kind}-{uuid.uuid4().hex}"

    # Reading.

    def read(self, folders: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in folders)) if folders else self.spark.createDataFrame([], schema)

    def merged(self, table: str, parts: list[dict], deltas: list[dict]) -> DataFrame:
        """The rows of compacted parts and deltas, of each key the latest, with seq."""
        schema, key, *_ = TABLES[table]
        numbered = f"{schema}, seq bigint"
        rows = self.read([p["folder"] for p in parts], schema).withColumn("seq", F.lit(0).cast("bigint"))
        if named := [d[table] for d in deltas if d[table]]:
            rows = rows.unionByName(self.read(named, numbered)) if parts else self.read(named, numbered)
        if changing := [d[table] for d in deltas if d[table] and not d["fresh"]]:
            last = self.read(changing, numbered).groupBy(*key).agg(F.max("seq").alias("last"))  # the keys that some commit changed
            rows = rows.join(last, list(key), "left").where("last IS NULL OR seq = last").drop("last")
        return rows

    def view(self, table: str, low: int | None = None, high: int | None = None, m: Manifest | None = None) -> DataFrame:
        m = m or self.manifest()
        schema, _, height, _ = TABLES[table]
        parts = [p for p in getattr(m, table).values() if overlaps(p, low, high)]
        rows = self.merged(table, parts, [d for d in m.deltas if overlaps(d, low, high)])
        if low is not None:
            rows = rows.where(F.col(height) >= low)
        if high is not None:
            rows = rows.where(F.col(height) <= high)
        return rows.select(*(c.split()[0] for c in schema.split(", ")))

    def blocks(self, low: int | None = None, high: int | None = None) -> DataFrame:
        """All blocks, or those of some heights; other heights' files are not read."""
        return self.view("blocks", low, high)

    def logs(self, low: int | None = None, high: int | None = None) -> DataFrame:
        return self.view("logs", low, high)

    def journal(self) -> DataFrame:
        """The journal with published_at, null where it is not."""
        m = self.manifest()
        marks = self.spark.createDataFrame([(low, high, _time(at)) for low, high, at in m.marks], MARKS)
        if m.marks_folder:
            marks = marks.unionByName(self.read([m.marks_folder], MARKS))
        bucket = F.col("event_id").cast("long") / MARK_BUCKET
        near = marks.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("low") / MARK_BUCKET), F.floor(F.col("high") / MARK_BUCKET))))
        rows = self.read([s["folder"] for s in m.journal], JOURNAL).withColumn("bucket", F.floor(bucket))
        both = rows.join(near, (rows["bucket"] == near["bucket"]) & rows["event_id"].between(near["low"], near["high"]), "left")
        return both.select(*(rows[c.split()[0]] for c in JOURNAL.split(", ")), "published_at")

    def unpublished(self, m: Manifest | None = None) -> list[dict]:
        """The journal's segments, in the order of their ids, that hold an id which is not published."""
        m = m or self.manifest()
        return [s for s in m.journal if s["high"] > m.published_upto and not any(low <= max(s["low"], m.published_upto + 1) and s["high"] <= high for low, high in m.ahead)]

    def pending(self, segments: list[dict], m: Manifest | None = None) -> DataFrame:
        """The unpublished rows of some segments; nothing else is read."""
        m = m or self.manifest()
        rows = self.read([s["folder"] for s in segments], JOURNAL).where(F.col("event_id") > m.published_upto)
        for low, high in m.ahead:
            rows = rows.where(~F.col("event_id").between(low, high))
        return rows

    def now(self) -> datetime.datetime:
        return self.spark.range(1).select(F.current_timestamp()).first()[0]

    def checkpoint(self) -> Header | None:
        c = self.manifest().checkpoint
        return Header(c["block_hash"], c["parent_hash"], c["height"]) if c else None

    # Writing.

    def identify(self, chain_id: int, genesis_hash: str) -> None:
        """Bind the store to a chain, once; another genesis is an error."""
        with self.lease() as lease:
            m = self.manifest()
            if m.chain_id is None:
                m.chain_id, m.genesis_hash = chain_id, genesis_hash
                self.publish(m, lease)
            elif (m.chain_id, m.genesis_hash) != (chain_id, genesis_hash):
                raise StoreError(f"the store holds chain {m.chain_id} with genesis {m.genesis_hash}")

    def commit(self, batch: Batch, blocks: DataFrame, logs: DataFrame, before_publish: Callable[[], None] = lambda: None, at_step: Callable[[str], None] = lambda step: None) -> None:
        """Commit a transition with the rows of its applied blocks and their logs; no event, no change.

        blocks and logs must match the applied headers exactly.  A batch of which every event is in the store already changes nothing,
        not the checkpoint either; one whose ancestor is not canonical is refused.  ``at_step`` is told each step once it is done.
        """
        if not batch.events:
            return
        with self.lease() as lease:
            at_step("lease")
            m = self.manifest()
            given = self._given(batch, blocks)
            low, high = min(e.header.height for e in batch.events), max(e.header.height for e in batch.events)
            stored = {}
            if any(overlaps(p, low, high) for p in [*m.blocks.values(), *m.deltas]):
                stored = {r["block_hash"]: r.asDict() for r in self.view("blocks", low, high, m).collect()}  # the blocks at the batch's own heights
            flips, changed = self._flips(batch, given, stored)
            at_step("flips")
            if not flips:
                return
            self._check_ancestor(batch.ancestor, m)
            target = batch.checkpoint
            self._check_chain({**stored, **changed}, target, low, high)
            delta = self._write(m, batch, changed, logs, stored, flips, at_step)
            m.deltas.append(delta | {"low": low, "high": high, "fresh": not stored.keys() & {e.header.block_hash for e in batch.events}})
            m.next_event_id += len(flips)
            m.checkpoint = target.__dict__ if target else None
            before_publish()
            self.publish(m, lease)
            at_step("publish")

    def _given(self, batch: Batch, blocks: DataFrame) -> dict[str, dict]:
        applied = {e.header.block_hash for e in batch.events if e.kind == "apply"}
        rows = blocks.select(*(c.split()[0] for c in BLOCKS.split(", "))).take(len(applied) + 1)
        given = {r["block_hash"]: r.asDict() for r in rows}
        if odd := applied ^ given.keys():
            raise StoreError(f"block {min(odd)} lacks its event or its payload")
        if len(rows) > len(given):
            raise StoreError("a block comes twice")
        return given

    @staticmethod
    def _flips(batch: Batch, given: dict[str, dict], stored: dict[str, dict]) -> tuple[list[tuple], dict[str, dict]]:
        """The events that change a flag, as (seq, kind, header), and the blocks' rows after them."""
        flips, changed = [], {}
        for seq, e in enumerate(batch.events):
            key, after = e.header.block_hash, e.kind == "apply"
            now = changed.get(key) or stored.get(key)
            if not after and now is None:
                raise StoreError(f"rollback of an unknown block {key}")
            if after == (now is not None and now["is_canonical"]):
                continue
            flips.append((seq, e.kind, e.header))
            row = dict(now or given[key]) | {"is_canonical": after}
            if after:  # time and status are those of the source that has it now; parent and height stay
                row |= {c: given[key][c] if given[key][c] is not None else row[c] for c in ("ts", "status", "status_source")}
            changed[key] = row
        return flips, changed

    def _check_ancestor(self, ancestor: Header | None, m: Manifest) -> None:
        if ancestor is None:
            if m.checkpoint:
                raise StoreError("a batch without an ancestor begins a store, but this one has a checkpoint")
        elif m.checkpoint != ancestor.__dict__:  # a checkpoint is canonical
            at = self.view("blocks", ancestor.height, ancestor.height, m).where((F.col("block_hash") == ancestor.block_hash) & F.col("is_canonical"))
            if not at.take(1):
                raise StoreError(f"the batch's ancestor at {ancestor.height} is not a canonical block of the store")

    @staticmethod
    def _check_chain(after: dict[str, dict], target: Header | None, low: int, high: int) -> None:
        """One canonical block at a height, of those the batch touches; the checkpoint is canonical."""
        heights = [r["height"] for r in after.values() if r["is_canonical"]]
        if len(heights) > len(set(heights)):
            raise StoreError("two canonical blocks at one height")
        if target and low <= target.height <= high:  # else it is the ancestor, which has been checked
            row = after.get(target.block_hash)
            if row is None or not row["is_canonical"] or row["height"] != target.height:
                raise StoreError("the checkpoint is not a canonical block")

    def _write(self, m: Manifest, batch: Batch, changed: dict[str, dict], logs: DataFrame, stored: dict[str, dict], flips: list[tuple], at_step: Callable[[str], None]) -> dict:
        spark, base = self.spark, self.folder(f"delta-{m.version + 1}")
        if fault := next(filter(None, map(merge.block_fault_of, changed.values())), None):
            raise StoreError(f"a block is out of its domain: {fault}")
        seq = F.lit(m.version + 1).cast("bigint").alias("seq")
        rows = spark.createDataFrame([tuple(r[c.split()[0]] for c in BLOCKS.split(", ")) for r in changed.values()], BLOCKS)
        rows = rows.select("*", seq).coalesce(1).sortWithinPartitions(*TABLES["blocks"][3])
        applied = {e.header.block_hash: e.header.height for e in batch.events if e.kind == "apply"}
        few = (lambda df: df.coalesce(1) if len(applied) <= ONE_FILE else df)  # fmt: skip  # a few blocks' logs need no shuffle
        first = {f[0]: m.next_event_id + i for i, f in enumerate(flips)}
        events = spark.createDataFrame([(s, kind, h.block_hash, h.height, changed[h.block_hash]["status"], first[s]) for s, kind, h in flips], "seq long, event_kind string, block_hash string, height long, status string, event_id long")
        with ThreadPoolExecutor(2) as pool:  # what does not wait for another runs beside it
            written = pool.submit(rows.write.parquet, f"{self.path}/{base}/blocks")
            if applied:
                few(self._with_kept(m, logs, applied, stored).select("*", seq)).sortWithinPartitions(*TABLES["logs"][3]).write.parquet(f"{self.path}/{base}/logs")
            written.result()
            at_step("rows")
            logs, n = few(self.read([f"{base}/logs"] if applied else [], LOGS)), 0
            made = journal.payloads(events.drop("event_id"), logs).join(F.broadcast(events.select("seq", "event_id")), "seq")  # the batch's own events
            made = made.select("event_id", "event_kind", "block_hash", "height", "payload", F.current_timestamp().alias("created_at"))
            written = pool.submit(made.coalesce(1).sortWithinPartitions("event_id").write.parquet, f"{self.path}/{base}/journal")
            if applied:
                n = self._check_rows(logs, applied)
            written.result()
        at_step("journal")
        m.journal.append({"folder": f"{base}/journal", "low": m.next_event_id, "high": m.next_event_id + len(flips) - 1})
        return {"first": m.version + 1, "last": m.version + 1, "commits": 1, "rows": n + len(changed), "blocks": f"{base}/blocks", "logs": f"{base}/logs" if applied else None}

    def _with_kept(self, m: Manifest, logs: DataFrame, applied: dict[str, int], stored: dict[str, dict]) -> DataFrame:
        """The applied blocks' logs in the store's columns; those of a block that was here before keep their raw fields."""
        logs = logs.select(*(c if c in logs.columns else F.lit(None).cast(kind).alias(c) for c, kind in (x.split() for x in LOGS.split(", "))))
        again = applied.keys() & stored.keys()
        if not again:
            return logs
        low, high = min(applied[h] for h in again), max(applied[h] for h in again)
        return merge.merge_logs(self.view("logs", low, high, m).where(F.col("block_hash").isin(sorted(again))), logs)

    def _check_rows(self, logs: DataFrame, applied: dict[str, int]) -> int:
        """Every log has its block at its height, comes once and is within its domain; gives the number of logs.  One job over the commit's own rows."""
        own = F.broadcast(self.spark.createDataFrame([(*x, True) for x in applied.items()], "block_hash string, block_number long, known boolean"))  # the batch's own headers
        faults = merge.log_fault(logs.columns)
        each = logs.join(own, ["block_hash", "block_number"], "left").groupBy("block_hash", "log_index").agg(
            F.count("*").alias("n"), F.bool_or(F.col("known").isNull()).alias("lost"), F.max(faults).alias("fault")
        )
        found = each.agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.bool_or("lost").alias("lost"), F.max("fault").alias("fault")).first()
        for words, there in (("a log lacks its block", found["lost"]), ("a log comes twice", (found["most"] or 0) > 1), ("a log is out of its domain", found["fault"])):
            if there:
                raise StoreError(words)
        return found["n"] or 0

    def redecode(self, decoded: DataFrame) -> int:
        """Replace changed decodes of all retained logs, orphans too, without a journal row.  Returns how many changed.

        decoded has block_hash, log_index, decoded_event and decoder_version of every log.  The changed rows are one delta, of one job.
        """
        with self.lease() as lease:
            m = self.manifest()
            base = self.folder(f"delta-{m.version + 1}")
            changed = merge.changed_decodes(self.view("logs", m=m), decoded)
            changed = changed.withColumns({"decoded_event": F.col("new_event"), "decoder_version": F.col("new_version"), "seq": F.lit(m.version + 1).cast("bigint")})
            changed.select(*(c.split()[0] for c in LOGS.split(", ")), "seq").sortWithinPartitions(*TABLES["logs"][3]).write.parquet(f"{self.path}/{base}/logs")
            found = self.read([f"{base}/logs"], LOGS).agg(F.count("*").alias("n"), F.min("block_number").alias("low"), F.max("block_number").alias("high")).first()
            if found["n"]:
                m.deltas.append({"first": m.version + 1, "last": m.version + 1, "commits": 1, "rows": found["n"], "low": found["low"], "high": found["high"], "blocks": None, "logs": f"{base}/logs", "fresh": False})
                self.publish(m, lease)
            return found["n"]

    # What is published.

    def mark_range(self, low: int, high: int) -> None:
        """The sink has taken these ids; a range that meets the position moves it on.  No data is read or written but the manifest."""
        with self.lease() as lease:
            m = self.manifest()
            fresh = _without([low, high], [[1, m.published_upto], *m.ahead])
            if not fresh:
                return
            at = int(datetime.datetime.now(datetime.timezone.utc).timestamp() * 1e6)
            m.marks += [[a, b, at] for a, b in fresh]
            spans = _joined([*m.ahead, *fresh])
            if spans and spans[0][0] <= m.published_upto + 1:
                m.published_upto = max(m.published_upto, spans.pop(0)[1])
            m.ahead = spans
            if len(m.marks) > INLINE_MARKS:
                folder = self.folder("marks")
                old = self.read([m.marks_folder], MARKS) if m.marks_folder else self.spark.createDataFrame([], MARKS)
                old.unionByName(self.spark.createDataFrame([(a, b, _time(t)) for a, b, t in m.marks], MARKS)).coalesce(1).write.parquet(f"{self.path}/{folder}")
                m.marks, m.marks_folder = [], folder
            self.publish(m, lease)

    def mark_published(self, event_ids: DataFrame) -> None:
        """After the sink has taken them; ids that are marked already keep their first time.  The driver gets a row for each run of consecutive ids."""
        from pyspark.sql import Window

        bucket = F.floor(F.col("event_id") / 65536)
        turn = F.row_number().over(Window.partitionBy(bucket).orderBy("event_id"))
        runs = event_ids.select("event_id").distinct().withColumn("run", F.col("event_id") - turn).groupBy(bucket.alias("bucket"), "run").agg(F.min("event_id").alias("low"), F.max("event_id").alias("high"))
        for low, high in _joined([[r["low"], r["high"]] for r in runs.collect()]):
            self.mark_range(low, high)


def _time(micros: int) -> datetime.datetime:
    return datetime.datetime.fromtimestamp(micros / 1e6, datetime.timezone.utc)


def _joined(spans: list[list[int]]) -> list[list[int]]:
    """Ranges of ids in order, neighbours as one."""
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def _without(span: list[int], known: list[list[int]]) -> list[list[int]]:
    """The parts of a range that no known range has."""
    out, at = [], span[0]
    for low, high in sorted(known):
        if high < at or low > span[1]:
            continue
        if low > at:
            out.append([at, low - 1])
        at = max(at, high + 1)
    return [*out, [at, span[1]]] if at <= span[1] else out
