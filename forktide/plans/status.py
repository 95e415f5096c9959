"""Readiness, health and status as expressions and small records."""

from __future__ import annotations

import datetime
import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .manifest import Files


def readiness(df: DataFrame) -> DataFrame:
    """(reconnect_ready, gaps, disagreements) with ready and state: ready, degraded or unavailable."""
    ready = F.col("reconnect_ready") & (F.col("gaps") == 0) & (F.col("disagreements") == 0)
    return df.withColumn("ready", ready).withColumn("state", F.when(F.col("ready"), "ready").when(F.col("reconnect_ready"), "degraded").otherwise("unavailable"))


@dataclass
class Health:
    """A correctness stop is final: nothing but a new process leaves it."""

    state: str = "unavailable"
    reason: str | None = None
    stopped: bool = False

    def set(self, state: str, reason: str | None = None) -> None:
        if state not in ("ready", "degraded", "unavailable"):
            raise ValueError(state)
        if not self.stopped:
            self.state, self.reason = state, reason

    def correctness_stop(self, reason: str) -> None:
        self.state, self.reason, self.stopped = "unavailable", reason, True

    @property
    def ok(self) -> bool:
        return self.state == "ready"


@dataclass
class Status:
    """What a run reports; ``frame`` makes it a one-row DataFrame for any sink."""

    checkpoint_height: int | None = None
    head_height: int | None = None
    reorgs: int = 0
    reorg_depth: int = 0
    n_unpublished: int = 0
    oldest_age_s: float = 0.0
    gaps: int = 0
    disagreements: int = 0
    health: Health = field(default_factory=Health)

    @property
    def lag(self) -> int:
        return max(0, (self.head_height or 0) - (self.checkpoint_height or 0))

    def frame(self, spark) -> DataFrame:
        row = {k: v for k, v in asdict(self).items() if k != "health"} | {"lag": self.lag, "state": self.health.state, "reason": self.health.reason}
        schema = "checkpoint_height long, head_height long, reorgs long, reorg_depth long, n_unpublished long, oldest_age_s double, gaps long, disagreements long, lag long, state string, reason string"
        return spark.createDataFrame([tuple(row.values())], schema)


#: A row of the series: a step of a live run, or an event of a streaming query.
SERIES = "at timestamp, kind string, name string, state string, reason string, checkpoint_height long, head_height long, lag long, reorgs long, reorg_depth long, n_applied long, n_rolled_back long, n_unpublished long, oldest_age_s double, disagreements long, batch_id long, input_rows long, rows_per_second double"


class Series:
    """Metrics over time, as a table: a file of JSON lines for every FLUSH rows, so that a long run leaves few files."""

    FLUSH = 64

    def __init__(self, spark: SparkSession, path: str, flush: int = FLUSH):
        self.spark, self.path, self.files, self.flush_at = spark, path.rstrip("/"), Files(spark, path), flush
        self.files.fs.mkdirs(self.files.at(self.path))
        self.rows: list[dict] = []

    def put(self, **row) -> None:
        self.rows.append({"at": datetime.datetime.now(datetime.timezone.utc).isoformat()} | row)
        if len(self.rows) >= self.flush_at:
            self.flush()

    def add(self, status: Status, report) -> None:
        s = {k: v for k, v in asdict(status).items() if k not in ("health", "gaps")}
        self.put(kind="step", name=None, state=report.state, reason=report.reason, lag=status.lag, n_applied=len(report.applied), n_rolled_back=len(report.rolled_back), **s)

    def flush(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            name = f"{rows[0]['at'].replace(':', '').replace('+', '_')}-{uuid.uuid4().hex[:8]}.json"
            self.files.make(f"{self.path}/{name}", "".join(json.dumps(r) + "\n" for r in rows))

    def frame(self) -> DataFrame:
        self.flush()
        return self.spark.read.schema(SERIES).json(self.path)


class QueryMetrics(StreamingQueryListener):
    """Writes the progress and the end of every streaming query of a session to a series."""

    def __init__(self, series: Series):
        self.series = series

    def onQueryStarted(self, event) -> None:
        self.series.put(kind="started", name=event.name or str(event.id), state="ready")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.series.put(kind="progress", name=p.name or str(p.id), state="ready", batch_id=p.batchId, input_rows=p.numInputRows, rows_per_second=p.processedRowsPerSecond)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        failed = event.exception is not None
        self.series.put(kind="ended", name=str(event.id), state="unavailable" if failed else "ready", reason=event.exception[:500] if failed else None)
        self.series.flush()
