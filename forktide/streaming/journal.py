"""Structured Streaming over the journal: ordered at-least-once dispatch and consumer-side dedup.

The journal's folder is a file source; any sink that takes a DataFrame can stand behind ``foreachBatch``.  Marks are written after the
sink has returned, so a crash between the two delivers the same ids again, and the consumer drops what it has seen.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from forktide.operators.journal import messages


def scratch(spark: SparkSession) -> str:
    """A folder in the shared checkpoint folder; on one machine without that setting, a temporary one."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{top.rstrip('/') if top else 'file://' + os.path.join(tempfile.gettempdir(), 'forktide')}/stream-{uuid.uuid4().hex}"


#: A broker's producer that neither loses, doubles nor reorders.
BROKER = {"kafka.acks": "all", "kafka.enable.idempotence": "true", "kafka.max.in.flight.requests.per.connection": "1", "includeHeaders": "true"}


def broker_options(servers: str, topic: str, timeout_seconds: float = 30.0) -> dict[str, str]:
    """The connector's options; a request's own timeout must not be longer than the delivery's."""
    timeout = max(2, int(timeout_seconds * 1000))
    return BROKER | {"topic": topic, "kafka.bootstrap.servers": servers, "kafka.delivery.timeout.ms": str(timeout), "kafka.request.timeout.ms": str(timeout // 2), "kafka.linger.ms": "0"}


def broker_sink(servers: str, topic: str, timeout_seconds: float = 30.0) -> Callable[[DataFrame], None]:
    """A sink for a dispatcher that writes to a broker; it needs Spark's Kafka connector on the class path."""

    def write(messages_: DataFrame) -> None:
        messages_.select("key", "value", "headers").write.format("kafka").options(**broker_options(servers, topic, timeout_seconds)).save()

    return write


def drain(pending: Callable[[], DataFrame], chain_id: int, sink: Callable[[DataFrame], None], mark: Callable[[DataFrame], None], rows: int = 1000) -> int:
    """Publish a journal's unpublished rows in the order of their ids over the whole journal, ``rows`` at a time.

    A part is marked after the sink has taken it and before the next one begins; the first error ends it, so nothing overtakes.
    """
    done = 0
    while True:
        part = pending().where("published_at IS NULL").orderBy("event_id").limit(rows)
        ids = [r["event_id"] for r in part.select("event_id").collect()]  # ``rows`` of them at most
        if not ids:
            return done
        part = part.where(part["event_id"] <= ids[-1])
        sink(messages(part, chain_id).orderBy("event_id"))
        mark(part.sparkSession.createDataFrame([(i,) for i in ids], "event_id long"))
        done += len(ids)


def dispatch_ordered(wake: DataFrame, pending: Callable[[], DataFrame], chain_id: int, sink: Callable[[DataFrame], None], mark: Callable[[DataFrame], None], checkpoint: str, rows: int = 1000) -> StreamingQuery:
    """A stream of new journal files as a wake-up alone: each micro-batch drains the journal itself, so files may come in any order."""
    run = (lambda _, __: drain(pending, chain_id, sink, mark, rows) and None)
    return wake.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def dispatch(journal: DataFrame, chain_id: int, sink: Callable[[DataFrame], None], mark: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Publish the stream's unpublished rows, those of a micro-batch in the order of their ids, then mark them; ``dispatch_ordered`` orders all."""

    def batch(rows: DataFrame, _: int) -> None:
        rows = rows.where("published_at IS NULL")
        sink(messages(rows, chain_id).orderBy("event_id"))
        mark(rows.select("event_id"))

    return journal.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(deliveries: DataFrame) -> DataFrame:
    """Each event id once; the state keeps all ids, as redelivery has no time limit."""
    return deliveries.dropDuplicates(["event_id"])


def deliveries(raw: DataFrame) -> DataFrame:
    """event_id, event_kind, block_height and payload of a broker's rows (value as text or binary).

    Empty values are skipped; one that is no JSON object or has no id fails the query.
    """
    value = F.col("value").cast("string")
    schema = "event_id long, transition_kind string, block_height long, payload string"
    read = raw.where(F.coalesce(F.length(F.trim(value)) > 0, F.lit(False))).select(value.alias("value"), F.from_json(value, schema, {"mode": "PERMISSIVE"}).alias("m"))
    bad = F.raise_error(F.concat(F.lit("a delivery without an event id: "), F.substring("value", 1, 200))).cast("boolean")
    read = read.where(F.when(F.col("m.event_id").isNotNull(), True).otherwise(bad))
    return read.select("m.event_id", F.col("m.transition_kind").alias("event_kind"), "m.block_height", "m.payload")
