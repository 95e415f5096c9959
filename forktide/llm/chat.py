r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, that reply alone is trainable.  The
context of an example is always a prefix of the formatted conversation.  So the output, a folder of two Parquet tables, is linear in
the input:

* ``segments``: conv_id, position, start, formatted: each turn once, formatted, and its first character's place in the conversation;
* ``examples``: conv_id, position, context_end, reply_start, reply_end: an example is the conversation from 0 to reply_end, of
  which 0 to context_end is context and reply_start to reply_end alone is trainable; position is the reply's turn.

``example_texts`` writes examples out in full.

Template: ``[INST] text [/INST]`` for a user, ``text</s>`` for an assistant, ``[SYS] text [/SYS]`` for a system, and
``[ROLE] role [TEXT] text [/ROLE]`` for any other role.  In a text (and such a role) each of the characters ``\ [ <`` has a
backslash put before it, so no marker can stand in it, and taking the backslashes away gives the text back.

A conversation's turns come in order to one task, which holds a turn at a time: a conversation of any length takes a bounded
memory.  Its digest is sequential by definition.

Defined cases: a null text or role is empty; turns go by turn, nulls first, then by role and text; repeated rows are turns of
their own; rows of a null conv_id form one conversation; a conversation without an assistant has no example; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, bounded_batches, partitions, remove, shared_dir, written

MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("", "</s>"), "system": ("[SYS] ", " [/SYS]")}
OTHER = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
PROBE = -7
PROBE_TEXT = "</s>[INST] ok [/INST]"


def escape(text: str) -> str:
    return text.replace("\\", r"\\").replace("[", r"\[").replace("<", r"\<")


def unescape(text: str) -> str:
    """Runs of backslashes begin where an escape does, so pairs of them are those of backslashes in the text."""
    return "\\".join(part.replace(r"\[", "[").replace(r"\<", "<") for part in text.split(r"\\"))


def segment(role: str, text: str) -> tuple[str, int]:
    """The formatted turn and the place in it where the text begins."""
    if role in MARKS:
        before, after = MARKS[role]
    else:
        before, after = OTHER[0] + escape(role) + OTHER[1], OTHER[2]
    return before + escape(text) + after, len(before)


def _end(formatted: str, at: int, marker: str) -> int:
    """Where the next marker that is not escaped begins."""
    found = formatted.find(marker, at)
    while found >= 0:
        before = found
        while before > at and formatted[before - 1] == "\\":
            before -= 1
        if (found - before) % 2 == 0:
            return found
        found = formatted.find(marker, found + 1)
    raise ValueError(f"the turn at character {at} has no end")


def parse(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; start and end are those of the escaped text.  Nothing but the turns' own texts is held."""
    at = 0
    while at < len(formatted):
        role, after = "assistant", MARKS["assistant"][1]
        for name, (before, end) in MARKS.items():
            if before and formatted.startswith(before, at):
                role, after, at = name, end, at + len(before)
        if formatted.startswith(OTHER[0], at) and role == "assistant":
            begin = at + len(OTHER[0])
            middle = _end(formatted, begin, OTHER[1])
            role, after, at = unescape(formatted[begin:middle]), OTHER[2], middle + len(OTHER[1])
        stop = _end(formatted, at, after)
        yield role, unescape(formatted[at:stop]), at, stop
        at = stop + len(after)


FORMATTED = "conv_id long, position long, start long, formatted string, reply_start long, reply_end long"
SEGMENTS = ("conv_id", "position", "start", "formatted")
EXAMPLES = ("conv_id", "position", "context_end", "reply_start", "reply_end")


def _formatted(turns: DataFrame) -> DataFrame:
    """A row for each turn, in order within a partition; an assistant's turn has its reply's place in the conversation."""
    ordered = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = ordered.repartition(partitions(turns.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = arrow_schema(FORMATTED)

    def run(batches):
        last, position, at = (None,), 0, 0
        for b in batches:
            rows = []
            for conv, role, text in zip(*(b.column(i).to_pylist() for i in (0, 2, 3))):
                if last != (conv, 1):
                    last, position, at = (conv, 1), 0, 0
                formatted, lead = segment(role, text)
                reply = role == "assistant"
                end = at + len(formatted) - len(MARKS["assistant"][1])
                rows.append((conv, position, at, formatted, at + lead if reply else None, end if reply else None))
                position, at = position + 1, at + len(formatted)
            yield _batch(rows, schema)

    return ordered.mapInArrow(run, FORMATTED)


def write_examples(turns: DataFrame, path: str) -> None:
    """Write the two tables below path: segments, and an example for every assistant turn."""
    spark = turns.sparkSession
    rows = written(_formatted(turns), f"{path}/formatted")
    rows.select(*SEGMENTS).write.mode("overwrite").parquet(f"{path}/segments")
    examples = rows.where("reply_start IS NOT NULL").withColumn("context_end", F.col("start")).select(*EXAMPLES)
    examples.write.mode("overwrite").parquet(f"{path}/examples")
    remove(spark, f"{path}/formatted")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _side_by_side(spark: SparkSession, path: str) -> DataFrame:
    """Segments and examples of a conversation in one order: an example follows the segment of its reply."""
    empty = [F.lit(None).cast("long").alias(n) for n in EXAMPLES[2:]]
    segments = spark.read.parquet(f"{path}/segments").select(*SEGMENTS, *empty)
    examples = spark.read.parquet(f"{path}/examples").select("conv_id", "position", F.lit(None).cast("long").alias("start"), F.lit(None).cast("string").alias("formatted"), *EXAMPLES[2:])
    both = segments.unionByName(examples).withColumn("kind", F.col("formatted").isNull().cast("int"))
    return both.repartition(partitions(spark), "conv_id").sortWithinPartitions("conv_id", "position", "kind")


def example_texts(spark: SparkSession, path: str) -> DataFrame:
    """conv_id, position, text, reply_start, reply_end: the examples in full, context before the reply."""
    ddl = "conv_id long, position long, text string, reply_start long, reply_end long"
    schema = arrow_schema(ddl)

    def run(batches):
        last, parts = (None,), []
        for b in batches:
            for r in b.to_pylist():
                if last != (r["conv_id"], 1):
                    last, parts = (r["conv_id"], 1), []
                if r["kind"] == 0:
                    parts.append(r["formatted"])
                else:
                    yield _batch([(r["conv_id"], r["position"], "".join(parts), r["reply_start"], r["reply_end"])], schema)

    return _side_by_side(spark, path).mapInArrow(run, ddl)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_examples long, example_chars long"


class _Digest:
    """What is read back of one conversation, segment by segment and example by example."""

    def __init__(self):
        self.turns, self.loss, self.segment = hashlib.sha256(), hashlib.sha256(), None
        self.n = self.chars = self.at = self.examples = self.example_chars = 0

    def add(self, r: dict) -> None:
        if r["kind"]:
            return self.example(r)
        if r["position"] != self.n or r["start"] != self.at:
            raise ValueError("a segment is missing or out of order")
        self.segment, turns = r, 0
        for role, text, *_ in parse(r["formatted"]):
            turns += 1
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        self.n, self.at = self.n + turns, self.at + len(r["formatted"])

    def example(self, r: dict) -> None:
        s = self.segment
        if s is None or s["position"] != r["position"] or not r["context_end"] == s["start"] <= r["reply_start"] <= r["reply_end"] <= self.at:
            raise ValueError("an example has no reply behind its context")
        reply = unescape(s["formatted"][r["reply_start"] - s["start"] : r["reply_end"] - s["start"]])
        self.loss.update(reply.encode("utf-8", "surrogatepass"))
        self.chars, self.examples, self.example_chars = self.chars + len(reply), self.examples + 1, self.example_chars + self.at

    def row(self, conv_id: int | None) -> tuple:
        return conv_id, self.n, self.turns.hexdigest(), self.chars, self.loss.hexdigest(), self.at, self.examples, self.example_chars


def read_back(spark: SparkSession, path: str) -> DataFrame:
    """Turns of each conversation from its segments, and the text under the loss mask from its examples, as they are in the files."""
    schema = arrow_schema(DIGEST)

    def run(batches):
        last, digest = (None,), None
        for b in batches:
            rows = []
            for r in b.to_pylist():
                if last != (r["conv_id"], 1):
                    if digest:
                        rows.append(digest.row(last[0]))
                    last, digest = (r["conv_id"], 1), _Digest()
                digest.add(r)
            yield _batch(rows, schema)
        if digest:
            yield _batch([digest.row(last[0])], schema)

    return _side_by_side(spark, path).mapInArrow(run, DIGEST)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark, 1024)
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(PROBE, 0, "user", PROBE_TEXT), (PROBE, 1, "assistant", PROBE_TEXT)], "conv_id long, turn long, role string, text string")
    path = shared_dir(spark)
    write_examples(turns.unionByName(probe), path)
    return read_back(spark, path)


ORACLE_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))),
sized AS (
  SELECT *, CAST(length(replace(replace(replace(text, '\\', '\\\\'), '[', '\\['), '<', '\\<')) AS BIGINT)
            + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 4 WHEN 'system' THEN 13
              ELSE 23 + length(replace(replace(replace(role, '\\', '\\\\'), '[', '\\['), '<', '\\<')) END AS chars FROM turns),
placed AS (SELECT *, CAST(sum(chars) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM sized)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars,
       CAST(count(*) FILTER (role = 'assistant') AS BIGINT) AS n_examples,
       CAST(coalesce(sum(upto) FILTER (role = 'assistant'), 0) AS BIGINT) AS example_chars
FROM placed GROUP BY conv_id
"""
