"""Packing by vector bin packing with the dot-product heuristic.

A sequence has limits on three things at once: tokens, segments and loss-bearing tokens.  One sequence is open at a time.
Of the pieces that fit, the one with the largest dot product of its demand and what the sequence has left, each a share of
its limit and weighted by what the waiting pieces ask for in all, goes in next.  Where pieces may be cut, the piece with the
largest dot product of those that no longer fit is cut to fill the sequence to its last token.

Each task packs the rows that it reads, WAITING pieces at a time, so nothing is shuffled, memory is bounded and a lost task
is redone alone; a sequence's id holds its partition.  Text longer than a sequence gives whole sequences first.  What is left
at the end of a partition goes to sequences whose lengths are powers of two, which need no padding.

Defined cases: a null text counts as empty and still has its end id; repeated rows are packed each on its own; a null doc_id
is carried; an empty table gives an empty result; other columns are ignored.  Without a column of loss-bearing spans, and where
it is null, every token bears loss, so with LOSS = LENGTH the token limit implies the loss limit.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, documents, map_arrow
from .tokens import encoder, forget, public_path

LENGTH = 4096
#: Segments of one sequence; loss-bearing tokens of one sequence.
SEGMENTS = 256
LOSS = 4096
END_ID = 2
#: Pieces that wait for a place in one task.
WAITING = 1024


@dataclass
class Piece:
    item: int
    start: int
    length: int
    #: Loss-bearing tokens in it.
    loss: int


Sequence = list[Piece]


class Packer:
    """Packs pieces as they come; ``add`` and ``finish`` yield complete sequences.

    cut: pieces may be cut anywhere.  The first token of a piece bears no loss; of the others all do, or those that ``bearing`` tells.
    """

    def __init__(self, length: int = LENGTH, segments: int = SEGMENTS, loss: int = LOSS, cut: bool = True, waiting: int = WAITING):
        self.limits, self.cut, self.waiting = np.array([length, segments, loss], float), cut, waiting
        self.pieces: list[Piece] = []
        #: Of each waiting item with spans, how many of its first k tokens bear loss, for k from 0.
        self.bearing: dict[int, np.ndarray] = {}

    def piece(self, item: int, start: int, length: int, loss: int | None = None) -> Piece:
        if loss is None and (before := self.bearing.get(item)) is not None:
            loss = int(before[start + length] - before[start + 1])
        return Piece(item, start, length, max(0, length - 1) if loss is None else loss)

    def most(self, item: int, start: int, length: int, loss: int) -> int:
        """The largest length up to the given one of a piece that begins at start and has no more loss than given."""
        before = self.bearing.get(item)
        if before is None:
            return min(length, loss + 1)
        return min(length, int(np.searchsorted(before, before[start + 1] + loss, "right")) - 1 - start)

    def add(self, item: int, length: int, loss: int | None = None, bearing: np.ndarray | None = None) -> Iterator[Sequence]:
        """loss: a count for an item that is not cut; bearing: for each token of one that may be, whether it bears loss."""
        top, start = int(self.limits[0]), 0
        if loss is not None and self.cut or bearing is not None and not self.cut:
            raise ValueError("items that may be cut take bearing, others loss")
        if bearing is not None:
            self.bearing[item] = np.concatenate(([0], np.cumsum(bearing)))
        if self.cut:
            while length > start:
                whole = self.most(item, start, min(top, length - start), int(self.limits[2]))
                if whole == length - start < top:
                    break
                yield [self.piece(item, start, whole)]
                start += whole
        elif length > top or (loss or 0) > self.limits[2]:
            raise ValueError(f"item {item} does not fit into a sequence")
        if length > start:
            self.pieces.append(self.piece(item, start, length - start, loss if not self.cut else None))
        if len(self.pieces) >= self.waiting:
            yield from self.drain(keep=self.waiting // 2)

    def finish(self) -> Iterator[Sequence]:
        yield from self.drain(keep=0)

    def drain(self, keep: int) -> Iterator[Sequence]:
        """Sequences of the waiting pieces until ``keep`` are left."""
        pieces = self.pieces
        n = len(pieces)
        demand = np.array([[p.length, 1, p.loss] for p in pieces], float).reshape(-1, 3) / self.limits
        free, left = np.ones(n, bool), n
        total = demand.sum(0)
        while left > keep:
            if keep == 0 and self.cut and total[0] * self.limits[0] < self.limits[0] and total[2] < 1 + 1e-9:
                break
            room, sequence = np.ones(3), []
            while left:
                value = demand @ (room * total)
                value[~free] = -1
                fits = (demand <= room + 1e-12).all(1)
                best = int(np.argmax(np.where(fits, value, -1)))
                if value[best] >= 0 and fits[best]:
                    sequence.append(pieces[best])
                    room, total = room - demand[best], total - demand[best]
                    free[best], left = False, left - 1
                    continue
                gap = round(float(room[0] * self.limits[0]))
                if self.cut and gap >= 1 and room[1] * self.limits[1] >= 0.5:
                    best = int(np.argmax(value))
                    p = pieces[best]
                    gap = self.most(p.item, p.start, gap, round(float(room[2] * self.limits[2])))
                    if p.length > gap:
                        sequence.append(self.piece(p.item, p.start, gap))
                        pieces[best] = self.piece(p.item, p.start + gap, p.length - gap)
                        total = total - demand[best]
                        demand[best] = np.array([pieces[best].length, 1, pieces[best].loss]) / self.limits
                        total = total + demand[best]
                break
            yield sequence
        self.pieces = [p for p, f in zip(pieces, free) if f]
        if self.bearing:
            waits = {p.item for p in self.pieces}
            self.bearing = {k: v for k, v in self.bearing.items() if k in waits}
        if keep == 0 and self.pieces:
            yield from self.tail()

    def tail(self) -> Iterator[Sequence]:
        """The last pieces, less than a sequence in all, in sequences whose lengths are powers of two."""
        pieces, self.pieces = self.pieces[::-1], []
        left = sum(p.length for p in pieces)
        while left:
            size, sequence = 1 << (left.bit_length() - 1), []
            while size and len(sequence) < self.limits[1]:
                p = pieces.pop()
                if p.length > size:
                    pieces.append(self.piece(p.item, p.start + size, p.length - size))
                    p = self.piece(p.item, p.start, size)
                sequence.append(p)
                size, left = size - p.length, left - p.length
            yield sequence


def in_spans(spans: list[dict], n: int) -> np.ndarray:
    """For each of n tokens whether it lies in a span."""
    out = np.zeros(n, bool)
    for s in spans:
        out[max(0, s["start"]) : max(0, s["end"])] = True
    return out


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, loss_tokens long"


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID, length: int = LENGTH, segments: int = SEGMENTS, loss: int = LOSS, with_ids: bool = False, loss_spans: str | None = None, remember: bool = True) -> DataFrame:
    """A row for each piece; with_ids adds the piece's ids as binary (little-endian unsigned 32-bit).

    loss_spans: a column array<struct<start, end>> of the tokens that bear loss, ends excluded; spans are cut with the pieces.
    remember: whether a worker keeps the ids of chunks for its next task, some 0.4 GB.
    """
    schema = SCHEMA + ", ids binary" * with_ids
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        from pyspark import TaskContext

        packer, held, number = Packer(length, segments, loss), {}, 0
        sequence_id = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def place(sequences):
            nonlocal sequence_id
            for s in sequences:
                at = 0
                for p in s:
                    doc, ids = held[p.item]
                    part = ids[4 * p.start : 4 * (p.start + p.length)]
                    rows.append((doc, p.start, p.length, zlib.crc32(part), len(ids) // 4, sequence_id, at, p.loss, *[part] * with_ids))
                    at += p.length
                sequence_id += 1

        def out():
            columns = list(zip(*rows)) or [()] * len(arrow)
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            spans = b.column(2).to_pylist() if loss_spans else [None] * len(keys)
            for doc, ids, some in zip(keys, encoder(tokenizer).encode(texts), spans):
                held[number] = (doc, ids + end)
                n = len(ids) // 4 + 1
                place(packer.add(number, n, bearing=None if some is None else in_spans(some, n)))
                number += 1
            waits = {p.item for p in packer.pieces}
            held = {k: held[k] for k in waits}
            yield out()
        place(packer.finish())
        if not remember:
            forget(tokenizer)
        yield out()

    return docs.select("doc_id", "text", *[loss_spans] * bool(loss_spans)).mapInArrow(run, schema)


def conversation_documents(turns: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id (the conv_id), text and spans of each conversation of (conv_id, turn, role, text): an assistant's tokens bear loss.

    Turns stand one under the other; the tokenizer joins nothing across a line's end, so a turn's tokens are those of its text.
    """

    def count(r):
        return {"conv_id": r["conv_id"], "turn": r["turn"], "role": r["role"], "text": r["text"], "n": [len(x) // 4 for x in encoder(tokenizer).encode(r["text"])]}

    def spans(r):
        out = []
        for turns_ in r["turns"]:
            at, mine = 0, []
            for t in turns_:
                if t["role"] == "assistant" and t["n"]:
                    mine.append({"start": at, "end": at + t["n"]})
                at += t["n"]
            out.append(mine)
        return {"doc_id": r["conv_id"], "text": ["\n".join(t["text"] or "" for t in x) for x in r["turns"]], "spans": out}

    counted = map_arrow(turns.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text"), count, "conv_id long, turn long, role string, text string, n long")
    whole = counted.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "n"))).alias("turns"))  # a conversation's own
    return map_arrow(whole, spans, "doc_id long, text string, spans array<struct<start: long, end: long>>")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return pack_documents(documents(spark, sf_dir), public_path("word_bpe_49k.json"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces; the last stage.  Workers that go on to other stages keep no ids."""
    bounded_batches(spark)
    return pack_documents(docs, public_path("word_bpe_49k.json"), remember=False)
