r"""Exact deduplication of long byte strings with sorted suffixes.

Texts are UTF-8 bytes.  A window is WINDOW consecutive bytes of one text; each byte goes that is covered by a window which also starts
earlier: in a document of smaller doc_id, or earlier in the same one.  Suffixes are compared by their first WINDOW bytes, as
nothing behind them matters.  The corpus' suffix array is never in one place; it is parted by minimiser:

1. a window's minimiser is the smallest hash of the GRAM-byte runs in it, the leftmost of equals, so equal windows have equal ones.
   Each row's text is known by its 128-bit digest; a text of several rows goes on once, as its first row's, and its other rows lose
   every window without being looked at;
2. minimisers with one place in the corpus need no look at their suffixes;
3. consecutive windows with one minimiser at one place are a stretch; the stretches of the others go to their minimiser's bucket.  A task
   sends a stretch's bytes with its first two places, and with any place that is before all it has met: enough to know the first place of
   all, and whether there are others;
4. a bucket puts the suffixes of its distinct stretches in order (``suffix_sort``: multikey quicksort to a shallow depth, then blind tries);
   in each class of equal windows the first place stays.  A minimiser with more than BUCKET distinct stretches is dealt again:
   its stretches are cut where a second minimiser, by another hash of LONG_GRAM bytes, changes, and where one of those has too many again, into windows, dealt by
   their digest.  Runs that long seldom lie within what a crowd has in common, so most parts are alone in their buckets;
   So a bucket is bounded, and all levels are sorted alike;
5. a stretch's answer is its first place and a mask of the windows that go there; at any other place all of its windows go.  Answers
   are joined to the places, and by text to the rows.

Nothing is collected; what is broadcast are bitmaps of 8 MB (``likely``).

Order of documents: by doc_id, null first, then by the text's digest.  Defined cases: a null text is empty; a text shorter than a window loses
nothing; of rows that are alike in doc_id and text one stays and the others lose all their windows; rows of one doc_id with different
texts are documents of their own; a text of any length is taken whole, as are bytes that are cut amid a character; an empty table gives an empty
result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, discard, documents, gram_hashes, likely, map_arrow, mix64, remove, shared_dir, tables_made, written
from .substrings import _task, digest, merged
from .suffix_sort import CHAR, WINDOW, equal_windows

GRAM, LONG_GRAM = 40, 80
#: Distinct stretches of one bucket; a minimiser with more is dealt again.
BUCKET = 2048
#: Stretches that a task remembers before it begins anew.
REMEMBERED = 200_000
#: Bytes whose minimisers are looked for at once, about.
TOGETHER = 1 << 19
#: Windows that are put in order at once, about.
SORTED = 200_000
#: The low bits of a hash give way to its place, so that one minimum finds both; the gram's whole hash is the minimiser.
PLACE = 24

#: Hashes of bytes, for either length of grams its own.
_BYTES = {gram: mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(odd)) for gram, odd in ((GRAM, 0x9E3779B97F4A7C15), (LONG_GRAM, 0xD1342543DE82EF95))}


def _minimum(h: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest of each ``width`` hashes, without their low bits, the leftmost of equals."""
    low = np.uint64((1 << PLACE) - 1)
    best, reach = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1
    while reach < width:
        step = min(reach, width - reach)
        best = np.minimum(best[:-step], best[step:])
        reach += step
    return (best & low).astype(np.int64)


def _parts(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text, first byte, bytes) of what is looked at together; a long text comes in parts that share all but one byte of a window."""
    some, size = [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - WINDOW + 1, TOGETHER):
            part = text[at : at + TOGETHER + WINDOW - 1]
            some.append((i, at, part))
            size += len(part)
            if size >= TOGETHER:
                yield some
                some, size = [], 0
    if some:
        yield some


def stretches(texts: list[bytes], gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, minimiser, first window, number of windows) of each stretch of some texts, in order."""
    found = []
    for some in _parts(texts):
        sizes = np.array([len(p) for *_, p in some])
        begins = np.cumsum(sizes) - sizes
        grams = gram_hashes(_BYTES[gram][np.frombuffer(b"".join(p for *_, p in some), np.uint8)], gram)
        place = _minimum(grams, WINDOW - gram + 1)
        inside = np.ones(len(place), bool)  # windows that lie in one text
        for b in begins[1:].tolist():
            inside[b - WINDOW + 1 : b] = False
        same = inside[1:] & inside[:-1] & (place[1:] == place[:-1])
        first = np.flatnonzero(inside & np.concatenate(([True], ~same)))
        last = np.flatnonzero(inside & np.concatenate((~same, [True])))
        part = np.searchsorted(begins, first, "right") - 1
        text, offset = np.array([i for i, *_ in some]), np.array([at for _, at, _ in some])
        found.append((text[part], grams[place[first]].view(np.int64), first - begins[part] + offset[part], last - first + 1))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 4


def _lists(edges: np.ndarray, values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(values, pa.int64()))


def order_of():
    """What documents are ordered by, before their texts."""
    return F.struct(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"))


def distinct_texts(keyed: DataFrame, path: str | None = None) -> DataFrame:
    """text_id, minimisers (one a stretch), first (its first row's doc_id), again (whether it has other rows); without texts shorter than a window."""

    def f(r):
        text, minimiser, *_ = stretches(r["text"])
        at = np.searchsorted(text, np.arange(len(r["text"]) + 1))
        keep = np.flatnonzero(np.diff(at))
        return {"text_id": [r["text_id"][i] for i in keep], "doc_id": [r["doc_id"][i] for i in keep], "minimisers": _lists(np.concatenate((at[keep], at[-1:])), minimiser)}

    rows = map_arrow(keyed.where(F.octet_length("text") >= WINDOW), f, "text_id binary, doc_id long, minimisers array<long>")
    return written(rows.groupBy("text_id").agg(F.any_value("minimisers").alias("minimisers"), F.min(order_of()).alias("first"), (F.count("*") > 1).alias("again")), path)


def asked_texts(texts: DataFrame) -> DataFrame:
    """text_id, first, asked array<struct<minimiser, places>>: of each text its minimisers with more than one place."""
    places = texts.select("text_id", F.explode("minimisers").alias("minimiser"))
    counts = written(places.groupBy("minimiser").agg(F.count("*").alias("places")).where("places > 1"))
    found = likely(places, "minimiser", counts, True).join(counts, "minimiser")
    asked = found.groupBy("text_id").agg(F.collect_set(F.struct("minimiser", "places")).alias("asked"))  # a text's own
    return written(asked.join(texts.select("text_id", "first"), "text_id"))


#: A place of a stretch, with its bytes or without; known, doc_id, text_id and start order places.
FOUND = "known boolean, doc_id long, text_id binary, start long, n int, minimiser long, places long, stretch binary, packed binary"


class Met:
    """Tells whether a place of a stretch is one of the first two that a task meets, or before all of them."""

    def __init__(self):
        self.met: dict[tuple, list] = {}

    def wanted(self, key: tuple, place: tuple) -> bool:
        old = self.met.get(key)
        if old is None:
            if len(self.met) >= REMEMBERED:
                self.met.clear()
            self.met[key] = [1, place]
            return True
        old[0] += 1
        if place < old[1]:
            old[1] = place
            return True
        return old[0] == 2


def found_stretches(keyed: DataFrame, asked: DataFrame) -> DataFrame:
    """A row for each place of the stretches of repeated minimisers, some with the bytes."""
    some = likely(keyed.select("text_id", "text"), "text_id", asked, True)

    def f(batches):
        met, last = Met(), None
        for rows in batches:
            fresh = []
            for text_id, text, first, wanted in rows:
                if text_id != last:  # a text's other rows come right after it and add nothing
                    last = text_id
                    fresh.append((text, (first["known"], first["doc_id"], text_id), wanted))
            places = {x["minimiser"]: x["places"] for *_, wanted in fresh for x in wanted}
            text, minimiser, start, n = stretches([t for t, *_ in fresh])
            hit = np.flatnonzero(np.isin(minimiser, np.fromiter(places, np.int64, len(places))))
            out = []
            for i, m, at, size in zip(*(x[hit].tolist() for x in (text, minimiser, start, n))):
                whole, order, _ = fresh[i]
                packed = whole[at : at + size + WINDOW - 1]
                key, place = digest(packed), (*order, at)
                sent = (m, places[m], key, packed) if met.wanted(key, place) else (None, None, key, None)
                out.append((*place, size, *sent))
                if len(out) >= 8192:
                    yield out
                    out = []
            yield out

    joined = some.join(asked, "text_id").select("text_id", "text", "first", "asked")
    return written(_task(joined, f, FOUND))


#: What is dealt to a bucket: a piece (a stretch or a part of one) at a place.
PIECES = ("minimiser", "salt", "piece", "known", "doc_id", "text_id", "start", "packed")
ANSWERS = "piece binary, known boolean, doc_id long, text_id binary, start long, mask long"


def _bucket_answers(rows: list[tuple]) -> list[tuple]:
    """rows: (bucket, piece, place, whether it has others, bytes) of whole buckets, each piece once, those of a bucket together.  Answers of the pieces that lose something
    somewhere."""
    masks = [0] * len(rows)
    at = 0
    while at < len(rows):
        end, windows = at, 0
        while end < len(rows) and (end == at or rows[end][0] == rows[end - 1][0] or windows < SORTED):
            windows += len(rows[end][4]) - WINDOW + 1
            end += 1
        part = rows[at:end]
        buckets = np.unique(np.array([r[0] for r in part]), return_inverse=True)[1]
        shared = np.flatnonzero(np.bincount(buckets)[buckets] > 1)  # a bucket of one piece has no equal windows
        if len(shared):
            sizes = np.array([len(part[i][4]) for i in shared])
            begins, n = np.cumsum(sizes) - sizes, sizes - WINDOW + 1
            owner = np.repeat(np.arange(len(shared)), n)
            offset = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            segment = np.flatnonzero(np.concatenate(([True], np.diff(buckets[shared]) != 0)))
            order, cls = equal_windows(b"".join(part[i][4] for i in shared) + bytes(CHAR), begins[owner] + offset, np.add.reduceat(n, segment))
            who = np.searchsorted(begins, order, "right") - 1
            many = np.flatnonzero(np.bincount(cls)[cls] > 1)
            who, cls, at_ = who[many], cls[many], (order - begins[who])[many]
            texts = [part[i][2][:3] for i in shared]
            rank = {t: k for k, t in enumerate(sorted(set(texts)))}
            begin = np.array([part[i][2][3] for i in shared])
            by = np.lexsort((begin[who] + at_, np.array([rank[t] for t in texts])[who], cls))
            later = by[1:][cls[by[1:]] == cls[by[:-1]]]  # all but the first of each class
            for i, j in zip(who[later].tolist(), at_[later].tolist()):
                masks[at + shared[i]] |= 1 << j
        at = end
    return [(r[1], *r[2], m) for r, m in zip(rows, masks) if m or r[3]]


def bucket_answers(pieces: DataFrame) -> DataFrame:
    """For each piece of PIECES that has several places or an earlier equal window: its first place, and a mask of the windows that go there."""
    ordered = pieces.select(*PIECES).repartition("minimiser", "salt").sortWithinPartitions("minimiser", "salt", "piece", "known", "doc_id", "text_id", "start")

    def f(batches):
        held, windows, number, bucket = [], 0, 0, None
        for rows in batches:
            for minimiser, salt, piece, known, doc_id, text_id, start, packed in rows:
                if bucket != (minimiser, salt):
                    bucket, number = (minimiser, salt), number + 1
                    if windows >= SORTED:
                        yield _bucket_answers(held)
                        held, windows = [], 0
                elif held[-1][1] == piece:  # at a later place
                    held[-1][3] = True
                    continue
                held.append([number, piece, (known, doc_id, text_id, start), False, packed])
                windows += len(packed) - WINDOW + 1
        yield _bucket_answers(held)

    return _task(ordered, f, ANSWERS)


#: A part of a piece that is dealt again: where it lies in it, its own place, and its bytes or not.
PARTS = "whole binary, at int, n int, minimiser long, salt long, piece binary, known boolean, doc_id long, text_id binary, start long, packed binary"


def _parted(pieces: DataFrame, cut) -> DataFrame:
    """Parts of pieces, each of which comes once.  cut(bytes, salts) gives (first window, windows, salt) of the parts of a piece."""

    def f(batches):
        met = Met()
        for rows in batches:
            out = []
            for minimiser, piece, known, doc_id, text_id, start, packed, salts in rows:
                for at, n, salt in cut(packed, salts):
                    part = packed[at : at + n + WINDOW - 1]
                    key, place = digest(part), (known, doc_id, text_id, start + at)
                    out.append((piece, at, n, minimiser, salt, key, *place, part if met.wanted((minimiser, salt, key), place) else None))
                if len(out) >= 8192:
                    yield out
                    out = []
            yield out

    return written(_task(pieces.select("minimiser", "piece", "known", "doc_id", "text_id", "start", "packed", "salts"), f, PARTS))


def _second_minimisers(packed: bytes, _: int) -> list[tuple[int, int, int]]:
    _, minimiser, start, n = stretches([packed], LONG_GRAM)
    return list(zip(start.tolist(), n.tolist(), minimiser.tolist()))


def _windows(packed: bytes, salts: int) -> list[tuple[int, int, int]]:
    return [(j, 1, int.from_bytes(digest(packed[j : j + WINDOW])[:6], "little") % salts) for j in range(len(packed) - WINDOW + 1)]


def place_of():
    return F.struct("known", "doc_id", "text_id", "start")


def answers(pieces: DataFrame, level: int = 0, sure: DataFrame | None = None) -> DataFrame:
    """bucket_answers() of PIECES (and of ``sure``, whose buckets are small), with crowded buckets dealt again: level 0 has stretches, 1 parts of one
    second minimiser, 2 windows."""
    few, more, keys = pieces.select(*PIECES), None, ["minimiser", "salt"]
    if level < 2:
        crowded = written(pieces.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > BUCKET).select(*keys, F.ceil(F.col("rows") * (WINDOW - GRAM + 1) / BUCKET).alias("salts")))
        if not crowded.isEmpty():
            few = few.join(crowded, keys, "left_anti")
            more = _dealt_again(pieces.join(crowded, keys), level)
    few = few if sure is None else few.unionByName(sure.select(*PIECES))
    return bucket_answers(few) if more is None else bucket_answers(few).unionByName(more)


def gone(mask: str, first: str) -> Column:
    """The windows that go at a place: those of the mask at the first one, all at any other.  The place is text_id, start and n."""
    here = (F.col(f"{first}.text_id") == F.col("text_id")) & (F.col(f"{first}.start") == F.col("start"))
    return F.when(here, F.col(mask)).otherwise(F.expr("shiftleft(1L, n) - 1"))


def _dealt_again(crowded: DataFrame, level: int) -> DataFrame:
    """The answers of pieces from those of their parts."""
    own = crowded.groupBy("minimiser", "piece", "salts").agg(F.min(place_of()).alias("first"), F.count("*").alias("times"), F.any_value("packed").alias("packed"))
    own = written(own.select("minimiser", "piece", "salts", "first.*", "times", "packed"))
    parts = _parted(own, _windows if level else _second_minimisers)
    known = answers(parts.where("packed IS NOT NULL"), level + 1).select("piece", F.struct("text_id", "start").alias("first"), "mask")
    places = parts.select("whole", "at", "n", "piece", "text_id", "start").join(known, "piece")
    masks = places.select("whole", F.call_function("shiftleft", gone("mask", "first"), F.col("at")).alias("mask")).groupBy("whole").agg(F.bit_or("mask").alias("mask"))
    found = own.join(masks, own["piece"] == masks["whole"], "left").withColumn("mask", F.coalesce("mask", F.lit(0).cast("long")))
    return found.where("mask <> 0 OR times > 1").select("piece", "known", "doc_id", "text_id", "start", "mask")


def text_hits(keyed: DataFrame, asked: DataFrame) -> DataFrame:
    """text_id, hits array<struct<start, mask>> of each text, as its first row has it, that loses windows."""
    found = found_stretches(keyed, asked)
    pieces = found.where("packed IS NOT NULL").withColumn("salt", F.lit(0).cast("long")).withColumnRenamed("stretch", "piece")
    known = answers(pieces.where(F.col("places") > BUCKET), sure=pieces.where(F.col("places") <= BUCKET))
    known = known.select(F.col("piece").alias("stretch"), F.struct("text_id", "start").alias("first"), "mask")
    places = found.select("stretch", "text_id", "start", "n").join(known, "stretch")
    return places.select("text_id", "start", gone("mask", "first").alias("mask")).where("mask <> 0").groupBy("text_id").agg(F.collect_list(F.struct("start", "mask")).alias("hits"))


def mask_spans(hits: list[dict]) -> list[tuple[int, int]]:
    """The spans of bytes under the masks' windows."""
    spans = []
    for h in hits:
        at, mask = h["start"], h["mask"]
        while mask:
            skip = (mask & -mask).bit_length() - 1
            mask >>= skip
            run = (~mask & (mask + 1)).bit_length() - 1
            spans.append((at + skip, at + skip + run - 1 + WINDOW))
            at, mask = at + skip + run, mask >> run
    return merged(spans)


def kept_bytes(text: bytes, hits: list[dict] | None, copy: bool) -> tuple[int, bytes]:
    """(number of removed spans, the other bytes)."""
    spans = [(0, len(text))] * (len(text) >= WINDOW) if copy else mask_spans(hits or [])
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return len(spans), b"".join([*out, text[at:]])


KEPT = "doc_id long, n_bytes long, n_spans long, kept binary"


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_spans (maximal runs of removed bytes) and kept (the other bytes) of every row of docs, which has doc_id and text."""
    keyed = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")).withColumn("text_id", F.unhex(F.md5("text")))
    twins = written(keyed.groupBy("text_id", "doc_id").agg(F.count("*").alias("n")).where("n > 1"))
    kept_table, mark = shared_dir(docs.sparkSession), tables_made()
    texts_table = shared_dir(docs.sparkSession)
    texts = distinct_texts(keyed, texts_table)
    asked, again = asked_texts(texts), written(texts.where("again").select("text_id", "first"))
    remove(docs.sparkSession, texts_table)  # the largest table, and no longer needed
    info = written(text_hits(keyed, asked).join(again, "text_id", "full"), kept_table)
    discard(docs.sparkSession, mark)
    nothing = [F.lit(None).cast(info.schema[c].dataType).alias(c) for c in ("hits", "first")]
    joined = likely(keyed, "text_id", info, True).join(info, "text_id", "left").select("doc_id", "text", "text_id", "hits", "first")
    rows = joined.unionByName(likely(keyed, "text_id", info, False).select("doc_id", "text", "text_id", *nothing))
    rows = rows.withColumn("copy", F.col("first").isNotNull() & (F.col("first") != order_of()))

    def f(r):
        done = [kept_bytes(*x) for x in zip(r["text"], r["hits"], r["copy"])]
        return {"doc_id": r["doc_id"], "n_bytes": list(map(len, r["text"])), "n_spans": [n for n, _ in done], "kept": [k for _, k in done]}

    if twins.isEmpty():
        return map_arrow(rows.drop("first", "text_id"), f, KEPT)
    # rows that are alike in doc_id and text: the first of them is looked at once, the others are copies
    alike = rows.join(twins, rows["text_id"].eqNullSafe(twins["text_id"]) & rows["doc_id"].eqNullSafe(twins["doc_id"]) & ~rows["copy"], "left_anti")
    one = rows.where("NOT copy").join(twins.select("text_id", F.col("doc_id").alias("twin_id"), "n"), "text_id").where(F.col("doc_id").eqNullSafe(F.col("twin_id")))
    one = one.groupBy("doc_id", "text_id", "n").agg(F.any_value("text").alias("text"), F.any_value("hits").alias("hits"))
    each = one.select("doc_id", "text", "hits", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("turn"))
    each = each.select("doc_id", "text", F.when(F.col("turn") == 1, F.col("hits")).alias("hits"), (F.col("turn") > 1).alias("copy"))
    return map_arrow(alike.select("doc_id", "text", "hits", "copy").unionByName(each), f, KEPT)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    kept = without_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = f"""
WITH texts AS (SELECT doc_id, hex(coalesce(text, '')) AS x, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
parts AS (SELECT doc_id, n, p, substr(x, 2 * p + 1, {2 * (WINDOW + 199)}) AS y FROM (SELECT doc_id, x, n, unnest(range(0, n - {WINDOW - 1}, 200)) AS p FROM texts)),
starts AS (SELECT doc_id, p + j AS i, md5_number(substr(y, 2 * j + 1, {2 * WINDOW})) AS w FROM (SELECT doc_id, p, y, unnest(range(least(200, n - {WINDOW - 1} - p))) AS j FROM parts)),
firsts AS (SELECT w, min(row(doc_id, i)) AS f FROM starts GROUP BY w HAVING count(*) > 1),
hits AS (SELECT doc_id, i FROM starts JOIN firsts USING (w) WHERE row(doc_id, i) <> f),
linked AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS below FROM hits),
numbered AS (SELECT doc_id, i, sum(CASE WHEN below IS NULL OR i > below + {WINDOW} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM linked),
spans AS (SELECT doc_id, k, min(i) AS a, max(i) + {WINDOW} AS b, lead(min(i)) OVER (PARTITION BY doc_id ORDER BY k) AS following FROM numbered GROUP BY doc_id, k),
cut AS (SELECT doc_id, min(a) AS head, sum(b - a) AS n_removed, count(*) AS n_spans, list(b ORDER BY k) AS ends, list(coalesce(following, -1) ORDER BY k) AS upto FROM spans GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN x ELSE substr(x, 1, CAST(2 * head AS BIGINT)) || list_aggregate(list_transform(list_zip(ends, upto),
    lambda z: substr(x, CAST(2 * z[1] + 1 AS BIGINT), CAST(CASE WHEN z[2] < 0 THEN 2 * n ELSE 2 * (z[2] - z[1]) END AS BIGINT))), 'string_agg', '') END)) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""
