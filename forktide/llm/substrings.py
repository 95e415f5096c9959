r"""Exact substring deduplication by super-k-mer partitioning.

A window is WINDOW consecutive words (``[^\x20\x09-\x0D]+``) of one document.  Every word that a window covers whose word
sequence also starts anywhere else goes.

A window's minimiser is the smallest hash of the GRAM-word runs in it, the leftmost of equals.  Consecutive windows with
their minimiser at one place are a super-k-mer.  Equal windows have equal minimisers, at places of their own, so a minimiser with a
single place in the corpus needs no look at its words.  The steps:

1. each row's text is known by its 128-bit digest from here on.  A text of several rows goes on once; as all its windows are
   repeated, all of it goes, and copies neither travel nor multiply;
2. the minimisers' places are counted, summed before the shuffle; each text is told which of its minimisers are repeated;
3. the super-k-mers of those travel as one packed string each to their minimiser's bucket.  A task sends a string's words
   twice at most, however often it meets it: twice is enough to know that it is repeated;
4. a bucket sorts the windows of its distinct strings and counts them: runs of equal ones are repeats.  A minimiser with more
   than BUCKET strings is dealt again: its strings are cut into super-k-mers of a second minimiser, by runs of LONG_GRAM words, and go to that one's
   bucket, again twice a task at most.  Where even such a bucket is crowded, parts are cut into windows, which go by a hash of their words.  So a
   bucket is bounded, and what is sorted and compared is whole words everywhere;
5. each distinct string's repeated windows are a mask, which is joined to the string's places, and by text to the rows.

Strings and windows are matched with the bucket's answers by 128-bit digests.  What is broadcast is a bitmap of 8 MB, which spares the
texts without candidates a shuffle (``likely``); nothing is collected.

Defined cases: a null or empty text has no words; a text shorter than a window loses nothing; repeated rows, and rows of one
text under several or null doc_ids, are repeats of each other and so lose their windows; an empty table gives an empty
result; further columns, whatever their names, stay in the stage and are ignored by the query.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, bounded_batches, documents, gram_hashes, likely, map_arrow, numbered, word_hashes, words_of, written

WINDOW = 35
GRAM, LONG_GRAM = 12, 24
#: Strings of one bucket; a minimiser with more is dealt again.
BUCKET = 1024
#: Digests that a task remembers to have sent, before it begins anew.
REMEMBERED = 200_000
WORD = re.compile(r"[^\x20\x09-\x0d]+")


def first_minima(h: np.ndarray, width: int) -> np.ndarray:
    """For each run of width values the index of its leftmost minimum, by doubling the reach."""
    index, value, reach = np.arange(len(h)), h, 1
    while reach < width:
        step = min(reach, width - reach)
        n = len(value) - step
        right = value[step : step + n] < value[:n]
        value, index = np.where(right, value[step : step + n], value[:n]), np.where(right, index[step : step + n], index[:n])
        reach += step
    return index


def super_kmers(texts: list[list[bytes]], gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, minimiser, first window, number of windows) of each super-k-mer of some texts, given as words, in order."""
    long = [i for i, w in enumerate(texts) if len(w) >= WINDOW]
    if not long:
        return (np.empty(0, np.int64),) * 4
    sizes = np.array([len(texts[i]) for i in long])
    begins = np.cumsum(sizes) - sizes
    hashes = np.concatenate([word_hashes(texts[i]) for i in long])
    grams = gram_hashes(hashes, gram)
    place = first_minima(grams, WINDOW - gram + 1)
    inside = np.ones(len(place), bool)  # windows that lie in one text
    for b in begins[1:]:
        inside[b - WINDOW + 1 : b] = False
    same = inside[1:] & inside[:-1] & (place[1:] == place[:-1])
    first = np.flatnonzero(inside & np.concatenate(([True], ~same)))
    last = np.flatnonzero(inside & np.concatenate((~same, [True])))
    text = np.searchsorted(begins, first, "right") - 1
    return np.array(long)[text], grams[place[first]].view(np.int64), first - begins[text], last - first + 1


def windows_of(packed: bytes) -> list[bytes]:
    """The windows of a packed string of words."""
    words = packed.split(b" ")
    if len(words) == WINDOW:
        return [packed]
    ends = np.cumsum([len(w) + 1 for w in words])
    return [packed[a : b - 1] for a, b in zip([0, *ends.tolist()], ends[WINDOW - 1 :].tolist())]


def repeated_windows(packed: list[tuple[bytes, bool]]) -> list[int]:
    """packed: (string, whether it occurs again) of a bucket's distinct strings.  For each a mask of its repeated windows."""
    every = [windows_of(p) for p, _ in packed]
    masks = [(1 << len(w)) - 1 if again else 0 for w, (_, again) in zip(every, packed)]
    if len(packed) > 1:
        ordered = sorted((text, i, j) for i, w in enumerate(every) for j, text in enumerate(w))
        for (a, i, j), (b, k, m) in zip(ordered, ordered[1:]):
            if a == b:
                masks[i] |= 1 << j
                masks[k] |= 1 << m
    return masks


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def masked_spans(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """hits: (first window, mask).  Spans of words under the masks' windows."""
    return merged([(start + j, start + j + WINDOW) for start, mask in hits for j in range(mask.bit_length()) if mask >> j & 1])


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


class Sent:
    """Tells whether a task should send what has this digest: twice, no more."""

    def __init__(self):
        self.times: Counter[bytes] = Counter()

    def wanted(self, key: bytes) -> bool:
        if len(self.times) >= REMEMBERED:
            self.times.clear()
        self.times[key] += 1
        return self.times[key] <= 2


def _task(df: DataFrame, f, schema: str) -> DataFrame:
    """mapInArrow: f gets an iterator of a task's rows, batch by batch, and gives lists of tuples."""
    arrow = arrow_schema(schema)

    def run(batches):
        for rows in f(list(zip(*(c.to_pylist() for c in b.columns))) for b in batches):
            columns = list(zip(*rows)) or [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(columns, arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def distinct_texts(keyed: DataFrame) -> DataFrame:
    """text_id, minimisers (one for each place), again (whether several rows have the text); texts shorter than a window are left out."""

    def f(r):
        words = list(map(words_of, r["text"]))
        text, minimiser, *_ = super_kmers(words)
        at = np.searchsorted(text, np.arange(len(words) + 1))
        keep = np.flatnonzero(np.diff(at))
        edges = pa.array(np.concatenate((at[keep], at[-1:])).astype(np.int32))
        return {"text_id": [r["text_id"][i] for i in keep], "minimisers": pa.ListArray.from_arrays(edges, pa.array(minimiser, pa.int64()))}

    rows = map_arrow(keyed.where("text_id IS NOT NULL").select("text_id", F.col("text").cast("binary").alias("text")), f, "text_id binary, minimisers array<long>")
    return written(rows.groupBy("text_id").agg(F.any_value("minimisers").alias("minimisers"), (F.count("*") > 1).alias("again")))


def repeated_minimisers(texts: DataFrame) -> DataFrame:
    """text_id, asked array<struct<minimiser, places>>: of each text its minimisers with more than one place."""
    places = texts.select("text_id", F.explode("minimisers").alias("minimiser"))
    counts = places.groupBy("minimiser").agg(F.count("*").alias("places")).where("places > 1")
    found = places.distinct().join(counts, "minimiser")
    return written(found.groupBy("text_id").agg(F.collect_list(F.struct("minimiser", "places")).alias("asked")))  # a text's own


FETCHED = "text_id binary, start int, minimiser long, places long, string_id binary, packed binary"


def fetched(keyed: DataFrame, asked: DataFrame) -> DataFrame:
    """The super-k-mers of repeated minimisers: their place, the digest of their words, and for two of a task the words."""
    some = likely(keyed.select("text_id", "text"), "text_id", asked, True)

    def f(batches):
        sent, last = Sent(), None
        for rows in batches:
            fresh = []
            for text_id, text, wanted in rows:
                if text_id != last:  # a text's other rows, which come after it, add nothing
                    last = text_id
                    fresh.append((text_id, words_of(text), {x["minimiser"]: x["places"] for x in wanted}))
            out, at, ends = [], -1, []
            for i, minimiser, start, n in zip(*(x.tolist() for x in super_kmers([w for _, w, _ in fresh]))):
                text_id, words, wanted = fresh[i]
                places = wanted.get(minimiser)
                if places is None:
                    continue
                if i != at:
                    at, joined = i, b" ".join(words)
                    ends = [0, *np.cumsum([len(w) + 1 for w in words]).tolist()]
                packed = joined[ends[start] : ends[start + n - 1 + WINDOW] - 1]
                string_id = digest(packed)
                out.append((text_id, start, minimiser, places, string_id, packed if sent.wanted(string_id) else None))
                if len(out) >= 8192:
                    yield out
                    out = []
            yield out

    joined = some.join(asked, "text_id").select("text_id", F.col("text").cast("binary"), "asked")
    return written(_task(joined, f, FETCHED))


PARTS = "whole binary, at int, n int, minimiser long, salt long, piece_id binary, words binary"


def _parted(strings: DataFrame, cut) -> DataFrame:
    """Parts of strings, each of which comes once.  cut(string, salts) gives (first window, windows, salt) of the parts of a string."""

    def f(batches):
        sent = Sent()
        for rows in batches:
            out = []
            for minimiser, whole, packed, salts in rows:
                ends = [0]
                for w in packed.split(b" "):
                    ends.append(ends[-1] + len(w) + 1)
                for at, n, salt in cut(packed, salts):
                    words = packed[ends[at] : ends[at + n - 1 + WINDOW] - 1]
                    part = digest(words)
                    out.append((whole, at, n, minimiser, salt, part, words if sent.wanted(part + salt.to_bytes(8, "little", signed=True)) else None))
                if len(out) >= 8192:
                    yield out
                    out = []
            yield out

    return written(_task(strings.select("minimiser", "piece_id", "words", "salts"), f, PARTS))


def _second_minimisers(packed: bytes, _: int) -> list[tuple[int, int, int]]:
    _, minimiser, start, n = super_kmers([packed.split(b" ")], LONG_GRAM)
    return list(zip(start.tolist(), n.tolist(), minimiser.tolist()))


def _windows(packed: bytes, salts: int) -> list[tuple[int, int, int]]:
    return [(j, 1, int.from_bytes(digest(words)[:6], "little") % salts) for j, words in enumerate(windows_of(packed))]


def piece_masks(pieces: DataFrame, level: int = 0, sure: DataFrame | None = None) -> DataFrame:
    """piece_id and mask of repeated windows of (minimiser, salt, piece_id, words), 0 left out.  Crowded buckets are dealt again: level 0 has super-k-mers, 1 those
    of a second minimiser within them, 2 single windows.  sure: pieces of buckets that are known to be small."""
    keys, more = ["minimiser", "salt"], None
    few = pieces.select(*keys, "piece_id", "words")
    if level < 2:
        crowded = written(few.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > BUCKET).select(*keys, F.ceil(F.col("rows") * (WINDOW - GRAM + 1) / BUCKET).alias("salts")))
        if not crowded.isEmpty():
            more = _dealt_again(few.join(crowded, keys), level)
            few = few.join(crowded, keys, "left_anti")
    few = few if sure is None else few.unionByName(sure)
    return bucket_masks(few) if more is None else bucket_masks(few).unionByName(more)


def _dealt_again(crowded: DataFrame, level: int) -> DataFrame:
    """Masks of whole pieces from those of their parts."""
    own = written(crowded.groupBy("minimiser", "piece_id", "salts").agg(F.any_value("words").alias("words"), (F.count("*") > 1).alias("again")))
    parts = _parted(own, _windows if level else _second_minimisers)
    known = piece_masks(parts.where("words IS NOT NULL"), level + 1)
    found = parts.select("whole", "at", "piece_id").join(known, "piece_id").select("whole", F.call_function("shiftleft", F.col("mask").cast("long"), F.col("at")).alias("mask"))
    every = own.where("again").select(F.col("piece_id").alias("whole"), F.expr(f"shiftleft(1L, size(split(CAST(words AS STRING), ' ')) - {WINDOW - 1}) - 1").alias("mask"))
    return found.unionByName(every).groupBy("whole").agg(F.bit_or("mask").cast("int").alias("mask")).withColumnRenamed("whole", "piece_id")


def bucket_masks(pieces: DataFrame) -> DataFrame:
    """piece_id, mask of its repeated windows, 0 left out, of (minimiser, salt, piece_id, words): a bucket is a minimiser and a salt."""
    ordered = pieces.select("minimiser", "salt", "piece_id", "words").repartition("minimiser", "salt").sortWithinPartitions("minimiser", "salt", "piece_id")

    def f(batches):
        bucket, ids, held = None, [], []

        def masks() -> Iterator[tuple[bytes, int]]:
            return ((i, m) for i, m in zip(ids, repeated_windows(held)) if m)

        for rows in batches:
            out = []
            for minimiser, salt, piece_id, words in rows:
                if bucket != (minimiser, salt):
                    out.extend(masks())
                    bucket, ids, held = (minimiser, salt), [], []
                if ids and ids[-1] == piece_id:
                    held[-1] = (words, True)
                else:
                    ids.append(piece_id)
                    held.append((words, False))
            yield out
        yield list(masks())

    return _task(ordered, f, "piece_id binary, mask int")


def repeated_spans(keyed: DataFrame) -> DataFrame:
    """text_id, hits array<struct<start, mask>> of each text with repeated windows; a start of -1 stands for the whole text.  keyed: text_id, text."""
    texts = distinct_texts(keyed)
    found = fetched(keyed, repeated_minimisers(texts))
    strings = found.where("packed IS NOT NULL")
    pieces = strings.select("minimiser", F.lit(0).cast("long").alias("salt"), F.col("string_id").alias("piece_id"), F.col("packed").alias("words"), "places")
    few = pieces.where(F.col("places") <= BUCKET).drop("places")
    of_strings = piece_masks(pieces.where(F.col("places") > BUCKET), sure=few).withColumnRenamed("piece_id", "string_id")
    hits = found.join(of_strings, "string_id").select("text_id", F.struct("start", "mask").alias("hit"))
    whole = texts.where("again").select("text_id", F.struct(F.lit(-1).alias("start"), F.lit(0).alias("mask")).alias("hit"))
    return written(hits.unionByName(whole).groupBy("text_id").agg(F.collect_list("hit").alias("hits")))


def with_hits(docs: DataFrame) -> DataFrame:
    """docs, which have a column text, with hits (null: none)."""
    keyed = docs.withColumn("text_id", F.unhex(F.md5("text")))
    hits = repeated_spans(keyed)
    apart = likely(keyed, "text_id", hits, False).withColumn("hits", F.lit(None).cast(hits.schema["hits"].dataType))
    return likely(keyed, "text_id", hits, True).join(hits, "text_id", "left").select(*docs.columns, "hits").unionByName(apart.select(*docs.columns, "hits"))


def spans_of(hits: list[dict] | None, n_words: int) -> list[tuple[int, int]]:
    if not hits:
        return []
    pairs = [(h["start"], h["mask"]) for h in hits]
    return [(0, n_words)] if min(pairs)[0] < 0 else masked_spans(pairs)


def kept_words(text: str | bytes | None, hits) -> tuple[list[bytes], list[bytes]]:
    """(all words, words outside the hits)."""
    words, kept, at = words_of(text), [], 0
    for a, b in spans_of(hits, len(words)):
        kept += words[at:a]
        at = b
    return words, kept + words[at:]


def cut_text(text: str, hits) -> str:
    """The text without the hits' words and the white space behind each; all other characters stay."""
    words, out, at = [m.span() for m in WORD.finditer(text)], [], 0
    for a, b in spans_of(hits, len(words)):
        out.append(text[at : words[a][0]])
        at = words[b][0] if b < len(words) else len(text)
    return "".join([*out, text[at:]])


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)

    def f(r):
        both = [kept_words(t, h) for t, h in zip(r["text"], r["hits"])]
        return {
            "doc_id": r["doc_id"], "n_words": [len(w) for w, _ in both], "n_removed": [len(w) - len(k) for w, k in both],
            "kept_sha256": [hashlib.sha256(b" ".join(k)).hexdigest() for _, k in both],
        }

    found = with_hits(documents(spark, sf_dir).select("doc_id", "text"))
    return map_arrow(found.withColumn("text", F.col("text").cast("binary")), f, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, without its repeated windows; a text with none is unchanged.  n_chars follows the text."""
    bounded_batches(spark)
    plain, carried = numbered(docs)
    found = with_hits(plain)

    def f(r):
        return {c: r[c] for c in carried} | {"cut": [t if not h else cut_text(t, h) for t, h in zip(r["text"], r["hits"])]}

    fields = ", ".join(f"{c} {found.schema[c].dataType.simpleString()}" for c in carried)
    done = map_arrow(found, f, f"{fields}, cut string")
    new = {"text": F.col("cut"), "n_chars": F.char_length("cut").cast("long")}
    return done.select(*(new[n].alias(n) if n in new else F.col(c).alias(n) for c, n in zip(carried, docs.columns)))


ORACLE_SQL = f"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, i, list_aggregate(w[i:i + {WINDOW - 1}], 'string_agg', ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM words)),
hits AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY s) AS n FROM starts) WHERE n > 1),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
judged AS (
  SELECT doc_id, word, i, max(CASE WHEN h.i IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS {WINDOW - 1} PRECEDING) AS gone
  FROM each LEFT JOIN hits h USING (doc_id, i)),
kept AS (SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS k FROM judged GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""
