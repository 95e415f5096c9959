r"""Target-distribution importance resampling: array-scored weights, sorted runs, external k-way tournament trees, exact draw.

A text's words are the runs of letters, digits and characters beyond ASCII, with A-Z in lower case; its features are the runs of 1
to ``orders`` consecutive words, each hashed to one of BUCKETS numbers.  A bucket's gain compares how often the target has it with
how often the corpus has it, so a document's weight is a sum over an array of gains.  A Gumbel number from the hash of its id is added,
so the highest scores are a draw without replacement in proportion to the exponential of the weights.  The steps:

1. a task counts its buckets in one array; the arrays are summed; the driver gets BUCKETS numbers for corpus and target;
2. every document is scored once into a table;
3. a task sorts its eligible rows in runs of RUN_ROWS, cuts each run where the ranges of scores end, and each cut into blocks;
4. a range's blocks come to one task, sorted by their heads.  A tournament tree has a player for each run; a block joins when all that is
   before its head has been given out, so no more than one block of a run is held and a range of any size streams through.
   Ranges are counted beforehand, so each knows its first rank; the one in which the draw ends stops there, those behind are not sent;
5. rows that are not drawn are told from the last drawn one by comparison; nothing is joined.

Ranges are RANGE_ROWS drawn rows each, about, by approximate percentiles of the scores; MAX_RANGES bounds what the driver gets, and a
range may hold more.  Which ranges there are changes no result.

Order: higher score, then smaller doc_id, null behind all others, then the place in the table.  Defined cases: a null or empty text has
no features and weight 0; a null doc_id is hashed as an empty text; repeated rows are documents of their own, and where the draw ends among equal ones
any of them are drawn, as they differ in nothing; a document below ``least_words`` is scored but never drawn; an empty target leaves gains that
depend on the corpus alone; an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, bounded_batches, documents, map_arrow, partitions, written

BUCKETS = 10_000
ORDERS = 1
SEED = 2024
LEAST_WORDS = 20
#: Of 100 eligible documents so many are drawn.
RATE = 10
RUN_ROWS = 1 << 20
BLOCK_ROWS = 1024
RANGE_ROWS = 1 << 16
MAX_RANGES = 4096
CACHE_FEATURES = 300_000

_UPPER, _KEPT = range(0x41, 0x5B), {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: Each byte of UTF-8 as it is compared: letters lower, separators a space.
FOLD = bytes(b + 32 if b in _UPPER else b if b in _KEPT else 32 for b in range(256))


class Buckets(dict):
    """feature -> bucket, remembered by a worker within bounds."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHE_FEATURES:
            self.clear()
        self[feature] = b = zlib.crc32(feature) % self.buckets
        return b


_known: dict[int, Buckets] = {}


def bucket_ids(text: bytes | None, buckets: int = BUCKETS, orders: int = ORDERS) -> tuple[int, np.ndarray]:
    """(number of words, the bucket of each feature)."""
    words = (text or b"").translate(FOLD).split()
    features = list(words)
    for n in range(2, orders + 1):
        features += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    known = _known.setdefault(buckets, Buckets(buckets))
    return len(words), np.fromiter(map(known.__getitem__, features), np.int64, len(features))


def _texts(df: DataFrame) -> DataFrame:
    return df.select(F.col("text").cast("binary").alias("text"))


def bucket_counts(df: DataFrame, buckets: int = BUCKETS, orders: int = ORDERS) -> np.ndarray:
    """How often each bucket is met in all texts; a task sends one array of counts at most."""
    ddl = "bucket int, n long"
    schema = arrow_schema(ddl)

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                total += np.bincount(bucket_ids(text, buckets, orders)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], schema=schema)

    out = np.zeros(buckets, np.int64)
    for r in _texts(df).mapInArrow(run, ddl).groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # ``buckets`` rows at most
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of smoothed shares), in doubles."""
    n, s, t = len(corpus), float(corpus.sum()), float(target.sum())
    ratio = ((target + 1.0) * (s + n)) / ((corpus + 1.0) * (t + n))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, orders: int = ORDERS, seed: int = SEED, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score, eligible, and row, a number of its own, of every document, as a table."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # an array of BUCKETS numbers

    def f(r):
        got = [bucket_ids(t, len(shared.value), orders) for t in r["text"]]
        weight = [int(shared.value[ids].sum()) for _, ids in got]
        return {
            "doc_id": r["doc_id"], "n_features": [len(ids) for _, ids in got], "weight": weight, "score": [w + noise(seed, d) for w, d in zip(weight, r["doc_id"])],
            "eligible": [n >= least_words for n, _ in got],
        }

    rows = map_arrow(docs.select("doc_id", F.col("text").cast("binary").alias("text")), f, "doc_id long, n_features long, weight long, score long, eligible boolean")
    return written(rows.withColumn("row", F.monotonically_increasing_id()))


class Tournament:
    """A tree of matches between players who each show their next key; the smallest key wins, None loses to any."""

    def __init__(self):
        self.players, self.size = 0, 1
        self.keys: list[tuple | None] = [None]
        #: Who won at each node: node i is the match of nodes 2i and 2i + 1, the players stand behind the matches.
        self.winner = [0, 0]

    def join(self) -> int:
        """A further player's number; a full tree doubles."""
        if self.players == self.size:
            self.size *= 2
            self.keys += [None] * self.players
            self.winner = [0] * self.size + [*range(self.size)]
            for node in range(self.size - 1, 0, -1):
                self._play(node)
        self.players += 1
        return self.players - 1

    def _play(self, node: int) -> None:
        a, b = self.winner[2 * node], self.winner[2 * node + 1]
        x, y = self.keys[a], self.keys[b]
        self.winner[node] = b if x is None or y is not None and y < x else a

    def show(self, player: int, key: tuple | None) -> None:
        """The player's new key; the matches from there to the top are played again."""
        self.keys[player] = key
        node = (self.size + player) // 2
        while node:
            self._play(node)
            node //= 2

    def first(self) -> tuple[int, tuple | None]:
        return self.winner[1], self.keys[self.winner[1]]


#: A row of a run: what it is ordered by, smallest first, and what it carries.
FIELDS = ("score", "missing", "doc_id", "row", "n_features", "weight")
BLOCK = "range int, run long, head struct<score: long, missing: long, doc_id: long, row: long>, rows binary"


def sorted_runs(eligible: DataFrame, floors: list[int], wanted: int) -> DataFrame:
    """The blocks of the eligible rows' sorted runs in the first ``wanted`` ranges.  Range i has the scores from floors[i] up to below floors[i - 1]."""
    schema = arrow_schema(BLOCK)
    limits = -np.array(floors, np.int64)  # in the order of the runs

    def blocks(parts: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(parts)
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
        at = np.searchsorted(limits, rows[:, 0])  # -score at most the range's limit
        edges = np.searchsorted(at, np.arange(wanted + 1))
        cuts = [(i, low, min(low + BLOCK_ROWS, edges[i + 1])) for i in range(wanted) for low in range(edges[i], edges[i + 1], BLOCK_ROWS)]
        run, heads = int(rows[:, 3].min()), [dict(zip(FIELDS, rows[low, :4].tolist())) for _, low, _ in cuts]
        columns = [i for i, *_ in cuts], [run] * len(cuts), heads, [rows[low:high].tobytes() for _, low, high in cuts]
        return pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(columns, schema)], schema=schema)

    def run(batches):
        parts, n = [], 0
        for b in batches:
            got = [b.column(i).to_numpy(zero_copy_only=False) for i in range(len(FIELDS))]
            parts.append(np.stack(got, 1).astype(np.int64))
            n += b.num_rows
            if n >= RUN_ROWS:
                yield blocks(parts)
                parts, n = [], 0
        if n:
            yield blocks(parts)

    keys = eligible.select((-F.col("score")).alias("score"), F.col("doc_id").isNull().cast("long").alias("missing"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "row", "n_features", "weight")
    return keys.mapInArrow(run, BLOCK)


DRAWN = "doc_id long, n_features long, weight long, score long, rank long, row long"


def merged_runs(blocks: DataFrame, before: list[int], draws: int) -> DataFrame:
    """The drawn rows with their ranks; before[i] rows stand in the ranges before range i."""
    schema = arrow_schema(DRAWN)
    ordered = blocks.repartition(partitions(blocks.sparkSession), "range").sortWithinPartitions("range", "head")

    class Merge:
        def __init__(self, at: int):
            self.at, self.rank, self.tree = at, before[at], Tournament()
            self.player: dict[int, int] = {}
            self.open: dict[int, Iterator] = {}

        def add(self, run: int, rows: bytes) -> None:
            if run not in self.player:
                self.player[run] = self.tree.join()
            player = self.player[run]
            self.open[player] = iter(np.frombuffer(rows, np.int64).reshape(-1, len(FIELDS)).tolist())
            self.advance(player)

        def advance(self, player: int) -> None:
            row = next(self.open[player], None)
            self.tree.show(player, None if row is None else tuple(row))

        def upto(self, head: tuple | None) -> Iterator[tuple]:
            """Rows in order, those before ``head`` (None: all), until the draw is complete."""
            while self.rank < draws:
                player, key = self.tree.first()
                if key is None or head is not None and key[:4] >= head:
                    return
                self.rank += 1
                score, missing, doc_id, row, n_features, weight = key
                yield None if missing else doc_id, n_features, weight, -score, self.rank, row
                self.advance(player)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(columns, schema)], schema=schema)

    def run(batches):
        merge, out = None, []
        for b in batches:
            for r in b.to_pylist():
                if merge is None or merge.at != r["range"]:
                    if merge is not None:
                        out.extend(merge.upto(None))
                    merge = Merge(r["range"])
                if merge.rank >= draws:
                    continue
                for row in merge.upto(tuple(r["head"][k] for k in FIELDS[:4])):
                    out.append(row)
                    if len(out) >= 8192:
                        yield batch(out)
                        out = []
                merge.add(r["run"], r["rows"])
        if merge is not None:
            for row in merge.upto(None):
                out.append(row)
                if len(out) >= 8192:
                    yield batch(out)
                    out = []
        yield batch(out)

    return ordered.mapInArrow(run, DRAWN)


def ranges(eligible: DataFrame, rows: int, draws: int) -> list[int]:
    """The least score of each range, highest first.  A few ranges lie below the draw, as percentiles are approximate; the last takes the rest."""
    n = min(MAX_RANGES, -(-draws // RANGE_ROWS))
    shares = [max(0.0, 1 - draws / rows * i / n) for i in range(1, n + 4)]
    found = eligible.agg(F.percentile_approx("score", shares, 100 * MAX_RANGES).alias("at")).first()["at"]
    return [*sorted(set(found), reverse=True), -(1 << 62)]


def draw(table: DataFrame, rate: int = RATE) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of a scored table; rank is null for those not drawn."""
    eligible = table.where("eligible")
    rows = eligible.count()
    draws = rate * rows // 100
    columns = ("doc_id", "n_features", "weight", "score", "rank")
    if not draws:
        return table.withColumn("rank", F.lit(None).cast("long")).select(*columns)
    floors = ranges(eligible, rows, draws)
    place = F.lit(0)
    for low in floors[:-1]:
        place = place + (F.col("score") < low).cast("int")
    counts = {r["place"]: r["n"] for r in eligible.groupBy(place.alias("place")).agg(F.count("*").alias("n")).collect()}  # a row a range
    before = [0]
    while before[-1] < draws:
        before.append(before[-1] + counts.get(len(before) - 1, 0))
    wanted = len(before) - 1
    near = eligible.where(F.col("score") >= floors[wanted - 1])
    drawn = written(merged_runs(sorted_runs(near, floors, wanted), before, draws))
    last = drawn.where(F.col("rank") == draws).first()
    missing, doc_id = F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0))
    behind, same = F.lit(False), F.lit(True)
    for key, at in ((-F.col("score"), -last["score"]), (missing, last["doc_id"] is None), (doc_id, last["doc_id"] or 0), (F.col("row"), last["row"])):
        behind, same = behind | (same & (key > at)), same & (key == at)
    rest = table.where(~F.col("eligible") | behind).withColumn("rank", F.lit(None).cast("long"))
    return drawn.select(*columns).unionByName(rest.select(*columns))


def importance_resample(docs: DataFrame, target: DataFrame, rate: int = RATE, buckets: int = BUCKETS, orders: int = ORDERS, seed: int = SEED, least_words: int = LEAST_WORDS) -> DataFrame:
    """Documents (doc_id, text) with n_features, weight, score and rank: ``rate`` per cent are drawn, those most like the target's texts more often."""
    gain = gains(bucket_counts(docs, buckets, orders), bucket_counts(target, buckets, orders))
    return draw(scored(docs, gain, orders, seed, least_words), rate)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return importance_resample(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE_SQL = f"""
WITH crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
folded AS (SELECT doc_id, true AS own, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents
  UNION ALL SELECT NULL, false, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
numbered AS (SELECT row_number() OVER () AS k, doc_id, own, regexp_extract_all(x, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM folded),
words AS (SELECT k, own, unnest(w) AS word FROM numbered),
hashed AS (SELECT word, xor(list_reduce([4294967295] || list_transform(range(strlen(word)), lambda i: CAST('0x' || substr(hex(word), CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT word FROM words), crc),
met AS (SELECT k, own, bucket FROM words JOIN hashed USING (word)),
counts AS (SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM met GROUP BY bucket),
totals AS (SELECT CAST(coalesce(sum(s), 0) AS DOUBLE) AS ss, CAST(coalesce(sum(t), 0) AS DOUBLE) AS tt FROM counts),
gain AS (SELECT bucket, CAST(floor(1000 * ln(((t + 1)::DOUBLE * (ss + {BUCKETS})) / ((s + 1)::DOUBLE * (tt + {BUCKETS})))) AS BIGINT) AS g FROM counts, totals),
weights AS (SELECT k, sum(g) AS weight FROM met JOIN gain USING (bucket) WHERE own GROUP BY k),
drawn AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
  CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM numbered LEFT JOIN weights USING (k) WHERE own),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id) AS r, count(*) FILTER (n_features >= {LEAST_WORDS}) OVER () AS n FROM drawn)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {LEAST_WORDS} AND r <= {RATE} * n // 100 THEN r END AS rank FROM ranked
"""
