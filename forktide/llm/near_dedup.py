"""Near-duplicates by bottom-k sketches of one hash function.

A document's set is its distinct 5-word shingles, words in ASCII lower case; documents are linked where the sets' Jaccard
similarity is 0.75 or more, and a component of links is a group of copies.

1. A document's sketch is the SKETCH smallest of its shingles' 64-bit hashes.  Documents with equal sets (a 128-bit digest of
   all hashes) form a class and go on as their member with the least doc_id, however many they are.
2. Retained values with the documents that retain them are inverted lists.  Two linked documents share LEAST of SKETCH values
   (at similarity 0.75 the number of values that the sketch of the union holds from both sets is binomial with mean 48; fewer than
   28 has a probability of about 1e-8), or, where a set is no larger than the sketch, a number that follows from
   0.75.  So a document need be listed only under its rarest values, all but LEAST - 1 of them (a prefix filter): values that
   one document alone has list nothing, and common passages drop out where they are less than 28 values of a document.
3. Each list's least document is its pivot; pairs of a pivot and a member, a row for each, are the first candidates.
   The union-sketch estimate filters them, exact Jaccard of the full sets confirms them.
4. Members that did not come into their pivot's component are compared with the pivot's other members, each with each that
   is not in its component, block against block: a pivot's members are dealt to blocks of bounded size by hash, a task
   compares two blocks by products of presence matrices, and only links that join something within them leave the task.  So a list of
   any length is worked off whole and no list of pairs exists.
5. Components of all links.

Defined cases: fewer than five words are one shingle of the whole sequence; a document without words has an empty set, no
links, and itself as its component; repeated rows are one document; rows of one doc_id with different texts are each a component of
its own, the doc_id itself, and the stage keeps them all, as nothing tells which text is meant; a document without a doc_id is in no
group (component null, kept false in the query; the stage keeps it); an empty table gives an empty result; other columns, whatever
their names, are ignored by the query and kept by the stage.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, discard, documents, gram_hashes, likely, map_arrow, mix64, numbered, shared_dir, tables_made, word_hashes, words_of, written
from .components import components

SHINGLE = 5
SKETCH = 64
LEAST = 28
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Shingles and members of one block, about.
BLOCK_SHINGLES = 120_000
BLOCK_MEMBERS = 192


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes([w.lower() for w in words])  # of bytes: A-Z alone
    if len(h) < SHINGLE:
        whole = mix64(np.uint64(len(h)) + np.bitwise_xor.reduce(mix64(h + np.arange(1, len(h) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))[None])
        return whole
    return np.unique(gram_hashes(h, SHINGLE))


def linked(both: int, a: int, b: int) -> bool:
    return 100 * both >= PERCENT * (a + b - both)


def estimate(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> tuple[int, int]:
    """(values from both sets, values) of the union's sketch, from the two sketches."""
    if not len(a) or not len(b):
        return 0, 1
    union = np.union1d(a, b)[:size]
    return len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), union, assume_unique=True)), len(union)


def least_shared(n: np.ndarray) -> np.ndarray:
    """How many sketch values a document of n shingles shares with each linked one, at least.

    A set within the sketch: 0.75 n of its values are in the other set, and the other's sketch leaves out none of them
    unless that set is the larger one, of whose first 64 values n / 3 at most are not in this set.
    """
    exact = np.minimum(-(-3 * n // 4), SKETCH - n // 3)
    return np.where(n <= SKETCH, np.maximum(exact, 1), LEAST)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest (null for an empty set), sketch array<long>, least int."""

    def f(r):
        sets = [shingles(t) for t in r["text"]]
        n = np.array([len(s) for s in sets])
        return {
            "doc_id": r["doc_id"], "n_shingles": n.tolist(), "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
            "sketch": [s[:SKETCH].view(np.int64).tolist() for s in sets], "least": least_shared(n).tolist(),
        }

    return map_arrow(docs.select("doc_id", "text"), f, "doc_id long, n_shingles long, digest binary, sketch array<long>, least int")


def inverted_lists(reps: DataFrame) -> DataFrame:
    """(value, rep): each representative under its rarest shared values."""
    entries = reps.select("rep", F.explode("sketch").alias("value"))
    counts = entries.groupBy("value").agg(F.count("*").alias("n")).where("n > 1")
    shared = entries.join(counts, "value").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("v"))  # a sketch's size at most
    shared = shared.join(reps.select("rep", "least"), "rep")
    rare = F.slice("v", F.lit(1), F.greatest(F.size("v") - F.col("least") + 1, F.lit(0)))
    return shared.select("rep", F.explode(rare["value"]).alias("value"))


def pivot_pairs(lists: DataFrame) -> DataFrame:
    """Distinct (pivot, member): members of a list with its least document."""
    pivots = lists.groupBy("value").agg(F.min("rep").alias("pivot"), F.count("*").alias("n")).where("n > 1").select("value", "pivot")
    return lists.join(pivots, "value").where("rep <> pivot").select("pivot", F.col("rep").alias("member")).distinct()


def confirmed(pairs: DataFrame, sides: DataFrame) -> DataFrame:
    """The linked ones of pairs (a, b): filtered by the estimate from the sketches, confirmed on the full sets of the texts."""

    def side(columns: str, key: str) -> DataFrame:
        return sides.select(F.col("rep").alias(key), F.col(columns).alias(f"{columns}_{key}"))

    def close(r):
        keep = []
        for i, (x, y) in enumerate(zip(r["sketch_a"], r["sketch_b"])):
            both, size = estimate(np.array(x, np.int64).view(np.uint64), np.array(y, np.int64).view(np.uint64))
            if both * SKETCH >= LEAST * size:
                keep.append(i)
        return {"a": [r["a"][i] for i in keep], "b": [r["b"][i] for i in keep]}

    def exact(r):
        keep, last = [], (None, None)
        for i, (a, x, y) in enumerate(zip(r["a"], r["text_a"], r["text_b"])):
            if last[0] != a:
                last = (a, shingles(x))
            other = shingles(y)
            if linked(len(np.intersect1d(last[1], other, assume_unique=True)), len(last[1]), len(other)):
                keep.append(i)
        return {"a": [r["a"][i] for i in keep], "b": [r["b"][i] for i in keep]}

    likely = map_arrow(pairs.join(side("sketch", "a"), "a").join(side("sketch", "b"), "b"), close, "a long, b long")
    return map_arrow(likely.join(side("text", "b"), "b").join(side("text", "a"), "a"), exact, "a long, b long")


def block_links(x: list[tuple], y: list[tuple] | None) -> list[tuple[int, int]]:
    """Links between two blocks (or within one) that join what no link before has joined.

    A member is (rep, component, set).  Pairs of one component are not looked at.
    """
    other = x if y is None else y
    inverse = np.unique(np.concatenate([m[2] for m in x]))
    inverse = np.intersect1d(inverse, np.concatenate([m[2] for m in other]))
    n, m = np.array([len(v[2]) for v in x]), np.array([len(v[2]) for v in other])
    both = np.zeros((len(x), len(other)), np.float32)
    at = [np.searchsorted(inverse, np.intersect1d(v[2], inverse, assume_unique=True)) for v in x]
    to = at if y is None else [np.searchsorted(inverse, np.intersect1d(v[2], inverse, assume_unique=True)) for v in other]
    for low in range(0, len(inverse), 8192):  # columns of the presence matrices at a time
        left, right = (_presence(p, low) for p in (at, to))
        both += left @ right.T
    hit = 100 * both >= PERCENT * (n[:, None] + m[None, :] - both)
    hit &= np.array([v[1] for v in x])[:, None] != np.array([v[1] for v in other])[None, :]
    parent: dict[int, int] = {}

    def root(v: int) -> int:
        while parent.get(v, v) != v:
            parent[v] = v = parent.get(parent[v], parent[v])
        return v

    out = []
    for i, j in zip(*np.nonzero(hit)):
        a, b = root(x[i][1]), root(other[j][1])
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((x[i][0], other[j][0]))
    return out


def _presence(places: list[np.ndarray], low: int) -> np.ndarray:
    out = np.zeros((len(places), 8192), np.float32)
    for row, p in zip(out, places):
        row[p[np.searchsorted(p, low) : np.searchsorted(p, low + 8192)] - low] = 1
    return out


def rest_links(pairs: DataFrame, found: DataFrame, sides: DataFrame) -> DataFrame:
    """Links of members that are not in their pivot's component.  pairs (pivot, member); found (node, component)."""
    part = found.select(F.col("node").alias("member"), F.col("component").alias("part"))
    of_pivot = found.select(F.col("node").alias("pivot"), F.col("component").alias("pivot_part"))
    placed = pairs.join(part, "member", "left").join(of_pivot, "pivot", "left").withColumn("part", F.coalesce("part", "member"))
    placed = placed.withColumn("rest", F.col("part") != F.coalesce("pivot_part", "pivot")).select("pivot", "member", "part", "rest")
    placed = written(placed.join(sides.select(F.col("rep").alias("member"), "n_shingles"), "member"))
    blocks = F.greatest(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES), F.ceil(F.count("n_shingles") / BLOCK_MEMBERS)).cast("int")
    size = placed.groupBy("pivot").agg(
        blocks.alias("_"), F.count_if("rest").alias("n_rest"), F.count("*").alias("n"),
        *(F.greatest(F.ceil(F.coalesce(F.sum(F.when(c, F.col("n_shingles"))), F.lit(0)) / BLOCK_SHINGLES), F.ceil(F.count_if(c) / BLOCK_MEMBERS)).cast("int").alias(name)
          for name, c in (("rests", F.col("rest")), ("stars", ~F.col("rest")))),
    ).where("n_rest > 0 AND n > 1").select("pivot", "rests", "stars")
    dealt = placed.join(size, "pivot")
    block = F.pmod(F.xxhash64("member", "pivot"), F.greatest(F.when(F.col("rest"), F.col("rests")).otherwise(F.col("stars")), F.lit(1))).cast("int")
    dealt = dealt.withColumn("mine", block)

    def upto(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    mates = F.transform(upto(F.col("rests")), lambda j: F.struct(F.lit("r").alias("kind"), F.least("mine", j).alias("i"), F.greatest("mine", j).alias("j"), F.when(F.col("mine") <= j, 0).otherwise(1).alias("side")))
    with_stars = F.transform(upto(F.col("stars")), lambda j: F.struct(F.lit("s").alias("kind"), F.col("mine").alias("i"), j.alias("j"), F.lit(0).alias("side")))
    as_star = F.transform(upto(F.col("rests")), lambda i: F.struct(F.lit("s").alias("kind"), i.alias("i"), F.col("mine").alias("j"), F.lit(1).alias("side")))
    tasks = dealt.select("pivot", "member", "part", F.explode(F.when(F.col("rest"), F.concat(mates, with_stars)).otherwise(as_star)).alias("t")).select("pivot", "t.*", "member", "part")
    full = map_arrow(
        sides.select("rep", "text").join(placed.join(size.select("pivot"), "pivot", "left_semi").select(F.col("member").alias("rep")).distinct(), "rep", "left_semi"),
        lambda r: {"member": r["rep"], "shingles": [shingles(t).tobytes() for t in r["text"]]}, "member long, shingles binary",
    )
    ordered = tasks.join(full, "member").select("pivot", "kind", "i", "j", "side", "member", "part", "shingles").repartition("pivot", "kind", "i", "j").sortWithinPartitions("pivot", "kind", "i", "j", "side")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        key, left, right, out = None, [], [], []

        def compare():
            if left and key[2] == key[3] and key[1] == "r":
                out.extend(block_links(left, None))
            elif left and right:
                out.extend(block_links(left, right))
            left.clear()
            right.clear()

        for b in batches:
            for p, kind, i, j, side, member, part, data in zip(*(c.to_pylist() for c in b.columns)):
                if key != (p, kind, i, j):
                    compare()
                    key = (p, kind, i, j)
                (right if side else left).append((member, part, np.frombuffer(data, np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], schema=schema)
            out.clear()
        compare()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], schema=schema)

    return ordered.mapInArrow(run, "a long, b long")


def classes(drawn: DataFrame) -> DataFrame:
    """drawn with rep, the least doc_id with the same set, and first, whether the row stands for the class.

    Rows whose doc_id stands with different sets are classes of their own, as nothing tells which text the id means.  The
    classes of several rows are a table of their own, so that Spark may split a large one's rows when they are joined.
    """
    drawn = written(drawn.withColumn("number", F.monotonically_increasing_id()))
    sets = drawn.groupBy("doc_id").agg(F.min(F.coalesce("digest", F.lit(b""))).alias("low"), F.max(F.coalesce("digest", F.lit(b""))).alias("high"))
    doubtful = written(sets.where("low <> high").select("doc_id"))
    plain = drawn.where("digest IS NOT NULL").join(doubtful, "doc_id", "left_anti")
    several = plain.groupBy("digest").agg(F.min(F.struct("doc_id", "number")).alias("least_row"), F.count("*").alias("rows")).where("rows > 1")
    several = written(several.select("digest", F.col("least_row.doc_id").alias("rep"), F.col("least_row.number").alias("rep_number")))
    found = plain.join(several, "digest", "left").withColumn("first", F.coalesce(F.col("number") == F.col("rep_number"), F.lit(True)))
    found = found.select("doc_id", "n_shingles", F.coalesce("rep", "doc_id").alias("rep"), "first", F.when(F.col("first"), F.col("sketch")).alias("sketch"), "least")
    apart = drawn.where("digest IS NOT NULL").join(doubtful, "doc_id", "left_semi").withColumn("doubtful", F.lit(True))
    apart = apart.unionByName(drawn.where("digest IS NULL").withColumn("doubtful", F.lit(False)))
    apart = apart.select("doc_id", "n_shingles", F.lit(None).cast("long").alias("rep"), F.lit(False).alias("first"), F.lit(None).cast("array<long>").alias("sketch"), "least", "doubtful")
    return found.withColumn("doubtful", F.lit(False)).unionByName(apart)


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, doubtful (whether its doc_id has other texts too) of each row with a doc_id, as a table; no other is left."""
    spark = docs.sparkSession
    path, mark = shared_dir(spark), tables_made()
    named = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    member_of = written(classes(sketches(named)))
    first = member_of.where("first").select("rep", "n_shingles", "sketch", "least")
    lists = inverted_lists(first)
    pairs = written(pivot_pairs(lists))
    asked = pairs.select(F.col("pivot").alias("rep")).unionAll(pairs.select(F.col("member").alias("rep"))).distinct()
    likely_named = likely(named, "doc_id", asked, True)
    sides = likely_named.join(asked, likely_named["doc_id"] == asked["rep"]).select("rep", "text").dropDuplicates(["rep"])
    sides = written(first.join(sides, "rep"))
    star = written(confirmed(pairs.select(F.col("pivot").alias("a"), F.col("member").alias("b")), sides))
    found = components(star)
    rest = written(rest_links(pairs, found, sides))
    if not rest.isEmpty():
        found = components(star.unionAll(rest))
    found = found.select(F.col("node").alias("rep"), "component")
    joined = member_of.where("rep IS NOT NULL").select("doc_id", "n_shingles", "rep").join(found, "rep", "left").select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"), F.lit(False).alias("doubtful"))
    out = written(joined.unionAll(member_of.where("rep IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "doubtful")), path)
    discard(spark, mark)
    return out


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = documents(spark, sf_dir)
    without = docs.where("doc_id IS NULL").select("doc_id", F.lit(None).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return groups(docs).drop("doubtful").unionAll(without).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the least doc_id, and one row of it."""
    bounded_batches(spark)
    plain, carried = numbered(docs)
    plain = plain.withColumn("doc_id", F.col(carried[docs.columns.index("doc_id")]))
    found = groups(plain).where("doc_id = component_id").groupBy(F.col("doc_id").alias("kept_id")).agg(F.bool_or("doubtful").alias("doubtful"))
    kept = written(found)
    rows = plain.withColumn("row", F.monotonically_increasing_id())
    named = rows.join(kept, rows["doc_id"] == kept["kept_id"]).withColumn("row", F.when(F.col("doubtful"), F.col("row")))
    one = named.dropDuplicates(["kept_id", "row"])
    return one.select(*carried).unionAll(plain.where("doc_id IS NULL").select(*carried)).toDF(*docs.columns)


ORACLE_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i:i + {SHINGLE - 1}], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM words WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * k >= {PERCENT} * (x.n + y.n - k)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM words UNION SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.r)
SELECT words.doc_id, coalesce(n, 0) AS n_shingles, component_id, words.doc_id = component_id AS kept
FROM words LEFT JOIN size USING (doc_id) JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) USING (doc_id)
"""
