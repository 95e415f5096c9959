"""A content-addressed store of token ids.

Format, a folder of three Parquet tables:

* ``chunks``: digest (first 16 bytes of SHA-256 of the ids), n, ids: each unique chunk once, sorted by digest within a file;
* ``recipes``: doc_id, start, n_tokens, digests, lengths, root, part, row: a document is its chunks in order; files and rows ascend by
  doc_id, start counts the ids of all documents before it, row its part's documents before it;
* ``manifest``: part, rows, ids, root of the part's documents, roots of its blocks; ``store_root`` is the root of all parts.

A document's ids are cut where a rolling hash of the last 32 ids has its low bits zero, so equal passages give equal chunks
wherever they stand, and at MAX_CHUNK ids.  Ids are stored as unsigned 16-bit integers where the vocabulary allows, else as 32-bit
ones.  Roots are those of Merkle trees: chunks below a document, documents below a part, parts below the store.  ``document_proof``
gives the path from one document to the store's root.

Reading verifies every chunk against its digest, every document against its root and every part against the manifest.
A document's CRC is put together from those of its chunks (appending by a matrix over GF(2) for each length), so only digests, lengths and CRCs are
shuffled back, not ids; ``reconstruct`` gives the ids themselves.

Documents are tokenised once, into a staged table that holds recipes and chunks by document; unique chunks are drawn from it, and it
is removed.

Defined cases: a null text is empty and has the end id alone; repeated rows each have a recipe; rows of one doc_id go by their
root and then as they are read; a null doc_id sorts first; an empty table gives an empty store; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_schema, bounded_batches, documents, map_arrow, mix64, partitions, remove, shared_dir
from .tokens import encoder, public_path

END_ID = 0
#: A chunk ends where so many low bits of the hash are zero: 512 ids in the mean.
CUT_BITS = 9
MIN_CHUNK = 128
MAX_CHUNK = 4096
WINDOW_STEPS = 5
#: Documents of a part whose roots are one block; a power of two, so that a block's root is a node of the part's tree.
BLOCK = 4096
#: Digests of chunks that a task remembers to have stored, before it begins anew.
REMEMBERED = 200_000
#: Rows of an Arrow batch: different chunks of text are looked up once for all of them.
ROWS = 1024


def rolling_hash(ids: np.ndarray) -> np.ndarray:
    """At each id the hash of it and the 31 before it: sum of g(id) << distance, modulo 2**32, by doubling the reach."""
    h = (mix64(ids.astype(np.uint64) + np.uint64(1)) >> np.uint64(32)).astype(np.uint32)
    for step in range(WINDOW_STEPS):
        reach = 1 << step
        if len(h) > reach:
            h[reach:] += h[:-reach] << np.uint32(reach)
    return h


def cuts(ids: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each document, ascending, for documents one after another that end at ``ends``.

    At a document's first ids the hash still holds ids of the one before; but no chunk ends within MIN_CHUNK ids, so those are not looked at.
    """
    marks = np.flatnonzero(rolling_hash(ids) >> np.uint32(32 - CUT_BITS) == 0) + 1
    bounds = np.searchsorted(marks, ends, "left")
    marks, out, at, low = marks.tolist(), [], 0, 0
    for end, high in zip(ends.tolist(), bounds.tolist()):
        mine = []
        for m in [*marks[low:high], end]:
            while m - at > MAX_CHUNK:
                at += MAX_CHUNK
                mine.append(at)
            if m > at and (m - at >= MIN_CHUNK or m == end):
                mine.append(m)
                at = m
        out.append(mine)
        low = high
    return out


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:16]


class Merkle:
    """The root of a Merkle tree (RFC 6962) over leaves that come one by one: it keeps one hash for each level."""

    def __init__(self):
        self.levels: list[bytes | None] = []

    def add(self, node: bytes) -> None:
        for i, other in enumerate(self.levels):
            if other is None:
                self.levels[i] = node
                return
            self.levels[i], node = None, _pair(other, node)
        self.levels.append(node)

    def root(self) -> bytes:
        found = None
        for other in self.levels:
            if other is not None:
                found = other if found is None else _pair(other, found)
        return hashlib.sha256(b"").digest() if found is None else found


def _leaf(data: bytes) -> bytes:
    return hashlib.sha256(b"\0" + data).digest()


def _pair(a: bytes, b: bytes) -> bytes:
    return hashlib.sha256(b"\1" + a + b).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """The root over data; see ``tree`` for one over hashes."""
    return tree(list(map(_leaf, leaves)))


def tree(nodes: list[bytes]) -> bytes:
    if len(nodes) == 1:
        return nodes[0]
    t = Merkle()
    for n in nodes:
        t.add(n)
    return t.root()


def path_to(nodes: list[bytes], at: int) -> list[tuple[bool, bytes]]:
    """The hashes that lead from a node to the root of all: (whether it stands on the left, hash)."""
    if len(nodes) < 2:
        return []
    half = 1 << (len(nodes) - 1).bit_length() - 1
    if at < half:
        return [*path_to(nodes[:half], at), (False, tree(nodes[half:]))]
    return [*path_to(nodes[half:], at - half), (True, tree(nodes[:half]))]


def follow(node: bytes, path: list[tuple[bool, bytes]]) -> bytes:
    for left, other in path:
        node = _pair(other, node) if left else _pair(node, other)
    return node


def chunk_documents(documents: list[bytes], width: int) -> list[list[tuple[bytes, bytes]]]:
    """(digest, stored ids of ``width`` bytes) of each chunk of documents of little-endian unsigned 32-bit ids."""
    ids = np.frombuffer(b"".join(documents), "<u4")
    ends = np.cumsum([len(d) // 4 for d in documents])
    raw, at, out = ids.astype(f"<u{width}").tobytes(), 0, []
    for mine in cuts(ids, ends):
        chunks = []
        for end in mine:
            data = raw[at * width : end * width]
            chunks.append((digest(data), data))
            at = end
        out.append(chunks)
    return out


# crc32(a + b) from crc32(a), crc32(b) and len(b): the register of a is led through len(b) zero bytes, then added.


def _times(columns: np.ndarray, x: np.ndarray) -> np.ndarray:
    """What operators, given as the images of a register's 32 bits on the last axis, make of registers."""
    out = np.zeros(np.broadcast_shapes(columns.shape[:-1], x.shape), np.uint32)
    for i in range(32):
        out ^= np.where(x >> np.uint32(i) & np.uint32(1), columns[..., i], np.uint32(0))
    return out


_operators: np.ndarray | None = None


def zero_operators() -> np.ndarray:
    """For each n up to MAX_CHUNK, what n times four zero bytes do to each bit of the register."""
    global _operators
    if _operators is None:
        one = np.array([0xEDB88320] + [1 << i for i in range(31)], np.uint32)  # one zero bit
        for _ in range(5):
            one = _times(one, one)
        known = np.array([[1 << i for i in range(32)], one], np.uint32)
        while len(known) <= MAX_CHUNK:  # n + m ids: the operator of n after that of m
            known = np.concatenate((known, _times(_times(known[-1], one)[None, None, :], known[: MAX_CHUNK + 1 - len(known)])))
        _operators = known
    return _operators


def crc_of_lists(ends: np.ndarray, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC of each document from those of its chunks, all documents one chunk further at each step; lengths in ids, ``ends`` in chunks."""
    begins = np.concatenate(([0], ends[:-1]))
    total, operators = np.zeros(len(ends), np.uint32), zero_operators()
    for step in range(int((ends - begins).max(initial=0))):
        at = np.flatnonzero(ends - begins > step)
        k = begins[at] + step
        total[at] = _times(operators[lengths[k]], total[at]) ^ crcs[k].astype(np.uint32) if step else crcs[k]
    return total.astype(np.int64)


def _tokens(df: DataFrame, tokenizer: str) -> DataFrame:
    end = np.array([END_ID], "<u4").tobytes()
    seen: set[bytes] = set()  # each task has its own

    def f(r):
        if len(seen) > REMEMBERED:
            seen.clear()
        e = encoder(tokenizer)
        width = 2 if e.tokenizer.get_vocab_size() <= 1 << 16 else 4
        made = chunk_documents([ids + end for ids in e.encode(r["text"])], width)
        digests = [[h for h, _ in c] for c in made]
        ends = np.cumsum([0, *map(len, made)]).astype(np.int32)
        stored = [x for c in made for x in c]
        sizes = np.array([len(d) for _, d in stored], np.int32)
        fresh = pa.array([None if h in seen or seen.add(h) else d for h, d in stored], pa.binary())  # a task's copies go no further
        lists = (lambda values: pa.ListArray.from_arrays(ends, values))
        return {
            "doc_id": r["doc_id"], "n_tokens": np.add.reduceat(sizes, ends[:-1]).astype(np.int64) // width, "digests": lists(pa.array([h for h, _ in stored], pa.binary())),
            "lengths": lists(pa.array(sizes // width)), "root": list(map(merkle, digests)), "chunks": lists(fresh),
        }

    return map_arrow(df.select("doc_id", "text"), f, "doc_id long, n_tokens long, digests array<binary>, lengths array<int>, root binary, chunks array<binary>")


def write_store(docs: DataFrame, path: str, tokenizer: str) -> None:
    """Write the three tables below path."""
    spark, n = docs.sparkSession, partitions(docs.sparkSession)
    rows = _tokens(docs, tokenizer).withColumn("number", F.monotonically_increasing_id())
    rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/staged")
    staged = spark.read.parquet(f"{path}/staged")
    chunks = staged.select(F.explode(F.arrays_zip("digests", "lengths", "chunks")).alias("c")).select(F.col("c.digests").alias("digest"), F.col("c.lengths").alias("n"), F.col("c.chunks").alias("ids"))
    chunks = chunks.where("ids IS NOT NULL").repartition("digest").dropDuplicates(["digest"]).sortWithinPartitions("digest")
    chunks.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/chunks")
    order = ("doc_id", "root", "number")  # number is unique, so rows of one (or null) doc_id part like others
    ranged = staged.drop("chunks").repartitionByRange(n, *order).sortWithinPartitions(*order)
    ranged.withColumn("part", F.spark_partition_id()).write.mode("overwrite").parquet(f"{path}/ordered")
    remove(spark, f"{path}/staged")
    ordered = spark.read.parquet(f"{path}/ordered")
    parts = ordered.groupBy("part").agg(F.sum("n_tokens").alias("ids")).orderBy("part").collect()  # a row for each part
    before, starts = 0, []
    for p in parts:
        starts.append((p["part"], before))
        before += p["ids"]
    here = Window.partitionBy("part").orderBy(*order)
    offsets = spark.createDataFrame(starts, "part int, before long")
    recipes = ordered.join(F.broadcast(offsets), "part").withColumn("start", F.col("before") + F.coalesce(F.sum("n_tokens").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    recipes = recipes.withColumn("row", F.row_number().over(here).cast("long") - 1).select("doc_id", "start", "n_tokens", "digests", "lengths", "root", "part", "row")
    recipes.repartitionByRange(n, "part").sortWithinPartitions("part", "start").write.mode("overwrite").parquet(f"{path}/recipes")
    part_roots(spark.read.parquet(f"{path}/recipes")).write.mode("overwrite").parquet(f"{path}/manifest")
    remove(spark, f"{path}/ordered")


def part_roots(recipes: DataFrame) -> DataFrame:
    """part, rows, ids, the root of the tree over its documents' roots, and the roots of its blocks of BLOCK documents, which are nodes of it."""
    ordered = recipes.select("part", "start", "n_tokens", "root").repartition(partitions(recipes.sparkSession), "part").sortWithinPartitions("part", "start")
    schema = "part int, rows long, ids long, root binary, blocks array<binary>"
    arrow = arrow_schema(schema)

    def run(batches):
        part, rows, ids, block, blocks = None, 0, 0, Merkle(), []

        def row() -> pa.RecordBatch:
            every = blocks + [block.root()] * (rows % BLOCK > 0)
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((part, rows, ids, tree(every), every), arrow)], schema=arrow)

        for b in batches:
            for p, n, root in zip(*(b.column(i).to_pylist() for i in (0, 2, 3))):
                if p != part:
                    if part is not None:
                        yield row()
                    part, rows, ids, block, blocks = p, 0, 0, Merkle(), []
                block.add(_leaf(root))
                rows, ids = rows + 1, ids + n
                if rows % BLOCK == 0:
                    blocks.append(block.root())
                    block = Merkle()
        if part is not None:
            yield row()

    return ordered.mapInArrow(run, schema)


def store_root(spark: SparkSession, path: str) -> str:
    """The root of the tree over the parts' roots, in hex; the manifest has a row for each part."""
    return tree([bytes(r["root"]) for r in spark.read.parquet(f"{path}/manifest").select("part", "root").orderBy("part").collect()]).hex()


def document_proof(spark: SparkSession, path: str, doc_id: int) -> tuple[bytes, list[tuple[bool, bytes]]]:
    """The root of a document with that id and the path from it to the store's root: follow(_leaf(root), path) gives ``store_root``."""
    recipes = spark.read.parquet(f"{path}/recipes")
    mine = recipes.where(F.col("doc_id") == doc_id).select("part", "row", "root").first()
    low = mine["row"] // BLOCK * BLOCK
    block = recipes.where((F.col("part") == mine["part"]) & F.col("row").between(low, low + BLOCK - 1)).select("row", "root").collect()  # BLOCK rows at most
    manifest = sorted(spark.read.parquet(f"{path}/manifest").collect(), key=lambda r: r["part"])  # a row for each part
    at = next(i for i, r in enumerate(manifest) if r["part"] == mine["part"])
    leaves = [_leaf(bytes(r["root"])) for r in sorted(block, key=lambda r: r["row"])]
    blocks = [bytes(x) for x in manifest[at]["blocks"]]
    return bytes(mine["root"]), path_to(leaves, mine["row"] - low) + path_to(blocks, low // BLOCK) + path_to([bytes(r["root"]) for r in manifest], at)


def verified_chunks(spark: SparkSession, path: str) -> DataFrame:
    """digest, n and CRC (of unsigned 32-bit ids) of each stored chunk, from its bytes; a wrong digest is an error."""

    def f(r):
        for d, data, n in zip(r["digest"], r["ids"], r["n"]):
            if digest(data) != d or len(data) not in (2 * n, 4 * n):
                raise ValueError(f"chunk {d.hex()} is damaged")
        ends = np.cumsum([4 * n for n in r["n"]]).tolist()
        if any(len(data) != 2 * n for data, n in zip(r["ids"], r["n"])):
            wide = b"".join(stored_ids(data, n).astype("<u4").tobytes() for data, n in zip(r["ids"], r["n"]))
        else:
            wide = np.frombuffer(b"".join(r["ids"]), "<u2").astype("<u4").tobytes()
        return {"digest": r["digest"], "n": r["n"], "crc": [zlib.crc32(wide[a:b]) for a, b in zip([0, *ends], ends)]}

    return map_arrow(spark.read.parquet(f"{path}/chunks").select("digest", "n", "ids"), f, "digest binary, n int, crc long")


def stored_ids(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}" if n else "<u2")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    recipes = spark.read.parquet(f"{path}/recipes")
    steps = recipes.select("start", "part", F.posexplode("digests").alias("at", "digest"))
    found = steps.join(verified_chunks(spark, path), "digest", "left")  # skewed digests are split by the join
    lists = found.groupBy("part", "start").agg(F.array_sort(F.collect_list(F.struct("at", "n", "crc"))).alias("c"))
    lists = lists.select("part", "start", F.col("c.n").alias("n"), F.col("c.crc").alias("crc"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    arrow = arrow_schema(schema)

    def run(batches):
        for b in batches:
            r = dict(zip(b.schema.names, b.columns))
            n, crc = r["n"].flatten(), r["crc"].flatten()
            if n.null_count or r["n"].null_count or len(n) != len(r["digests"].flatten()):
                raise ValueError("a document's recipe names a chunk that is not stored")
            ends = r["n"].value_lengths().to_numpy().cumsum()
            n, totals = n.to_numpy(), r["n_tokens"].to_numpy()
            if (np.diff(np.concatenate(([0], np.concatenate(([0], n.cumsum()))[ends]))) != totals).any() or any(merkle(d) != root for d, root in zip(r["digests"].to_pylist(), r["root"].to_pylist())):
                raise ValueError("a document's recipe doesn't lead to its root")
            yield pa.RecordBatch.from_arrays([r["doc_id"], r["start"], r["n_tokens"], pa.array(crc_of_lists(ends, crc.to_numpy(), n))], schema=arrow)

    whole = recipes.join(lists, ["part", "start"], "left").select("doc_id", "start", "n_tokens", "digests", "root", "n", "crc")
    wrong = part_roots(recipes).exceptAll(spark.read.parquet(f"{path}/manifest")).limit(1).count()
    if wrong:
        raise ValueError("a part doesn't lead to the manifest's root")
    return whole.mapInArrow(run, schema)


def reconstruct(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start, ids (array<int>) of all or some documents."""
    recipes = spark.read.parquet(f"{path}/recipes")
    if doc_ids is not None:
        recipes = recipes.where(F.col("doc_id").isin(doc_ids))
    steps = recipes.select("doc_id", "start", F.posexplode("digests").alias("at", "digest"))
    lists = steps.join(spark.read.parquet(f"{path}/chunks"), "digest").groupBy("doc_id", "start").agg(F.array_sort(F.collect_list(F.struct("at", "n", "ids"))).alias("c"))

    def f(r):
        return {"doc_id": r["doc_id"], "start": r["start"], "ids": [np.concatenate([stored_ids(x["ids"], x["n"]) for x in c]).tolist() for c in r["c"]]}

    return map_arrow(lists, f, "doc_id long, start long, ids array<int>")


def op6_chunk_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark, ROWS)
    path = shared_dir(spark)
    write_store(documents(spark, sf_dir), path, public_path("byte_bpe_50k.json"))
    return read_store(spark, path)
