"""Shared helpers: word splitting, word hashes, bounded Arrow batches and shared-folder tables."""

from __future__ import annotations

import atexit
import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in one Arrow batch; a batch of very long texts stays small.
ROWS_PER_BATCH = 256
#: Bytes after which a batch is closed; one longer text is a batch of its own.
BYTES_PER_BATCH = 16 << 20
#: Words kept in a worker's hash cache before it is emptied.
CACHE_WORDS = 200_000
#: Of the bitmap that spares rows without a partner a shuffle: 2 ** 26 bits are 8 MB.
FILTER_BITS = 26


def bounded_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Keep the Arrow batches of this session small, in rows and in bytes, so that long texts don't fill a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))


def words_of(text: str | bytes | None) -> list[bytes]:
    r"""Maximal runs of ``[^\x20\x09-\x0D]`` as UTF-8, of a text or its UTF-8; ``bytes.split`` cuts at exactly these six bytes."""
    return [] if text is None else (text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")).split()


class WordHashes(dict):
    """word -> 64-bit hash, computed once per worker and word; the size is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


WORD_HASHES = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(WORD_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: a bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """One 64-bit hash for each run of n consecutive word hashes: a polynomial in an odd base, by doubling the run, then mixed."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    base, runs, out, done = 0x9E3779B97F4A7C15, {1: h}, None, 0
    while 2 * (k := max(runs)) <= n:
        runs[2 * k] = runs[k][:-k] * np.uint64(pow(base, k, 1 << 64)) + runs[k][k:]
    for k in sorted(runs, reverse=True):
        if n & k:
            size = len(h) - done - k + 1
            out = runs[k] if out is None else out[:size] * np.uint64(pow(base, k, 1 << 64)) + runs[k][done : done + size]
            done += k
    return mix64(out)


def map_arrow(df: DataFrame, f: Callable[[dict[str, list]], Iterator[dict] | dict], schema: str) -> DataFrame:
    """mapInArrow over Python columns: f gets a batch as {column: list} and returns {column: list} of the schema."""
    names, out_schema = df.columns, arrow_schema(schema)

    def run(batches):
        for b in batches:
            if b.num_rows:
                got = f({n: b.column(i).to_pylist() for i, n in enumerate(names)})
                for part in [got] if isinstance(got, dict) else got:
                    yield pa.RecordBatch.from_arrays([as_array(part[x.name], x.type) for x in out_schema], schema=out_schema)

    return df.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def numbered(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with columns of names that clash with none, and text beside them; the new names, in the old order."""
    names = [f"_in_{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names).withColumn("text", F.col(names[docs.columns.index("text")])), names


def as_array(values, kind: pa.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, type=kind)


_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; only where that is unset (tests on one machine) a temporary one."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        top = f"file://{tempfile.gettempdir()}/forktide-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", top)
    path = f"{top.rstrip('/')}/forktide/{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def tables_made() -> int:
    """A mark for discard()."""
    return len(_made)


def discard(spark: SparkSession, since: int) -> None:
    """Remove the tables written since a mark; nothing that is still to run may read them."""
    late = _made[since:]
    _made[since:] = [x for x in late if x[0] is not spark]
    for owner, path in late:
        if owner is spark:
            remove(spark, path)


@atexit.register
def _remove_all() -> None:
    for spark, path in _made:
        try:
            if spark.sparkContext._jsc is not None:
                remove(spark, path)
        except Exception:  # the session may be gone by now
            return


def written(df: DataFrame, path: str | None = None, compression: str = "snappy") -> DataFrame:
    """The rows as a Parquet table in the shared folder: a cut in the lineage that outlives lost executors."""
    spark = df.sparkSession
    path = path or shared_dir(spark)
    df.write.mode("overwrite").option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def likely(rows: DataFrame, key: str, ids: DataFrame, yes: bool) -> DataFrame:
    """The rows whose key may be in the first column of ids, or (yes false) the others, which are surely not in it.

    A bitmap of FILTER_BITS hashed ids, at most 8 MB, is broadcast to the scan, so that a shuffle gets few other rows; past
    some ten million ids it lets more and more pass, and the join that follows decides.
    """
    place = F.pmod(F.xxhash64(key), F.lit(1 << FILTER_BITS))
    bits = ids.select(F.pmod(F.xxhash64(ids.columns[0]), F.lit(1 << FILTER_BITS)).alias("_bit"))
    maps = bits.groupBy(F.floor(F.col("_bit") / 32768).alias("_block")).agg(F.bitmap_construct_agg(F.col("_bit") % 32768).alias("_bits"))
    found = rows.withColumn("_place", place).join(F.broadcast(maps), F.floor(F.col("_place") / 32768) == F.col("_block"), "left")
    at = (F.col("_place") % 32768).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, at % 8) == 1, F.lit(False))
    return found.where(hit if yes else ~hit).select(*(F.col(f"`{c}`") for c in rows.columns))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unsigned32(c):
    return F.when(c < 0, c + F.lit(1 << 32)).otherwise(c)
