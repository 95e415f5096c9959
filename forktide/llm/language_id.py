"""Language identification with string kernels.

A text's blended spectrum is the set of its character n-grams, n = 1 to 4, over letters with every other run of
characters as one space; each gram is hashed to one of 2**18 numbers.  The presence kernel of two texts is the cosine of their
sets, |x & y| / sqrt(|x| |y|).  A bounded sample of labelled texts trains one-versus-rest kernel ridge regression on
Nystrom features of landmark texts.  The decision function k(x, landmarks) . beta is linear in the presence vector of x,
so the landmarks' presence vectors and beta are multiplied once, and a batch of texts is scored by one product of its presence matrix.

Every label is learned.  Bounds: SAMPLE_ROWS labelled rows in all train the model, or LEAST_ROWS of each language if that is more; LANDMARKS of them are
landmarks, or one of each language up to MOST_LANDMARKS.  So the model grows with the number of languages and with nothing else; it is solved and
applied in blocks of LANGUAGES.  The sample's kernel rows are computed on executors; the driver gets a count of each language, the landmarks' sets
(32 KB of bits each before compression) and a number for each landmark and row.  Every other step covers all rows.

Defined cases: a null text, or one without a letter, gets ``und`` and score 0, as does every text if no labelled row can be
learned from; ties go to the language first by name; texts are read whole; rows that are alike get the same answer; a
null doc_id counts as an empty text for the fold and is never learned from; repeated rows may be learned from more than once; an
empty table gives an empty result; other columns, whatever their names, are ignored by the query and kept by the stage.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, documents, map_arrow, numbered, partitions, written

BITS = 18
ORDERS = (1, 2, 3, 4)
SAMPLE_ROWS = 1600
LANDMARKS = 200
RIDGE = 1e-2
FOLDS = 5
#: Of each language, if SAMPLE_ROWS are too few for so many.
LEAST_ROWS = 10
MOST_LANDMARKS = 1000
#: Languages that are solved for and scored together.
LANGUAGES = 64
UNDETERMINED = "und"
#: The stage's least share of a text's grams that some landmark has.  Unlearned scripts have 0.07 to 0.25 (the space, and hashes met
#: by chance), 6,000 documents at sf0.1 have 0.82 or more.
EVIDENCE = 0.5
#: The stage's least score, where 0 is what a guess among the languages would have and 1 is certain.  With four languages it is a score of 0.4: every
#: classifier's value is below -0.2, where 1 is its own language and -1 another.  At sf0.1 one document, a repeated shout, is below it; 0.45 would
#: take ten, three of them labelled good.
LEAST_EVIDENT = 0.2
#: Texts of one presence matrix.
SCORE_BATCH = 32

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def spectrum(text: str | None) -> np.ndarray:
    """The sorted numbers of the text's n-grams; empty without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    known = letters()[codes]
    if not known.any():
        return np.empty(0, np.int64)
    codes = np.where(known, codes, np.uint32(32))
    keep = np.ones(len(codes), bool)
    keep[1:] = known[1:] | known[:-1]
    codes = codes[keep]
    codes = np.concatenate(([32], codes[int(codes[0] == 32) : len(codes) - int(codes[-1] == 32)], [32])).astype(np.uint64)
    seen, h = np.zeros(1 << BITS, bool), np.zeros(len(codes), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        if len(codes) < n:
            break
        h = (h[: len(codes) - n + 1] + codes[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if n in ORDERS:
            seen[(h >> np.uint64(64 - BITS)).astype(np.int64)] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    languages: list[str]
    #: Column of each gram in weights, -1 for grams of no landmark.
    column: np.ndarray
    #: A matrix for each block of languages.
    weights: list[np.ndarray]

    def score(self, texts: list[str | None], least: float = 0.0) -> tuple[list[str], list[float]]:
        """Texts of whose grams less than the share ``least`` is a landmark's count as undetermined."""
        labels, scores = [], []
        for at in range(0, len(texts), SCORE_BATCH):
            sets = [spectrum(t) for t in texts[at : at + SCORE_BATCH]]
            presence = np.zeros((len(sets), int(self.column.max(initial=-1)) + 1), np.float32)
            for i, (row, s) in enumerate(zip(presence, sets)):
                c = self.column[s]
                row[c[c >= 0]] = 1
                if np.count_nonzero(c >= 0) < least * len(s):
                    sets[i] = s[:0]
            size = np.sqrt([max(1, len(s)) for s in sets])
            value = np.concatenate([np.zeros((len(sets), 0)), *(presence @ w for w in self.weights)], 1) / size[:, None]
            for s, v in zip(sets, value):
                best = int(np.argmax(v)) if len(v) and len(s) else -1
                labels.append(self.languages[best] if best >= 0 else UNDETERMINED)
                scores.append(float(np.clip((1 + v[best]) / 2, 0, 1)) if best >= 0 else 0.0)
        return labels, scores


@dataclass
class Landmarks:
    """The landmarks' sets, one after another, as columns; the columns are the grams that some landmark has."""

    column: np.ndarray
    flat: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, sets: list[np.ndarray]) -> Landmarks:
        used = np.unique(np.concatenate(sets)) if sets else np.empty(0, np.int64)
        column = np.full(1 << BITS, -1, np.int32)
        column[used] = np.arange(len(used))
        return cls(column, column[np.concatenate(sets)] if sets else np.empty(0, np.int32), np.array([len(x) for x in sets], np.int64))

    @property
    def columns(self) -> int:
        return int(self.column.max(initial=-1)) + 1

    @property
    def presence(self) -> np.ndarray:
        """Column by landmark: 1 where it has the gram; a worker makes it once."""
        if "_presence" not in self.__dict__:
            self._presence = np.zeros((self.columns, len(self.sizes)), np.uint8)
            self._presence[self.flat, np.repeat(np.arange(len(self.sizes)), self.sizes)] = 1
        return self._presence

    def kernel(self, grams: np.ndarray) -> np.ndarray:
        """The presence kernel of a text with each landmark."""
        c = self.column[grams]
        both = self.presence[c[c >= 0]].sum(0, dtype=np.uint32)
        return (both / np.sqrt(np.maximum(1, self.sizes) * max(1, len(grams)))).astype(np.float32)

    def times(self, beta: np.ndarray) -> np.ndarray:
        """Weights of the columns: the sum of the landmarks' normalised presence vectors times beta."""
        out = np.zeros((self.columns, beta.shape[1]))
        for row, end, n in zip(beta, np.cumsum(self.sizes), self.sizes):
            out[self.flat[end - n : end]] += row / np.sqrt(max(1, n))
        return out.astype(np.float32)


def fit(marks: Landmarks, near: np.ndarray, langs: list[str], ridge: float = RIDGE) -> Model:
    """near: a row of kernels with the landmarks for each row of the sample, whose first rows are the landmarks."""
    languages = sorted(set(langs))
    if not languages:
        return Model([], marks.column, [])
    between = near[: len(marks.sizes)].astype(np.float64)
    values, vectors = np.linalg.eigh((between + between.T) / 2)
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])  # Nystrom: k(x, y) ~ f(x) . f(y) with f(x) = k(x, marks) root
    f = near.astype(np.float64) @ root
    number = np.searchsorted(languages, langs)
    weight = 1.0 / np.bincount(number)[number]  # each language counts alike
    weight *= len(langs) / weight.sum()
    inner = f.T @ (f * weight[:, None]) + ridge * len(langs) / len(between) * np.eye(f.shape[1])
    weights = []
    for low in range(0, len(languages), LANGUAGES):
        target = np.where(number[:, None] == np.arange(low, min(low + LANGUAGES, len(languages))), 1.0, -1.0)
        weights.append(marks.times(root @ np.linalg.solve(inner, f.T @ (target * weight[:, None]))))
    return Model(languages, marks.column, weights)


def fold(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS


def training_sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """turn, lang, doc_id, text: of every language as many rows as of the others, those first by a hash of their id, from the folds but 0.

    Only rows whose hash is below a bound come to the window, half as many again as are wanted, so that no language is gathered.
    """
    spark = docs.sparkSession
    known = docs.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
    found = known.groupBy("lang").count().collect()  # a row a language
    each = max(LEAST_ROWS, rows // max(1, len(found)))
    bounds = [(r["lang"], int(-(2**63) + 2**64 * min(1 - 2**-40, (1.5 * each + 64) / r["count"]))) for r in found]
    first = known.join(F.broadcast(spark.createDataFrame(bounds, "lang string, bound long")), "lang").withColumn("hash", F.xxhash64("doc_id"))
    first = first.where((F.col("hash") <= F.col("bound")) & F.col("text").isNotNull())
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "doc_id", "text"))
    return first.withColumn("turn", turn).where(F.col("turn") <= each).select("turn", "lang", "doc_id", "text")


def _bits(grams: np.ndarray) -> bytes:
    seen = np.zeros(1 << BITS, bool)
    seen[grams] = True
    return zlib.compress(np.packbits(seen).tobytes(), 1)


def _grams(bits: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(zlib.decompress(bits), np.uint8)))


def train(sample: DataFrame, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """sample: the columns of training_sample; its first rows by turn and language are the landmarks."""
    sample, order = written(sample), ("turn", "lang", "doc_id")
    landmarks = max(landmarks, min(MOST_LANDMARKS, sample.where("turn = 1").count()))  # the first row of each language comes first
    marks = map_arrow(sample.orderBy(*order).limit(landmarks), lambda r: {n: r[n] for n in order} | {"bits": [_bits(spectrum(t)) for t in r["text"]]}, "turn int, lang string, doc_id long, bits binary")
    sets = Landmarks.of([_grams(r["bits"]) for r in sorted(marks.collect(), key=lambda r: tuple(r[n] for n in order))])
    shared = sample.sparkSession.sparkContext.broadcast(sets)  # LANDMARKS sets of 2**18 grams at most

    def f(r):
        return {n: r[n] for n in order} | {"near": [shared.value.kernel(spectrum(t)).tobytes() for t in r["text"]]}

    rows = map_arrow(sample.repartition(partitions(sample.sparkSession)), f, "turn int, lang string, doc_id long, near binary").collect()  # the sample's rows, a number for each landmark
    shared.destroy()
    rows.sort(key=lambda r: tuple(r[n] for n in order))
    near = np.array([np.frombuffer(r["near"], np.float32) for r in rows], np.float32).reshape(len(rows), len(sets.sizes))
    return fit(sets, near, [r["lang"] for r in rows], ridge)


def identify(docs: DataFrame, model: Model, keep: list[str] = ("doc_id",), least: float = 0.0) -> DataFrame:
    """The kept columns with lang_pred and score; text is the model's only input.  No kept column may have one of these two names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the landmarks' grams, 2**18 at most, times the languages
    kept = list(keep)

    def f(r):
        labels, scores = shared.value.score(r["_text"], least)
        return {n: r[n] for n in kept} | {"lang_pred": labels, "score": scores}

    fields = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in kept)
    return map_arrow(docs.select(*(F.col(f"`{n}`") for n in kept), F.col("text").alias("_text")), f, f"{fields}, lang_pred string, score double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = documents(spark, sf_dir)
    found = identify(docs, train(training_sample(docs)))
    return found.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, languages: list[str] | None = None, least_evident: float = LEAST_EVIDENT) -> DataFrame:
    """Documents stay as they are, but for those that go: null, without a letter, with too few of the landmarks' grams, with a score that is too near
    to a guess's, or found to be in none of ``languages`` (None: every language that is learned)."""
    bounded_batches(spark)
    plain, carried = numbered(docs)
    model = train(training_sample(docs))
    guess = 1 / max(1, len(model.languages))
    found = identify(plain, model, carried, EVIDENCE)
    wanted = F.col("lang_pred") != UNDETERMINED if languages is None else F.col("lang_pred").isin(languages)
    return found.where(wanted & (F.col("score") >= guess + least_evident * (1 - guess))).select(*carried).toDF(*docs.columns)
