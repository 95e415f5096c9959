"""SentencePiece encoding and decoding by a streaming Viterbi search.

The text, with spaces as U+2581 and one such sign before it, is cut into the pieces with the largest sum of scores.  The search
runs over the text once.  It keeps best paths to the last ``longest`` positions alone; whenever the backpointers of all of
them meet at one boundary, the ids up to that boundary are final, are given out, and the window's tail is forgotten.  So a
text of any length takes memory for its undecided part only.

If no piece has the sign behind another character, every path passes the boundary before each run of signs, so the stream
commits there whatever stands around, and the stretch from one such commit to the next always gives the same ids.  A worker
remembers the ids of short stretches behind their commits; the streams of new ones run in step, those of one length together, with
pieces found in a table of hashes.

Scores are taken as whole numbers of 2 ** -SCALE, so sums are exact: neither where a stream begins or commits, nor what runs beside it,
can change a sum or a tie.

Characters without a piece become their UTF-8 bytes' pieces, at the lowest score less 10, as does U+2581 itself where the
text has it; so decoding gives every text back.  Of equal sums the path whose last piece is longest wins.

Defined cases: a null or empty text has no ids; repeated rows get the same ids; a null doc_id is carried; an empty table gives
an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import bounded_batches, documents, map_arrow
from .tokens import public_path

SIGN = "▁"
#: Stands for a U+2581 of the text itself while it is searched; a lone surrogate, which no piece and no valid text has.
LITERAL = "\ud800"
PENALTY = 10.0
CACHE_WORDS = 700_000
#: Longer stretches are streamed each time they come.
CACHE_LENGTH = 64
TABLE_BITS = 17
#: Streams of one length that are worth a step together; fewer go one by one, to the same ids.
LANES = 8
#: Binary places of a score that count; those of a vocabulary of ranks or of logarithms in single precision need fewer.
SCALE = 20


def exact(score: float) -> int:
    return round(score * (1 << SCALE))


#: Less than any sum.
NONE = -(1 << 62)


class PieceModel:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        m = SentencePieceProcessor(model_file=path)
        ids = range(m.get_piece_size())
        special = {i for i in ids if m.is_control(i) or m.is_unknown(i) or m.is_unused(i)}
        self.bytes = {int(m.id_to_piece(i)[1:-1], 16): i for i in ids if m.is_byte(i)}
        self.text = {i: m.id_to_piece(i) for i in ids if i not in special and not m.is_byte(i)}
        self.pieces = {p: (i, exact(m.get_score(i))) for i, p in self.text.items()}
        self.longest = max(map(len, self.pieces))
        self.prefixes = {p[:n] for p in self.pieces for n in range(1, len(p) + 1)}
        self.unknown = min(s for _, s in self.pieces.values()) - exact(PENALTY)
        self.byte_of = {i: b for b, i in self.bytes.items()}
        if len(self.bytes) != 256 or max(self.byte_of) - min(self.byte_of) != 255:
            raise ValueError("the model has no run of pieces for bytes")
        #: True if no piece has the sign behind another character.
        self.words = not any(SIGN in p.lstrip(SIGN) for p in self.pieces)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._table()

    def _table(self) -> None:
        """Open addressing: the hash of each piece at the first free slot from its own on."""
        names = list(self.pieces)
        hashes = np.zeros(len(names), np.uint64)
        for n in range(1, self.longest + 1):
            at = [i for i, p in enumerate(names) if len(p) == n]
            if at:
                codes = np.frombuffer("".join(names[i] for i in at).encode("utf-32-le"), np.uint32).reshape(len(at), n)
                h = np.zeros(len(at), np.uint64)
                for k in range(n):
                    h = self.step(h, codes[:, k])
                hashes[at] = h
        if len(set(hashes.tolist())) < len(names) or not hashes.all():
            raise ValueError("two pieces have one hash")
        self.slots = np.zeros(1 << TABLE_BITS, np.uint64)
        self.slot_id, self.slot_score, self.probes = np.zeros(len(self.slots), np.int32), np.zeros(len(self.slots), np.int64), 1
        for p, h in zip(names, hashes.tolist()):
            at, tries = h >> (64 - TABLE_BITS), 1
            while self.slots[at]:
                at, tries = (at + 1) % len(self.slots), tries + 1
            self.slots[at], (self.slot_id[at], self.slot_score[at]) = h, self.pieces[p]
            self.probes = max(self.probes, tries)

    @staticmethod
    def step(h: np.ndarray, code: np.ndarray) -> np.ndarray:
        h = (h + code.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(32))

    def find(self, h: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 if no piece has it."""
        at = (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        there = self.slots[at]
        out = np.where(there == h, at, -1)
        open_ = np.flatnonzero((there != h) & (there != 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) % len(self.slots)
            there = self.slots[at[open_]]
            out[open_[there == h[open_]]] = at[open_[there == h[open_]]]
            open_ = open_[(there != h[open_]) & (there != 0)]
        return out

    def stream_many(self, stretches: list[str]) -> list[bytes]:
        """The streams' ids of stretches of text, each from one boundary that all paths pass to the next; those of one length run in step."""
        out: list[bytes] = [b""] * len(stretches)
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(stretches):
            by_length.setdefault(len(w), []).append(i)
        for at in by_length.values():
            if len(at) < LANES:  # alone or in step, the sums are the same whole numbers
                for i in at:
                    out[i] = array("I", [k for run in self.stream([self.signed(stretches[i])]) for k in run]).tobytes()
                continue
            for low in range(0, len(at), 4096):
                some = at[low : low + 4096]
                for i, ids in zip(some, self._in_step([self.signed(stretches[i]) for i in some])):
                    out[i] = ids
        return out

    def _in_step(self, lanes: list[str]) -> list[bytes]:
        """``stream`` for texts of one length at once.  A column holds all lanes' best paths to one position.

        After every ``longest`` positions the lanes' surviving paths are followed back to where they meet; the ids up to there are
        given out, and columns that no lane needs any more are forgotten.
        """
        n, length, reach = len(lanes), len(lanes[0]), self.longest
        codes = np.ascontiguousarray(np.frombuffer("".join(lanes).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length).T)
        best, back, piece = {0: np.zeros(n, np.int64)}, {}, {}
        given = np.zeros(n, np.int64)
        out: list[list[int]] = [[] for _ in lanes]
        for s in range(length):
            h, base = np.zeros(n, np.uint64), best.pop(s)
            for end in range(s + 1, min(length, s + reach) + 1):
                if end not in best:
                    best[end], back[end], piece[end] = np.full(n, NONE), np.zeros(n, np.int32), np.full(n, -1, np.int32)
                h = self.step(h, codes[end - 1])
                slot = self.find(h)
                hit = np.flatnonzero(slot >= 0)
                if end == s + 1:
                    lone = np.flatnonzero(slot < 0)
                    better = lone[base[lone] + self.unknown > best[end][lone]]
                    best[end][better], back[end][better], piece[end][better] = base[better] + self.unknown, s, -1
                if len(hit):
                    score = base[hit] + self.slot_score[slot[hit]]
                    up = score > best[end][hit]
                    hit = hit[up]
                    best[end][hit], back[end][hit], piece[end][hit] = score[up], s, self.slot_id[slot[hit]]
            if s + 1 == length:
                self._give(lanes, out, given, np.full(n, length), back, piece)
            elif (s + 1) % reach == 0:
                top = np.max(list(best.values()), 0)
                best = {k: np.where(x > NONE, x - top, NONE) for k, x in best.items()}  # sums of a long stretch stay small
                meet = self._meeting(best, back, given)
                self._give(lanes, out, given, meet, back, piece)
                given = meet
                for k in [k for k in back if k <= given.min()]:
                    del back[k], piece[k]
        return [array("I", ids).tobytes() for ids in out]

    @staticmethod
    def _meeting(best: dict[int, np.ndarray], back: dict[int, np.ndarray], given: np.ndarray) -> np.ndarray:
        """For each lane the last position that every surviving path passes: of the live ends the furthest steps back until one is left."""
        low, high = int(given.min()), max(best)
        alive = np.zeros((high - low + 1, len(given)), bool)
        for k, score in best.items():
            alive[k - low] = score > NONE
        left = alive.sum(0)
        for k in range(high, low, -1):
            lane = np.flatnonzero(alive[k - low] & (left > 1))
            to = back[k][lane] - low
            left[lane] -= alive[to, lane]
            alive[k - low, lane] = False
            alive[to, lane] = True
        return low + alive.argmax(0)

    def _give(self, lanes: list[str], out: list[list[int]], given: np.ndarray, meet: np.ndarray, back: dict[int, np.ndarray], piece: dict[int, np.ndarray]) -> None:
        """Add the ids between what each lane has given out and where its paths meet."""
        low = int(given.min())
        columns = range(low + 1, int(meet.max()) + 1)
        to, ids = (np.array([x[k] for k in columns]).reshape(len(columns), -1).T.tolist() for x in (back, piece))
        for i, (begin, end) in enumerate(zip(given.tolist(), meet.tolist())):
            path = []
            while end > begin:
                k, start = ids[i][end - low - 1], to[i][end - low - 1]
                if k >= 0:
                    path.append(k)
                else:
                    path += reversed(self.fallback(lanes[i][start]))
                end = start
            out[i] += reversed(path)

    def fallback(self, char: str) -> list[int]:
        return [self.bytes[b] for b in (SIGN if char == LITERAL else char).encode("utf-8", "surrogatepass")]

    def advance(self, window: str, best: list[int], back: list[tuple[int, int]], at: int, to: int) -> None:
        """Lead the paths that end at the positions from ``at`` to before ``to`` on by one piece each."""
        pieces, prefixes, n = self.pieces, self.prefixes, len(window)
        for start in range(at, to):
            base, end, known = best[start], start + 1, False
            while end <= n and (p := window[start:end]) in prefixes:
                if p in pieces:
                    k, score = pieces[p]
                    if base + score > best[end]:
                        best[end], back[end] = base + score, (start, k)
                    known = known or end == start + 1
                end += 1
            if not known and base + self.unknown > best[start + 1]:
                best[start + 1], back[start + 1] = base + self.unknown, (start, -1)

    def stream(self, blocks: Iterable[str]) -> Iterator[list[int]]:
        """Runs of final ids of the signed text, which comes in blocks, as soon as they are final."""
        window, best, back, at = "", [0], [(0, -1)], 0
        for block in blocks:
            for cut in range(0, len(block), 4 * self.longest):
                part = block[cut : cut + 4 * self.longest]
                window += part
                best += [NONE] * len(part)
                back += [(0, -1)] * len(part)
                to = max(at, len(window) - self.longest)  # a piece that begins here ends within the window
                self.advance(window, best, back, at, to)
                at = to
                meet = self.boundary(best, back, at)
                if meet:
                    yield self.path(window, back, meet)
                    window, best, at = window[meet:], [b - best[meet] if b > NONE else NONE for b in best[meet:]], at - meet
                    back = [(max(0, s - meet), k) for s, k in back[meet:]]
        self.advance(window, best, back, at, len(window))
        yield self.path(window, back, len(window))

    def boundary(self, best: list[int], back: list[tuple[int, int]], at: int) -> int:
        """The last position that every surviving path passes; surviving are those that end at ``at`` or behind it."""
        alive = {i for i in range(at, len(best)) if best[i] > NONE}
        while len(alive) > 1:
            last = max(alive)
            alive.discard(last)
            alive.add(back[last][0])
        return alive.pop()

    @staticmethod
    def signed(text: str) -> str:
        """A sign and the text, in which every space is one."""
        return SIGN + text.replace(SIGN, LITERAL).replace(" ", SIGN)

    def path(self, window: str, back: list[tuple[int, int]], end: int) -> list[int]:
        out = []
        while end:
            start, k = back[end]
            out += [k] if k >= 0 else reversed(self.fallback(window[start]))
            end = start
        return out[::-1]

    def encode_stream(self, text: str) -> list[int]:
        return [k for run in self.stream([self.signed(text) if text else ""]) for k in run]

    def words_of(self, text: str) -> list[str]:
        """The text's words, each with the spaces before it but for one."""
        words = text.split(" ")
        if "" not in words:
            return words
        out, run = [], 0
        for w in words[:-1]:
            if w:
                out.append(" " * run + w)
            run = 0 if w else run + 1
        return [*out, " " * run + words[-1]]

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        if not self.words:
            return [array("I", self.encode_stream(t or "")).tobytes() for t in texts]
        if len(self.cache) > CACHE_WORDS:
            self.older, self.cache = self.cache, {}
        cache, older = self.cache, self.older
        split = [self.words_of(t) if t else [] for t in texts]
        missing = set().union(*split) - cache.keys()
        again = missing & older.keys()
        cache.update((w, older[w]) for w in again)
        missing = list(missing - again)
        cache.update(zip(missing, self.stream_many(missing)))
        out = [b"".join(map(cache.__getitem__, s)) for s in split]
        for w in missing:
            if len(w) > CACHE_LENGTH:
                del cache[w]
        return out

    def decode(self, ids: Iterable[int]) -> str:
        out, raw = [], bytearray()
        for k in ids:
            b = self.byte_of.get(k)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode("utf-8", "surrogatepass"))
                raw.clear()
            out.append(self.text[k].replace(SIGN, " "))
        out.append(raw.decode("utf-8", "surrogatepass"))
        return "".join(out)[1:]

    def decode_array(self, ids: bytes) -> str:
        """decode() over arrays: byte pieces and others differ by their UTF-8 alone, so all are joined as UTF-8."""
        if not hasattr(self, "_utf8"):
            self._utf8 = [b""] * (max(max(self.text), max(self.byte_of)) + 1)
            for k, p in self.text.items():
                self._utf8[k] = p.replace(SIGN, " ").encode()
            for k, b in self.byte_of.items():
                self._utf8[k] = bytes([b])
        return b"".join(map(self._utf8.__getitem__, np.frombuffer(ids, "<u4").tolist()))[1:].decode("utf-8", "surrogatepass")


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode_column(df: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) -> (doc_id, text, ids binary)."""

    def f(r):
        return {"doc_id": r["doc_id"], "text": r["text"], "ids": model(path).encode_all(r["text"])}

    return map_arrow(df.select("doc_id", "text"), f, "doc_id long, text string, ids binary")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids_crc32, n_bytes (UTF-8 bytes of the fallback), decoded_sha256 and same (decoded text = text)."""
    bounded_batches(spark, 1024)  # more new stretches of one length run in step
    path = public_path("piece_bpe_32k.model")

    def f(r):
        m = model(path)
        ids = m.encode_all(r["text"])
        texts = [m.decode_array(i) for i in ids]
        low, high = min(m.byte_of), max(m.byte_of)
        return {
            "doc_id": r["doc_id"], "n_ids": [len(i) // 4 for i in ids], "ids_crc32": [zlib.crc32(i) for i in ids],
            "n_bytes": [int(((a >= low) & (a <= high)).sum()) for a in (np.frombuffer(i, "<u4") for i in ids)],
            "decoded_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts],
            "same": [t == (x or "") for t, x in zip(texts, r["text"])],
        }

    return map_arrow(documents(spark, sf_dir).select("doc_id", "text"), f, "doc_id long, n_ids long, ids_crc32 long, n_bytes long, decoded_sha256 string, same boolean")
