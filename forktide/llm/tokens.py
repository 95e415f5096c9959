"""Token ids of whole texts by the tokenizers library, with the ids of repeated chunks kept.

A text is cut only where the tokenizer's own rules can't join or look across the cut, so the ids of the chunks, one after
another, are the ids of the text:

* word BPE drops white space, and none of its patterns, rules of normalisation or special strings spans an ASCII space;
* byte BPE takes one space into the word behind it, and only a space that has a character other than white space behind it
  begins a chunk here; runs of white space stay with what stands before them;
* neither has a pattern that takes a letter and a sign behind it, but for the apostrophe; | is left out as well, as special
  strings end with it;
* byte BPE takes a line's end alone as an id of its own where no other white space stands beside it.

Word BPE ignores case, so its texts are first put into ASCII lower case, but for those with ``<|`` (special strings have a case)
or with combining marks (an ASCII letter may compose with one).

The texts of a call are cut as one array of bytes, equal chunks are numbered by Arrow, and only different ones are looked up.
Ids are held as little-endian unsigned 32-bit integers.  A worker keeps two generations of CACHE_CHUNKS chunks: when the younger
is full the older goes, and chunks still met move up.
"""

from __future__ import annotations

import gc
import os
import re
import sys
from array import array

import numpy as np
import pyarrow as pa

CACHE_CHUNKS = 700_000
#: Longer chunks are encoded each time they come.
CACHE_LENGTH = 64
#: New chunks that are encoded as one text.
TOGETHER = 4096
#: Stands between chunks that are encoded as one text: a sign that no pattern of word BPE joins with a neighbour across spaces,
#: and a line's end, which byte BPE joins with nothing but white space.
WORD_SEPARATOR, BYTE_SEPARATOR = b" | ", b"\n"
#: Chunks that byte BPE needs no separator between: their one space comes first, and no white space (or what may be some) next.
SPACED = re.compile(rb" [^\t-\r\x1c-\x20\xc2\xe1\xe2\xe3][^ ]*")


def _bytes_of(values) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


ASCII_LETTERS = _bytes_of([*range(65, 91), *range(97, 123)])
SPACES = _bytes_of([*range(9, 14), 32])
WHITE = _bytes_of([*range(9, 14), *range(28, 33)])
#: Signs that are cut off the letters before them, and the line's end.
SIGNS = _bytes_of([10, *range(33, 39), *range(40, 48), *range(58, 65), *range(91, 97), 123, 125, 126])
#: First bytes of white space beyond ASCII, and all of it.
WHITE_BEGINS = _bytes_of([0xC2, 0xE1, 0xE2, 0xE3])
WIDE_WHITE = [int.from_bytes(c.encode(), "big") for c in map(chr, [0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])]
#: First bytes of two whose characters are all letters: U+0100 to U+017F, U+0400 to U+047F.
LETTER_BEGINS = _bytes_of([0xC4, 0xC5, 0xD0, 0xD1])


def _white_at(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a character of white space begins at these places; three bytes follow the last of them."""
    first = data[at]
    white, wide = WHITE[first], np.flatnonzero(WHITE_BEGINS[first])
    p = at[wide]
    two = first[wide].astype(np.int32) << 8 | data[p + 1]
    white[wide] = np.isin(np.where(first[wide] == 0xC2, two, two << 8 | data[p + 2]), WIDE_WHITE)
    return white


def _letter_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether an ASCII, Latin or Cyrillic letter ends before these places; U+0130 is none, as its lower case has a mark at its end."""
    last, first = data[at - 1], data[at - 2]
    latin = (first == 0xC3) & (last != 0x97) & (last != 0xB7)
    return ASCII_LETTERS[last] | latin | LETTER_BEGINS[first] & (last >= 0x80) & ~((first == 0xC4) & (last == 0xB0))


def chunk_begins(raw: bytes, ends: np.ndarray, byte_level: bool) -> np.ndarray:
    """Where the chunks of texts begin that end at ``ends`` and stand one after another."""
    data = np.frombuffer(b"".join((b"\0\0", raw, b"\0\0\0")), np.uint8)  # two bytes can be looked at before each, three behind
    begins = np.zeros(len(data), bool)
    spaces = np.flatnonzero(data == 32 if byte_level else SPACES[data])
    begins[spaces[~_white_at(data, spaces + 1)]] = True
    filled = ends[np.diff(ends, prepend=0) > 0]
    begins[filled + 1] &= ~SPACES[data[filled + 1]]  # a text's last space has nothing behind it
    signs = np.flatnonzero(SIGNS[data])
    begins[signs[_letter_before(data, signs)]] = True
    if byte_level:
        lines = np.flatnonzero(data == 10)
        before = data[lines - 1]
        lines = lines[_letter_before(data, lines) | (before < 0x80) & ~WHITE[before]] + 1
        begins[lines[~_white_at(data, lines)]] = True
    begins = begins[2 : 2 + len(raw)]
    begins[np.concatenate(([0], filled[:-1]))] = True
    return np.flatnonzero(begins)


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core for each task
        from tokenizers import Tokenizer

        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are written as the machine holds them: little-endian, four bytes")
        self.tokenizer = Tokenizer.from_file(path)
        self.byte_level = self.tokenizer.normalizer is None
        self.tokenizer.model._resize_cache(0)  # what comes here is new each time
        self.between = BYTE_SEPARATOR if self.byte_level else WORD_SEPARATOR
        self.separator = int(np.frombuffer(self._alone([self.between])[0], "<u4")[0])
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.spaced[[i for piece, i in self.tokenizer.get_vocab().items() if piece.startswith("\u0120")]] = True
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        if not self.byte_level:
            raws = [raw if b"<|" in raw or b"\xcc" in raw or b"\xcd" in raw else raw.lower() for raw in raws]
        collecting = gc.isenabled()
        gc.disable()  # many small objects come, and none of them is part of a cycle
        try:
            return self._encode(b"".join(raws), np.cumsum([len(raw) for raw in raws], dtype=np.int64))
        finally:
            if collecting:
                gc.enable()

    def _encode(self, raw: bytes, ends: np.ndarray) -> list[bytes]:
        if not raw:
            return [b""] * len(ends)
        begins = chunk_begins(raw, ends, self.byte_level)
        offsets = pa.py_buffer(np.append(begins, len(raw)))
        chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, offsets, pa.py_buffer(raw)]).dictionary_encode()
        known = self._known(chunks.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array(known, pa.large_binary()).take(chunks.indices)
        at = np.frombuffer(ids.buffers()[1], np.int64)[np.searchsorted(begins, np.append(0, ends))].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        return [bytes(data[a:b]) for a, b in zip(at, at[1:])]

    def _known(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of different chunks, looked up or new."""
        if len(self.cache) > CACHE_CHUNKS:
            self.older, self.cache = self.cache, {}
        found = list(map(self.cache.get, chunks))
        absent = [k for k, ids in enumerate(found) if ids is None]
        names = [chunks[k] for k in absent]
        got = dict(zip(names, map(self.older.get, names)))
        got.update(self._fresh([c for c, ids in got.items() if ids is None]))
        for k, c in zip(absent, names):
            found[k] = got[c]
        self.cache.update(got)
        for c in names:
            if len(c) > CACHE_LENGTH:
                del self.cache[c]
        return found

    def _fresh(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        """The ids of chunks: of most as one text that is cut where a chunk begins, of those that could blur the cuts alone."""
        spaced = list(filter(SPACED.fullmatch, chunks)) if self.byte_level else []
        out = dict.fromkeys(spaced, b"")
        rest = [c for c in chunks if c not in out]
        odd = [c for c in rest if self._blurs(c)]
        out.update(zip(odd, self._alone(odd)))
        rest = [c for c in rest if c not in out]
        for some, between in ((spaced, b""), (rest, self.between)):
            for low in range(0, len(some), TOGETHER):
                few = some[low : low + TOGETHER]
                out.update(zip(few, self._together(few, between) or self._alone(few)))
        return out

    def _blurs(self, chunk: bytes) -> bool:
        if not self.byte_level:
            return b"|" in chunk
        text = chunk.decode("utf-8", "replace")
        words = text.split()
        return len(words) != 1 or len(text) - len(words[0]) != (text[0] == " ")

    def _together(self, chunks: list[bytes], between: bytes) -> list[bytes] | None:
        """None if the chunks' ids can't be told apart in the ids of all."""
        ids = np.frombuffer(self._alone([between.join(chunks)])[0], "<u4")
        if between:
            marks = np.flatnonzero(ids == self.separator)
            begins, ends = np.append(0, marks + 1), np.append(marks, len(ids))
        else:  # a space is the first byte of each chunk's first id and stands nowhere else
            marks = np.flatnonzero(self.spaced[ids])
            begins, ends = marks, np.append(marks[1:], len(ids))
        if len(begins) != len(chunks):
            return None
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip((4 * begins).tolist(), (4 * ends).tolist())]

    def _alone(self, chunks: list[bytes]) -> list[bytes]:
        texts = [c.decode("utf-8", "replace") for c in chunks]
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget(path: str) -> None:
    """Give the memory of a worker's encoder back."""
    _encoders.pop(path, None)


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
