"""Values of 32-byte words as text, a column at a time.

Words come as hex in an Arrow array.  Integers of any size become decimal text by their 16-bit limbs, all words of a type together: one matrix
product gives each word's digits in base 10 ** 9, carries are passed on once, and the texts are cut from one matrix of digits.  A word that is
no value of its type becomes null.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = 64
#: The types that can be read: integers of whole bytes, addresses, flags, fixed and dynamic bytes, texts, and lists of those of one word.
FIXED = re.compile(r"address|bool|bytes([1-9]|[12][0-9]|3[0-2])|u?int(8|16|24|32|40|48|56|64|72|80|88|96|104|112|120|128|136|144|152|160|168|176|184|192|200|208|216|224|232|240|248|256)")
CHUNK, CHUNKS = 10**9, 9
#: The three digits of each number below 1000, as ASCII.
THREE = np.stack([np.arange(1000) // 100, np.arange(1000) // 10 % 10, np.arange(1000) % 10], 1).astype(np.uint8) + np.uint8(48)
#: Of each 16-bit limb's unit its digits in base CHUNK, highest first.  Sums of 16 products stay below 2 ** 50, so doubles hold them exactly.
UNITS = np.array([[(1 << 16 * (15 - i)) // CHUNK ** (CHUNKS - 1 - j) % CHUNK for j in range(CHUNKS)] for i in range(16)], np.float64)
#: The value of each hex digit, 255 for other characters.
NIBBLES = np.full(256, 255, np.uint8)
NIBBLES[[*b"0123456789abcdef"]] = NIBBLES[[*b"0123456789ABCDEF"]] = np.arange(16)


def dynamic(kind: str) -> bool:
    """Whether a value stands behind the words, at the place that its word names."""
    return kind in ("bytes", "string") or kind.endswith("[]")


def check_type(kind: str) -> None:
    if not (kind in ("bytes", "string") or FIXED.fullmatch(kind.removesuffix("[]"))):
        raise ValueError(f"values of type {kind!r} cannot be decoded")


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(number of each word of 64 hex digits, its 32 bytes); all others are left out."""
    long = pc.fill_null(pc.equal(pc.binary_length(words), WORD), False)
    at = np.flatnonzero(long.to_numpy(zero_copy_only=False))
    if not len(at):
        return at, np.empty((0, 32), np.uint8)
    whole = pa.concat_arrays([words.take(pa.array(at))])
    begin = np.frombuffer(whole.buffers()[1], np.int32, 1, 4 * whole.offset)[0]
    nibbles = NIBBLES[np.frombuffer(whole.buffers()[2], np.uint8, WORD * len(at), begin).reshape(-1, WORD)]
    good = (nibbles < 16).all(1)
    nibbles = nibbles[good]
    return at[good], nibbles[:, ::2] << np.uint8(4) | nibbles[:, 1::2]


def integers(raw: np.ndarray, bits: int, signed: bool) -> pa.Array:
    """Words as rows of bytes as decimal text; null where the unused bytes are neither zero nor the sign."""
    unused, n = 32 - bits // 8, len(raw)
    negative = raw[:, unused] >= 0x80 if signed else np.zeros(n, bool)
    good = (raw[:, :unused] == np.where(negative, 0xFF, 0)[:, None]).all(1)
    limbs = np.where(negative[:, None], ~raw, raw) if signed else raw
    chunks = (np.ascontiguousarray(limbs).view(">u2").astype(np.float64) @ UNITS).astype(np.int64).T.copy()
    chunks[-1] += negative  # two's complement: the inverted bits, and one
    groups = np.empty((3 * CHUNKS, n), np.int16)
    carry = np.zeros(n, np.int64)
    for k in range(CHUNKS - 1, -1, -1):
        now = chunks[k] + carry
        carry = now // CHUNK
        rest = (now - carry * CHUNK).astype(np.int32)
        for j in range(3 * k + 2, 3 * k - 1, -1):
            above = rest // 1000
            groups[j] = rest - above * 1000
            rest = above
    digits = THREE[groups.T]
    ends = np.arange(n + 1, dtype=np.int32) * (9 * CHUNKS)
    text = pc.ascii_ltrim(pa.StringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(digits.tobytes())), characters="0")
    text = pc.if_else(pc.equal(text, ""), "0", text)
    if negative.any():
        text = pc.if_else(pa.array(negative), pc.binary_join_element_wise(pa.scalar("-"), text, ""), text)
    return pc.if_else(pa.array(good), text, pa.scalar(None, pa.string()))


def _where(good: pa.Array, values: pa.Array) -> pa.Array:
    return pc.if_else(pc.fill_null(good, False), values, pa.scalar(None, pa.string()))


def _prefixed(values: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(pa.scalar("0x"), pc.utf8_lower(values), "")


def _text(body: str | None) -> str | None:
    try:
        return None if body is None else bytes.fromhex(body).decode()
    except ValueError:
        return None


def rendered(kind: str, words: pa.Array) -> pa.Array:
    """Words of a type, or the hex behind a dynamic one, as text: integers decimal, bytes and addresses in lower hex, lists as JSON."""
    if kind == "bytes":
        return _where(pc.match_substring_regex(words, "^([0-9a-fA-F]{2})*$"), _prefixed(words))
    if kind == "string":
        good = _where(pc.match_substring_regex(words, "^([0-9a-fA-F]{2})*$"), words)
        return pa.array([_text(b) for b in good.to_pylist()], pa.string())
    if kind.endswith("[]"):
        return _lists(kind[:-2], words)
    if kind.lstrip("u").startswith("int"):
        return _integers(kind, words)
    whole = pc.fill_null(pc.match_substring_regex(words, "^[0-9a-fA-F]{64}$"), False)
    if kind == "bool":
        return _where(pc.and_(whole, pc.match_substring_regex(words, "^0{63}[01]$")), pc.if_else(pc.ends_with(words, "1"), "true", "false"))
    if kind == "address":
        return _where(pc.and_(whole, pc.starts_with(words, "0" * 24)), _prefixed(pc.utf8_slice_codeunits(words, 24, WORD)))
    n = 2 * int(kind[5:])
    return _where(pc.and_(whole, pc.match_substring_regex(words, f"^.{{{n}}}0*$")), _prefixed(pc.utf8_slice_codeunits(words, 0, n)))


def _integers(kind: str, words: pa.Array) -> pa.Array:
    at, raw = _bytes(words)
    if not len(at):
        return pa.nulls(len(words), pa.string())
    found = integers(raw, int(kind.lstrip("uint")), kind.startswith("int"))
    back = np.full(len(words), -1)
    back[at] = np.arange(len(at))
    return found.take(pa.array(back, mask=back < 0))


def _lists(kind: str, bodies: pa.Array) -> pa.Array:
    """Bodies of lists as JSON lists of texts; null if a word of one is no value of the type."""
    each = [None if b is None else [b[i : i + WORD] for i in range(0, len(b), WORD)] for b in bodies.to_pylist()]
    flat = rendered(kind, pa.array([w for x in each if x for w in x], pa.string())).to_pylist()
    out, at = [], 0
    for x in each:
        values = flat[at : at + len(x or ())]
        at += len(x or ())
        out.append(None if x is None or None in values else "[" + ",".join(f'"{v}"' for v in values) + "]")
    return pa.array(out, pa.string())


def rendered_rows(kinds: list[list[str]], event: pa.Array, words: pa.Array) -> pa.Array:
    """Lists of words of many events at once: row r has words of the types kinds[event[r]].  Types are rendered together, whatever row they stand in."""
    flat = pa.concat_arrays([words.values.slice(words.offsets[0].as_py(), words.offsets[-1].as_py() - words.offsets[0].as_py())])
    offsets = words.offsets.to_numpy() - words.offsets[0].as_py()
    number = np.where(np.diff(offsets) > 0, pc.fill_null(event, -1).to_numpy(zero_copy_only=False), -1)
    places: dict[str, list[np.ndarray]] = {}
    for e in np.unique(number[number >= 0]).tolist():
        begin = offsets[:-1][number == e]
        for j, kind in enumerate(kinds[e]):
            places.setdefault(kind, []).append(begin + j)
    if not places:
        return pa.ListArray.from_arrays(words.offsets, words.values, mask=words.is_null()) if words.null_count else words
    at = {kind: np.concatenate(x) for kind, x in places.items()}
    done = pa.concat_arrays([rendered(kind, flat.take(pa.array(x))) for kind, x in at.items()])
    back = np.full(len(flat), -1)
    back[np.concatenate(list(at.values()))] = np.arange(len(done))
    values = done.take(pa.array(back, mask=back < 0))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values, mask=words.is_null())
