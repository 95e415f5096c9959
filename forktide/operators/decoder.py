"""Decoding of contract logs: a registry of addresses, a table of events, native slicing of 32-byte words.

A log's address picks the standard, its first topic the event; the same topic means different events for different
standards.  Topics and data are hex without a prefix.  Contracts and events are small tables that are joined to the logs; an event's row says where
each argument's word stands.  Spark takes the words out, one Arrow function renders those of a whole batch (``words.py``), and Spark
makes the JSON.  Nothing fails: what cannot be decoded has a status and no decode.  Addresses are rendered in lower case;
``checksummed`` gives the mixed-case form.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from . import words

#: First topics of the events, and their arguments as (name, type, indexed).
TRANSFER = "ddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"
APPROVAL = "8c5be1e5ebec7d5bd14f71427d1e84f3dd0314c0f7b2291e5b200ac8c7c3b925"
SWAP = "c42079f94a6350d7e6235f29174924f928cc2ac818eb64fed8004e115fbcca67"
MINT = "7a53080ba414158be7ec69b987b5fb7d07dee101fe85488f0853ae16239d0bde"
BURN = "0c396cd989a39f4459b5fa1aed6a9a8dcdbc45908acfd67e028cd568da98982c"
EVENTS = {
    ("erc20", "Transfer", TRANSFER): [("from", "address", True), ("to", "address", True), ("value", "uint256", False)],
    ("erc20", "Approval", APPROVAL): [("owner", "address", True), ("spender", "address", True), ("value", "uint256", False)],
    ("erc721", "Transfer", TRANSFER): [("from", "address", True), ("to", "address", True), ("tokenId", "uint256", True)],
    ("erc721", "Approval", APPROVAL): [("owner", "address", True), ("approved", "address", True), ("tokenId", "uint256", True)],
    ("uniswap_v3_pool", "Swap", SWAP): [
        ("sender", "address", True), ("recipient", "address", True), ("amount0", "int256", False), ("amount1", "int256", False),
        ("sqrtPriceX96", "uint160", False), ("liquidity", "uint128", False), ("tick", "int24", False)],
    ("uniswap_v3_pool", "Mint", MINT): [
        ("sender", "address", False), ("owner", "address", True), ("tickLower", "int24", True), ("tickUpper", "int24", True),
        ("amount", "uint128", False), ("amount0", "uint256", False), ("amount1", "uint256", False)],
    ("uniswap_v3_pool", "Burn", BURN): [
        ("owner", "address", True), ("tickLower", "int24", True), ("tickUpper", "int24", True),
        ("amount", "uint128", False), ("amount0", "uint256", False), ("amount1", "uint256", False)],
}
#: Other spellings of the standards' names, without punctuation and in lower case.
ALIASES = {"erc20": "erc20", "erc721": "erc721", "uniswapv3pool": "uniswap_v3_pool", "uniswapv3": "uniswap_v3_pool"}
WORD = words.WORD


def standard_name(name: str) -> str:
    key = "".join(c for c in name.lower() if c.isalnum())
    if key not in ALIASES:
        raise ValueError(f"unknown standard {name!r}")
    return ALIASES[key]


def registry(spark: SparkSession, contracts: list[tuple[str, str, str]]) -> DataFrame:
    """(address, standard, version) rows; an address may stand once.  The list is a configuration, so its table is small."""
    rows = [(a.lower().removeprefix("0x"), standard_name(s), v) for a, s, v in contracts]
    if len({a for a, *_ in rows}) < len(rows):
        raise ValueError("an address is registered twice")
    if any(len(a) != 40 or set(a) - set("0123456789abcdef") for a, *_ in rows):
        raise ValueError("an address is not 20 bytes of hex")
    return spark.createDataFrame(rows, "address string, standard string, version string")


def small_unsigned(w: Column) -> Column:
    """A word as bigint; null if it needs more than 63 bits."""
    return F.when(F.substring(w, 1, 48).eqNullSafe("0" * 48) & (F.substring(w, 49, 1) < "8"), F.conv(F.substring(w, 49, 16), 16, 10).try_cast("bigint"))


def _reader(kinds: list[list[str]]):
    """The Arrow function for the words of some events: one call a batch, whatever events and types are in it."""

    @F.arrow_udf(ArrayType(StringType()))
    def read(event: pa.Array, found: pa.Array) -> pa.Array:
        return words.rendered_rows(kinds, event, found)

    return read


def rendered(w: Column, kind: str) -> Column:
    """A word's value as text by its type."""
    words.check_type(kind)
    return F.get(_reader([[kind]])(F.lit(0), F.array(w)), F.lit(0))


def _tail(data: Column, w: Column, kind: Column) -> Column:
    """The hex of a dynamic value, which stands where its word says; null if it does not lie within the data."""
    # no log has 16 MB of data, so larger places and lengths are outside
    near = (lambda c: F.when(small_unsigned(c) < 1 << 24, small_unsigned(c)))
    at = near(w)
    length = near(F.substring(data, (1 + 2 * at).cast("int"), F.lit(WORD)))
    digits = length * F.when(kind.endswith("[]"), WORD).otherwise(2)
    inside = (at % 32 == 0) & (2 * at + WORD <= F.length(data)) & (digits <= F.length(data) - 2 * at - WORD)
    return F.when(F.coalesce(inside, F.lit(False)), F.substring(data, (1 + WORD + 2 * at).cast("int"), digits.cast("int")))


EVENT_TABLE = "_standard string, _selector string, _event int, _name string, _signature string, _args array<string>, _kinds array<string>, _read array<string>, _places array<int>, _topics int, _slots int"


def event_table(spark: SparkSession, events: dict) -> tuple[DataFrame, list[list[str]]]:
    """A row for each event of a configuration, and the types in which its words are read.  A place is a word of the data, or below 0 a topic."""
    rows = []
    for e, ((standard, name, selector), args) in enumerate(events.items()):
        for _, kind, _ in args:
            words.check_type(kind)
        topic, slot, places = 0, 0, []
        for _, _, indexed in args:
            topic, slot = topic + indexed, slot + (not indexed)
            places.append(-topic if indexed else slot - 1)
        kinds = [k for _, k, _ in args]
        read = ["bytes32" if indexed and words.dynamic(k) else k for _, k, indexed in args]  # a topic has the hash of a dynamic value
        rows.append((standard, selector, e, name, f"{name}({','.join(kinds)})", [a for a, *_ in args], kinds, read, places, 1 + topic, slot))
    return spark.createDataFrame(rows, EVENT_TABLE), [r[7] for r in rows]


def decode(logs: DataFrame, contracts: DataFrame, events: dict = EVENTS) -> DataFrame:
    """logs (address, topics array<string>, data) with status, decoded_event (JSON) and decoder_version."""
    done = decoded(logs, contracts, events)
    return done.select(*logs.columns, "status", F.to_json("decoded_event").alias("decoded_event"), F.col("decoded_event.decoder_version").alias("decoder_version"))


def decoded(logs: DataFrame, contracts: DataFrame, events: dict = EVENTS) -> DataFrame:
    """logs (address, topics array<string>, data) with status and decoded_event, the struct that becomes JSON; null if not decoded.

    The status is Decoded, UnknownAbi (address not registered), UnknownSignature (no topic, or no event with it) or
    DecodeFailure (the event is known, its topics or data do not fit).
    """
    table, read = event_table(logs.sparkSession, events)
    both = logs.join(F.broadcast(contracts), "address", "left").join(  # a configuration's rows
        F.broadcast(table), (F.col("standard") == F.col("_standard")) & (F.lower(F.get("topics", F.lit(0))) == F.col("_selector")), "left"
    )
    data = F.col("data")

    def value(place: Column, i: Column) -> Column:
        w = F.when(place < 0, F.get("topics", -place)).otherwise(F.substring(data, 1 + WORD * place, F.lit(WORD)))
        if not any(words.dynamic(k) for kinds in read for k in kinds):
            return w
        kind = F.get("_read", i)
        behind = (place >= 0) & (kind.isin("bytes", "string") | kind.endswith("[]"))
        return F.when(behind, _tail(data, w, kind)).otherwise(w)

    sized = F.col("_event").isNotNull() & (F.size("topics") == F.col("_topics")) & (F.length(data) >= WORD * F.col("_slots"))
    # rows without words send an empty list, not a null: Arrow's writer goes back over the whole run of null lists at each one
    both = both.withColumn("_sized", F.coalesce(sized, F.lit(False)))
    both = both.withColumn("_words", F.when(F.col("_sized"), F.transform("_places", value)).otherwise(F.array().cast("array<string>")))
    both = both.withColumn("_values", _reader(read)(F.col("_event"), F.col("_words")))
    valid = F.col("_sized") & ~F.exists("_values", lambda v: v.isNull())
    body = F.struct(
        F.lit(1).alias("schema_version"), F.col("standard").alias("standard"), F.col("version").alias("decoder_version"), F.col("_name").alias("event"), F.col("_signature").alias("signature"),
        F.map_from_arrays("_args", "_values").alias("args"),
        F.transform("_args", lambda a, i: F.struct(a.alias("name"), F.get("_kinds", i).alias("type"), F.get("_values", i).alias("value"))).alias("ordered_args"),
    )
    status = F.when(F.col("standard").isNull(), "UnknownAbi").when(F.col("_event").isNull(), "UnknownSignature").when(valid, "Decoded").otherwise("DecodeFailure")
    return both.select(*logs.columns, status.alias("status"), F.when(valid, body).alias("decoded_event"))


def status_counts(decoded: DataFrame) -> DataFrame:
    return decoded.groupBy("status").agg(F.count("*").alias("n"))


# Keccak-256 after the published specification; used for checksummed addresses only.


def _rotate(x: int, n: int) -> int:
    n %= 64
    return ((x << n) | (x >> (64 - n))) & 0xFFFFFFFFFFFFFFFF if n else x


def _round_constants() -> list[int]:
    """From the linear feedback shift register x^8 + x^6 + x^5 + x^4 + 1."""
    out, state = [], 1
    for _ in range(24):
        value = 0
        for j in range(7):
            if state & 1:
                value ^= 1 << ((1 << j) - 1)
            state = (state << 1) ^ (0x171 if state & 0x80 else 0)
        out.append(value)
    return out


ROUNDS = _round_constants()


def keccak_256(data: bytes) -> bytes:
    padded = bytearray(data + b"\1" + bytes(-(len(data) + 1) % 136))
    padded[-1] |= 0x80
    lane = [[0] * 5 for _ in range(5)]
    for start in range(0, len(padded), 136):
        for i in range(17):
            lane[i % 5][i // 5] ^= int.from_bytes(padded[start + 8 * i : start + 8 * i + 8], "little")
        for constant in ROUNDS:
            parity = [col[0] ^ col[1] ^ col[2] ^ col[3] ^ col[4] for col in lane]
            for x in range(5):
                d = parity[x - 1] ^ _rotate(parity[(x + 1) % 5], 1)
                lane[x] = [v ^ d for v in lane[x]]
            x, y, current = 1, 0, lane[1][0]
            for t in range(24):
                x, y = y, (2 * x + 3 * y) % 5
                current, lane[x][y] = lane[x][y], _rotate(current, (t + 1) * (t + 2) // 2)
            for y in range(5):
                row = [lane[x][y] for x in range(5)]
                for x in range(5):
                    lane[x][y] = row[x] ^ (~row[(x + 1) % 5] & row[(x + 2) % 5])
            lane[0][0] ^= constant
    return b"".join(lane[i % 5][i // 5].to_bytes(8, "little") for i in range(4))


def checksum_address(address: str) -> str:
    low = address.lower().removeprefix("0x")
    digest = keccak_256(low.encode()).hex()
    return "0x" + "".join(c.upper() if int(d, 16) >= 8 else c for c, d in zip(low, digest))


@F.pandas_udf(StringType())
def checksummed(addresses: pd.Series) -> pd.Series:
    return addresses.map(lambda a: None if a is None else checksum_address(a))
