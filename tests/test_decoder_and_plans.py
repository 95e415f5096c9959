"""Pinned decodes, scalar expressions, planning and configuration."""

import json

import pytest
from pyspark.sql import functions as F

from forktide.functions import scalars
from forktide.operators import decoder
from forktide.operators.transition import Header
from forktide.plans import config, ranges
from forktide.plans.status import Health, Status

ERC20, ERC721, POOL = "20" * 20, "72" * 20, "33" * 20


def topic(byte):
    return "00" * 12 + byte * 20


def word(v):
    return f"{v % (1 << 256):064x}"


def test_decodes(spark):
    logs = [
        ("transfer", ERC20, [decoder.TRANSFER, topic("01"), topic("02")], word(1000)),
        ("wide", ERC20, [decoder.TRANSFER, topic("01"), topic("02")], word((1 << 256) - 1)),
        ("nft", ERC721, [decoder.TRANSFER, topic("01"), topic("02"), word(77)], ""),
        ("swap", POOL, [decoder.SWAP, topic("10"), topic("20")], word(-5) + word(9) + word(12345) + word(77) + word(-120)),
        ("mint", POOL, [decoder.MINT, topic("11"), word(-60), word(60)], topic("40") + word(88) + word(3) + word(4)),
        ("unknown", "99" * 20, [decoder.TRANSFER], ""),
        ("no topic", ERC20, [], ""),
        ("other topic", ERC20, ["ab" * 32], ""),
        ("short", ERC20, [decoder.TRANSFER, topic("01"), topic("02")], "01"),
        ("dirty address", ERC20, [decoder.TRANSFER, "11" * 32, topic("02")], word(1)),
    ]
    df = spark.createDataFrame(logs, "name string, address string, topics array<string>, data string")
    contracts = decoder.registry(spark, [("0x" + ERC20, "ERC-20", "a"), (ERC721, "erc721", "b"), (POOL, "uniswap-v3", "c")])
    out = {r["name"]: r for r in decoder.decode(df, contracts).collect()}
    args = {n: json.loads(r["decoded_event"])["args"] for n, r in out.items() if r["decoded_event"]}
    assert args["transfer"] == {"from": "0x" + "01" * 20, "to": "0x" + "02" * 20, "value": "1000"}
    assert args["wide"]["value"] == str((1 << 256) - 1) and args["nft"]["tokenId"] == "77"
    assert (args["swap"]["amount0"], args["swap"]["tick"], args["swap"]["sqrtPriceX96"]) == ("-5", "-120", "12345")
    assert (args["mint"]["tickLower"], args["mint"]["tickUpper"], args["mint"]["amount"]) == ("-60", "60", "88")
    status = {n: r["status"] for n, r in out.items()}
    assert [status[n] for n in ("unknown", "no topic", "other topic", "short", "dirty address")] == ["UnknownAbi", "UnknownSignature", "UnknownSignature", "DecodeFailure", "DecodeFailure"]
    assert out["short"]["decoder_version"] is None and out["transfer"]["decoder_version"] == "a"
    with pytest.raises(ValueError):
        decoder.registry(spark, [(ERC20, "erc20", "a"), (ERC20, "erc721", "b")])


def test_integers_of_every_size(spark):
    """Numbers of one, two, four and eight limbs meet without a seam."""
    halves = (10**38 - 1) // (1 << 64)
    values = [0, 1, (1 << 63) - 1, 1 << 63, (1 << 64) - 1, 1 << 64, 10**38 - 1, 10**38, halves << 64, (halves - 1 << 64) + 5, (1 << 128) - 1, 1 << 128, (1 << 255) - 1]
    signed = spark.createDataFrame([(word(v), str(v)) for x in values for v in (x, -x, -x - 1)], "w string, want string")
    assert signed.where(decoder.rendered(F.col("w"), "int256") != F.col("want")).count() == 0
    unsigned = spark.createDataFrame([(word(v), str(v)) for v in [*values, (1 << 256) - 1]], "w string, want string")
    assert unsigned.where(decoder.rendered(F.col("w"), "uint256") != F.col("want")).count() == 0


def test_dynamic_values(spark):
    t = "ee" * 32
    events = {("erc20", "Odd", t): [("note", "string", False), ("raw", "bytes", False), ("ids", "int16[]", False), ("tag", "bytes4", False), ("hash", "string", True)]}
    text = "zwölf"
    body = lambda raw: word(len(raw)) + raw.hex() + "00" * (-len(raw) % 32)
    parts = [body(text.encode()), body(b"\1\2\3"), word(2) + word(-7) + word(300)]
    at = [128]
    for p in parts[:2]:
        at.append(at[-1] + len(p) // 2)
    data = "".join(map(word, at)) + "abcd0123".ljust(64, "0") + "".join(parts)
    good = (ERC20, [t, "99" * 32], data)
    bad = [data[:-64], data[:64] + word(1 << 40) + data[128:], data.replace(word(300), word(40000)), data.replace("abcd0123" + "0" * 8, "abcd0123" + "1" * 8), data.replace(text.encode().hex(), "ff" * len(text.encode()))]
    df = spark.createDataFrame([good, *((ERC20, [t, "99" * 32], b) for b in bad)], "address string, topics array<string>, data string")
    out = decoder.decode(df, decoder.registry(spark, [(ERC20, "erc20", "a")]), events).collect()
    args = [json.loads(r["decoded_event"])["args"] for r in out if r["decoded_event"]]
    assert args == [{"note": text, "raw": "0x010203", "ids": '["-7","300"]', "tag": "0xabcd0123", "hash": "0x" + "99" * 32}]
    assert [r["status"] for r in out] == ["Decoded"] + ["DecodeFailure"] * 5


def test_rows_without_words_send_no_null_lists(spark, monkeypatch):
    """Arrow's writer goes back over a run of null lists at each of them, so a batch of them took the square of its rows."""
    sent = []

    def spy(event, words):
        sent.append(words)
        return F.transform(words, lambda w: F.lower(w))

    monkeypatch.setattr(decoder, "_reader", lambda kinds: spy)
    logs = [("99" * 20, [decoder.TRANSFER], ""), (ERC20, None, None), (ERC20, [decoder.TRANSFER, topic("01"), topic("02")], word(5)), (ERC20, [decoder.TRANSFER], "01"), (None, [], None)]
    df = spark.createDataFrame(logs, "address string, topics array<string>, data string")
    events = {**decoder.EVENTS, ("erc20", "Bare", "ab" * 32): []}
    out = decoder.decode(df.union(spark.createDataFrame([(ERC20, ["ab" * 32], "")], df.schema)), decoder.registry(spark, [(ERC20, "erc20", "a")]), events)
    assert sorted(r["status"] for r in out.collect()) == sorted(["UnknownAbi", "UnknownSignature", "Decoded", "DecodeFailure", "UnknownAbi", "Decoded"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(sent) == 1 and "ELSE [] END" in plan


def test_checksums():
    assert decoder.checksum_address("0x5aaeb6053f3e94c9b9a09f33669435e7ef1beaed") == "0x5aAeb6053F3E94C9b9A09f33669435E7Ef1BeAed"
    assert decoder.keccak_256(b"Transfer(address,address,uint256)").hex() == decoder.TRANSFER


def test_scalars(spark):
    df = spark.createDataFrame([("0xff",), ("0x",), ("17",), ("0x7fffffffffffffff",), ("0x8000000000000000",), (None,)], "q string")
    assert [r[0] for r in df.select(scalars.quantity(F.col("q"))).collect()] == [255, None, 17, (1 << 63) - 1, None, None]
    urls = ["https://u:pw@h/v2/abc?x=1", "https://h/a?api_key=k&b=2", "wss://h/my-apikey-1/x", "https://h/v1/ok?auth_token=t"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(scalars.redacted_url(F.col("u"))).collect()]
    assert got == ["https://u:redacted@h/v2/redacted?x=1", "https://h/a?api_key=redacted&b=2", "wss://h/redacted/x", "https://h/v1/ok?auth_token=redacted"]
    a = spark.createDataFrame([("0x" + "AB" * 20,), ("ab",)], "a string").select(scalars.address(F.col("a"))).collect()
    assert [r[0] for r in a] == ["ab" * 20, None]


def headers(low, high, branch="", parent=None):
    out = []
    for h in range(low, high + 1):
        out.append(Header(f"{h}{branch}", out[-1].block_hash if out else parent or str(h - 1), h))
    return out


def test_coordinator_orders_and_invalidates():
    done = []
    c = ranges.Coordinator(target=9, next_height=0)
    put = lambda r, h: done.append((r.low, r.high))
    assert c.offer(ranges.BlockRange(4, 6), headers(4, 6), put) is None and not done
    c.offer(ranges.BlockRange(0, 3), headers(0, 3), put)
    assert done == [(0, 3), (4, 6)]
    assert c.offer(ranges.BlockRange(7, 9), headers(7, 9, "x", "6x"), put) == ranges.BlockRange(7, 9) and not c.pending
    c.offer(ranges.BlockRange(7, 9), headers(7, 9), put)
    assert c.done and c.committed == 10
    for bad in (ranges.BlockRange(7, 9), ranges.BlockRange(10, 12)):
        with pytest.raises(ranges.BackfillError):
            c.offer(bad, headers(bad.low, bad.high), put)
    with pytest.raises(ranges.BackfillError):
        ranges.Coordinator(target=9, next_height=3)
    with pytest.raises(ranges.BackfillError):
        ranges.check_headers(ranges.BlockRange(0, 2), headers(0, 1))


def test_sizes_retries_and_budgets():
    s = ranges.RangeSizer(4, 1, 6)
    s.succeeded()
    assert s.current == 6 and s.next(10, 12) == ranges.BlockRange(10, 12) and s.next(13, 12) is None
    for _ in range(5):
        s.refused()
    assert s.current == 1
    r = ranges.Retry(3, 1.0, 3.0)
    assert 0.5 <= r.delay("timeout", 1) <= 1 <= r.delay("timeout", 2) <= 2 and r.delay("timeout", 3) is None and r.delay("permanent", 1) is None and r.delay("rate_limited", 1, 9.0) == 3.0
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("timeout")
        return "ok"

    assert r.run(flaky, lambda e: "timeout", lambda s: None) == "ok" and len(calls) == 3
    b = ranges.LifetimeBudget(max_requests=3, max_cost=8)
    b.spend("logs")
    b.spend("block", 2)
    with pytest.raises(ranges.BackfillError):
        b.spend("block")
    now = [0.0]
    w = ranges.WindowBudget(10, 60, lambda: now[0])
    assert w.wait(6) == 0 and w.wait(5) == 60 and w.wait(5) == 0


def test_config_and_health(tmp_path):
    f = tmp_path / "c.toml"
    f.write_text('chain_id = 5\n[rpc]\nurl = "http://file:1"\n[indexer]\npoll_seconds = 3.0\n')
    c = config.load(f, {"FORKTIDE__RPC__URL": "http://env:2"}, {"backfill": {"workers": 2}})
    assert (c.chain_id, c.rpc.url, c.indexer.poll_seconds, c.backfill.workers) == (5, "http://env:2", 3.0, 2)
    for bad in ({"chain_id": 0}, {"rpc": {"url": "ftp://x"}}, {"nothing": 1}, {"indexer": {"safe_depth": 99}}):
        with pytest.raises(config.ConfigError):
            config.load(None, {}, bad)
    h = Health()
    h.set("ready")
    assert h.ok
    h.correctness_stop("two sources disagree")
    h.set("ready")
    assert not h.ok and Status(checkpoint_height=5, head_height=9).lag == 4
