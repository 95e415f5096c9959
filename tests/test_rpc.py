"""The JSON-RPC sources against a local fixture server."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from forktide.plans.ranges import Retry
from forktide.sources import rpc

A, B = "aa" * 20, "bb" * 20


def block(h):
    return {"number": hex(h), "hash": f"0x{h + 1:064x}", "parentHash": f"0x{h:064x}", "timestamp": hex(1_800_000_000 + h)}


def log(h, i, owner, **more):
    return {"blockNumber": hex(h), "blockHash": block(h)["hash"], "transactionIndex": "0x0", "logIndex": hex(i), "transactionHash": "0x" + "cc" * 32, "address": "0x" + owner, "topics": ["0x" + "dd" * 32], "data": "0x01", "removed": False} | more


class Node:
    def __init__(self):
        self.head, self.asked, self.fail, self.bad = 9, [], 0, {}
        outer = self

        class Handler(BaseHTTPRequestHandler):
            def do_POST(self):
                calls = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
                if outer.fail:
                    outer.fail -= 1
                    self.send_error(503)
                    return
                body = json.dumps([{"id": c["id"], "result": outer.answer(c["method"], c["params"])} for c in calls]).encode()
                self.send_response(200)
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *_):
                pass

        self.server = HTTPServer(("127.0.0.1", 0), Handler)
        self.url = f"http://127.0.0.1:{self.server.server_port}"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def answer(self, method, params):
        if method == "eth_chainId":
            return "0x5"
        if method == "eth_getBlockByNumber":
            h = self.head if params[0] == "latest" else int(params[0], 16)
            return block(h) if h <= self.head else None
        if method == "eth_getBlockByHash":
            return next((block(h) for h in range(self.head + 1) if block(h)["hash"] == params[0]), None)
        self.asked.append(params[0])
        low, high = (int(params[0][k], 16) for k in ("fromBlock", "toBlock")) if "fromBlock" in params[0] else (int(params[0]["blockHash"], 16) - 1,) * 2
        rows = [log(h, i, a, **self.bad) for h in range(low, high + 1) for i, a in ((1, B), (0, A))]
        return [r for r in rows if params[0].get("address", r["address"]) == r["address"]]


@pytest.fixture
def node():
    n = Node()
    yield n
    n.server.shutdown()


def test_client(node):
    c = rpc.Client(node.url, retry=Retry(3, 0.01, 0.02))
    node.fail = 2
    assert c.head() == {"chain_id": 5, "height": 9, "block_hash": f"{10:064x}", "genesis_hash": f"{1:064x}"}
    assert c.header_by_hash(f"{4:064x}").height == 3 and c.header_by_hash("ff" * 32) is None
    assert [r[3] for r in c.logs_of(c.header_by_hash(f"{4:064x}"))] == [0, 1]
    with pytest.raises(rpc.RpcError):
        c.block_at(10)
    for bad in ({"removed": True}, {"data": None}, {"logIndex": hex(1 << 40)}, {"blockNumber": "0x63"}, {"address": "0x00"}):
        node.bad = bad
        with pytest.raises(rpc.RpcError):
            c.logs(0, 3)
    with pytest.raises(rpc.RpcError):
        rpc.Client("ftp://x")


def test_batch_sources_push_filters(spark, node):
    rpc.register(spark)
    blocks = spark.read.format("evm_blocks").options(url=node.url, span=4).load()
    assert [r["height"] for r in blocks.orderBy("height").collect()] == list(range(10))
    node.asked.clear()
    logs = spark.read.format("evm_logs").options(url=node.url, span=4).load().where(f"address = '{A}' AND block_number BETWEEN 2 AND 7")
    got = logs.orderBy("block_number").collect()
    assert [(r["block_number"], r["address"], r["log_index"]) for r in got] == [(h, A, 0) for h in range(2, 8)]
    assert {(q["fromBlock"], q["toBlock"], q["address"]) for q in node.asked} == {("0x2", "0x5", "0x" + A), ("0x6", "0x7", "0x" + A)}


def test_stream_of_blocks(spark, node, tmp_path):
    rpc.register(spark)

    def run():
        q = spark.readStream.format("evm_blocks").options(url=node.url, span=4, low=3).load().writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).start()
        q.processAllAvailable()
        q.stop()
        return sorted(r["height"] for r in spark.read.parquet(str(tmp_path / "o")).collect())

    assert run() == list(range(3, 10))
    node.head = 14
    assert run() == list(range(3, 15))
