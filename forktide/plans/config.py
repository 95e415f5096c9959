"""Settings: defaults, then a TOML file, then environment variables (FORKTIDE__SECTION__NAME), then explicit overrides."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path
from urllib.parse import urlparse


class ConfigError(ValueError):
    pass


# The defaults of this file that a user of the published settings relies on.


@dataclass
class Rpc:
    url: str = "http://127.0.0.1:8545"
    verifier_url: str | None = None
    window_cost: int = 1200
    window_seconds: float = 60.0


@dataclass
class Indexer:
    max_reorg_depth: int = 2048
    safe_depth: int = 12
    finalized_depth: int = 64
    poll_seconds: float = 12.0


@dataclass
class Backfill:
    workers: int = 8
    initial_blocks: int = 100
    min_blocks: int = 1
    max_blocks: int = 100
    max_requests: int | None = None
    max_cost: int | None = None


@dataclass
class Broker:
    servers: str | None = None
    topic: str = "chain-events"
    poll_seconds: float = 0.25
    delivery_timeout_seconds: float = 30.0
    #: Ids of a part that is handed to the broker at once.
    part_ids: int = 1000


@dataclass
class Config:
    chain_id: int = 1
    store: str = "store"
    rpc: Rpc = field(default_factory=Rpc)
    indexer: Indexer = field(default_factory=Indexer)
    backfill: Backfill = field(default_factory=Backfill)
    broker: Broker = field(default_factory=Broker)
    #: Of the chain's first block; None: as the node has it.
    genesis_hash: str | None = None
    #: Tables of address, standard and version.
    contracts: list = field(default_factory=list)

    def validate(self) -> Config:
        if not 0 < self.chain_id < 1 << 64:
            raise ConfigError("chain_id must be a positive unsigned 64-bit number")
        for url in filter(None, (self.rpc.url, self.rpc.verifier_url)):
            u = urlparse(url)
            if u.scheme not in ("http", "https") or not u.hostname:
                raise ConfigError("an RPC URL must use http or https and name a host")
        if any(not isinstance(c, dict) or not {"address", "standard"} <= c.keys() <= {"address", "standard", "version"} for c in self.contracts):
            raise ConfigError("a contract has an address, a standard and a version")
        if self.indexer.safe_depth > self.indexer.finalized_depth:
            raise ConfigError("safe_depth must not exceed finalized_depth")
        b = self.broker
        if not b.topic.strip() or (b.servers is not None and not all(s.strip() for s in b.servers.split(","))):
            raise ConfigError("a broker has a topic, and servers without empty entries")
        if min(b.poll_seconds, b.delivery_timeout_seconds, b.part_ids, self.indexer.poll_seconds) <= 0:
            raise ConfigError("polls, timeouts and parts must be positive")
        if min(self.indexer.max_reorg_depth, self.backfill.workers, self.backfill.min_blocks) < 1:
            raise ConfigError("depths, workers and sizes must be positive")
        return self


def _put(target, values: dict) -> None:
    known = {f.name: f for f in fields(target)}
    for name, value in values.items():
        if name not in known:
            raise ConfigError(f"unknown setting {name}")
        old = getattr(target, name)
        if is_dataclass(old):
            _put(old, value)
        else:
            kind = type(old)
            setattr(target, name, kind(value) if old is not None and not isinstance(value, kind) else value)


def load(path: str | Path | None = None, env: dict[str, str] | None = None, overrides: dict | None = None) -> Config:
    out = Config()
    if path:
        _put(out, tomllib.loads(Path(path).read_text()))
    nested: dict = {}
    for name, value in (os.environ if env is None else env).items():
        if name.startswith("FORKTIDE__"):
            at, parts = nested, name[len("FORKTIDE__") :].lower().split("__")
            for p in parts[:-1]:
                at = at.setdefault(p, {})
            at[parts[-1]] = value
    try:
        _put(out, nested)
        _put(out, overrides or {})
    except ValueError as e:
        raise ConfigError(str(e)) from e
    return out.validate()
