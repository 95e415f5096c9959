"""Schemas of the chain tables.  Hashes and addresses are lower-case hex without a prefix; ``0x`` is put on at the edge.

Spark's decimals end at 38 digits, so a chain id (an unsigned 64-bit number) is DECIMAL(20, 0).
"""

SCHEMA_VERSION = 1
CHAIN_IDENTITY = "chain_id decimal(20,0), genesis_hash string, created_at timestamp"
BLOCKS = "chain_id decimal(20,0), block_hash string, parent_hash string, height bigint, ts timestamp, is_canonical boolean, status string, status_source string"
LOGS = (
    "chain_id decimal(20,0), block_hash string, block_number bigint, transaction_index int, log_index int, tx_hash string, "
    "address string, topics array<string>, data string, decoded_event string, decoder_version string"
)
OUTBOX = "event_id bigint, chain_id decimal(20,0), event_kind string, block_hash string, block_height bigint, payload string, created_at timestamp, published_at timestamp"
CHECKPOINT = "chain_id decimal(20,0), last_height bigint, last_hash string"

#: The states that a block and a journal row may have.
STATUSES = ("unsafe", "safe", "finalized")
STATUS_SOURCES = ("observed", "native", "depth")
EVENT_KINDS = ("apply", "rollback", "safe", "finalized")
