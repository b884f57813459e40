"""Generic DataFrame operators the pipelines are made of."""

from cartwright.operators.checks import Check, run_checks, summarize_checks
from cartwright.operators.contracts import ContractBreach, enforce_contract
from cartwright.operators.dedup import dedup_first
from cartwright.operators.hot import HotKeys, find_hot
from cartwright.operators.jsonflat import flatten_json
from cartwright.operators.lookup import lookup_join
from cartwright.operators.lookback import EPOCH, incremental_filter, lookback_filter, max_timestamp
from cartwright.operators.neighbours import with_neighbour
from cartwright.operators.pit import pit_join, supersede
from cartwright.operators.snapshot import scd2_merge, scd2_snapshot
from cartwright.operators.upsert import align_schemas, upsert, upsert_frames

__all__ = [
    "EPOCH",
    "Check",
    "ContractBreach",
    "HotKeys",
    "align_schemas",
    "dedup_first",
    "enforce_contract",
    "find_hot",
    "flatten_json",
    "incremental_filter",
    "lookback_filter",
    "lookup_join",
    "max_timestamp",
    "pit_join",
    "run_checks",
    "scd2_merge",
    "scd2_snapshot",
    "summarize_checks",
    "supersede",
    "upsert",
    "upsert_frames",
    "with_neighbour",
]
