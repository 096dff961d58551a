"""The queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from . import ann, bpe, decontamination, katz, near_dedup, quality, secrets, sharding, substring_dedup, token_counts

_MODULES = (ann, bpe, decontamination, katz, near_dedup, quality, secrets, sharding, substring_dedup, token_counts)

QUERIES = {name: build for module in _MODULES for name, build in module.QUERIES.items()}
ORACLES = {name: sql for module in _MODULES for name, sql in module.ORACLES.items()}
