"""The registered queries of this package, and the SQL that DuckDB can check them with."""

from __future__ import annotations

from . import chat, langid, leaderboard, lm, minhash, mixing, pieces, pii, quality, sharding, simhash, topk, trie

_MODULES = (quality, lm, sharding, chat, topk, pieces, pii, langid, simhash, mixing, trie, leaderboard, minhash)


def queries() -> dict:
    return {name: run for m in _MODULES for name, run in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
