"""Operators of a training-data pipeline, each a module with its registered query; nothing else imports this package."""

from __future__ import annotations

from cohortspark.llm import (
    chats,
    clusters,
    decontaminate,
    lengths,
    lines,
    packing,
    quality,
    repeats,
    scoring,
    shards,
    simhash,
    toxicity,
    whitening,
)

MODULES = [
    chats,
    clusters,
    decontaminate,
    lengths,
    lines,
    packing,
    quality,
    repeats,
    scoring,
    shards,
    simhash,
    toxicity,
    whitening,
]
QUERIES = {name: build for module in MODULES for name, build in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in getattr(module, "ORACLES", {}).items()}
