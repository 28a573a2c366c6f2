"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from sporeline.llm import bpe, centroids, decontam, pages, ppm, quality, rollup, secrets, simhash, spelling, suffixes, tokenfile, toxicity

MODULES = (bpe, centroids, decontam, pages, ppm, quality, rollup, secrets, simhash, spelling, suffixes, tokenfile, toxicity)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in MODULES for k, v in m.ORACLES.items()}
