"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from cladeframe.llm import centroids, dedup, licenses, media, mixing, neighbours, packing, pii, quality, substrings, toxicity, warc, whitening

MODULES = (dedup, quality, licenses, toxicity, mixing, pii, warc, media, substrings, packing, neighbours, whitening, centroids)


def queries() -> dict:
    return {k: q for m in MODULES for k, q in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in m.ORACLES.items()}
