"""All queries of this subpackage and their SQL."""

from . import (  # noqa: F401
    classifier,
    conversations,
    hmm,
    html,
    minhash,
    mixing,
    packing,
    pii,
    rules,
    spelling,
    topk,
    urls,
    warc,
)
from .common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
