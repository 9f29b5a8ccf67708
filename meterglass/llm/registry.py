"""The queries of this subpackage and their SQL."""

from meterglass.llm import bpe, decontamination, exact_dedup, hard_negatives, lm, mixing, ngram_join, quality, sharding, substring_dedup, toxicity, warc, whitening  # noqa: F401
from meterglass.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
