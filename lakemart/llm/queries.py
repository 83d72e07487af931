"""All registered queries of the training-data operators and their SQL."""

from lakemart.llm import (  # noqa: F401
    collide, hmm, lattice, merkle, minhash, mixing, packing, periodic, quality, sharding, topk, toxicity, transducer,
)
from lakemart.llm.common import LLM_ORACLE, LLM_QUERIES

__all__ = ["LLM_ORACLE", "LLM_QUERIES"]
