"""Imports every module that registers queries."""

from corpusflow.plans import (  # noqa: F401
    chat_queries,
    corpus_queries,
    reward_queries,
    rollout_queries,
    stream_queries,
)
from corpusflow.plans.registry import ORACLES, QUERIES  # noqa: F401
