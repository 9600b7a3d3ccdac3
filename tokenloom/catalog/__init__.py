"""Every operator as a runnable query over the driver tables, with its SQL twin where SQL can state it."""

from tokenloom.catalog import (  # noqa: F401
    corpus_queries,
    packing_queries,
    rollout_queries,
    runlog_queries,
    scoring_queries,
    streaming_queries,
    vector_queries,
    vocab_queries,
)
from tokenloom.catalog.registry import ORACLES, QUERIES  # noqa: F401
