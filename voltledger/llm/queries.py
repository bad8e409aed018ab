"""All queries of the training-data operators; importing this module registers them."""

from voltledger.llm import (  # noqa: F401
    anchor_queries, chat_queries, decontamination_queries, fim_queries, jaccard_queries, language_queries, mtree_queries,
    packing_queries, quality_queries, simhash_queries, token_count_queries, toxicity_queries, warc_queries,
)
from voltledger.llm.catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
