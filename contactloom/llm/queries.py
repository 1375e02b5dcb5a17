"""All queries of this subpackage; importing the modules registers them."""

import corpus_pipeline
from contactloom.llm import queries_corpus, queries_documents, queries_pages  # noqa: F401
from contactloom.llm.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
