"""From raw documents to packed training sequences, in stages that are written and read again.

The stages are those of ``shoplens.llm.pipeline``: quality rules, near duplicates, decontamination,
secrets, packing.
"""

from shoplens.llm.pipeline import (
    ORACLE_SQL,
    STAGES,
    good_documents,
    one_of_each,
    run,
    sequences,
    without_benchmark,
    without_secrets,
)

__all__ = [
    "ORACLE_SQL",
    "STAGES",
    "good_documents",
    "one_of_each",
    "run",
    "sequences",
    "without_benchmark",
    "without_secrets",
]
