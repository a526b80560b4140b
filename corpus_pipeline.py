"""Training corpus pipeline: language ID, line dedup, near-duplicate documents, decontamination, source mixing."""

from __future__ import annotations

from logweave.llm import pipeline as _stages

STAGES = _stages.STAGES
#: Language identification has no SQL form; the stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in order, starting from ``documents``; each result is written as Parquet and read by the next."""
    return _stages.run(spark, sf_dir, STAGES)
