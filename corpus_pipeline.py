"""The corpus pipeline: STAGES, run() and ORACLE_SQL of litloom.llm.pipeline."""

from litloom.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
