"""The corpus pipeline: its stages, their SQL and the run over all of them, from ``paytrail.llm.pipeline``."""

from paytrail.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
