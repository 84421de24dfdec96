"""The stages of the corpus pipeline, under the name the driver looks for."""

from chronofold.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
