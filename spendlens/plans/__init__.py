from .pipeline import References, enrich, run_phase1, run_phase2, run_phase3

__all__ = ["References", "enrich", "run_phase1", "run_phase2", "run_phase3"]
