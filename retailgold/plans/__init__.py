from retailgold.plans.gold_run import GateFailure, RunResult, run, run_paths, stage_feeds, stage_settlement

__all__ = ["GateFailure", "RunResult", "run", "run_paths", "stage_feeds", "stage_settlement"]
