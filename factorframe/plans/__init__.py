from .ingest import (
    MergeReport,
    build_replay,
    ingest_ratings,
    merge_staged,
    split_paths,
    stage_arrivals,
    stage_arrivals_stream,
)
from .ledger import Ledger
from .lifecycle import (
    CYCLE_STEPS,
    RunReport,
    detect_drift,
    evaluate_version,
    run_drift_cycle,
    run_initial,
    train_model,
)

__all__ = [n for n in dir() if not n.startswith("_")]
