from .blocked_text import parse_blocked_lines, read_blocked_ratings
from .counts import ArrivalCounts, RowCounts, UpsertCounts
from .factors import (
    FactorShape,
    as_factors,
    factor_manifest,
    factor_shape,
    factor_stats,
    read_factors,
)
from .models import (
    compile_manifest,
    compile_manifests,
    factor_folders,
    is_complete,
    is_written,
    list_versions,
    load_model,
    read_model_factors,
    resolve_version,
    save_model,
    version_name,
    version_path,
    version_timestamp,
)
from .ratings import (
    read_ratings,
    read_ratings_csv,
    read_ratings_if_exists,
    register_table,
    remove_sources,
    upsert_ratings,
    write_ratings,
    write_replay_csv,
)
from .versioned import MergeCounts, VersionedRatings

__all__ = [n for n in dir() if not n.startswith("_")]
