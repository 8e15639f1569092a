from .als import evaluate, fit_factors, model_factors, recommend_for_users, score_ratings
from .bucketed import predict_pairs_bucketed, write_bucketed_factors
from .drift import data_drift, drift_report, prediction_drift, rating_summary, retrain_decision
from .feedback_sums import FeedbackSums, packed_equations
from .foldin import fold_in, item_gram, mean_item_vector, normal_equations, usable_feedback, weighted_feedback
from .metrics import (
    flatten_recommendations,
    rank_recommendations,
    ranking_metrics,
    ranking_per_user,
    regression_metrics,
)
from .month_summaries import MonthSummaries, drift_from_summaries, month_summaries
from .nested import recommend_nested
from .nnls import nonnegative_solutions
from .norm_index import NormIndex
from .quality import (
    complete_rows,
    drop_columns,
    keep_max,
    predicted_rows,
    relevant_rows,
    split_by_key,
    with_date_parts,
)
from .scoring import (
    exclude_items,
    fold_in_and_recommend,
    hot_ids,
    predict_lists,
    predict_pairs,
    recommend,
    recommend_requests,
    user_vectors,
)
from .topk import top_k, top_k_lists

__all__ = [n for n in dir() if not n.startswith("_")]
