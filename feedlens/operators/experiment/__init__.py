from feedlens.operators.experiment.buckets import (
    bucket_metrics, bucket_metrics_from_users, bucket_ratios, bucket_user_metrics, index_quantile,
    with_bucket,
)
from feedlens.operators.experiment.histogram import histogram
from feedlens.operators.experiment.metrics import (
    control_ctr, group_totals, linearized_likes, smoothed_ctr, user_metrics,
)
from feedlens.operators.experiment.ranks import (
    mann_whitney, mann_whitney_stats, prob_superiority, rank_summary, rank_table,
)
from feedlens.operators.experiment.resample import (
    aa_pvalues, aa_stats, aa_subsamples, aa_summary, bootstrap_replicates, bootstrap_summary,
)
from feedlens.operators.experiment.welch import welch_stats, welch_stats_many, welch_test

__all__ = [
    "bucket_metrics", "bucket_metrics_from_users", "bucket_ratios", "bucket_user_metrics", "index_quantile", "histogram", "control_ctr",
    "group_totals", "linearized_likes", "smoothed_ctr", "user_metrics", "mann_whitney",
    "mann_whitney_stats", "prob_superiority", "rank_summary", "rank_table", "aa_pvalues", "aa_stats", "aa_subsamples",
    "aa_summary", "bootstrap_replicates", "bootstrap_summary", "welch_stats", "welch_stats_many", "welch_test",
    "with_bucket",
]
