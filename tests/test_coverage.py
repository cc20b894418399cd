
import __spark_entry__ as se
from prepfold import catalog

# SURVEY section 2 keys (J5's index_pipeline is registered as index_categoricals;
# list_columns and check_dtypes are schema-only and tested in test_validate).
SURVEY_KEYS = {
    "scan_parquet", "model_roundtrip", "check_load", "summary_stats", "shape_report",
    "conditional_counts", "preview", "max_corr", "corr_report", "skewness", "sample",
    "distinct_values", "histogram", "linear_trend", "null_profile", "null_patterns",
    "category_counts", "drop_columns", "exclude_values", "sigma_filter", "impute_mean",
    "impute_median", "impute_constant", "drop_sparse_columns", "drop_low_obs", "zero_fill",
    "null_out_outlier", "percent_scale", "percent_scale_round_first", "min_max_scale",
    "reflect_log", "log_transform", "precision_join", "sql_left_join", "join_audit_unmatched",
    "join_audit_fanout", "prior_period_join", "global_aggregates", "pivot_tokens", "lag_feature",
    "report_gap_audit", "unit_convert", "difference_feature", "ratio_features", "sum_feature",
    "compound_ratio", "parse_date", "day_of_week", "text_flag", "split_list", "explode_tokens",
    "token_vocabulary", "multi_hot", "binarize_weekend", "bucketize", "string_index", "one_hot",
    "index_categoricals", "assemble_features", "split_date", "time_split", "asof_days_open",
    "time_split_pct", "gbt_predict", "rfr_predict", "evaluate_models", "feature_importance",
}
ROWS_ONLY = {"sample"}


def test_every_survey_key_is_registered():
    assert SURVEY_KEYS <= set(se.queries())


def test_every_other_key_has_sql():
    assert {n for n, e in catalog.REGISTRY.items() if not e.sql} == ROWS_ONLY


def test_no_reserved_names():
    for name in catalog.REGISTRY:
        assert "pipeline" not in name and not name.startswith("op")
