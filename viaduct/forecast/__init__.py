"""Forecasting of vehicle counts and congestion."""

from .evaluation import best_model, compare_models, compare_predictions, evaluate_regression
from .features import FEATURES, LABEL, build_training_set, feature_stages, prepare_features, split, standardized
from .ledger import record_predictions, with_actuals
from .scoring import fill_feature_defaults, forecast_24h, score_congestion, score_vehicle_count
from .training import (Searched, TrainedModels, cross_validated, grid_search, load_model, save_model, train_boosted_subsampled,
                       train_forest, train_gbt, train_linear, train_models)

__all__ = [
    "FEATURES", "LABEL", "Searched", "TrainedModels", "best_model", "build_training_set", "compare_models",
    "compare_predictions",
    "cross_validated", "evaluate_regression", "feature_stages", "fill_feature_defaults", "forecast_24h",
    "grid_search", "load_model", "prepare_features", "record_predictions", "save_model", "score_congestion",
    "score_vehicle_count", "split", "standardized", "train_boosted_subsampled", "train_forest",
    "train_gbt", "train_linear", "train_models", "with_actuals",
]
