from foldwright.plans.ensembles import (
    adaboost_kfold_scores,
    adaboost_predict,
    bagging_kfold_scores,
    bagging_predict,
    kfold_scores,
)
from foldwright.plans.features import clean, derive_features, feature_steps, feature_table
from foldwright.plans.study import (
    Settings,
    cluster_study,
    importance_study,
    model_study,
    prepare,
    profile_tables,
    run_study,
)

__all__ = [
    "Settings",
    "adaboost_kfold_scores",
    "adaboost_predict",
    "bagging_kfold_scores",
    "bagging_predict",
    "clean",
    "cluster_study",
    "derive_features",
    "feature_steps",
    "feature_table",
    "importance_study",
    "kfold_scores",
    "model_study",
    "prepare",
    "profile_tables",
    "run_study",
]
