from foldwright.functions.dates import date_diff_days, months_between_years
from foldwright.functions.keys import hash_fold, key_text, poisson_cuts, poisson_weight
from foldwright.functions.scores import exp_sigmoid, positive_share, threshold_predict, to_prob_vec

__all__ = [
    "date_diff_days",
    "exp_sigmoid",
    "hash_fold",
    "key_text",
    "months_between_years",
    "poisson_cuts",
    "poisson_weight",
    "positive_share",
    "threshold_predict",
    "to_prob_vec",
]
