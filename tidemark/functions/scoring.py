"""A fixed logistic scorer, for scoring without a trained model (and for exact checks)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTERCEPT = -1.25

# weight, and whether the feature enters as ln(1 + x)
WEIGHTS = {
    "user_item_freq": (0.9, True),
    "user_cat_freq": (-0.2, True),
    "user_cat_eng": (0.35, True),
    "intent_score": (0.6, False),
    "item_popularity": (0.15, True),
    "cat_popularity": (-0.05, True),
    "cat_target_enc": (0.02, False),
    "lag_1": (0.25, True),
    "lag_2": (0.1, True),
}


def logistic_score(digits: int | None = None) -> Column:
    """P(class 1) of the feature columns; rounded when ``digits`` is given."""
    z = F.lit(INTERCEPT)
    for name, (weight, logged) in WEIGHTS.items():
        z = z + F.lit(weight) * (F.log1p(name) if logged else F.col(name))
    p = 1.0 / (1.0 + F.exp(-z))
    return p if digits is None else F.round(p, digits)
