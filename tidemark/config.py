"""Parameters of the jobs. The defaults are part of the results, not tuning."""

from __future__ import annotations

from dataclasses import dataclass, field

# The behaviours that count as engagement.
ENGAGEMENT = ("buy", "cart", "fav")

# The model input, in this order.
FEATURE_COLS = (
    "user_item_freq",
    "user_cat_freq",
    "user_cat_eng",
    "intent_score",
    "item_popularity",
    "cat_popularity",
    "cat_target_enc",
    "lag_1",
    "lag_2",
)

# Key and label columns in front of the features.
MATRIX_KEYS = ("user_id", "item_id", "category_id", "day", "event_date", "label", "split")
MATRIX_COLS = MATRIX_KEYS + FEATURE_COLS


@dataclass(frozen=True)
class IngestConfig:
    """Which part of the log enters the lake, and how it is dated."""

    # Nine local days, both bounds inclusive, in epoch seconds.
    ts_min: int = 1511539200
    ts_max: int = 1512316799
    timezone: str = "Asia/Shanghai"
    min_interactions: int = 10
    grain: str = "day"

    def __post_init__(self):
        if self.grain not in ("day", "month"):
            raise ValueError(f"grain must be 'day' or 'month', not {self.grain!r}")


@dataclass(frozen=True)
class Splits:
    """Day ordinals per split. Days in no split only serve as history (burn-in)."""

    train: tuple[int, ...] = (4, 5, 6)
    val: tuple[int, ...] = (7,)
    test: tuple[int, ...] = (8,)
    infer: tuple[int, ...] = (9,)

    def __post_init__(self):
        days = self.train + self.val + self.test + self.infer
        if len(set(days)) != len(days):
            raise ValueError("a day may belong to one split only")

    def as_dict(self) -> dict[str, tuple[int, ...]]:
        return {"train": self.train, "val": self.val, "test": self.test, "infer": self.infer}

    @property
    def labelled(self) -> tuple[int, ...]:
        return self.train + self.val + self.test

    @property
    def used(self) -> tuple[int, ...]:
        return self.labelled + self.infer


@dataclass(frozen=True)
class FeatureConfig:
    """Feature smoothing, negative sampling and the split calendar."""

    epsilon: float = 1e-6
    neg_ratio: int = 4
    top_popular: int = 20
    splits: Splits = field(default_factory=Splits)

    def __post_init__(self):
        # The length of the popular list, which one task puts in order.
        if self.top_popular < 1:
            raise ValueError("top_popular must be positive")
        if self.neg_ratio < 0:
            raise ValueError("neg_ratio must not be negative")


@dataclass(frozen=True)
class TrainConfig:
    """Boosted trees with patience-based early stopping."""

    max_rounds: int = 200
    max_depth: int = 4
    step_size: float = 0.1
    patience: int = 10
    seed: int = 42
    # margins are written down every so many rounds; not part of the result
    rounds_per_table: int = 5


# Fixed value: the decision threshold of the class metrics (score >= threshold).
THRESHOLD = 0.5

# Fixed value: recommendations kept per user.
TOP_K = 10

# Fixed value: how many of the newest runs are looked at for a finished one.
NEWEST_RUNS = 10
