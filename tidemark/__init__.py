"""Daily feature store and top-K recommendations as Spark DataFrame jobs."""

from tidemark.config import FeatureConfig, IngestConfig, Splits, TrainConfig
from tidemark.plans import run_bootstrap, run_features, run_inference, run_training

__all__ = [
    "FeatureConfig",
    "IngestConfig",
    "Splits",
    "TrainConfig",
    "run_bootstrap",
    "run_features",
    "run_inference",
    "run_training",
]
