"""The four jobs. Each hands over to the next through a table."""

from tidemark.plans.bootstrap import run_bootstrap
from tidemark.plans.features import run_features
from tidemark.plans.inference import run_inference
from tidemark.plans.training import run_training

__all__ = ["run_bootstrap", "run_features", "run_inference", "run_training"]
