"""Data-quality checks as Spark plans."""

from truegrain.api import *  # noqa: F403
from truegrain.errors import RuleError
from truegrain.operators.scalar import evaluate
from truegrain.plans.suite import publish_job, run_job, run_suite

__all__ = ["RuleError", "evaluate", "publish_job", "run_job", "run_suite"]
