"""tradescribe: regulatory trade reports as Spark DataFrame plans."""

from tradescribe.plans.report import report

__all__ = ["report"]
