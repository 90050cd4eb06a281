"""Batch retail analytics as composable Spark DataFrame operators."""

from tallyhouse.plans.model import RetailModel
from tallyhouse.plans.preset import RetailPreset
from tallyhouse.session import build_session

__all__ = ["RetailModel", "RetailPreset", "build_session"]
