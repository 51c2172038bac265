"""Interval and usage-timeline analytics as Spark DataFrame plans."""

from tideline.contracts import ContractError, UsageSpec

__all__ = ["ContractError", "UsageSpec"]
