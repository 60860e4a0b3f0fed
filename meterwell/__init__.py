"""Subscriber usage analytics expressed as Spark DataFrame operators."""

from meterwell.settings import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]
