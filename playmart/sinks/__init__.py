"""Stored tables."""

from playmart.sinks.warehouse import Warehouse

__all__ = ["Warehouse"]
