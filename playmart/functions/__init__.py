"""Column expressions shared by the plans."""

from playmart.functions.calendar import calendar_parts, epoch_to_timestamp
from playmart.functions.coerce import checked_cast, coerce
from playmart.functions.guards import not_null

__all__ = ["calendar_parts", "checked_cast", "coerce", "epoch_to_timestamp", "not_null"]
