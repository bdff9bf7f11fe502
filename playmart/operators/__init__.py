"""Operators that take more than one built-in expression."""

from playmart.operators.keys import duplicate_keys
from playmart.operators.lookup import broadcast_within
from playmart.operators.numbering import dense_ids
from playmart.operators.scratch import Scratch

__all__ = ["Scratch", "broadcast_within", "dense_ids", "duplicate_keys"]
