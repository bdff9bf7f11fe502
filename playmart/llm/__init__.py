"""Operators for preparing training text at scale. Nothing outside imports them."""
