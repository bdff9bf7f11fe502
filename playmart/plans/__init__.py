"""Logical plans: the star schema, the reports and the full load."""
