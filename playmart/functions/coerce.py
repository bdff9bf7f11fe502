"""Type coercion of raw JSON text at load time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playmart.schemas import numeric_type


def checked_cast(value: Column, *kinds: str, label: str) -> Column:
    """``value`` cast through ``kinds`` in turn; what does not fit fails the job.

    Written out rather than left to the ANSI setting, so that no session turns
    junk into NULL.
    """
    result = value
    for kind in kinds:
        result = result.try_cast(kind)
    message = F.concat(F.lit(f"cannot load {label} as {kinds[-1]}: "), value.cast("string"))
    return F.coalesce(result, F.when(value.isNotNull(), F.raise_error(message).cast(kinds[-1])))


def coerce(raw: Column, name: str, kind: str, numeric_mode: str = "exact") -> Column:
    """Raw text as column ``name`` of type ``kind``.

    Empty text becomes NULL for every type but string; junk aborts the load.
    """
    if kind == "string":
        return raw.alias(name)
    text = F.nullif(F.trim(raw), F.lit(""))
    kinds = [kind]
    if kind == "numeric":
        kinds = [numeric_type(numeric_mode)]
        if numeric_mode == "ddl":
            # A cast to decimal(18,0) rounds; through bigint it truncates toward zero.
            kinds = ["decimal(38,18)", "bigint", *kinds]
    return checked_cast(text, *kinds, label=name).alias(name)
