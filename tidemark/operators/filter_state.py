"""Tables of filter states: how many filters are set, what changed, what a reply asks for.

A state is a struct with the list fields and the ``[low, high]`` fields below.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields of a filter state, their captions, defaults, and fixed texts.
LIST_FIELDS = {"brands": "Brand", "models": "Models", "vehicle_types": "Vehicle Types", "colors": "Colors"}
RANGE_FIELDS = {
    "engine_range": "Engine Size",
    "weight_range": "Vehicle Weight",
    "seats": "Number of Seats",
    "year_range": "Registration Year",
}
RANGE_DEFAULTS = {"engine_range": [500, 8000], "weight_range": [500, 5000], "seats": [1, 7], "year_range": [2000, 2020]}
OPEN_TOP = {"seats": 7}
LISTED_ITEMS = 3
DEFAULT_MESSAGE = "I can help you find cars."

_FIELDS = [f"{name}: array<string>" for name in LIST_FIELDS] + [f"{name}: array<int>" for name in RANGE_FIELDS]
STATE_TYPE = f"struct<{', '.join(_FIELDS)}>"


def _ints(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _filled(column: Column) -> Column:
    return F.coalesce(F.size(column) > 0, F.lit(False))


def active_filter_count(
    states: DataFrame, state: str = "state", defaults: Mapping[str, Sequence[int]] = RANGE_DEFAULTS
) -> DataFrame:
    """Add ``n_active``: lists that are not empty plus ranges that differ from their default."""
    active = [_filled(F.col(f"{state}.{name}")) for name in LIST_FIELDS]
    for name in RANGE_FIELDS:
        chosen = F.col(f"{state}.{name}")
        active.append(_filled(chosen) & ~chosen.eqNullSafe(_ints(defaults[name])))
    return states.withColumn("n_active", sum((a.cast("int") for a in active), F.lit(0)))


def _shown_list(values: Column) -> Column:
    count = F.size(values)
    return F.when(count <= LISTED_ITEMS, F.array_join(values, ", ")).otherwise(
        F.concat(count.cast("string"), F.lit(" items selected"))
    )


def _shown_range(name: str, values: Column) -> Column:
    high = F.get(values, F.lit(1))
    top = F.when(high == OPEN_TOP[name], F.lit("+")).otherwise("") if name in OPEN_TOP else F.lit("")
    return F.concat(F.get(values, F.lit(0)).cast("string"), F.lit("-"), high.cast("string"), top)


def filter_diff(states: DataFrame, current: str = "current", suggested: str = "suggested") -> DataFrame:
    """Add ``changes``: one text per field that the suggestion changes, in field order.

    A field missing from the suggestion keeps its value.  Lists are compared as sets.
    """
    texts = []
    for name, caption in {**LIST_FIELDS, **RANGE_FIELDS}.items():
        old = F.col(f"{current}.{name}")
        new = F.coalesce(F.col(f"{suggested}.{name}"), old)
        if name in LIST_FIELDS:
            nothing = F.array().cast("array<string>")
            differs = F.array_sort(F.array_distinct(F.coalesce(old, nothing))) != F.array_sort(
                F.array_distinct(F.coalesce(new, nothing))
            )
            shown = _shown_list(new)
        else:
            differs = ~old.eqNullSafe(new)
            shown = _shown_range(name, new)
        texts.append(F.when(differs & _filled(new), F.concat(F.lit(f"{caption}: "), shown)))
    return states.withColumn("changes", F.array_compact(F.array(*texts)))


def parse_reply(replies: DataFrame, reply: str = "reply", current: str = "current") -> DataFrame:
    """Add ``message`` and ``filters`` from the JSON between the outer braces of each reply.

    Filter values that are given replace the current ones.  A reply without readable JSON
    is itself the message and changes nothing.
    """
    text = F.nullif(F.regexp_extract(F.trim(F.col(reply)), r"(?s)\{.*\}", 0), F.lit(""))
    # NULL unless the text is readable; one column, so that it is parsed once per row.
    parsed = F.when(F.try_parse_json(text).isNotNull(), F.from_json(text, f"message string, filters {STATE_TYPE}"))
    merged = [
        F.coalesce(F.col(f"__parsed.filters.{name}"), F.col(f"{current}.{name}")).alias(name)
        for name in (*LIST_FIELDS, *RANGE_FIELDS)
    ]
    message = F.when(F.col("__parsed").isNull(), F.col(reply)).otherwise(
        F.coalesce(F.col("__parsed.message"), F.lit(DEFAULT_MESSAGE))
    )
    return (
        replies.withColumn("__parsed", parsed)
        .withColumns({"message": message, "filters": F.struct(*merged)})
        .drop("__parsed")
    )
