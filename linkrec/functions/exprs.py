"""Column expressions (built-in functions only, so they stay inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's.
# Action weights of the interaction score; any other action weighs 1.0.
ACTION_WEIGHTS = {"follow": 3.0, "watch": 2.0, "game_play": 1.5, "unfollow": -1.0}
DEFAULT_ACTION_WEIGHT = 1.0

# Driver events.event_type -> action of the activity stream (test mapping).
EVENT_TYPE_ACTIONS = {"signup": "follow", "view": "watch", "click": "game_play",
                      "error": "unfollow", "purchase": "purchase"}


def _case(col: Column, mapping: dict, default) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def action_weight(action: Column) -> Column:
    """Follow 3, watch 2, game_play 1.5, unfollow -1, anything else 1.0."""
    return _case(action, ACTION_WEIGHTS, DEFAULT_ACTION_WEIGHT).cast("double")


def action_from_event_type(event_type: Column) -> Column:
    return _case(event_type, EVENT_TYPE_ACTIONS, event_type)


def int_strict(c: Column) -> Column:
    """B1: strict integer cast; raises on bad text under ANSI mode."""
    return c.cast("int")


def int_lenient(c: Column) -> Column:
    """B2: lenient integer cast; NULL on bad text."""
    return c.try_cast("int")


def bool_false_default(c: Column) -> Column:
    """True iff lower(x) = 'true', else false (NULL input -> false)."""
    return F.coalesce(F.lower(c) == F.lit("true"), F.lit(False))


def bool_lenient(c: Column) -> Column:
    """B4: 'true'/'false' in any case -> boolean, anything else NULL."""
    lc = F.lower(F.trim(c))
    return F.when(lc == "true", F.lit(True)).when(lc == "false", F.lit(False))


def safe_div_null(x: Column, y: Column) -> Column:
    """X / NULLIF(y, 0)."""
    return x.cast("double") / F.nullif(y, F.lit(0))


def safe_div_zero(x: Column, y: Column) -> Column:
    """X / y if y > 0 else 0.0."""
    return F.when(y > 0, x.cast("double") / y).otherwise(F.lit(0.0))


def len_or_null(arr: Column) -> Column:
    """Array length that is NULL for an empty array."""
    return F.nullif(F.size(arr), F.lit(0))


def parse_int_list(text: Column) -> Column:
    """JSON text -> array<bigint>, NULL / empty / bad text -> []."""
    return F.coalesce(F.from_json(text, "array<bigint>"), F.array().cast("array<bigint>"))


def hash_order(*parts) -> Column:
    """Reproducible pseudo-random order key: first 32 bits of md5('a|b|seed').

    Same value in any partitioning and in DuckDB
    (``('0x'||substr(md5(s),1,8))::BIGINT``); used instead of a seeded RNG.
    """
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit("|"))
        cols.append(p.cast("string") if isinstance(p, Column) else F.lit(str(p)))
    s = F.concat(*cols)
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def hash_unit(*parts) -> Column:
    """Reproducible uniform number in (0, 1): the first 60 bits of
    md5('a|b|seed'), plus a half, over 2**60 (in DuckDB
    ``(('0x'||substr(md5(s),1,15))::BIGINT + 0.5) / 2**60``)."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit("|"))
        cols.append(p.cast("string") if isinstance(p, Column) else F.lit(str(p)))
    h = F.conv(F.substring(F.md5(F.concat(*cols)), 1, 15), 16, 10).cast("bigint")
    return (h.cast("double") + F.lit(0.5)) / F.lit(float(1 << 60))


def same_or_zero(a: Column, b: Column) -> Column:
    """Equality flag where a missing value never equals anything."""
    return F.coalesce((a == b).cast("int"), F.lit(0))


def rnd(c: Column, places: int = 6) -> Column:
    return F.round(c, places)
