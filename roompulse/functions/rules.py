"""Comfort labels, prediction text and age buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Comfort limits and the life-stage bounds.
MIN_LIGHT = 20
MAX_TEMPERATURE = 30
MAX_HUMIDITY = 60
TEENAGER_FROM = 13
TEENAGER_TO = 19


def is_number(name: str) -> Column:
    """Neither NULL nor NaN, which JSON text may hold too."""
    return F.col(name).isNotNull() & ~F.isnan(name)


def comfort_label(
    light: str = "light", temperature: str = "temperature", humidity: str = "humidity",
    light_rule: str = "below",
) -> Column:
    """1 for a comfortable reading, 0 otherwise; readings on a limit are comfortable.

    A reading without all three values has no label (NULL). ``light_rule='below'`` rejects dark
    rooms, ``'above'`` rejects bright ones (the variant that labels noise rows).
    """
    if light_rule not in ("below", "above"):
        raise ValueError(f"light_rule must be 'below' or 'above', not {light_rule!r}")
    bad_light = F.col(light) < MIN_LIGHT if light_rule == "below" else F.col(light) > MIN_LIGHT
    uncomfortable = (
        bad_light | (F.col(temperature) > MAX_TEMPERATURE) | (F.col(humidity) > MAX_HUMIDITY)
    )
    complete = is_number(light) & is_number(temperature) & is_number(humidity)
    return F.when(complete & uncomfortable, 0).when(complete, 1)


def prediction_text(prediction: str = "prediction") -> Column:
    """``comfortable`` for 1, ``not comfortable`` for anything else, NULL included."""
    return F.when(F.col(prediction) == 1, "comfortable").otherwise("not comfortable")


def life_stage(age: str = "age") -> Column:
    """``child``, ``teenager`` (both bounds inside) or ``adult``; an unknown age counts as adult."""
    return (
        F.when(F.col(age) < TEENAGER_FROM, "child")
        .when(F.col(age).between(TEENAGER_FROM, TEENAGER_TO), "teenager")
        .otherwise("adult")
    )
