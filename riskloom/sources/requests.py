"""Scoring requests as JSON text: parsing, defaults and contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a request means when it leaves a key out.
REQUIRED = ["transaction_id", "user_id", "merchant_id"]
DEFAULT_TEXT = {"channel": "web", "card_type": "credit", "device_type": "windows", "country": "US"}
DEFAULT_DISTANCE_KM = 15.0
DEFAULT_HOUR = 14


def parse_requests(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Typed request columns, ``violations`` (array of texts) and ``is_accepted``.

    A key that is left out takes its default. A key that is present but null is
    a violation, except ``hour_of_day`` and ``timestamp``, which may be null.
    Works the same on batch and streaming input.
    """
    # exploding a one-element array keeps the parsed map as a column of its own:
    # a plain projection would be merged into the filters below and parsed again there
    entries = F.array(F.from_json(F.col(payload), "map<string,string>"))
    parsed = df.select("*", F.explode(entries).alias("_m"))

    def given(key: str) -> Column:
        return F.coalesce(F.map_contains_key("_m", key), F.lit(False))

    def text(key: str) -> Column:
        return F.try_element_at(F.col("_m"), F.lit(key))

    def number(key: str, kind: str, default: float | int | None = None) -> Column:
        value = text(key).try_cast(kind)
        return value if default is None else F.when(given(key), value).otherwise(F.lit(default))

    typed = parsed.withColumns({
        **{key: text(key) for key in REQUIRED},
        "amount": number("amount", "double"),
        **{key: F.when(given(key), text(key)).otherwise(value) for key, value in DEFAULT_TEXT.items()},
        "distance_from_home_km": number("distance_from_home_km", "double", DEFAULT_DISTANCE_KM),
        "hour_of_day": number("hour_of_day", "int", DEFAULT_HOUR),
        "timestamp": text("timestamp"),
    })
    hour = F.col("hour_of_day")
    bad_hour = F.when(text("hour_of_day").isNotNull(), hour.isNull() | ~hour.between(0, 23)).otherwise(False)
    checks = [
        *[(F.col(c).isNull(), f"{c} is missing") for c in [*REQUIRED, *DEFAULT_TEXT]],
        (~F.coalesce((F.col("amount") > 0) & ~F.isnan("amount"), F.lit(False)), "amount must be above 0"),
        (~F.coalesce((F.col("distance_from_home_km") >= 0) & ~F.isnan("distance_from_home_km"), F.lit(False)),
         "distance_from_home_km must not be negative"),
        (bad_hour, "hour_of_day must be within 0..23"),
    ]
    found = F.filter(F.array(*[F.when(bad, text_) for bad, text_ in checks]), lambda v: v.isNotNull())
    return (
        typed.withColumn("violations", found)
        .withColumn("is_accepted", F.size("violations") == 0)
        .drop("_m", payload)
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where("is_accepted").drop("violations", "is_accepted")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where("not is_accepted")
