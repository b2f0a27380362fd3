"""Small column functions on dates, times, ids and loosely typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hhmm_minutes(value: str) -> Column:
    """Minutes of the day from ``HHMM`` (number or text, left zeros optional).

    Anything that is not a time of day gives null.
    """
    text = f"lpad(trim(CAST({value} AS STRING)), 4, '0')"
    hour, minute = f"CAST(substring({text}, 1, 2) AS INT)", f"CAST(substring({text}, 3, 2) AS INT)"
    return F.expr(
        f"CASE WHEN trim(CAST({value} AS STRING)) RLIKE '^[0-9]{{1,4}}$'"
        f" AND {hour} < 24 AND {minute} < 60 THEN {hour} * 60 + {minute} END"
    )


def expect_type(value: str, type_name: str, default: str) -> Column:
    """The value as ``type_name`` or the default where it does not convert."""
    return F.expr(f"coalesce(try_cast({value} AS {type_name}), {default})")


def days_between(later: str, earlier: str) -> Column:
    return F.expr(f"datediff({later}, {earlier})")


def position_id(lat: str, lon: str, decimals: int = 5) -> Column:
    """md5 over latitude and longitude written with fixed digits."""
    d = f"decimal(20, {decimals})"
    return F.expr(f"md5(concat(CAST(CAST({lat} AS {d}) AS STRING), CAST(CAST({lon} AS {d}) AS STRING)))")


def stable_detection_id() -> Column:
    """Identity of a detection that does not depend on the load it came with."""
    return F.expr("xxhash64(acq_date, acq_time, lon, lat, satellite)")


def python_float_text(value: str) -> str:
    """SQL text of a double the way Python prints it.

    Both write the shortest digits; they differ in when the exponent starts and
    in its form (1.0E-4 / 0.0001, 1.5E-5 / 1.5e-05, 1.0E7 / 10000000.0). Java before
    19 may add a digit to very large or small values, far outside coordinates.
    """
    text, size = f"CAST({value} AS STRING)", f"abs({value})"
    plain_digits = f"trim(TRAILING '0' FROM CAST(CAST({text} AS DECIMAL(38, 20)) AS STRING))"
    exponent = (
        f"regexp_replace(regexp_replace(replace({text}, '.0E', 'E'), 'E-([0-9])$', 'e-0$1'),"
        " 'E([0-9])', 'e+$1')"
    )
    return (
        f"CASE WHEN {size} >= 1e-3D AND {size} < 1e7D OR {value} = 0D THEN {text}"
        f" WHEN {size} >= 1e-4D AND {size} < 1e16D THEN"
        f" IF({plain_digits} LIKE '%.', concat({plain_digits}, '0'), {plain_digits})"
        f" ELSE replace({exponent}, 'E-', 'e-') END"
    )
