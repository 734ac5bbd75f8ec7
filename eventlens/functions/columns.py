"""Column expressions shared by the operators. All stay inside the JVM."""

from pyspark.sql import Column, functions as F


def is_present(col) -> Column:
    """True for a value that is neither null nor blank."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & (c.cast("string") != "")


def routing_key(partition_key="partition_key", user_id="user_id") -> Column:
    """The partition key, or the user id where the key is blank."""
    return F.when(is_present(partition_key), F.col(partition_key)).otherwise(F.col(user_id))


def hash_partition(key: Column, n: int) -> Column:
    """``int(md5(key), 16) % n`` in 64-bit arithmetic.

    The 128-bit digest is folded as four 32-bit digits in base 2**32, reducing
    modulo n after each digit; for n below 2**31 no step overflows a long.
    """
    if not 0 < n < 2 ** 31:
        raise ValueError("n must be in 1 .. 2**31-1")
    digest = F.md5(key.cast("binary"))
    base = 2 ** 32 % n
    rest = F.lit(0).cast("long")
    for start in (1, 9, 17, 25):
        digit = F.conv(F.substring(digest, start, 8), 16, 10).cast("long")
        rest = (rest * F.lit(base).cast("long") + digit) % F.lit(n).cast("long")
    return rest.cast("int")


def round_robin_partition(arrival_no: Column, n: int) -> Column:
    """Partition of the ``arrival_no``-th send (0-based) when events carry no key."""
    return F.pmod(arrival_no, F.lit(n)).cast("int")


def latency_ms(event_time="ts", processing_time="ingest_ts") -> Column:
    return (F.unix_micros(F.col(processing_time)) - F.unix_micros(F.col(event_time))) / F.lit(1000.0)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """part / whole * 100, half-up; 0 where there is nothing to divide by."""
    return F.when(whole > 0, F.round(part.cast("double") / whole * 100, digits)).otherwise(F.lit(0.0))


def lag_percent(lag: Column, full_at: float = 10_000) -> Column:
    return F.least(F.lit(100.0), lag / F.lit(float(full_at)) * 100)


def health_band(value: Column, red_above: float, yellow_above: float) -> Column:
    return (
        F.when(value > red_above, "red").when(value > yellow_above, "yellow").otherwise("green")
    )


def category_label(name: Column) -> Column:
    """First word of a category name."""
    return F.split(name, " ", 2)[0]
