"""IPv4 addresses and ranges as numbers, so that membership is an equi-join."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SHAPE, RANGE_SHAPE = r"\A\d{1,3}(\.\d{1,3}){3}\z", r"\A\d{1,3}(\.\d{1,3}){3}(/(0|[1-9]\d?))?\z"


def ipv4_number(address: Column) -> Column:
    """Dotted quad as a bigint, NULL for anything else (IPv6 included). Leading zeros are taken as decimal."""
    octets = F.split(F.when(address.rlike(SHAPE), address), r"\.")
    # The octets stand outside any condition, so that the split is evaluated once for all four.
    parts = [F.get(octets, F.lit(position)).cast("bigint") for position in range(4)]
    number = parts[0]
    for part in parts[1:]:
        number = number * 256 + part
    return F.when(F.greatest(*parts) <= 255, number)


def is_ipv4_range(text: Column) -> Column:
    """True for ``a.b.c.d`` and ``a.b.c.d/0`` to ``/32``; a trailing newline is not accepted, nor is a prefix with a leading zero."""
    prefix = F.substring_index(text, "/", -1).try_cast("int")
    fits = F.when(text.contains("/"), prefix <= 32).otherwise(F.lit(True))
    number = ipv4_number(F.substring_index(text, "/", 1))
    return F.coalesce(text.rlike(RANGE_SHAPE) & fits & number.isNotNull(), F.lit(False))


def to_range(text: Column) -> Column:
    """A bare address becomes a /32 range."""
    return F.when(text.contains("/"), text).otherwise(F.concat(text, F.lit("/32")))


def range_key(number: Column, prefix_length: Column | int) -> Column:
    """One bigint for (prefix length, network): equal keys mean the same range.

    Prefix length in the high bits, the network's leading bits in the low 32.
    """
    length = F.lit(prefix_length) if isinstance(prefix_length, int) else prefix_length
    length = length.cast("int")
    network = F.call_function("shiftright", number, F.lit(32) - length)
    return F.shiftleft(length.cast("bigint"), 32) + network
