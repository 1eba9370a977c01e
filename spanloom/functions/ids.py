"""Identifier columns: 64-bit ids as lower-hex text, and IPv4 addresses as integers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LOOPBACK = 2130706433  # 127.0.0.1


def hex_id(value: Column) -> Column:
    """16 lower-hex characters; negative ids print as two's complement."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def trace_id_string(high: Column, low: Column) -> Column:
    """32 characters when the high half is set, else 16."""
    return F.when(high != 0, F.concat(hex_id(high), hex_id(low))).otherwise(hex_id(low))


def parse_hex_id(text: Column) -> Column:
    """Low 64 bits of 1 to 32 lower-hex characters; null for anything else."""
    low = F.conv(F.right(text, F.lit(16)), 16, -10).cast("bigint")
    return F.when(text.rlike("^[0-9a-f]{1,32}$"), low)


def ipv4_to_int(address: Column) -> Column:
    """Big-endian signed 32-bit value of a dotted address.

    A missing address means the loopback address; a host name gives null (no name lookup).
    """
    octet = "(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    parts = F.split(address, r"\.")
    unsigned = sum(
        (F.get(parts, F.lit(i)).cast("bigint") * (1 << (24 - 8 * i)) for i in range(1, 4)),
        F.get(parts, F.lit(0)).cast("bigint") * (1 << 24),
    )
    signed = F.when(unsigned >= 1 << 31, unsigned - (1 << 32)).otherwise(unsigned)
    return (
        F.when(address.isNull() | (address == ""), F.lit(LOOPBACK).cast("bigint"))
        .when(address.rlike(rf"^{octet}(\.{octet}){{3}}$"), signed)
    )
