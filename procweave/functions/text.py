"""Scalar functions: times, sizes, addresses, names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

READ, WRITE = 256, 128


def seconds(whole: Column, micros: Column) -> Column:
    return whole + micros / F.lit(1e6)


def readable(mode: Column) -> Column:
    return mode.bitwiseAND(READ) != 0


def writable(mode: Column) -> Column:
    return mode.bitwiseAND(WRITE) != 0


def connection(path: Column) -> Column:
    """``tcp:local:port:remote:port`` as a struct."""
    part = lambda i: F.get(F.split(path, ":"), i)
    return F.struct(part(0).alias("protocol"), part(1).alias("localAddress"), part(2).cast("long").alias("localPort"), part(3).alias("remoteAddress"), part(4).cast("long").alias("remotePort"))


def ipv4(number: Column) -> Column:
    """Dotted text of a little-endian address."""
    return F.concat_ws(".", *[F.shiftright(number.cast("long"), 8 * i).bitwiseAND(255).cast("string") for i in range(4)])


def short_context(name: Column) -> Column:
    """A host, identifier or subidentifier up to its first dot."""
    return F.substring_index(name, ".", 1)


def short_host(host: Column, first: str, second: str) -> Column:
    """Short name by two domain forms; null for others, which callers reject."""
    one = F.regexp_extract(host, first, 1)
    return F.nullif(F.when(one != "", one).otherwise(F.regexp_extract(host, second, 1)), F.lit(""))


def size_1000(x: Column) -> Column:
    """Bytes with two decimals, stepping at 1000."""
    out = F.format_string("%.2f PB", x / 1e15)
    for unit, step in (("TB", 1e12), ("GB", 1e9), ("MB", 1e6), ("KB", 1e3)):
        out = F.when(x < step * 1000, F.format_string(f"%.2f {unit}", x / step)).otherwise(out)
    return F.when(x < 1000, F.format_string("%.2f B", x.cast("double"))).otherwise(out)


def size_1024(x: Column, limit: float = 2.0**63) -> Column:
    """Bytes with one decimal, stepping at 1024; ``limit`` and more has no size."""
    out = F.format_string("%.1fT", x / 1024.0**4)
    for unit, power in (("G", 3), ("M", 2), ("K", 1)):
        out = F.when(x < 1024.0 ** (power + 1), F.format_string(f"%.1f{unit}", x / 1024.0**power)).otherwise(out)
    return F.when(x >= limit, F.lit("limit")).when(x < 1024, F.format_string("%.1fB", x.cast("double"))).otherwise(out)


def elapsed(secs: Column) -> Column:
    """Seconds as ``HH:MM:SS.mmmm``."""
    whole = F.floor(secs).cast("long")
    number = lambda x: F.floor(x).cast("long")
    return F.format_string("%02d:%02d:%02d.%04d", number(whole / 3600), F.pmod(number(whole / 60), F.lit(60)), F.pmod(whole, F.lit(60)), number((secs - whole) * 10000))


def job_text(text: Column) -> Column:
    """``job.task`` as a struct; no task is ``*``."""
    parts = F.split(text, "[.]")
    return F.struct(F.get(parts, 0).alias("job"), F.coalesce(F.get(parts, 1), F.lit("*")).alias("task"))


def topic(text: Column) -> Column:
    """``host.identifier.subidentifier.type`` as a struct."""
    parts = F.split(text, "[.]")
    return F.struct(*[F.get(parts, i).alias(n) for i, n in enumerate(("host", "identifier", "subidentifier", "type"))])


def spaced(cmd_args: Column) -> Column:
    return F.translate(cmd_args, "|", " ")


def date_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")
