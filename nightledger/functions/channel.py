"""The channel id: a structured text carrying product, version, channel code and sub-code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from nightledger.functions import codes
from nightledger.functions.numeric import implies
from nightledger.functions.text import byte_length, from_end, head, tail, to_number


def is_android(c: Column) -> Column:
    return c.startswith("s")


def is_ios(c: Column) -> Column:
    return head(c, 5).isin(codes.IPHONE, codes.IPAD)


def valid_channel(c: Column) -> Column:
    """Keys fit for the quality report: no blanks, placeholders, odd lengths or stray characters."""
    return (
        ~c.isin("0", codes.PLACEHOLDER_CHANNEL)
        & byte_length(c).between(8, 17)
        & ~c.contains(".")
        & ~c.contains("_")
        & ~c.contains("%")
    )


def junk_channel(c: Column) -> Column:
    """Keys dropped from the returning-user report."""
    return c.isNull() | c.isin(*codes.JUNK_CHANNELS) | tail(c, 6).like(codes.EXCLUDED_CODE + "%")


def excluded_code(c: Column) -> Column:
    return from_end(c, 6, 4) == codes.EXCLUDED_CODE


def _layouts(c: Column) -> list[tuple[Column, int, Column, Column, Column]]:
    """Known layouts in order of precedence: (test, type, version, code, sub-code)."""
    n = F.length(c)
    zero = F.lit(0)
    web, android, iphone, ipad = (c.startswith(p) for p in (codes.WEB, codes.ANDROID, codes.IPHONE, codes.IPAD))
    mid = F.substring(c, 6, 3)
    code, sub = from_end(c, 6, 4), tail(c, 2)
    long_android = F.substring(c, 11, 4) == codes.LONG_ANDROID_CODE
    long_iphone = from_end(c, 8, 4) == codes.LONG_IPHONE_CODE
    return [
        (head(c, 1).isin("2", "6") & (n == 8), codes.DEVICE_WEB, zero, head(c, 4), tail(c, 4)),
        (web & (n == 14), codes.DEVICE_WEB, mid, code, sub),
        (
            android & (n == 17) & long_android,
            codes.DEVICE_ANDROID,
            F.substring(c, 7, 3),
            F.lit(codes.LONG_ANDROID_CODE),
            tail(c, 4),
        ),
        (android & (n == 15), codes.DEVICE_ANDROID, F.substring(c, 7, 3), code, sub),
        (iphone & (n == 14), codes.DEVICE_IPHONE, mid, code, sub),
        (iphone & (n == 16) & long_iphone, codes.DEVICE_IPHONE, mid, F.lit(codes.LONG_IPHONE_CODE), tail(c, 4)),
        (ipad & (n == 14), codes.DEVICE_IPAD, mid, code, sub),
    ]


def parse_channel(c: Column) -> Column:
    """Struct (channel_type, channel_version, channel_code, channel_subcode), all 0 for unknown layouts."""
    names = ("channel_type", "channel_version", "channel_code", "channel_subcode")
    fields = []
    for i, name in enumerate(names):
        expr = None
        for layout in _layouts(c):
            part = layout[1 + i]
            value = F.coalesce(to_number(part.cast("string")), F.lit(0)) if isinstance(part, Column) else F.lit(part)
            expr = F.when(layout[0], value) if expr is None else expr.when(layout[0], value)
        fields.append(expr.otherwise(F.lit(0)).alias(name))
    return F.struct(*fields)


def normalise_channel(c: Column) -> Column:
    """Cut a channel id to the length of its layout; ``'0'`` for unknown products."""
    return (
        F.when(c.startswith("s") & (F.substring(c, 11, 4) == codes.LONG_ANDROID_CODE), head(c, 17))
        .when(c.startswith("s"), head(c, 15))
        .when(head(c, 1).isin("2", "6"), head(c, 8))
        .when(head(c, 5).isin(codes.IPHONE, codes.IPAD, codes.WEB), head(c, 14))
        .otherwise(F.lit("0"))
    )


def standard_class(c: Column) -> Column:
    """1, 2, 3 for the standard android, iPhone and iPad channels, 4 for all others."""
    return (
        F.when(is_android(c) & (tail(c, 6) == codes.ANDROID_STANDARD_TAIL), 1)
        .when(c.startswith(codes.IPHONE) & (tail(c, 6) == codes.IOS_STANDARD_TAIL), 2)
        .when(c.startswith(codes.IPAD) & (tail(c, 6) == codes.IOS_STANDARD_TAIL), 3)
        .otherwise(4)
    )


def product_class(c: Column) -> Column:
    """1 android, 2 iPhone, 3 iPad, 4 anything else."""
    return F.when(is_android(c), 1).when(c.startswith(codes.IPHONE), 2).when(c.startswith(codes.IPAD), 3).otherwise(4)


def price_platform(c: Column) -> Column:
    """Platform number used by the price list: 1 web, 2 android, 3 iPhone, 4 other."""
    return F.when(c.startswith(codes.WEB), 1).when(is_android(c), 2).when(c.startswith(codes.IPHONE), 3).otherwise(4)


def device_mismatch(c: Column, device_type: Column) -> Column:
    """Channel and device disagree."""
    return (
        (is_android(c) & (device_type != codes.DEVICE_ANDROID))
        | (~is_android(c) & (device_type == codes.DEVICE_ANDROID))
        | (c.startswith(codes.IPHONE) & (device_type != codes.DEVICE_IPHONE))
        | (~c.startswith(codes.IPHONE) & (device_type == codes.DEVICE_IPHONE))
    )


def parent_code(c: Column) -> Column:
    """Four-character parent code."""
    return F.when(F.length(c) == 8, head(c, 4)).otherwise(head(tail(c, 6), 4))


def sub_code(c: Column) -> Column:
    """Child key: the whole short id, else its last six characters."""
    return F.when(F.length(c) == 8, c).otherwise(tail(c, 6))


def version_gate(c: Column, minimum: int = codes.MIN_QUALITY_VERSION) -> Column:
    """Android ids must carry at least ``minimum``; all others pass."""
    return implies(is_android(c), F.coalesce(to_number(from_end(c, 9, 3)) >= minimum, F.lit(False)))


def below_settled_version(c: Column, minimum: int = codes.MIN_SETTLED_VERSION) -> Column:
    """Android ids whose version is too old to be paid."""
    return is_android(c) & F.coalesce(to_number(F.substring(c, 7, 3)) < minimum, F.lit(False))


def platform_name(channel_type: Column) -> Column:
    expr = F.lit("")
    for number, name in codes.PLATFORM_NAMES.items():
        expr = F.when(channel_type == number, name).otherwise(expr)
    return expr
