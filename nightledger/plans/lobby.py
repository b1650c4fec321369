"""Devices that stay in the lobby: consecutive notice requests at a steady pace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightledger.functions import codes
from nightledger.operators.windows import first_row, following, keep_first

KEYS = ["dt", "idfa"]


def notice_requests(requests: DataFrame) -> DataFrame:
    """One iOS notice request per day, network address and second."""
    rows = requests.filter(
        (F.col("action") == codes.ACTION_NOTICE)
        & F.col("terminal").isin(codes.DEVICE_IPHONE, codes.DEVICE_IPAD)
    )
    return keep_first(rows, ["dt", "macaddr", "dateline"], ["id"])


def in_band(gap: Column, low: int, high: int) -> Column:
    return F.coalesce(gap.between(low, high), F.lit(False))


def steady_requests(requests: DataFrame, low: int = 90, high: int = 100) -> DataFrame:
    """Requests whose next two gaps both fall in the band, with ``gap`` and ``next_gap``.

    The requests of a day are one sequence by address and time. A gap counts between neighbours of one device (``idfa``),
    so another device on the address breaks the pace, and a device is steady on one address whatever it sends from
    others. Requests without a device are steady with nothing.
    """
    found = following(requests, ["dt"], ["macaddr", "dateline"], ["idfa", "dateline"])
    same = (F.col("next_1.idfa") == F.col("idfa")) & (F.col("next_2.idfa") == F.col("idfa"))
    gap = F.col("next_1.dateline") - F.col("dateline")
    next_gap = F.col("next_2.dateline") - F.col("next_1.dateline")
    steady = found.filter(same & in_band(gap, low, high) & in_band(next_gap, low, high))
    return steady.select(*requests.columns, gap.alias("gap"), next_gap.alias("next_gap"))


def lobby_stay(requests: DataFrame, hosts: DataFrame, low: int = 90, high: int = 100) -> DataFrame:
    """One row per day and device with at least two steady gaps in a row; hosts are labelled."""
    first = (
        steady_requests(notice_requests(requests), low, high)
        .groupBy(*KEYS)
        .agg(first_row(["uid", "channelid", "terminal"], ["dateline", "id"]).alias("_r"))
        .select("dt", "idfa", "_r.uid", "_r.channelid", "_r.terminal")
    )
    host = hosts.select("uid", F.lit(codes.LABEL_HOST).alias("special")).distinct()
    return first.join(host, "uid", "left").select(
        "dt", "idfa", "uid", "channelid", "terminal", F.coalesce("special", F.lit(0)).alias("special")
    )
