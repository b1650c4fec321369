"""Caller-supplied cohort filters, composed as one predicate."""

from __future__ import annotations

from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import Column
from pyspark.sql import functions as F

from nightledger.functions import codes
from nightledger.functions.channel import parent_code, sub_code
from nightledger.functions.text import tail

INCLUDE = 1
EXCLUDE = 2


@dataclass(frozen=True)
class CohortFilter:
    """Which online users a retention study covers.

    ``device``: 0 all, 1 web, 2 android, 3 iPhone, 4 iPad. ``statis_type``: 0 all, else the only
    partner type kept. ``parents`` and ``children`` are included or excluded by their mode.
    """

    device: int = 0
    statis_type: int = 0
    parents: tuple[str, ...] = field(default=())
    parent_mode: int = INCLUDE
    children: tuple[str, ...] = field(default=())
    child_mode: int = INCLUDE

    def predicate(self, channel: Column) -> Column:
        cond = ~tail(channel, 6).like(codes.EXCLUDED_CODE + "%")
        five = F.substring(channel, 1, 5)
        if self.device == codes.DEVICE_WEB:
            cond = cond & ~channel.startswith("s") & ~five.isin(codes.IPHONE, codes.IPAD)
        elif self.device == codes.DEVICE_ANDROID:
            cond = cond & channel.startswith("s")
        elif self.device == codes.DEVICE_IPHONE:
            cond = cond & (five == codes.IPHONE)
        elif self.device == codes.DEVICE_IPAD:
            cond = cond & (five == codes.IPAD)
        for key, values, mode in (
            (parent_code(channel), self.parents, self.parent_mode),
            (sub_code(channel), self.children, self.child_mode),
        ):
            if values:
                member = key.isin(*values)
                cond = cond & (member if mode == INCLUDE else ~member)
        return cond

    def columns(self) -> dict[str, Column]:
        """The filter as result columns, so that studies of one period under several filters stay apart."""
        return {
            "statis_type": F.lit(self.statis_type),
            "device_type": F.lit(self.device),
            "f_type": F.lit(self.parent_mode),
            "p_type": F.lit(self.child_mode),
            "f_cids": F.lit(",".join(self.parents)),
            "p_cids": F.lit(",".join(self.children)),
        }

    def key(self) -> str:
        """A folder name for the filter."""
        parts = (self.statis_type, self.device, self.parent_mode, self.child_mode, "+".join(self.parents), "+".join(self.children))
        return "_".join(quote(str(x), safe="+") for x in parts)
