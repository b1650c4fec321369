"""Daily product and revenue analytics for an online entertainment service, on PySpark."""

from nightledger.session import prepare

__all__ = ["prepare"]
