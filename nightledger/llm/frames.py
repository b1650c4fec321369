"""What the operators of this package share on the Spark side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from nightledger.session import cut_lineage, prepare, shared_folder

BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20


def ready(spark: SparkSession) -> SparkSession:
    """Session options for Arrow functions over texts: a batch is bounded in rows and bytes."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


class Carried:
    """A frame whose columns travel through an operator under names that clash with nothing.

    ``work`` has the columns asked for by their own names, and a struct ``row`` with all others under positional
    names, whatever they are called: names with dots, blanks or hyphens, names that differ in case only, and names
    that the operator gives to its own columns; those in ``without``, in any case, are left out. ``back`` puts the columns back in their order and under their names.
    """

    def __init__(self, docs: DataFrame, *own: str, without: tuple[str, ...] = ()):
        plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
        kept = [i for i, n in enumerate(docs.columns) if n.lower() not in without]
        self.names = [docs.columns[i] for i in kept]
        plain = plain.select(*[F.col(f"c{i}").alias(f"c{j}") for j, i in enumerate(kept)])
        self._own = {}
        for name in own:
            same = [i for i, c in enumerate(self.names) if c == name]
            same = same or [i for i, c in enumerate(self.names) if c.lower() == name]
            if not same:
                raise ValueError(f"no column {name} among {self.names}")
            self._own[same[0]] = name
        rest = [f"c{i}" for i in range(len(self.names)) if i not in self._own] or [F.lit(0).alias("none")]
        self.work = plain.select(F.struct(*rest).alias("row"), *[F.col(f"c{i}").alias(n) for i, n in self._own.items()])

    def schema(self, *more: StructField) -> StructType:
        """Schema of ``work`` and more fields."""
        return StructType([*self.work.schema, *more])

    def back(self, df: DataFrame, extra: dict[str, Column] | None = None, **changed: Column) -> DataFrame:
        """The columns of the frame from ``df``, own ones changed as given, and ``extra`` ones after them.

        A column of the frame that has the name of an extra one, in any case, gives way to it.
        """
        extra = extra or {}
        shadowed = {n.lower() for n in extra}
        kept = [i for i, n in enumerate(self.names) if n.lower() not in shadowed]
        out = []
        for i in kept:
            name = self._own.get(i)
            out.append(F.col("row")[f"c{i}"] if name is None else changed.get(name, F.col(name)))
        columns = [c.alias(f"c{i}") for i, c in enumerate([*out, *extra.values()])]
        return df.select(*columns).toDF(*[self.names[i] for i in kept], *extra)


__all__ = ["Carried", "cut_lineage", "ready", "shared_folder", "table"]
