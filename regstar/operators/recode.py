"""Code recoding and source unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstar.operators.lookup import bounded_broadcast

def recode(
    df: DataFrame,
    dictionary: DataFrame,
    *,
    code: str,
    from_col: str = "from",
    to_col: str = "to",
    out: str = "recoded",
) -> DataFrame:
    """Replace ``code`` by its dictionary value; rows with unknown codes drop.

    Matching is exact (case sensitive). The dictionary is broadcast only
    after its size is proven (see ``bounded_broadcast``).
    ``quality.unmapped_codes`` reports what the inner join drops.
    """
    d = dictionary.select(F.col(from_col).alias("__from"), F.col(to_col).alias(out))
    d = bounded_broadcast(d)
    return df.join(d, F.col(code) == F.col("__from"), "inner").drop("__from")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate same-shaped frames by column name, duplicates kept."""
    if not frames:
        raise ValueError("union_all needs at least one frame")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate and drop exact duplicate rows (one shuffle, with a partial
    de-duplication in each task first)."""
    return union_all(frames).distinct()


def latest_source(frames: Sequence[DataFrame], key: Column) -> DataFrame:
    """Distinct rows of all frames, but for each ``key`` only those of the
    last frame that has it (a later file replaces what earlier ones say)."""
    tagged = [f.withColumns({"__at": F.lit(i), "__key": key}) for i, f in enumerate(frames)]
    rows = union_distinct(tagged)
    last = rows.groupBy("__key").agg(F.max("__at").alias("__last"))
    same = rows["__key"].eqNullSafe(last["__key"]) & (rows["__at"] == F.col("__last"))
    return rows.join(last, same, "left_semi").drop("__at", "__key")
