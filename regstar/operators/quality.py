"""Data-quality checks derived from the source database's declared keys.

Each check is a Spark job that returns the offending keys with their row
counts (grouped, so a hot key is one output row and is pre-aggregated in each
task before the shuffle). An empty result means the constraint holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstar.operators.lookup import bounded_broadcast


def duplicate_keys(df: DataFrame, keys: Sequence[Column | str], *, n: str = "n_rows") -> DataFrame:
    """Keys held by more than one row, and keys that are null (primary key:
    unique and not null). Null keys are reported as one group."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias(n))
    any_null = None
    for c in counted.columns[: len(cols)]:
        cond = F.col(c).isNull()
        any_null = cond if any_null is None else (any_null | cond)
    return counted.where((F.col(n) > 1) | any_null)


def orphans(
    child: DataFrame,
    parent: DataFrame,
    *,
    child_key: Column,
    parent_key: Column,
    key_name: str,
    n: str = "n_rows",
) -> DataFrame:
    """Foreign-key check: child keys with no parent row (null keys allowed).

    The child is first reduced to distinct keys with counts, so the anti join
    moves one row per key however many child rows share it.
    """
    per_key = (
        child.select(child_key.alias(key_name))
        .where(F.col(key_name).isNotNull())
        .groupBy(key_name)
        .agg(F.count(F.lit(1)).alias(n))
    )
    p = parent.select(parent_key.alias("__pk")).where(F.col("__pk").isNotNull())
    return per_key.join(p, F.col(key_name) == F.col("__pk"), "left_anti")


def orphans_by_key(
    child: DataFrame,
    checks: Sequence[tuple[str, Column, DataFrame, Column]],
    *,
    check_name: str = "foreign_key",
    key_name: str = "key",
    n: str = "n_rows",
) -> DataFrame:
    """Several foreign keys of one child checked in one pass over the child.

    ``checks`` holds ``(name, child_key, parent, parent_key)``; keys are
    compared as strings. Each child row emits one ``(name, key)`` pair per
    check, the pairs are counted (partial aggregation before the shuffle),
    and one anti join against the tagged parent keys leaves the orphans. The
    child, however expensive, is evaluated once.
    """
    pairs = F.array(
        *[F.struct(F.lit(name).alias("c"), key.cast("string").alias("k")) for name, key, _, _ in checks]
    )
    per_key = (
        child.select(F.explode(pairs).alias("p"))
        .select(F.col("p.c").alias(check_name), F.col("p.k").alias(key_name))
        .where(F.col(key_name).isNotNull())
        .groupBy(check_name, key_name)
        .agg(F.count(F.lit(1)).alias(n))
    )
    parents = None
    for name, _, parent, parent_key in checks:
        keys = parent.select(F.lit(name).alias("__c"), parent_key.cast("string").alias("__pk"))
        parents = keys if parents is None else parents.unionByName(keys)
    parents = parents.where(F.col("__pk").isNotNull())
    cond = (F.col(check_name) == F.col("__c")) & (F.col(key_name) == F.col("__pk"))
    return per_key.join(parents, cond, "left_anti")


def unmapped_codes(
    df: DataFrame,
    dictionary: DataFrame,
    *,
    code: str,
    from_col: str = "from",
    n: str = "n_rows",
) -> DataFrame:
    """Codes a recoding dictionary does not know (rows an inner recode drops).

    Null codes are reported too: they match no dictionary entry either.
    """
    per_code = df.groupBy(F.col(code)).agg(F.count(F.lit(1)).alias(n))
    d = bounded_broadcast(dictionary.select(F.col(from_col).alias("__from")))
    return per_code.join(d, F.col(code).eqNullSafe(F.col("__from")), "left_anti")
