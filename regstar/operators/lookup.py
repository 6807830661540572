"""Dimension lookups: left joins from a fact to a dimension by business key.

SQL multiset semantics are kept: a key held by k dimension rows gives k fact
rows (a non-unique dimension key fans out, as in the modelled program).
``regstar.operators.quality.duplicate_keys`` reports such keys beforehand.

Physical strategy is left to the planner: a dimension whose size is known to
be small is hinted as broadcast only after :func:`bounded_broadcast` proved its
row count; everything else is planned from statistics, and AQE re-plans from
the runtime size of the shuffled dimension (broadcast if it turns out small,
sort-merge otherwise, with skewed fact partitions split).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstar.session import cut_lineage


def bounded_broadcast(
    df: DataFrame, max_rows: int = 100_000, max_bytes: int = 16 << 20, *, written: bool = False
) -> DataFrame:
    """``df``, with a broadcast hint only if it provably holds at most
    ``max_rows`` rows and ``max_bytes`` bytes (as JSON text).

    The list is computed once and written to the shared folder; the proof (one
    job over the written list, which stops past ``max_rows``) and every later
    use read it from there. Beyond a bound the frame has no hint and the
    planner chooses (shuffle join). For code lists and small dimensions; with
    ``written``, ``df`` is a table as it is and not written again.
    """
    table = df if written else cut_lineage(df)
    size = F.octet_length(F.to_json(F.struct(*table.columns)))
    held = table.limit(max_rows + 1).agg(F.count("*").alias("n"), F.sum(size).alias("b")).first()
    return F.broadcast(table) if held["n"] <= max_rows and (held["b"] or 0) <= max_bytes else table


def repeats(
    dims: Mapping[str, tuple[DataFrame, Column]], max_rows: int = 100_000, max_bytes: int = 16 << 20
) -> dict[str, DataFrame]:
    """For each named dimension and its key: the keys that more than one of its
    rows hold, as (``__<name>_key``, ``__<name>_n``), which is what a lookup
    multiplies a fact row by. Such keys are exceptions. All lists are computed
    and written in one job and measured in a second one; those within the bounds
    are hinted as broadcast, the others are left to the planner."""
    lists = None
    for name, (dim, key) in dims.items():
        counted = dim.select(key.cast("string").alias("key")).where(F.col("key").isNotNull()).groupBy("key").agg(F.count("*").alias("n"))
        part = counted.where(F.col("n") > 1).select(F.lit(name).alias("of"), "key", "n")
        lists = part if lists is None else lists.unionByName(part)
    table = cut_lineage(lists)
    sizes = table.groupBy("of").agg(F.count("*").alias("n"), F.sum(F.octet_length("key") + 8).alias("b")).collect()
    large = {r["of"] for r in sizes if r["n"] > max_rows or r["b"] > max_bytes}
    found = {}
    for name in dims:
        rows = table.where(F.col("of") == name).select(F.col("key").alias(f"__{name}_key"), F.col("n").alias(f"__{name}_n"))
        found[name] = rows if name in large else F.broadcast(rows)
    return found


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    *,
    fact_key: Column | str,
    dim_key: Column | str,
    carry: Mapping[str, str],
    how: str = "left",
    name: str = "lk",
) -> DataFrame:
    """Join ``dim`` to ``fact`` where ``dim_key == fact_key``.

    ``carry`` maps dimension columns to the names they get in the result; only
    those columns (and the key) leave the dimension, so the join moves as few
    bytes as possible. ``fact_key`` names a column of the fact or is an
    expression over them (for example a cleaned key), which is evaluated once,
    before the exchange: a sort-merge join would evaluate it again for each
    comparison of its sort.
    """
    key = f"__{name}_key"
    dkey = F.col(dim_key) if isinstance(dim_key, str) else dim_key
    d = dim.select(dkey.alias(key), *[F.col(src).alias(dst) for src, dst in carry.items()])
    if isinstance(fact_key, str):
        return fact.join(d, fact[fact_key] == d[key], how).drop(key)
    of = f"__{name}_of"
    fact = fact.withColumn(of, fact_key)
    return fact.join(d, fact[of] == d[key], how).drop(key, of)


def role_lookup(
    fact: DataFrame,
    dim: DataFrame,
    *,
    roles: Mapping[str, Column],
    dim_key: Column | str,
    carry: Mapping[str, str],
) -> DataFrame:
    """Role-playing dimension: one lookup per role into the same dimension.

    ``roles`` maps a role name to the fact expression holding its key;
    ``carry`` values are templates with ``{role}`` (e.g. ``'factory_{role}_id'``).
    """
    for role, key in roles.items():
        fact = lookup(
            fact,
            dim,
            fact_key=key,
            dim_key=dim_key,
            carry={src: dst.format(role=role) for src, dst in carry.items()},
            name=role,
        )
    return fact
