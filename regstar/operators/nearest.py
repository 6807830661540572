"""Nearest known codes, by a deletion-neighbourhood index.

Two codes are at most d edits apart (insert, delete, replace one character) only
if some text can be reached from both by at most d deletions. So the known codes
are listed under each of these texts, the unknown ones too, and the two lists are
joined on equality: no code is compared with the whole dictionary. The true
distance of each pair found decides. Distance 1 is tried first; only codes that
found nothing go on to the next distance, whose lists are longer.

Under one text there are at most as many codes as characters can be put back
into it, so no group of the join grows with the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstar.operators.recode import union_all
from regstar.session import cut_lineage


def shortened(code: Column, deletions: int) -> Column:
    """Array of ``code`` and of all texts made by at most ``deletions`` deletions
    of one character, each once."""
    texts = F.array(code)
    for _ in range(deletions):
        fewer = F.transform(texts, _one_less)
        texts = F.array_distinct(F.concat(texts, F.flatten(fewer)))
    return texts


def _one_less(text: Column) -> Column:
    places = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))


def nearest_codes(
    codes: DataFrame, dictionary: DataFrame, *, code: str = "code", known: str = "known", max_distance: int = 2, max_length: int = 64
) -> DataFrame:
    """(code, known, distance): for each distinct code of ``codes`` every known
    code of ``dictionary`` that is nearest to it, at most ``max_distance`` edits
    away. Codes with no such known code have no row; neither have null codes and
    codes of more than ``max_length`` characters (the index of a code grows with
    a power of its length). A known code is its own nearest, at distance 0."""
    short = lambda c: F.col(c).isNotNull() & (F.length(c) <= max_length)
    left = codes.select(F.col(code).alias("code")).where(short("code")).distinct()
    words = dictionary.select(F.col(known).alias("known")).where(short("known")).distinct()
    left, words = cut_lineage(left), cut_lineage(words)
    same = left.join(words, F.col("code") == F.col("known"), "left_semi")
    found = [same.select("code", F.col("code").alias("known"), F.lit(0).alias("distance"))]
    left = left.join(words, F.col("code") == F.col("known"), "left_anti")
    for d in range(1, max_distance + 1):
        at = lambda df, c: df.select(c, F.explode(shortened(F.col(c), d)).alias("text"))
        pairs = at(left, "code").join(at(words, "known"), "text").select("code", "known").distinct()
        pairs = pairs.where(F.levenshtein("code", "known") == d).withColumn("distance", F.lit(d))
        found.append(cut_lineage(pairs))
        left = left.join(found[-1], "code", "left_anti")
    return union_all(found)


def proposals(counted: DataFrame, dictionary: DataFrame, *, code: str, known: str, **options) -> DataFrame:
    """``counted`` (codes with whatever columns) with the ``proposal`` for each
    code, the first of its nearest known codes, how many ``nearest`` there are,
    and their ``distance``; nulls and zero where there is none."""
    counted = cut_lineage(counted)
    near = nearest_codes(counted, dictionary, code=code, known=known, **options)
    best = near.groupBy("code", "distance").agg(F.min("known").alias("proposal"), F.count("*").alias("nearest"))
    best = best.withColumnRenamed("code", "__code")
    out = counted.join(best, F.col(code) == F.col("__code"), "left").drop("__code")
    return out.withColumn("nearest", F.coalesce("nearest", F.lit(0)))
