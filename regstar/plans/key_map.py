"""Dense surrogate ids: a lasting map from keys to 1, 2, 3, ... without gaps.

A star's hash keys need no map but are 16 bytes long. Where a consumer wants
small integers, a :class:`KeyMap` gives each key the next free number, once:
:meth:`KeyMap.extend` numbers only the keys that are not in the map yet, so ids
stay as they are however often the star is rebuilt. Numbering is distributed:
each task numbers its own keys, and the tasks' totals (one number for each task)
shift them. A version of the map is published whole, as in
:mod:`regstar.plans.store`; of two writers one is told that the other was first.
"""

from __future__ import annotations

import itertools
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from regstar.plans.store import Conflict
from regstar.shared_files import SharedFiles

_POSITION = (1 << 33) - 1  # the part of monotonically_increasing_id that counts a partition's rows


class KeyMap:
    """The map below ``root``; ``key_type`` is the keys' type as DDL."""

    def __init__(self, spark: SparkSession, root: str, key_type: str = "binary"):
        self.spark, self.files = spark, SharedFiles(spark, root)
        self.schema = StructType([*spark.createDataFrame([], f"key {key_type}").schema, StructField("id", LongType())])

    def _last(self) -> dict:
        names = [n for n in self.files.names("maps") if n.endswith(".json") and not n.startswith(".")]
        return json.loads(self.files.read("maps", max(names))) if names else {"version": 0, "folders": [], "ids": 0}

    def frame(self) -> DataFrame:
        """(key, id) of all keys that have an id."""
        folders = [self.files.path("keys", f) for f in self._last()["folders"]]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)

    def extend(self, keys: DataFrame) -> DataFrame:
        """Give an id to every key of ``keys`` (its one column) that has none;
        :meth:`frame` with them. Null is no key."""
        last, folder = self._last(), uuid.uuid4().hex
        column = F.col(f"`{keys.columns[0]}`").cast(self.schema["key"].dataType).alias("key")
        new = keys.select(column).where("key IS NOT NULL").distinct()
        if last["folders"]:
            new = new.join(self.frame(), "key", "left_anti")
        # Written before they are numbered, so that a lost task can't deal them out differently.
        at = F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION))
        draft = self.files.path("keys", f".{folder}")
        new.select("key", F.spark_partition_id().alias("part"), at.alias("at")).write.parquet(draft)
        placed = self.spark.read.schema(StructType([self.schema["key"]]).add("part", IntegerType()).add("at", LongType())).parquet(draft)
        sizes = sorted(tuple(r) for r in placed.groupBy("part").agg(F.count("*"), F.min("at")).collect())  # one for each task
        if sizes:
            ends = list(itertools.accumulate((n for _, n, _ in sizes), initial=last["ids"]))
            shift = [(part, before + 1 - first) for (part, _, first), before in zip(sizes, ends)]
            shifts = F.broadcast(self.spark.createDataFrame(shift, "part int, shift long"))
            numbered = placed.join(shifts, "part").select("key", (F.col("at") + F.col("shift")).alias("id"))
            numbered.write.parquet(self.files.path("keys", folder))
            version = last["version"] + 1
            now = {"version": version, "folders": [*last["folders"], folder], "ids": ends[-1]}
            if not self.files.create(json.dumps(now), "maps", f"{version:012d}.json"):
                self.files.remove("keys", f".{folder}")
                self.files.remove("keys", folder)
                raise Conflict(f"version {version} of the key map was published by another writer")
        self.files.remove("keys", f".{folder}")
        return self.frame()
