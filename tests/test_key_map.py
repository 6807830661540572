"""Dense ids: gapless, stable, published whole."""

import pytest
from pyspark.sql import functions as F

from regstar.plans.key_map import KeyMap
from regstar.plans.store import Conflict
from regstar.session import shared_dir


def ids(frame):
    return dict(map(tuple, frame.collect()))


def test_ids_are_gapless_and_stay(spark):
    keys = KeyMap(spark, shared_dir(spark, "keys"), "string")
    assert ids(keys.frame()) == {}
    some = spark.range(500).select(F.concat(F.lit("k"), "id").alias("any"))
    first = ids(keys.extend(some.repartition(7).unionByName(some)))
    assert sorted(first.values()) == list(range(1, 501))
    more = spark.range(200, 900).select(F.concat(F.lit("k"), "id").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string"))
    second = ids(keys.extend(more.repartition(3)))
    assert sorted(second.values()) == list(range(1, 901)) and first.items() <= second.items()
    assert ids(keys.extend(some)) == second  # nothing new
    # Another session opens the same map.
    assert ids(KeyMap(spark, keys.files.root, "string").frame()) == second
    assert ids(keys.extend(more.limit(0))) == second


def test_two_writers(spark, monkeypatch):
    keys = KeyMap(spark, shared_dir(spark, "keys"), "long")
    stale = keys._last()
    keys.extend(spark.range(5))
    before = keys._last
    monkeypatch.setattr(keys, "_last", lambda: stale)
    with pytest.raises(Conflict):
        keys.extend(spark.range(9))
    monkeypatch.setattr(keys, "_last", before)
    assert len(keys.files.names("keys")) == 1 and sorted(ids(keys.frame()).values()) == [1, 2, 3, 4, 5]


def test_a_killed_numbering_leaves_the_map(spark, monkeypatch):
    keys = KeyMap(spark, shared_dir(spark, "keys"), "long")
    was = ids(keys.extend(spark.range(5)))

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(keys.files, "create", killed)
    with pytest.raises(KeyboardInterrupt):
        keys.extend(spark.range(9))
    monkeypatch.undo()
    assert ids(keys.frame()) == was
    now = ids(keys.extend(spark.range(9)))
    assert sorted(now.values()) == list(range(1, 10)) and was.items() <= now.items()
