"""The lasting star: whole versions, pins, change sets, collection."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from regstar.functions.keys import KEY_WHITESPACE
from regstar.plans import catalogue as C
from regstar.plans import questions as Q
from regstar.plans.star import build_star
from regstar.plans.store import BUCKETED_TABLES, Changes, Conflict, NoVersion, StarStore
from regstar.session import shared_dir
from regstar.sources import Sources, driver_sources
from regstar.sources.driver_changes import history
from regstar.sources.schemas import CLAIM, RESPONSE_COLUMNS
from tests.conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def built(spark):
    """A store with the sources as they stood at first, and the change sets."""
    store = StarStore(spark, shared_dir(spark, "store"), buckets=8)
    first, changes = history(spark, SF_SMALL)
    store.build(first, note="first")
    return store, first, changes


def facts(star):
    return rows(C.reimbursements(star)), rows(C.registrations(star))


def folders(manifest, name="claim"):
    return {b: part["folder"] for part in manifest["tables"][name] for b in part["buckets"]}


def test_version_equals_the_unwritten_star(spark, built):
    store, first, _ = built
    assert facts(store.star(store.manifest(1))) == facts(build_star(spark, first))


def test_changes_equal_a_rebuild(spark, built):
    store, _, changes = built
    before = facts(store.star())
    for change in changes:
        store.apply(Changes(**change))
    want = facts(build_star(spark, driver_sources(spark, SF_SMALL)))
    assert facts(store.star()) == want != before
    assert store.manifest()["parent"] == store.manifest()["version"] - 1
    # The versions before are as they were.
    assert facts(store.star(store.manifest(1))) == before


def test_a_change_rewrites_its_buckets_only(spark, built):
    store, _, _ = built
    base = store.manifest()
    star = store.star(base)
    number = store.table(base, "claim", [3]).where("claimtype = 'REFUND' AND drugprice LIKE '%CHF'").first()["claimnumber"]
    names = store.table(base, "claim").drop("bucket").columns
    row = store.table(base, "claim").where(F.col("claimnumber") == number).limit(1).select(*names)
    changed = row.withColumn("drugprice", F.lit("7 CHF")).withColumn("claimnumber", F.concat(F.lit("\t"), F.lower(F.trim("claimnumber"))))
    new = store.apply(Changes(claims=changed), note="one claim")
    was, now = folders(base), folders(new)
    assert {b for b in was if was[b] != now[b]} == {3}
    for name in BUCKETED_TABLES:
        written = store.spark.read.parquet(store.files.path("data", now[3], name))
        assert {r[0] for r in written.select("bucket").distinct().collect()} <= {3}
    key = number.strip().upper()
    there = store.star(new).reimbursement(with_attributes=True)
    assert {r.drug_price for r in there.where(F.col("claimnumber") == key).collect()} == {7}
    other = F.col("claimnumber") != key
    assert rows(there.where(other)) == rows(star.reimbursement(with_attributes=True).where(other))


def test_empty_changes_null_numbers_and_unknown_withdrawals(spark, built):
    store, _, _ = built
    base = store.manifest()
    assert store.apply(Changes()) == base
    schema = store.table(base, "claim").drop("bucket").schema
    nothing = spark.createDataFrame([], schema)
    gone = spark.createDataFrame([("no such claim",), (None,)], "claimnumber string")
    before = facts(store.star(base))
    assert facts(store.star(store.apply(Changes(claims=nothing, withdrawn_claims=gone)))) == before
    nameless = store.table(base, "claim").where("claimtype = 'REFUND' AND drugprice LIKE '%CHF'").limit(1).drop("bucket")
    nameless = nameless.withColumn("claimnumber", F.lit(None).cast("string"))
    for n in (1, 2):  # added each time: nothing names them
        m = store.apply(Changes(claims=nameless))
        assert store.star(m).reimbursement().where("claimnumber IS NULL").count() == n


def test_many_changes_keep_few_folders(spark):
    store = StarStore(spark, shared_dir(spark, "store"), buckets=4, max_parts=3)
    _, changes = history(spark, SF_SMALL)
    now = driver_sources(spark, SF_SMALL)
    store.build(now)
    one = spark.createDataFrame([("CL-1-1",)], "n string")
    for _ in range(4):
        manifest = store.apply(Changes(withdrawn_claims=one))
        assert all(len(parts) <= 3 for parts in manifest["tables"].values())
    want = C.reimbursements(build_star(spark, now)).where("claimnumber <> 'CL-1-1'")
    assert rows(C.reimbursements(store.star())) == rows(want)


class Killed(Exception):
    pass


def test_a_killed_build_leaves_the_old_version(spark, built):
    store, first, _ = built
    before, version = facts(store.star()), store.manifest()["version"]

    class Dying(StarStore):
        def _write_rows(self, rows, folder, name, key, buckets):
            if name == "response_row":
                raise Killed  # dimensions and claims are written
            return super()._write_rows(rows, folder, name, key, buckets)

    dying = Dying(spark, store.files.root, buckets=8)
    with pytest.raises(Killed):
        dying.build(first)
    with pytest.raises(Killed):
        dying.apply(Changes(withdrawn_responses=spark.createDataFrame([("CL-1-1",)], "n string")))
    assert store.manifest()["version"] == version and facts(store.star()) == before
    held = set(store.files.names("data"))
    store.collect(keep=100, grace_seconds=3600)
    assert set(store.files.names("data")) == held  # the build may still run
    store.collect(keep=100, grace_seconds=-1)
    assert len(store.files.names("data")) < len(held) and facts(store.star()) == before


def test_two_writers_of_one_number(spark, built):
    store, _, _ = built
    stale = store.manifest()
    store._publish(stale | {"version": stale["version"] + 1})
    with pytest.raises(Conflict):
        store._publish(stale | {"version": stale["version"] + 1})


def test_collect_keeps_pinned_versions(spark, built):
    store, _, _ = built
    version = store.versions()[0]
    manifest, pin = store.pin(version)
    before = rows(store.star(manifest).reimbursement())
    dropped = store.collect(grace_seconds=-1)
    assert version not in dropped and store.versions() == [version, max(store.versions())]
    assert rows(store.star(manifest).reimbursement()) == before
    store.release(pin)
    _, over = store.pin(version, seconds=-1)  # its time is over
    assert store.collect(grace_seconds=-1) == [version] and len(store.versions()) == 1
    with pytest.raises(NoVersion):
        store.manifest(version)
    assert store.star().reimbursement().count() > 0


def test_a_pin_between_two_looks_of_the_collector(spark, built):
    store, _, _ = built
    old = store.manifest()
    store._publish(old | {"version": old["version"] + 1})
    looks = [set(), {old["version"]}, {old["version"]}]
    store._pinned = lambda: looks.pop(0)
    try:
        assert store.collect(grace_seconds=-1) == []
    finally:
        del store._pinned
    assert old["version"] in store.versions() and store.star(old).reimbursement().count() > 0


def test_questions_on_an_empty_store(spark):
    store = StarStore(spark, shared_dir(spark, "store"), buckets=2)
    with pytest.raises(NoVersion):
        store.star()
    now = driver_sources(spark, SF_SMALL)
    given = {name: getattr(now, name) for name in Sources.NAMES}
    empty = Sources(**given | {"claim": now.claim.limit(0), "responses": [r.limit(0) for r in now.responses]})
    store.build(empty)
    assert rows(Q.q1_claims_per_year(store.star())) == []
    assert rows(Q.q2a_on_time_share(store.star())) == [(0, 0, None)]


def test_a_change_set_is_computed_once(spark, built):
    store, _, _ = built
    base = store.manifest()
    claim = store.table(base, "claim").drop("bucket").limit(1)
    row, read = claim.first(), spark.sparkContext.accumulator(0)

    def seen(r):
        read.add(1)
        return r

    counted = spark.sparkContext.parallelize([tuple(row)], 1).map(seen)
    store.apply(Changes(claims=spark.createDataFrame(counted, claim.schema)))
    assert read.value == 1


def test_facts_are_dealt_out_narrow_and_without_a_second_distinct(spark):
    plans = {}

    class Looked(StarStore):
        def _write_buckets(self, rows, key, buckets, folder, name, *order, **how):
            plans[name] = rows._jdf.queryExecution().optimizedPlan().toString().replace(KEY_WHITESPACE, "").splitlines()
            return super()._write_buckets(rows, key, buckets, folder, name, *order, **how)

    Looked(spark, shared_dir(spark, "store"), buckets=4).build(driver_sources(spark, SF_SMALL))
    depth = lambda lines, key: min(len(x) - len(x.lstrip(" :+-")) for x in lines if key in x)
    for name in ("registration_claim", "reimbursement_claim"):
        lines = plans[name]
        assert not any("Aggregate" in x for x in lines)  # stored response rows are distinct
        assert depth(lines, "= __country_key") < depth(lines, "Rebalance") < depth(lines, "= __response_key")


def test_a_change_set_writes_the_rows_of_its_claim_numbers_only(spark):
    store = StarStore(spark, shared_dir(spark, "store"), buckets=4)
    base = store.build(driver_sources(spark, SF_SMALL))
    reimbursed = store.table(base, "reimbursement_claim")
    answered = store.table(base, "response_row").withColumnRenamed("claim_number", "number").drop("bucket")
    found = reimbursed.where("response = 'Approved'").groupBy("claimnumber").count().where("count = 1")
    number = found.join(answered, found["claimnumber"] == answered["number"], "left_semi").first()["claimnumber"]
    row = answered.where(F.col("number") == number).withColumn("response_date", F.lit("2001-02-03"))
    new = store.apply(Changes(responses=row))
    folder = folders(new)[new["tables"]["claim"][-1]["buckets"][0]]
    for name, key in (("claim", "claimnumber"), ("response_row", "claim_number"), ("reimbursement_claim", "claimnumber")):
        written = rows(store.spark.read.parquet(store.files.path("data", folder, name)).select(F.upper(F.trim(key))))
        assert written == [(number,)]  # not the other rows of its bucket
    before, now = (rows(C.reimbursements(store.star(m))) for m in (base, new))
    assert len(now) == len(before) and sum(x != y for x, y in zip(before, now, strict=True)) == 1


def test_overlapping_changes_equal_a_rebuild(spark):
    """Change sets that name the same claim numbers again, in one table or both,
    in other spellings, with rows that repeat and rows without a number, in
    folders on top of each other and (by ``max_parts``) rewritten ones."""
    dims = driver_sources(spark, SF_SMALL)
    given = {n: (lambda n=n: getattr(dims, n)) for n in Sources.NAMES if n not in ("claim", "responses")}
    schema = StructType([StructField(f.name, f.dataType) for f in CLAIM])
    answer = StructType([StructField(c, StringType()) for c in RESPONSE_COLUMNS])
    day = date(1997, 5, 6)

    def claim(number, kind="REFUND", price="5 CHF", country="NB"):
        return ("RO1", None, country, day, day, number, "PRD1", "IND-BUILDING", kind, "F101", "F111", "F112", price, 7)

    def claims_of(some):
        return spark.createDataFrame(some, schema)

    def answers_of(some):
        return spark.createDataFrame(some, answer)

    clean = lambda n: None if n is None else n.strip().upper()
    claims = [claim("A-1"), claim("A-1"), claim(" b-2\t", "REGISTER", "null"), claim("C-3"), claim(None), claim("D-4", "REGISTER")]
    answers = [("A-1", "1998-01-01", "F"), ("A-1", "1998-01-02", "O"), ("b-2", "1998-01-01", "F"), ("E-5", "1998-01-01", "F"), (None, "x", "F")]
    store = StarStore(spark, shared_dir(spark, "store"), buckets=2, max_parts=3)
    store.build(Sources(claim=claims_of(claims), responses=[answers_of(answers)], **given))
    steps = [
        # (claims, withdrawn claims, answers, withdrawn answers)
        ([claim("a-1 ", price="8 CHF"), claim("E-5"), claim("E-5")], [], [("C-3", "1999-09-09", "O"), ("C-3", "1999-09-09", "O")], []),
        ([claim("A-1", "OTHER"), claim(None, "REGISTER")], ["c-3", None], [("A-1", "unknown", "F")], ["E-5"]),
        ([], ["E-5"], [("E-5", "2000-01-01", "F"), ("F-6", "2000-01-01", "P")], ["b-2", "no such"]),
        ([claim("B-2", "REGISTER"), claim("B-2"), claim("F-6", country="XX")], [], [], ["A-1"]),
        ([claim("A-1"), claim("C-3", price=None)], ["F-6"], [("d-4", "1999-01-01", "O")], []),
    ]
    parts = []
    for new, gone, said, unsaid in steps:
        numbers = lambda some: spark.createDataFrame([(x,) for x in some], "n string") if some else None
        manifest = store.apply(
            Changes(
                claims=claims_of(new) if new else None, withdrawn_claims=numbers(gone),
                responses=answers_of(said) if said else None, withdrawn_responses=numbers(unsaid),
            )
        )
        named = {clean(c[5]) for c in new} | {clean(x) for x in gone}
        claims = [c for c in claims if c[5] is None or clean(c[5]) not in named] + [c for c in new if c[8] != "OTHER"]
        named = {clean(a[0]) for a in said} | {clean(x) for x in unsaid}
        answers = [a for a in answers if a[0] is None or clean(a[0]) not in named] + list(dict.fromkeys(said))
        want = build_star(spark, Sources(claim=claims_of(claims), responses=[answers_of(answers)], **given))
        assert facts(store.star()) == facts(want)
        assert rows(store.table(manifest, "claim").drop("bucket")) == sorted(claims, key=repr)
        assert rows(store.table(manifest, "response_row").drop("bucket")) == sorted(answers, key=repr)
        for bucket in range(2):
            assert rows(store.table(manifest, "claim", [bucket])) == rows(store.table(manifest, "claim").where(F.col("bucket") == bucket))
        parts.append(len(manifest["tables"]["claim"]))
    assert max(parts) == 3 and min(parts[2:]) < 3
