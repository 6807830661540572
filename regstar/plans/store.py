"""A lasting star: versions that are published whole, read pinned, and kept up
to date by change sets.

The store is a folder that sessions share::

    data/<id>/<table>/...       written once, by one build or one change set
    manifests/<number>.json     a version: which folders its tables consist of
    pins/<number>.<id>.json     a reader of a version, until a time

A build or a change set writes its tables into a fresh folder and then publishes
one manifest, which is written whole or not at all. So a build that is
killed leaves nothing that a reader can see, and a reader, which opens the
tables that one manifest names, never sees half of a version. Of two writers
that publish the same number, one is told so (:class:`Conflict`).

Claims, responses and both facts are partitioned by ``bucket``, the hash of the
claim number modulo the number of buckets: a fact row depends on rows of its own
claim number alone (and on the small dimensions and the products). A change set
therefore writes all rows, in all four tables, of the claim numbers it names, and
the list of these numbers (``named``), into a folder that the new manifest puts on
top of the others: of a claim number the rows of the last folder that names it
count. So the work follows the change set and not the buckets it falls into.
Reading leaves out what later folders replaced, by one join in the buckets that
several folders have; the other buckets are read as they are. Once a table
consists of ``max_parts`` folders, the next change set rewrites its buckets and
those that earlier ones wrote, so the number of folders stays bounded. Old versions
are removed by :meth:`StarStore.collect`, unless they are pinned.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regstar.functions import clean_bk
from regstar.operators import bounded_broadcast, union_all
from regstar.plans import dims as D
from regstar.plans.facts import REFUND, REGISTER, registration_fact, reimbursement_fact
from regstar.plans.star import SMALL_DIMENSIONS, Star
from regstar.shared_files import SharedFiles
from regstar.sources import Sources
from regstar.sources.schemas import CLAIM, RESPONSE_COLUMNS

BUCKET = "bucket"
WHOLE_TABLES = ("country", "factory", "indication", "product", "calendar", "dictionary")
BUCKETED_TABLES = ("claim", "response_row", "registration_claim", "reimbursement_claim")
# The columns that have the claim number in the tables a change set names rows of.
NUMBERS = {"claim": "claimnumber", "response_row": "claim_number"}
# The claim numbers whose rows a change set's folder has, cleaned, and which of these tables it names them in.
NAMED = "named"


class Conflict(RuntimeError):
    """Another writer published the version number first."""


class NoVersion(LookupError):
    """The store has no such version."""


@dataclass
class Changes:
    """A change set, by (cleaned) claim number. ``claims`` (source shape) and
    ``responses`` (rows of a response file) replace all rows of the claim
    numbers they name, or add them; the claim numbers of ``withdrawn_claims``
    and ``withdrawn_responses`` (one column) lose their rows. A claim without a
    number can't be named: such rows are only added. Absent parts change nothing."""

    claims: DataFrame | None = None
    withdrawn_claims: DataFrame | None = None
    responses: DataFrame | None = None
    withdrawn_responses: DataFrame | None = None


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)


class StarStore:
    """Versions of a star below ``root``, a folder that all sessions share."""

    def __init__(self, spark: SparkSession, root: str, *, buckets: int = 64, max_parts: int = 8):
        self.spark, self.files = spark, SharedFiles(spark, root)
        self.buckets, self.max_parts = buckets, max_parts

    # ------------------------------------------------------------- versions

    def versions(self) -> list[int]:
        names = self.files.names("manifests")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, version: int | None = None) -> dict:
        """The manifest of a version, by default the last one."""
        if version is None:
            version = max(self.versions(), default=0)
        text = self.files.read("manifests", f"{version:012d}.json")
        if text is None:
            raise NoVersion(f"{self.files.root} has no version {version}")
        return json.loads(text)

    def _publish(self, manifest: dict) -> dict:
        if not self.files.create(json.dumps(manifest), "manifests", f"{manifest['version']:012d}.json"):
            raise Conflict(f"version {manifest['version']} was published by another writer")
        return manifest

    def pin(self, version: int | None = None, *, seconds: float = 24 * 3600) -> tuple[dict, str]:
        """(manifest, name of the pin): the version is kept until the pin is
        released or its time is over."""
        while True:
            found = self.manifest(version)
            name = f"{found['version']:012d}.{uuid.uuid4().hex}.json"
            self.files.create(json.dumps({"until": time.time() + seconds}), "pins", name)
            # A collection that did not see the pin removed the manifest first.
            if self.files.read("manifests", f"{found['version']:012d}.json") is not None:
                return found, name
            self.release(name)
            if version is not None:
                raise NoVersion(f"version {version} was removed")

    def release(self, pin: str) -> None:
        self.files.remove("pins", pin)

    def _pinned(self) -> set[int]:
        held = set()
        for name in self.files.names("pins"):
            text = None if name.startswith(".") else self.files.read("pins", name)
            if text and json.loads(text)["until"] > time.time():
                held.add(int(name.split(".")[0]))
        return held

    def collect(self, *, keep: int = 1, grace_seconds: float = 24 * 3600) -> list[int]:
        """Remove versions but the last ``keep`` and the pinned ones, then the
        folders that no remaining version names. A folder younger than
        ``grace_seconds`` may belong to a build that still runs, and stays."""
        versions, held = self.versions(), self._pinned()
        texts = {v: json.dumps(self.manifest(v)) for v in versions[: max(0, len(versions) - keep)] if v not in held}
        for v in texts:
            self.files.remove("manifests", f"{v:012d}.json")
        # A reader pins first and then looks whether the manifest is still there:
        # whoever saw it before it was removed has a pin by now.
        late = self._pinned() & set(texts)
        for v in late:
            self.files.create(texts[v], "manifests", f"{v:012d}.json")
        dropped = sorted(set(texts) - late)
        used = {part["folder"] for v in self.versions() for parts in self.manifest(v)["tables"].values() for part in parts}
        before = time.time() - grace_seconds
        for name, changed in self.files.names("data").items():
            if name not in used and changed <= before:
                self.files.remove("data", name)
        return dropped

    # -------------------------------------------------------------- reading

    def table(
        self, manifest: dict, name: str, buckets: Iterable[int] | None = None, *, only: DataFrame | None = None
    ) -> DataFrame:
        """A table of a version; of a bucketed one, with ``buckets``, only these,
        and with ``only`` (column ``key``) only rows of these cleaned claim numbers."""
        parts = manifest["tables"][name]
        if parts[0]["buckets"] is None:
            return union_all([self._part(manifest, part, name) for part in parts])
        wanted = set(range(manifest["buckets"]) if buckets is None else buckets)
        live = [wanted.intersection(part["buckets"]) for part in parts]
        # A column of its own: a join sorts by its keys, and would clean them again for each comparison.
        number = clean_bk(NUMBERS[name]) if name in NUMBERS else F.col("claimnumber")

        def these(rows: DataFrame) -> DataFrame:
            return rows if only is None else rows.join(only, F.col("__key") == only["key"], "left_semi")

        frames, below, replaced = [], [], []
        for at, (part, found) in enumerate(zip(parts, live, strict=True)):
            earlier, later = set().union(*live[:at]), set().union(*live[at + 1 :])
            if found - later:
                rows = self._part(manifest, part, name, found - later)
                frames.append(rows if only is None else these(rows.withColumn("__key", number)).drop("__key"))
            if found & later:
                rows = these(self._part(manifest, part, name, found & later).withColumn("__key", number))
                below.append(rows.withColumn("__at", F.lit(at)))
            if found & earlier:
                named = self._named(part["folder"]).where(F.col(BUCKET).isin(sorted(found & earlier)))
                replaced.append(these(named.select(F.col("key").alias("__key"), F.lit(at).alias("__by"))))
        if below:
            rows, by = union_all(below), union_all(replaced)
            now = rows.join(by, (rows["__key"] == by["__key"]) & (rows["__at"] < by["__by"]), "left_anti")
            frames.append(now.drop("__key", "__at"))
        return union_all(frames) if frames else self._part(manifest, parts[-1], name, set())

    def _part(self, manifest: dict, part: dict, name: str, buckets: set[int] | None = None) -> DataFrame:
        """The rows that one folder has of a table; with ``buckets`` only these."""
        schema = StructType.fromJson(manifest["schemas"][name])
        rows = self.spark.read.schema(schema).parquet(self.files.path("data", part["folder"], name))
        if buckets is not None and len(buckets) < manifest["buckets"]:
            rows = rows.where(F.col(BUCKET).isin(sorted(buckets)))  # prunes folders
        return rows

    def _named(self, folder: str) -> DataFrame:
        schema = f"key string, {BUCKET} int, " + ", ".join(f"{name} boolean" for name in NUMBERS)
        return self.spark.read.schema(schema).parquet(self.files.path("data", folder, NAMED))

    def star(self, manifest: dict | None = None) -> Star:
        """The star of a version (by default the last one)."""
        m = manifest or self.manifest()
        star = self._star(m, self.table(m, "claim"), self.table(m, "response_row"))
        star.facts = {name: self.table(m, name) for name in ("registration_claim", "reimbursement_claim")}
        return star

    def _star(self, m: dict, claims: DataFrame, responses: DataFrame) -> Star:
        dims = {name: self.table(m, name) for name in ("country", "factory", "indication", "product", "calendar")}
        dims = {name: bounded_broadcast(dim, written=True) if name in SMALL_DIMENSIONS else dim for name, dim in dims.items()}
        dims["calendar"] = F.broadcast(dims["calendar"])
        sources = Sources(
            claim=claims.select(*CLAIM.fieldNames()),
            responses=[responses.select(*RESPONSE_COLUMNS)],
            dictionary=lambda: self.table(m, "dictionary"),
        )
        return Star(self.spark, sources, dims=dims)

    # -------------------------------------------------------------- writing

    def _write(self, rows: DataFrame, folder: str, name: str) -> dict:
        rows.write.parquet(self.files.path("data", folder, name))
        return rows.schema.jsonValue()

    def _write_buckets(
        self, rows: DataFrame, key: Column, buckets: int, folder: str, name: str, *order: str, dealt: bool = False
    ) -> dict:
        """Write a table into a folder, partitioned by bucket; its schema. AQE
        deals the rows out by bucket (unless they are ``dealt`` so already),
        splits heavy ones and joins light ones.
        Rows are sorted by ``order``, so that filters on it skip row groups."""
        rows = rows.withColumn(BUCKET, bucket_of(key, buckets))
        rows = (rows if dealt else rows.hint("rebalance", BUCKET)).sortWithinPartitions(BUCKET, *order)
        rows.write.partitionBy(BUCKET).parquet(self.files.path("data", folder, name))
        return rows.schema.jsonValue()

    def _stage(self, rows: DataFrame, folder: str, name: str) -> DataFrame:
        """The rows of a change set, written to its folder until it is published."""
        self._write(rows, folder, f"given_{name}")
        return self.spark.read.schema(rows.schema).parquet(self.files.path("data", folder, f"given_{name}"))

    def _write_rows(self, rows: DataFrame, folder: str, name: str, key: str, buckets: int) -> dict:
        return self._write_buckets(rows, clean_bk(key), buckets, folder, name)

    def _write_facts(self, star: Star, folder: str, buckets: int) -> dict:
        # The stored response rows of a claim number are distinct; those without a
        # number may not be, but no claim finds them.
        (answers,) = star.sources.responses
        numbered = answers.where(F.col(RESPONSE_COLUMNS[0]).isNotNull())
        star = Star(self.spark, star.sources, dims=star._dims | {"response": D.recoded_responses(numbered, star.sources.dictionary)})
        # Rows are dealt out by bucket before the small lists widen them.
        number = F.col("claimnumber")
        deal = lambda f: f.withColumn(BUCKET, bucket_of(number, buckets)).hint("rebalance", BUCKET)
        facts = {
            "registration_claim": registration_fact(star, with_attributes=True, deal=deal),
            "reimbursement_claim": reimbursement_fact(star, with_attributes=True, deal=deal),
        }
        order = ("country_bk", "response_date_id")
        return {name: self._write_buckets(f, number, buckets, folder, name, *order, dealt=True) for name, f in facts.items()}

    def build(self, sources: Sources, *, note: str = "") -> dict:
        """Build a version from all the sources and publish it: its manifest."""
        folder, star = uuid.uuid4().hex, Star(self.spark, sources)
        schemas = {name: self._write(getattr(star, name), folder, name) for name in WHOLE_TABLES if name != "dictionary"}
        schemas["dictionary"] = self._write(sources.dictionary, folder, "dictionary")
        claims = sources.claim.where(F.col("claimtype").isin(REGISTER, REFUND)).select(*CLAIM.fieldNames())
        schemas["claim"] = self._write_rows(claims, folder, "claim", "claimnumber", self.buckets)
        responses = D.response_rows(sources.responses)
        schemas["response_row"] = self._write_rows(responses, folder, "response_row", "claim_number", self.buckets)
        every = list(range(self.buckets))
        tables = {name: [{"folder": folder, "buckets": None}] for name in WHOLE_TABLES}
        tables |= {name: [{"folder": folder, "buckets": every}] for name in BUCKETED_TABLES}
        manifest = {
            "version": max(self.versions(), default=0) + 1, "parent": None, "note": note, "buckets": self.buckets,
            "tables": tables, "schemas": schemas,
        }
        written = self._star(manifest, self.table(manifest, "claim"), self.table(manifest, "response_row"))
        schemas |= self._write_facts(written, folder, self.buckets)
        return self._publish(manifest)

    def apply(self, changes: Changes, *, note: str = "") -> dict:
        """Publish the last version with ``changes`` applied: its manifest. Only
        rows of claim numbers that the change set names are written, unless the
        tables have ``max_parts`` folders by now."""
        base = self.manifest()
        buckets, folder = base["buckets"], uuid.uuid4().hex
        # The change set is written once: it is read for the claim numbers it
        # names and for its rows.
        given = {"claim": changes.claims, "response_row": changes.responses}
        new = {name: None if rows is None else self._stage(rows, folder, name) for name, rows in given.items()}
        if new["response_row"] is not None:
            new["response_row"] = new["response_row"].toDF(*RESPONSE_COLUMNS)
        naming = {
            "claim": _replacing(new["claim"], NUMBERS["claim"], changes.withdrawn_claims),
            "response_row": _replacing(new["response_row"], NUMBERS["response_row"], changes.withdrawn_responses),
        }
        if not any(naming.values()):
            return base
        found = self._write_named(naming, folder, buckets)
        named, live = self._named(folder), {r[BUCKET] for r in found}
        if not live:
            return self._publish(base | {"version": base["version"] + 1, "parent": base["version"], "note": note})
        whole = len(base["tables"]["claim"]) >= self.max_parts
        if whole:
            live |= {b for part in base["tables"]["claim"][1:] for b in part["buckets"]}
        schemas, mine = dict(base["schemas"]), {"folder": folder, "buckets": sorted(live)}
        for name, key in NUMBERS.items():
            # Of the rows there are, all that the change set does not replace, or
            # those whose claim number it names in the other table only.
            added, kept = new[name], []
            touched = {r[BUCKET] for r in found if r[f"not_{name}"]}
            if whole:
                replaced = named.where(F.col(name))
                rows = self.table(base, name, live).withColumn("__key", clean_bk(key))
                kept = [rows.join(replaced, rows["__key"] == replaced["key"], "left_anti")]
            elif touched:
                kept = [self.table(base, name, touched, only=named.where(~F.col(name)).select("key"))]
            if added is not None:
                kept.append(added.where(F.col("claimtype").isin(REGISTER, REFUND)) if name == "claim" else added.distinct())
            columns = StructType([f for f in StructType.fromJson(schemas[name]) if f.name != BUCKET])
            rows = union_all([self.spark.createDataFrame([], columns), *(f.select(*columns.names) for f in kept)])
            schemas[name] = self._write_rows(rows, folder, name, key, buckets)
            self._openable(schemas, name, mine)
        tables = {name: base["tables"][name] for name in WHOLE_TABLES}
        for name in BUCKETED_TABLES:
            parts = base["tables"][name]
            if whole:
                parts = [part | {"buckets": sorted(set(part["buckets"]) - live)} for part in parts]
            tables[name] = [part for part in parts if part["buckets"]] + [mine]
        manifest = base | {
            "version": base["version"] + 1, "parent": base["version"], "note": note, "tables": tables, "schemas": schemas,
        }
        written = {name: self._part(manifest, mine, name) for name in NUMBERS}
        if not written["claim"].isEmpty():  # without a claim there is no fact
            schemas |= self._write_facts(self._star(manifest, written["claim"], written["response_row"]), folder, buckets)
        for name in BUCKETED_TABLES:
            self._openable(schemas, name, mine)
        for name in given:
            self.files.remove("data", folder, f"given_{name}")
        return self._publish(manifest)

    def _write_named(self, naming: dict[str, list[tuple[DataFrame, Column]]], folder: str, buckets: int) -> list[Row]:
        """Write the claim numbers that a change set names, each with the tables it
        is named in; by bucket (at most ``buckets`` rows) how many are not named in
        each table. A null names no rows, only its bucket."""
        frames = [
            f.select(clean_bk(k).alias("key"), *(F.lit(of == name).alias(of) for of in NUMBERS))
            for name, named in naming.items()
            for f, k in named
        ]
        keys = union_all(frames).groupBy("key").agg(*(F.bool_or(of).alias(of) for of in NUMBERS))
        keys = keys.withColumn(BUCKET, bucket_of(F.col("key"), buckets))
        self._write(keys.sortWithinPartitions(BUCKET), folder, NAMED)
        lacking = [F.count_if(~F.col(of) & F.col("key").isNotNull()).alias(f"not_{of}") for of in NUMBERS]
        return self._named(folder).groupBy(BUCKET).agg(*lacking).collect()

    def _openable(self, schemas: dict, name: str, part: dict) -> None:
        """An empty file where a table has no rows in a folder, so that it opens."""
        if not any(n.startswith(f"{BUCKET}=") for n in self.files.names("data", part["folder"], name)):
            schema = StructType([f for f in StructType.fromJson(schemas[name]) if f.name != BUCKET])
            path = self.files.path("data", part["folder"], name, f"{BUCKET}={part['buckets'][0]}")
            self.spark.createDataFrame([], schema).coalesce(1).write.parquet(path)


def _replacing(rows: DataFrame | None, key: str, withdrawn: DataFrame | None) -> list[tuple[DataFrame, Column]]:
    """Frames that name claim numbers, with the column that has them."""
    found = [] if rows is None else [(rows, F.col(key))]
    return found if withdrawn is None else [*found, (withdrawn, F.col(withdrawn.columns[0]))]
