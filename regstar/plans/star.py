"""The star: dimensions built from sources, facts built on demand."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regstar.functions import clean_bk
from regstar.functions.keys import CALENDAR_START
from regstar.operators import bounded_broadcast, repeats
from regstar.plans import dims as D
from regstar.plans.calendar import dim_calendar
from regstar.session import remove_dir, shared_dir
from regstar.sources import Sources

DIMENSIONS = ("country", "factory", "indication", "response", "product", "calendar")
# Code lists whose size is proven before they are broadcast.
SMALL_DIMENSIONS = ("country", "factory", "indication")
FACTS = ("registration_claim", "reimbursement_claim")
# Written facts are partitioned by this text of the country code, which is
# never empty or null, so that the code itself stays as it is.
COUNTRY_PART = "country_part"


class Star:
    """Dimensions (``country``, ``factory``, ``indication``, ``response``,
    ``product``, ``calendar``) and the two facts over one set of sources.

    Every dimension plan is built on first use, so a question pays only for
    the dimensions it touches. ``dims`` / ``facts`` supply already built
    frames (e.g. read back by :func:`materialize`).
    """

    def __init__(
        self,
        spark: SparkSession,
        sources: Sources,
        *,
        check_small_dims: bool = True,
        dims: dict[str, DataFrame] | None = None,
        facts: dict[str, DataFrame] | None = None,
        answered: bool = False,
        grid=None,
    ):
        self.spark = spark
        self.sources = sources
        self.check_small_dims = check_small_dims
        #: The claims have a cleaned number and their response's columns already.
        self.answered = answered
        #: How the reimbursement fact is clustered (``clustered.Grid``), if it is.
        self.grid = grid
        self._dims: dict[str, DataFrame] = dict(dims or {})
        self.facts: dict[str, DataFrame] = dict(facts or {})
        self._repeats: dict[str, DataFrame] = {}

    def _dim(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._dims:
            self._dims[name] = build()
        return self._dims[name]

    def _small(self, df: DataFrame) -> DataFrame:
        return bounded_broadcast(df) if self.check_small_dims else df

    @property
    def country(self) -> DataFrame:
        """Country list (a small file): broadcast once its size is proven."""
        return self._dim("country", lambda: self._small(D.dim_country(self.sources.countries)))

    @property
    def factory(self) -> DataFrame:
        """Factory list (small files): broadcast once its size is proven."""
        return self._dim("factory", lambda: self._small(D.dim_factory(self.sources.factories)))

    @property
    def indication(self) -> DataFrame:
        """Indication list (a code table): broadcast once its size is proven."""
        return self._dim("indication", lambda: self._small(D.dim_indication(self.sources.indication)))

    @property
    def response(self) -> DataFrame:
        return self._dim(
            "response", lambda: D.dim_response(self.sources.responses, self.sources.dictionary)
        )

    @property
    def product(self) -> DataFrame:
        return self._dim(
            "product",
            lambda: D.dim_product(self.sources.drugproduct, self._small(self.sources.drugproductfamily)),
        )

    def repeats(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """For each of these dimensions the business keys that several of its
        rows hold, written once. A dimension that no other plan has used yet is
        only counted, not written."""
        plain = {
            "country": lambda: D.dim_country(self.sources.countries),
            "factory": lambda: D.dim_factory(self.sources.factories),
            "indication": lambda: D.dim_indication(self.sources.indication),
            "product": lambda: D.dim_product(self.sources.drugproduct, self.sources.drugproductfamily),
        }
        asked = {}
        for name in names:
            if name not in self._repeats:
                dim = plain[name]() if name in plain and name not in self._dims else getattr(self, name)
                asked[name] = (dim, clean_bk(f"{name}_bk"))
        if asked:
            self._repeats |= repeats(asked)
        return {name: self._repeats[name] for name in names}

    @property
    def calendar(self) -> DataFrame:
        """Calendar: 73,050 rows by construction, so always a broadcast side
        (in DataFrame plans and in SQL over its view alike)."""
        return self._dim("calendar", lambda: F.broadcast(dim_calendar(self.spark)))

    def registration(self, *, with_attributes: bool = False) -> DataFrame:
        from regstar.plans.facts import REGISTRATION_COLUMNS, registration_fact

        if "registration_claim" in self.facts:
            f = self.facts["registration_claim"]
            return f if with_attributes else f.select(*REGISTRATION_COLUMNS)
        return registration_fact(self, with_attributes=with_attributes)

    def reimbursement(self, *, with_attributes: bool = False) -> DataFrame:
        from regstar.plans.facts import REIMBURSEMENT_COLUMNS, reimbursement_fact

        if "reimbursement_claim" in self.facts:
            f = self.facts["reimbursement_claim"]
            return f if with_attributes else f.select(*REIMBURSEMENT_COLUMNS)
        return reimbursement_fact(self, with_attributes=with_attributes)

    @property
    def facts_written(self) -> bool:
        return all(name in self.facts for name in FACTS)

    def register_views(self) -> None:
        """Temp views under the names the SQL forms use; all are lazy plans."""
        self.sources.claim.createOrReplaceTempView("claim_src")
        for name in DIMENSIONS:
            getattr(self, name).createOrReplaceTempView(f"dim_{name}")
        self.registration(with_attributes=True).createOrReplaceTempView("fact_registration")
        self.reimbursement(with_attributes=True).createOrReplaceTempView("fact_reimbursement")


def build_star(spark: SparkSession, sources: Sources, *, check_small_dims: bool = True) -> Star:
    """Lazy star over ``sources`` (nothing runs until a plan is executed,
    except the size proof of a small dimension when it is first used)."""
    return Star(spark, sources, check_small_dims=check_small_dims)


def materialize(star: Star, path: str | None = None) -> Star:
    """Write the dimensions, then both facts (with attributes), as Parquet and
    return a star that reads them back.

    This is the build step of the modelled program (which caches its frames
    before asking its questions), done as written tables: several questions
    then share one build, and their plans start from the written files, so
    lineage is cut and a lost executor costs a re-read, not a rebuild. The
    facts are built from the written dimensions, so no dimension is derived
    twice. The default location is a fresh folder under
    ``spark.checkpoint.dir``.
    """
    spark = star.spark
    base = path or shared_dir(spark, "star")
    for name in DIMENSIONS:
        getattr(star, name).write.mode("overwrite").parquet(f"{base}/{name}")
    dims = {name: spark.read.parquet(f"{base}/{name}") for name in DIMENSIONS}
    dims["calendar"] = F.broadcast(dims["calendar"])
    if star.check_small_dims:
        for name in SMALL_DIMENSIONS:
            dims[name] = bounded_broadcast(dims[name])
    from regstar.plans.facts import REFUND, REGISTER, claim_lookups, finish_registration, finish_reimbursement

    written = Star(spark, star.sources, check_small_dims=star.check_small_dims, dims=dims)
    # The lookups both facts share run once and are written, partitioned by
    # claim type; each fact is finished from its own partition (the claim
    # type filter prunes the other one at planning time). They are removed
    # when both facts are written.
    lookups = shared_dir(spark, "claim_lookups")
    claim_lookups(written, (REGISTER, REFUND), with_attributes=True).write.partitionBy("claimtype").parquet(lookups)
    shared = spark.read.parquet(lookups)
    finish_registration(shared, written, with_attributes=True).write.mode("overwrite").parquet(
        f"{base}/registration_claim"
    )
    # The reimbursement questions filter on the claim's country, so that fact
    # is written partitioned by country (a filter then reads one folder). The
    # rebalance hint lets AQE split a country holding many claims over
    # several writers and merge small ones, so neither file count nor one
    # writer's load follows the skew.
    reimb = finish_reimbursement(shared, with_attributes=True).withColumn(COUNTRY_PART, country_part("country_bk"))
    reimb.hint("rebalance", COUNTRY_PART).write.mode("overwrite").partitionBy(COUNTRY_PART).parquet(
        f"{base}/reimbursement_claim"
    )
    remove_dir(spark, lookups)
    facts = {
        "registration_claim": spark.read.parquet(f"{base}/registration_claim"),
        "reimbursement_claim": spark.read.schema(reimb.schema).parquet(f"{base}/reimbursement_claim"),
    }
    return Star(spark, star.sources, check_small_dims=star.check_small_dims, dims=dims, facts=facts)


def country_part(code) -> Column:
    """The partition text of a country code."""
    column = F.col(code) if isinstance(code, str) else code
    return F.concat(F.lit("code_"), F.coalesce(column, F.lit("")))


def in_countries(fact: DataFrame, countries) -> DataFrame:
    """Rows of a written fact of these countries; only their folders are read."""
    codes = list(countries)
    rows = fact.where(F.col("country_bk").isin(codes))
    if COUNTRY_PART in fact.columns:
        rows = rows.where(F.col(COUNTRY_PART).isin([f"code_{c}" for c in codes]))
    return rows


def answered_in(star: Star, countries: Iterable[str], start: date, end: date) -> DataFrame:
    """Written reimbursement claims (with attributes) of these countries that
    were answered between ``start`` and ``end``, both included. The days are
    compared as numbers with literals, so row groups without them are not read;
    of a clustered fact neither are the other zones' files."""
    codes = list(countries)
    first, last = (start - CALENDAR_START).days, (end - CALENDAR_START).days
    rows = in_countries(star.reimbursement(with_attributes=True), codes)
    rows = rows.where(F.col("response_date_id").between(first, last))
    return rows if star.grid is None else star.grid.prune(rows, codes, first, last)
