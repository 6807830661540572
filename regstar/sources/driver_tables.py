"""Claim-shaped sources derived from the TPC-H-like driver tables.

The star is built from claim-shaped sources (:class:`Sources`). In production
these come from JDBC tables and delimited files; here they are derived, with
DataFrame expressions only, from the Parquet tables under one ``sf`` folder,
so every query's work grows with those tables.

Mapping (one claim row per ``lineitem`` row joined to its order, customer and
supplier):

- claim number   ``CL-<l_orderkey>-<l_linenumber>``; not unique, because
                 ``(l_orderkey, l_linenumber)`` is not. Line 3 is written in
                 lower case between a blank and a tab, to be cleaned.
- claim type     ``l_returnflag``: ``R`` REGISTER, ``A`` REFUND, ``N`` OTHER
- dates          submission ``o_orderdate``; expected answer 60 days later
- country        the customer's nation, code ``N`` + letter (nation 0 is
                 ``NA``, which must stay text; nation 26 is ``NA1``)
- indication     the customer's market segment
- product        the part (``PRD<l_partkey>``); every 29th part is claimed
                 under ``PRX``, a code no product carries, so some claims are
                 orphans
- family         the part type; the family table omits ``PROMO`` types
- factories      REGISTER rows only (others carry empty text, which matches
                 nothing): api = supplier's nation, bulk = customer's nation,
                 package = ``l_partkey % 30`` (25..29 match no factory)
- price          text ``'null'`` on REGISTER rows and on line 7; SQL null when
                 ``l_tax = 0``; otherwise ``floor(l_extendedprice)`` + ``' CHF'``
- percentage     ``round(l_discount * 100)``, zeros included
- responses      one row per claim number: latest ship date (as text) and the
                 order status as the raw code (``F``, ``O``; ``P`` is a code
                 the dictionary does not know); every 97th order answers on a
                 date that is no date (``unknown``)
- factories file two overlapping lists of all nations; factory 11 has two
                 countries, factory 12 two names (so lookups fan out),
                 factory 5 carries a trailing blank in the first file, 3 has a
                 padded name, 7 quotes and a backslash in it, 4 an empty
                 country and 6 none
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from regstar.sources import schemas

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed values of the mapping.
EXPECTED_ANSWER_DAYS = 60
UNKNOWN_PRODUCT_MODULUS = 29
UNPARSABLE_DATE_MODULUS = 97
# The two factory files overlap: of each 25 nations in a row, the first 15
# are in the first file and the last 15 in the second.
FACTORY_FILE_NATIONS = 25
LICENCE_FIRST_DAY, LICENCE_STEP, LICENCE_DAYS, LICENCE_LENGTH = "1992-01-01", 53, 2200, 300
FACTORY_FILE_1_UNTIL = 14
FACTORY_FILE_2_FROM = 10
FACTORY_PADDED_NAME = 3
FACTORY_EMPTY_COUNTRY = 4
FACTORY_NO_COUNTRY = 6
FACTORY_QUOTED_NAME = 7
FACTORY_TWO_COUNTRIES = 11
FACTORY_TWO_NAMES = 12
FACTORY_TRAILING_BLANK = 5
PACKAGE_MODULUS = 30
RESPONSE_DICTIONARY_ROWS = (("F", "Approved"), ("O", "Declined"))


class Tables(Mapping[str, DataFrame]):
    """Driver tables of one folder, opened on first use with their declared
    schemas (no inference job, nothing opened that a plan does not use). A
    plain scan: how it is split is Spark's decision."""

    def __init__(self, spark: SparkSession, sf_dir: str, names=DRIVER_TABLES):
        self._spark, self._dir, self._names = spark, sf_dir.rstrip("/"), tuple(names)
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._open:
            reader = self._spark.read
            if name in schemas.DRIVER:
                reader = reader.schema(schemas.DRIVER[name])
            self._open[name] = reader.parquet(f"{self._dir}/{name}.parquet")
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def load_tables(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> Tables:
    return Tables(spark, sf_dir, names)


def country_code(nationkey: Column) -> Column:
    """``N`` and a letter; beyond 26 nations the letter repeats with a number."""
    letter = F.chr(F.lit(65) + nationkey % 26)
    return F.concat(F.lit("N"), letter, F.when(nationkey < 26, F.lit("")).otherwise(F.floor(nationkey / 26).cast("string")))


def factory_code(n: Column) -> Column:
    return F.concat(F.lit("F"), (F.lit(100) + n).cast("string"))


def family_id(family_name: Column) -> Column:
    """Integer family key: the first 60 bits of the name's MD5."""
    return F.conv(F.substring(F.md5(family_name), 1, 15), 16, 10).cast("bigint")


def claim_number(orderkey: Column, linenumber: Column) -> Column:
    return F.concat(F.lit("CL-"), orderkey.cast("string"), F.lit("-"), linenumber.cast("string"))


def claim_source(t: Mapping[str, DataFrame]) -> DataFrame:
    """Rows in the shape of the relational ``claim`` table."""
    li = t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag",
    )
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    cust = t["customer"].select("c_custkey", "c_nationkey", "c_mktsegment")
    supp = t["supplier"].select("s_suppkey", "s_nationkey")
    # Orders meet their customer first (orders are a quarter of lineitem),
    # then the line items.
    oc = orders.join(cust, orders.o_custkey == cust.c_custkey)
    rows = li.join(oc, li.l_orderkey == oc.o_orderkey).join(supp, li.l_suppkey == supp.s_suppkey)

    register = F.col("l_returnflag") == "R"
    number = claim_number(F.col("l_orderkey"), F.col("l_linenumber"))
    submitted = F.col("o_orderdate").cast("date")
    price = (
        F.when(register | (F.col("l_linenumber") == 7), F.lit("null"))
        .when(F.col("l_tax") == 0, F.lit(None).cast(StringType()))
        .otherwise(F.concat(F.floor("l_extendedprice").cast("bigint").cast("string"), F.lit(" CHF")))
    )

    def factory(n: Column) -> Column:
        return F.when(register, factory_code(n)).otherwise(F.lit(""))

    return rows.select(
        F.concat(F.lit("RO"), F.col("o_custkey").cast("string")).alias("ronumber"),
        F.lit(None).cast(StringType()).alias("productfamily"),
        country_code(F.col("c_nationkey")).alias("countrycode"),
        submitted.alias("submissiondate"),
        F.date_add(submitted, EXPECTED_ANSWER_DAYS).alias("expectedresponsedate"),
        F.when(F.col("l_linenumber") == 3, F.concat(F.lit(" "), F.lower(number), F.lit("\t")))
        .otherwise(number)
        .alias("claimnumber"),
        F.concat(
            F.when(F.col("l_partkey") % UNKNOWN_PRODUCT_MODULUS == 0, "PRX").otherwise("PRD"),
            F.col("l_partkey").cast("string"),
        ).alias("productcodeid"),
        F.concat(F.lit("IND-"), F.col("c_mktsegment")).alias("indicationid"),
        F.when(register, "REGISTER").when(F.col("l_returnflag") == "A", "REFUND")
        .otherwise("OTHER").alias("claimtype"),
        factory(F.col("s_nationkey")).alias("factoryapi"),
        factory(F.col("c_nationkey")).alias("factorybulk"),
        factory(F.col("l_partkey") % PACKAGE_MODULUS).alias("factorypackage"),
        price.alias("drugprice"),
        F.round(F.col("l_discount") * 100).cast("smallint").alias("reimbursementprct"),
    )


def drugproduct_source(t: Mapping[str, DataFrame]) -> DataFrame:
    """Product catalogue: all parts. Every 17th code is stored in lower case
    with a trailing blank (cleaned when the dimension is built)."""
    p = t["part"]
    code = F.concat(F.lit("PRD"), F.col("p_partkey").cast("string"))
    return p.select(
        F.when(F.col("p_partkey") % 17 == 0, F.concat(F.lower(code), F.lit(" ")))
        .otherwise(code).alias("drugproductid"),
        F.lit("A").alias("recordstatus"),
        F.col("p_name").alias("drugproductname"),
        F.lit(None).cast(StringType()).alias("ronumber"),
        family_id(F.col("p_type")).alias("drugproductfamilyid"),
    )


def drugproductfamily_source(t: Mapping[str, DataFrame]) -> DataFrame:
    """Families: distinct part types except promotional ones."""
    types = t["part"].select("p_type").where(~F.col("p_type").startswith("PROMO")).distinct()
    return types.select(
        family_id(F.col("p_type")).alias("drugproductfamilyid"),
        F.col("p_type").alias("drugproductfamilyname"),
    )


def indication_source(t: Mapping[str, DataFrame]) -> DataFrame:
    seg = t["customer"].select("c_mktsegment").distinct()
    return seg.select(
        F.concat(F.lit("IND-"), F.col("c_mktsegment")).alias("indicationid"),
        F.lit("A").alias("recordstatus"),
        F.lower("c_mktsegment").alias("indicationdescription"),
    )


def countries_source(t: Mapping[str, DataFrame]) -> DataFrame:
    """Rows in the shape of the countries CSV (header names kept)."""
    n = t["nation"]
    code = country_code(F.col("n_nationkey"))
    names = [f.name for f in schemas.COUNTRIES.fields]
    return n.select(
        F.col("n_name").alias(names[0]),
        code.alias(names[1]),
        F.concat(F.lit("X"), code).alias(names[2]),
        F.col("n_nationkey").cast("string").alias(names[3]),
        F.concat(F.lit("ISO 3166-2:"), code).alias(names[4]),
    )


def factories_sources(t: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Two factory files with overlapping rows (shape: code, name, country)."""
    n = t["nation"]
    k = F.col("n_nationkey")
    place = k % FACTORY_FILE_NATIONS
    plain = F.concat(F.lit("Plant "), F.col("n_name"))
    name = (
        F.when(k == FACTORY_PADDED_NAME, F.concat(F.lit(" "), plain, F.lit("  ")))
        .when(k == FACTORY_QUOTED_NAME, F.concat(F.lit('"A" \\ '), plain))
        .otherwise(plain)
    )
    country = (
        F.when(k == FACTORY_EMPTY_COUNTRY, F.lit(""))
        .when(k == FACTORY_NO_COUNTRY, F.lit(None).cast(StringType()))
        .otherwise(F.col("n_name"))
    )
    first = n.where(place <= FACTORY_FILE_1_UNTIL).select(
        F.when(k == FACTORY_TRAILING_BLANK, F.concat(factory_code(k), F.lit(" ")))
        .otherwise(factory_code(k)).alias("code"),
        name.alias("name"),
        country.alias("country"),
    )
    second = n.where(place >= FACTORY_FILE_2_FROM).select(
        factory_code(k).alias("code"),
        F.when(k == FACTORY_TWO_NAMES, F.lower(name)).otherwise(name).alias("name"),
        F.when(k == FACTORY_TWO_COUNTRIES, F.lit("ELSEWHERE")).otherwise(F.col("n_name")).alias("country"),
    )
    return [first, second]


def responses_sources(t: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Response file rows: one per claim number (latest ship date, order status).

    The line items are aggregated per claim key before they meet the orders,
    so a hot key collapses in the map-side partial aggregation.
    """
    latest = t["lineitem"].groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_shipdate").alias("shipped")
    )
    o = t["orders"].select("o_orderkey", "o_orderstatus")
    rows = latest.join(o, latest.l_orderkey == o.o_orderkey)
    names = [f.name for f in schemas.RESPONSES.fields]
    return [
        rows.select(
            claim_number(F.col("l_orderkey"), F.col("l_linenumber")).alias(names[0]),
            F.when(F.col("l_orderkey") % UNPARSABLE_DATE_MODULUS == 0, F.lit("unknown"))
            .otherwise(F.date_format(F.col("shipped").cast("date"), "yyyy-MM-dd"))
            .alias(names[1]),
            F.col("o_orderstatus").alias(names[2]),
        )
    ]


def response_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RESPONSE_DICTIONARY_ROWS), schemas.RESPONSE_DICTIONARY)


class Sources:
    """Claim-shaped inputs of the star (reference shape, raw values).

    Each source is given as a DataFrame (a list of them for the multi-file
    sources ``factories`` and ``responses``) or as a zero-argument function
    that builds it; functions run on first use only, so a plan that needs
    one source never builds the others.
    """

    NAMES = (
        "claim", "drugproduct", "drugproductfamily", "indication", "countries",
        "factories", "responses", "dictionary",
    )

    def __init__(self, **sources):
        unknown = set(sources) - set(self.NAMES)
        if unknown:
            raise TypeError(f"unknown sources: {sorted(unknown)}")
        self._given = sources
        self._built: dict[str, object] = {}

    def __getattr__(self, name: str):
        if name.startswith("_") or name not in self.NAMES:
            raise AttributeError(name)
        if name not in self._built:
            if name not in self._given:
                raise AttributeError(f"source {name!r} was not given")
            v = self._given[name]
            self._built[name] = v() if callable(v) else v
        return self._built[name]


def driver_sources(spark: SparkSession, sf_dir: str) -> Sources:
    t = load_tables(spark, sf_dir)
    return Sources(
        claim=lambda: claim_source(t),
        drugproduct=lambda: drugproduct_source(t),
        drugproductfamily=lambda: drugproductfamily_source(t),
        indication=lambda: indication_source(t),
        countries=lambda: countries_source(t),
        factories=lambda: factories_sources(t),
        responses=lambda: responses_sources(t),
        dictionary=lambda: response_dictionary(spark),
    )


def factory_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of the factories (shape: key, licence, valid_from, valid_to): one
    for each supplier, for the factory of its nation; the days from its number,
    every fourth one with an end."""
    n = F.col("s_suppkey")
    start = F.date_add(F.lit(LICENCE_FIRST_DAY).cast("date"), F.pmod(n * LICENCE_STEP, F.lit(LICENCE_DAYS)).cast("int"))
    return load_tables(spark, sf_dir)["supplier"].select(
        factory_code(F.col("s_nationkey")).alias("key"),
        F.col("s_name").alias("licence"),
        start.alias("valid_from"),
        F.when(n % 4 == 0, F.date_add(start, LICENCE_LENGTH)).alias("valid_to"),
    )
