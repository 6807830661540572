"""Query catalogue over the driver tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Every entry reads the Parquet tables of one scale-factor folder through
``regstar.sources.driver_sources`` and runs the library's plans over them, so
each query's work grows with the tables. Column names are stable; they are
what the SQL oracles produce too.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regstar.functions import (
    clean_bk,
    date_key,
    date_of_key,
    has_price,
    parse_date,
    price_amount,
    price_currency,
)
from regstar.operators import (
    as_of,
    duplicate_keys,
    orphans,
    orphans_by_key,
    proposals,
    role_lookup,
    union_all,
    union_distinct,
    unmapped_codes,
)
from regstar.plans import dims as D
from regstar.plans import questions as Q
from regstar.plans import sql_forms as S
from regstar.plans.calendar import dim_calendar
from regstar.plans.clustered import cluster
from regstar.plans.cobucketed import answered_star, write_answered
from regstar.plans.facts import REGISTER, weighted_claims
from regstar.plans.key_map import KeyMap
from regstar.plans.star import Star, build_star, materialize
from regstar.plans.store import Changes, StarStore
from regstar.session import shared_dir
from regstar.sources import driver_sources, load_tables, read_delimited, read_records, schemas, write_delimited
from regstar.sources.driver_changes import history
from regstar.sources.driver_tables import countries_source, factory_licences

# Fixed parameters of the questions on the driver tables.
Q3_COUNTRIES = ("NB", "NC", "ND", "NE")
Q3_YEAR = 1998
Q3_QUARTER = "Q4"
Q4_COUNTRY = "NH"
Q4_START = date(1997, 1, 1)
Q4_END = date(1999, 12, 31)
# Two overlapping parts of the suppliers, by place of their nation in 25.
UNION_NATIONS = 25
UNION_PART_1_UNTIL = 14
UNION_PART_2_FROM = 10

Query = Callable[[SparkSession, str], DataFrame]


def _star(spark: SparkSession, sf_dir: str) -> Star:
    return build_star(spark, driver_sources(spark, sf_dir))


# ---------------------------------------------------------------- sources


def src_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The response file with broken records in it (a field too few, one too
    many, an amount that is no number), read into good rows and quarantine."""
    (rows,) = driver_sources(spark, sf_dir).responses
    number, date, code = (F.col(f"`{c}`") for c in rows.columns)
    fault = F.substring(F.md5(number.cast("binary")), 1, 1)
    amount = F.when(fault == "2", F.concat(F.lit("n/a "), F.length(number))).otherwise(F.length(number).cast("string"))
    line = F.concat_ws(",", number, date, code, F.when(fault != "0", amount), F.when(fault == "1", F.lit("again")))
    path = f"{shared_dir(spark, 'quarantine')}/responses"
    rows.select(line.alias("value")).write.text(path)
    schema = "claim_number string, response_date string, response string, amount int"
    found = read_records(spark, path, StructType.fromDDL(schema), header=False)
    bad = found.bad.select(*(F.lit(None).cast("string").alias(c) for c in ("claim_number", "response_date", "response")),
                           F.lit(None).cast("int").alias("amount"), "record")
    return found.good.withColumn("record", F.lit(None).cast("string")).unionByName(bad)


def src_delimited_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and the country list written as delimited text into the
    shared folder (headerless TSV, header CSV), read back with fixed schemas
    in strict mode, and joined."""
    t = load_tables(spark, sf_dir, ("customer", "nation"))
    base = shared_dir(spark, "roundtrip")
    cust_path = write_delimited(
        t["customer"].select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
        f"{base}/customers_tsv",
        header=False,
        sep="\t",
    )
    ctry_path = write_delimited(countries_source(t), f"{base}/countries_csv", header=True)
    cust = read_delimited(
        spark, cust_path, schemas._strings("custkey", "name", "nationkey", "segment"), header=False, sep="\t"
    )
    ctry = read_delimited(spark, ctry_path, schemas.COUNTRIES, header=True).toDF(*schemas.COUNTRY_COLUMNS)
    return cust.join(ctry, cust.nationkey == ctry.numeric_code).select(
        F.col("custkey").cast("bigint").alias("c_custkey"),
        F.col("name").alias("c_name"),
        F.col("country_name"),
    )


def _supplier_slices(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    s = load_tables(spark, sf_dir, ("supplier",))["supplier"].select("s_suppkey", "s_name", "s_nationkey")
    place = F.col("s_nationkey") % UNION_NATIONS
    return [s.where(place <= UNION_PART_1_UNTIL), s.where(place >= UNION_PART_2_FROM)]


def src_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_all(_supplier_slices(spark, sf_dir))


def src_union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_distinct(_supplier_slices(spark, sf_dir))


def src_files_factory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two factory lists written as headerless TSV (padded names, quotes,
    empty and missing values), read in one scan, built into the dimension."""
    base = shared_dir(spark, "files")
    files = driver_sources(spark, sf_dir).factories
    paths = [write_delimited(f, f"{base}/factories_{i}", header=False, sep="\t") for i, f in enumerate(files)]
    read = read_delimited(spark, paths, schemas.FACTORIES, header=False, sep="\t")
    return D.dim_factory([read]).drop("factory_id")


def src_files_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping response files written as CSV with a header, and the
    dictionary as TSV, read back and built into the dimension."""
    base = shared_dir(spark, "files")
    src = driver_sources(spark, sf_dir)
    (rows,) = src.responses
    line = F.substring_index(F.col(f"`{rows.columns[0]}`"), "-", -1).cast("int")
    parts = [rows.where(line <= 4), rows.where(line >= 3)]
    paths = [write_delimited(f, f"{base}/responses_{i}", header=True) for i, f in enumerate(parts)]
    codes = write_delimited(src.dictionary, f"{base}/dictionary", header=False, sep="\t")
    read = read_delimited(spark, paths, schemas.RESPONSES, header=True)
    dictionary = read_delimited(spark, codes, schemas.RESPONSE_DICTIONARY, header=False, sep="\t")
    return D.dim_response([read], dictionary).drop("response_id")


# ---------------------------------------------------------------- functions


def bk_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands padded with blanks, tabs and newlines, in mixed case, or null,
    cleaned to business keys."""
    p = load_tables(spark, sf_dir, ("part",))["part"]
    variant = F.col("p_partkey") % 5
    raw = (
        F.when(variant == 0, F.concat(F.lit("  "), F.lower("p_brand"), F.lit("\t")))
        .when(variant == 1, F.col("p_brand"))
        .when(variant == 2, F.lit(None).cast("string"))
        .when(variant == 3, F.concat(F.lit("\u00a0\u2003"), F.col("p_brand"), F.lit("\x1c\x85\u3000")))
        .otherwise(F.concat(F.lit("\n"), F.upper("p_brand"), F.lit(" \r")))
    )
    return p.select("p_partkey", raw.alias("raw_brand")).select(
        "p_partkey", "raw_brand", clean_bk("raw_brand").alias("brand_bk")
    )


def price_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price texts of every line item (amount + currency, the ``'null'``
    marker, SQL nulls and junk) split into amount and currency."""
    li = load_tables(spark, sf_dir, ("lineitem",))["lineitem"]
    amount = F.floor("l_extendedprice").cast("bigint").cast("string")
    text = (
        F.when(F.col("l_linenumber") == 7, F.lit("null"))
        .when(F.col("l_tax") == 0, F.lit(None).cast("string"))
        .when(F.col("l_linenumber") == 6, F.concat(F.lit("n/a "), F.col("l_returnflag"), F.lit("EUR")))
        .when(F.col("l_linenumber") == 5, F.concat(F.lit(" "), amount, F.lit(" USD")))
        .when(F.col("l_linenumber") == 4, F.lit("EUR"))
        .otherwise(F.concat(amount, F.lit(" CHF")))
    )
    rows = li.select("l_orderkey", "l_linenumber", text.alias("price_text")).where(has_price("price_text"))
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "price_text",
        price_amount("price_text").alias("drug_price"),
        price_currency("price_text").alias("drug_price_currency"),
    )


# ---------------------------------------------------------------- dimensions


def dim_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.dim_country(driver_sources(spark, sf_dir).countries).drop("country_id")


def dim_indication(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.dim_indication(driver_sources(spark, sf_dir).indication).drop("indication_id")


def dim_factory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.dim_factory(driver_sources(spark, sf_dir).factories).drop("factory_id")


def dim_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = driver_sources(spark, sf_dir)
    return D.dim_response(src.responses, src.dictionary).drop("response_id")


def dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _star(spark, sf_dir).product.drop("product_id")


def dim_factory_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factories where a later file replaces what an earlier one says."""
    return D.dim_factory(driver_sources(spark, sf_dir).factories, dedupe="latest_source").drop("factory_id")


def dim_calendar_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of the calendar with the number of claims submitted on it.
    Claims are counted per day key first (partial aggregation); what is left
    is at most one row for each day."""
    claims = driver_sources(spark, sf_dir).claim
    per_day = claims.groupBy(date_key("submissiondate").alias("date_id")).agg(
        F.count(F.lit(1)).alias("n_claims")
    )
    days = dim_calendar(spark).join(per_day, "date_id", "left")
    return days.select(
        "date_id", "dt", "date", "year", "month", "day", "quarter", F.coalesce("n_claims", F.lit(0)).alias("n_claims")
    )


# ---------------------------------------------------------------- lookups and facts


def join_role_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration claims with three date roles resolved through one calendar.

    One calendar projection is broadcast once; the three role joins alias
    the same frame, so the planner reuses that broadcast for every role."""
    star = _star(spark, sf_dir)
    # Only the dates are shown: the other lookups count by their repeats.
    claims = weighted_claims(star, (REGISTER,))
    fact = claims.withColumn("time", F.explode(F.sequence(F.lit(1), F.col("weight"))))
    cal = F.broadcast(star.calendar.select("date_id", "year", "quarter"))
    out = fact.select("claimnumber", "submission_date_id", "expectedresponse_date_id", "response_date_id").alias("f")
    roles = (("submission", "submission_date_id"), ("expected", "expectedresponse_date_id"), ("response", "response_date_id"))
    for role, key in roles:
        out = out.join(cal.alias(role), F.col(f"f.{key}") == F.col(f"{role}.date_id"), "left")
    return out.select(
        F.col("f.claimnumber").alias("claimnumber"),
        *[
            c
            for role, _ in roles
            for c in (F.col(f"{role}.year").alias(f"{role}_year"), F.col(f"{role}.quarter").alias(f"{role}_quarter"))
        ],
    )


def join_role_factory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration claims with api, bulk and package factories (unmatched
    roles kept as nulls; a factory code listed twice fans out)."""
    star = _star(spark, sf_dir)
    claims = star.sources.claim.where(F.col("claimtype") == "REGISTER")
    out = role_lookup(
        claims.select(clean_bk("claimnumber").alias("claimnumber"), "factoryapi", "factorybulk", "factorypackage"),
        star.factory,
        roles={r: clean_bk(f"factory{r}") for r in ("api", "bulk", "package")},
        dim_key="factory_bk",
        carry={"factory_name": "factory_{role}_name"},
    )
    return out.select("claimnumber", "factory_api_name", "factory_bulk_name", "factory_package_name")


def asof_factory_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registration claims by their api factory and its licence that was valid on
    the day of submission (null: none was)."""
    claims = driver_sources(spark, sf_dir).claim.where(F.col("claimtype") == REGISTER)
    claims = claims.select(clean_bk("factoryapi").alias("factory"), "submissiondate")
    licences = factory_licences(spark, sf_dir)
    licensed = as_of(claims, licences, key=F.col("factory"), day=F.col("submissiondate"), carry=["licence"])
    return licensed.groupBy("factory", "licence").agg(
        F.count("*").alias("claims"), F.min("submissiondate").alias("first_day"), F.max("submissiondate").alias("last_day")
    )


def fact_registration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registrations(_star(spark, sf_dir))


def registrations(star: Star) -> DataFrame:
    """The registration fact with its keys shown as business keys."""
    f = star.registration(with_attributes=True)
    return f.select(
        "claimnumber",
        "product_bk",
        "indication_bk",
        "factory_api_bk",
        "factory_bulk_bk",
        "factory_package_bk",
        date_of_key("response_date_id").alias("response_date"),
        date_of_key("expectedresponse_date_id").alias("expected_date"),
        date_of_key("submission_date_id").alias("submission_date"),
        "country_bk",
        "response",
    )


def fact_reimbursement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reimbursements(_star(spark, sf_dir))


def reimbursements(star: Star) -> DataFrame:
    """The reimbursement fact with its keys shown as business keys."""
    f = star.reimbursement(with_attributes=True)
    return f.select(
        "claimnumber",
        "product_bk",
        "reimbursement_claimed_prc",
        "reimbursement_app_prc",
        "indication_bk",
        date_of_key("response_date_id").alias("response_date"),
        date_of_key("expectedresponse_date_id").alias("expected_date"),
        date_of_key("submission_date_id").alias("submission_date"),
        "country_bk",
        "response",
        "drug_price",
        "drug_price_currency",
    )


# ---------------------------------------------------------------- questions


def q1_claims_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.q1_claims_per_year(_star(spark, sf_dir))


def q1_sql_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.q1_sql(_star(spark, sf_dir), S.REIMB)


def q2a_on_time_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.q2a_on_time_share(_star(spark, sf_dir))


def q2a_sql_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.q2_sql(_star(spark, sf_dir), S.REIMB)


def q2b_share_as_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.q2b_share(_star(spark, sf_dir), denominator="reimbursement")


def q2b_share_own_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.q2b_share(_star(spark, sf_dir), denominator="registration")


def q2b_sql_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.q2_sql(_star(spark, sf_dir), S.REG)


def q3_top_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.q3_top_price(_star(spark, sf_dir), Q3_COUNTRIES, Q3_YEAR, Q3_QUARTER)


def q3_sql_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.q3_sql(_star(spark, sf_dir), Q3_COUNTRIES, Q3_YEAR, Q3_QUARTER)


def q4a_top_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.q4_top(_star(spark, sf_dir), Q4_COUNTRY, Q4_START, Q4_END, measure="price_over_pct")


def q4a_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.q4_sql(
        _star(spark, sf_dir), Q4_COUNTRY, Q4_START, Q4_END,
        "try_divide(price, pct)",
    )


def q4b_top_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.q4_top(_star(spark, sf_dir), Q4_COUNTRY, Q4_START, Q4_END, measure="pct")


def sql_view_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4.b as SQL text over the star's temp views; its keys are cleaned by
    ``format_bk``, an inlined SQL function."""
    return S.q4_sql(_star(spark, sf_dir), Q4_COUNTRY, Q4_START, Q4_END, "pct")


def q4_amount_granted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The highest amount granted (price times percentage) of approved claims."""
    return Q.q4_top(
        _star(spark, sf_dir), Q4_COUNTRY, Q4_START, Q4_END, measure="price_times_pct", approved_only=True
    )


def star_written_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 on the star as it is built and written."""
    return Q.q3_top_price(materialize(_star(spark, sf_dir)), Q3_COUNTRIES, Q3_YEAR, Q3_QUARTER)


def star_written_q4a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4.a on the star as it is built and written."""
    star = materialize(_star(spark, sf_dir))
    return Q.q4_top(star, Q4_COUNTRY, Q4_START, Q4_END, measure="price_over_pct")


def star_clustered_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 on the reimbursement fact clustered by response date and country."""
    return Q.q3_top_price(cluster(materialize(_star(spark, sf_dir))), Q3_COUNTRIES, Q3_YEAR, Q3_QUARTER)


def prices_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approved offers answered in one quarter by country and currency; the
    claims pass a runtime filter of the quarter's responses before they are shuffled."""
    return Q.prices_by_country(_star(spark, sf_dir), Q3_YEAR, Q3_QUARTER)


def key_map_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense ids of the products: all known families' products are numbered,
    then the whole dimension. Number of ids, lowest, highest, and how many of the
    first ones are unchanged."""
    keys = KeyMap(spark, shared_dir(spark, "keys"))
    products = _star(spark, sf_dir).product
    first = keys.extend(products.where("product_family_name IS NOT NULL").select("product_id"))
    now = keys.extend(products.select("product_id"))
    both = now.join(first.withColumnRenamed("id", "was"), "key", "left")
    return both.agg(
        F.count_distinct("id").alias("ids"), F.min("id").alias("lowest"), F.max("id").alias("highest"),
        F.count_if(F.col("id") == F.col("was")).alias("unchanged"),
    )


def _bucketed_star(spark: SparkSession, sf_dir: str) -> Star:
    star = _star(spark, sf_dir)
    return answered_star(star, write_answered(star))


def star_bucketed_q2a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2.a on claims and responses that are stored co-bucketed."""
    return Q.q2a_on_time_share(_bucketed_star(spark, sf_dir))


def star_bucketed_q4a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4.a on claims and responses that are stored co-bucketed."""
    return Q.q4_top(_bucketed_star(spark, sf_dir), Q4_COUNTRY, Q4_START, Q4_END, measure="price_over_pct")


def _store(spark: SparkSession, sf_dir: str) -> StarStore:
    """A fresh store with a bucket for each million claims."""
    claims = load_tables(spark, sf_dir)["lineitem"].count()
    return StarStore(spark, shared_dir(spark, "store"), buckets=max(8, claims // 1_000_000))


def star_version_q3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 on a published version of the star, opened through its manifest."""
    store = _store(spark, sf_dir)
    store.build(driver_sources(spark, sf_dir))
    manifest, _ = store.pin()
    return Q.q3_top_price(store.star(manifest), Q3_COUNTRIES, Q3_YEAR, Q3_QUARTER)


def star_changes_reimbursement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reimbursement fact of a star that was built from the sources as they
    stood at first and brought up to date by three change sets."""
    store = _store(spark, sf_dir)
    first, changes = history(spark, sf_dir)
    store.build(first)
    for change in changes:
        store.apply(Changes(**change))
    return reimbursements(store.star())


# ---------------------------------------------------------------- builds as SQL text


def dim_product_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.dim_product_sql(_star(spark, sf_dir))


def dim_response_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.dim_response_sql(_star(spark, sf_dir))


def fact_registration_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.fact_registration_sql(_star(spark, sf_dir))


def fact_reimbursement_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.fact_reimbursement_sql(_star(spark, sf_dir))


# ---------------------------------------------------------------- data quality


def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary keys of the four relational sources: duplicated or null keys."""
    src = driver_sources(spark, sf_dir)
    checks = [
        ("claim", src.claim, "claimnumber"),
        ("drugproduct", src.drugproduct, "drugproductid"),
        ("drugproductfamily", src.drugproductfamily, "drugproductfamilyid"),
        ("indication", src.indication, "indicationid"),
    ]
    return union_all(
        [
            duplicate_keys(df.select(F.col(k).cast("string").alias("key")), ["key"]).select(
                F.lit(name).alias("source"), "key", "n_rows"
            )
            for name, df, k in checks
        ]
    )


def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foreign keys (on cleaned business keys): claim to product and claim to
    indication (one pass over the claims), product to family."""
    src = driver_sources(spark, sf_dir)
    claim_checks = orphans_by_key(
        src.claim,
        [
            ("claim.productcodeid", clean_bk("productcodeid"), src.drugproduct, clean_bk("drugproductid")),
            ("claim.indicationid", clean_bk("indicationid"), src.indication, clean_bk("indicationid")),
        ],
    )
    family_check = orphans(
        src.drugproduct,
        src.drugproductfamily,
        child_key=F.col("drugproductfamilyid").cast("string"),
        parent_key=F.col("drugproductfamilyid").cast("string"),
        key_name="key",
    ).select(F.lit("drugproduct.drugproductfamilyid").alias("foreign_key"), "key", "n_rows")
    return union_all([claim_checks, family_check])


def dq_nearest_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of claims that no product carries, with their claims, and
    the nearest product code: the first one, how many there are, and the distance."""
    src = driver_sources(spark, sf_dir)
    products = src.drugproduct.select(clean_bk("drugproductid").alias("known"))
    lost = orphans(src.claim, products, child_key=clean_bk("productcodeid"), parent_key=F.col("known"), key_name="key")
    return proposals(lost, products, code="key", known="known")


def dq_fanout_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business keys held by more than one row of a lookup dimension (each
    such key multiplies the fact rows that look it up)."""
    star = build_star(spark, driver_sources(spark, sf_dir), check_small_dims=False)
    checks = [
        ("country", star.country, "country_bk"),
        ("factory", star.factory, "factory_bk"),
        ("indication", star.indication, "indication_bk"),
        ("product", star.product, "product_bk"),
        ("response", star.response, "response_bk"),
    ]
    return union_all(
        [
            duplicate_keys(df.select(clean_bk(k).alias("key")), ["key"]).select(
                F.lit(name).alias("dimension"), "key", "n_rows"
            )
            for name, df, k in checks
        ]
    )


def dq_key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and distinct surrogate ids of each dimension: as many ids as
    there are distinct raw rows, or two rows share an id."""
    star = build_star(spark, driver_sources(spark, sf_dir), check_small_dims=False)
    return union_all(
        [
            getattr(star, name)
            .select(F.col(f"{name}_id").alias("id"))
            .groupBy("id")
            .agg(F.count("*").alias("n"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_ids"))
            .select(F.lit(name).alias("dimension"), "n_rows", "n_ids")
            for name in ("country", "factory", "indication", "product", "response")
        ]
    )


def dq_unparsable_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response dates that are given but are no dates, with their row counts."""
    rows = D.response_rows(driver_sources(spark, sf_dir).responses)
    bad = rows.where(F.col("response_date").isNotNull() & parse_date("response_date").isNull())
    return bad.groupBy("response_date").agg(F.count("*").alias("n_rows"))


def dq_unmapped_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response codes the dictionary does not know, with their row counts."""
    src = driver_sources(spark, sf_dir)
    rows = D.response_rows(src.responses)
    return unmapped_codes(rows, src.dictionary, code="response")


CATALOGUE: dict[str, Query] = {
    "src_delimited_roundtrip": src_delimited_roundtrip,
    "src_files_factory": src_files_factory,
    "src_files_response": src_files_response,
    "src_quarantine": src_quarantine,
    "src_union_all": src_union_all,
    "src_union_distinct": src_union_distinct,
    "bk_clean": bk_clean,
    "price_parse": price_parse,
    "dim_country": dim_country,
    "dim_indication": dim_indication,
    "dim_factory": dim_factory,
    "dim_factory_latest": dim_factory_latest,
    "dim_response": dim_response,
    "dim_product": dim_product,
    "dim_calendar": dim_calendar_q,
    "join_role_calendar": join_role_calendar,
    "join_role_factory": join_role_factory,
    "asof_factory_licences": asof_factory_licences,
    "fact_registration": fact_registration,
    "fact_reimbursement": fact_reimbursement,
    "q1_claims_per_year": q1_claims_per_year,
    "q1_sql_twin": q1_sql_twin,
    "q2a_on_time_share": q2a_on_time_share,
    "q2a_sql_twin": q2a_sql_twin,
    "q2b_share_as_reference": q2b_share_as_reference,
    "q2b_share_own_total": q2b_share_own_total,
    "q2b_sql_twin": q2b_sql_twin,
    "q3_top_price": q3_top_price,
    "q3_sql_twin": q3_sql_twin,
    "q4a_top_amount": q4a_top_amount,
    "q4a_sql": q4a_sql,
    "q4b_top_percent": q4b_top_percent,
    "sql_view_question": sql_view_question,
    "q4_amount_granted": q4_amount_granted,
    "star_written_q3": star_written_q3,
    "star_written_q4a": star_written_q4a,
    "star_clustered_q3": star_clustered_q3,
    "prices_by_country": prices_by_country,
    "key_map_products": key_map_products,
    "star_bucketed_q2a": star_bucketed_q2a,
    "star_bucketed_q4a": star_bucketed_q4a,
    "star_version_q3": star_version_q3,
    "star_changes_reimbursement": star_changes_reimbursement,
    "dim_product_sql": dim_product_sql,
    "dim_response_sql": dim_response_sql,
    "fact_registration_sql": fact_registration_sql,
    "fact_reimbursement_sql": fact_reimbursement_sql,
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_orphans": dq_orphans,
    "dq_nearest_products": dq_nearest_products,
    "dq_fanout_guard": dq_fanout_guard,
    "dq_unmapped_codes": dq_unmapped_codes,
    "dq_key_collisions": dq_key_collisions,
    "dq_unparsable_dates": dq_unparsable_dates,
}
