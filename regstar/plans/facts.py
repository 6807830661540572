"""Fact tables: claims of one type with their dimension keys.

Plan shape (per fact): the claim scan is filtered on ``claimtype`` and pruned
to the columns used; date keys are computed, not joined; then come the lookups
whose dimensions grow with the data (response, product: shuffle joins re-planned
by AQE from runtime sizes), then those into small lists (country, indication:
broadcast), and last the factory roles, so that neither the columns of the small
lists nor the extra rows of codes that are not unique are shuffled.

``with_attributes=True`` also carries the business attributes the questions
need (product key and name, response text and date, country code, ...) out of
the same joins, so no question has to join a dimension a second time by id.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstar.functions import clean_bk, date_key, has_price, price_amount, price_currency
from regstar.operators import lookup, may_match, role_lookup
from regstar.plans.star import Star

REGISTRATION_COLUMNS = (
    "claimnumber",
    "product_id",
    "indication_id",
    "factory_api_id",
    "factory_bulk_id",
    "factory_package_id",
    "response_date_id",
    "expectedresponse_date_id",
    "submission_date_id",
    "country_id",
    "response_id",
)

REIMBURSEMENT_COLUMNS = (
    "claimnumber",
    "product_id",
    "reimbursement_claimed_prc",
    "reimbursement_app_prc",
    "indication_id",
    "response_date_id",
    "expectedresponse_date_id",
    "submission_date_id",
    "country_id",
    "response_id",
    "drug_price",
    "drug_price_currency",
)

FACTORY_ROLES = ("api", "bulk", "package")

# Source columns of a claim that no fact has and no lookup after the shared ones reads.
LOOKUP_ONLY = (
    "ronumber", "productfamily", "countrycode", "submissiondate", "expectedresponsedate", "productcodeid", "indicationid",
)

# Business attributes carried with ``with_attributes=True``.
ATTRIBUTE_COLUMNS = (
    "product_bk",
    "product_name",
    "indication_bk",
    "response",
    "response_date",
    "country_bk",
)


def _country(star: Star, f: DataFrame, extra: bool, only: Iterable[str] | None = None) -> DataFrame:
    """Country lookup; with ``only``, an inner one with these countries, which
    so filters the claims before anything is shuffled."""
    dim = star.country if only is None else star.country.where(F.col("country_bk").isin(list(only)))
    return lookup(
        f,
        dim,
        fact_key=clean_bk("countrycode"),
        dim_key=clean_bk("country_bk"),
        carry={"country_id": "country_id", **({"country_bk": "country_bk"} if extra else {})},
        how="left" if only is None else "inner",
        name="country",
    )


def _response(star: Star, f: DataFrame, extra: bool, only: Column | None = None) -> DataFrame:
    """Response lookup and the day of the answer; with ``only``, an inner one
    with the responses that meet this condition. Claims of a star that is
    ``answered`` have the response's columns."""
    if star.answered:
        f = f if only is None else f.where(only)
        f = f if extra else f.drop("response")
        return f.withColumn("response_date_id", date_key("response_date"))
    dim = star.response if only is None else star.response.where(only)
    f = lookup(
        f,
        dim,
        fact_key="claimnumber",
        dim_key="response_bk",
        carry={"response_id": "response_id", "response_date": "response_date", **({"response": "response"} if extra else {})},
        how="left" if only is None else "inner",
        name="response",
    )
    return f.withColumn("response_date_id", date_key("response_date"))


def _indication(star: Star, f: DataFrame, extra: bool) -> DataFrame:
    return lookup(
        f,
        star.indication,
        fact_key=clean_bk("indicationid"),
        dim_key=clean_bk("indication_bk"),
        carry={"indication_id": "indication_id", **({"indication_bk": "indication_bk"} if extra else {})},
        name="indication",
    )


def _product(star: Star, f: DataFrame, extra: bool) -> DataFrame:
    return lookup(
        f,
        star.product,
        fact_key=clean_bk("productcodeid"),
        dim_key="product_bk",
        carry={"product_id": "product_id", **({"product_bk": "product_bk", "product_name": "product_name"} if extra else {})},
        name="product",
    )


def _shared_lookups(star: Star, claims: DataFrame, with_attributes: bool, deal=None) -> DataFrame:
    """Response and product first, while the rows are as narrow as the source's,
    then the small lists (broadcast), whose columns so are never shuffled. The
    source columns that only the lookups read are left out afterwards. ``deal``,
    if given, deals the rows out to writers between the two (see ``StarStore``)."""
    f = _response(star, claims, with_attributes)
    f = _product(star, f, with_attributes)
    f = f if deal is None else deal(f)
    f = _country(star, f, with_attributes)
    f = _indication(star, f, with_attributes)
    return f.drop(*LOOKUP_ONLY)


def offers(star: Star, countries: Iterable[str], answers: Column) -> DataFrame:
    """Priced reimbursement claims of ``countries`` whose response (a row of
    the response dimension) meets ``answers``: product_key, drug_price,
    reimbursement_claimed_prc. The country filter is applied right after the
    claims' scan, then the responses join; the product is not looked up."""
    f = _country(star, _claims(star, (REFUND,)), False, countries)
    f = _response(star, f, False, answers)
    f = _indication(star, f, False)
    return f.select(
        clean_bk("productcodeid").alias("product_key"),
        price_amount("drugprice").alias("drug_price"),
        F.col("reimbursementprct").alias("reimbursement_claimed_prc"),
    )


def answered_prices(star: Star, answers: Column, **bounds) -> DataFrame:
    """Priced reimbursement claims of all countries whose response (a row of the
    response dimension) meets ``answers``: country_bk, drug_price,
    drug_price_currency. The claims that are shuffled to their responses are
    those that pass a runtime filter of the responses' keys (``bounds``: those of
    ``may_match``)."""
    side = star.response.where(answers).select("response_bk")
    claims, side = may_match(_claims(star, (REFUND,)), F.col("claimnumber"), side, "response_bk", **bounds)
    f = lookup(claims, side, fact_key="claimnumber", dim_key="response_bk", carry={}, how="inner", name="response")
    f = _indication(star, _country(star, f, True), False)
    return f.select(
        "country_bk", price_amount("drugprice").alias("drug_price"), price_currency("drugprice").alias("drug_price_currency")
    )


def with_products(star: Star, rows: DataFrame) -> DataFrame:
    """Product attributes of ``rows`` (product_key); unknown products drop."""
    carry = {"product_bk": "product_bk", "product_name": "product_name"}
    return lookup(rows, star.product, fact_key="product_key", dim_key="product_bk", carry=carry, how="inner")


def weighted_claims(star: Star, claimtypes: tuple[str, ...], *, answers: bool = True) -> DataFrame:
    """Claims of the facts of ``claimtypes``, each with ``weight``, the number
    of fact rows it makes: a lookup matters to a count only where its key is
    held by several rows of the dimension, and those keys are a short list.
    With ``answers`` the responses are joined in earnest (response and
    response_date_id); else they too are only counted."""
    f = _claims(star, claimtypes)
    weight = F.lit(1).cast("long")
    keys = {
        "country": clean_bk("countrycode"),
        "indication": clean_bk("indicationid"),
        "product": clean_bk("productcodeid"),
    }
    if not answers and not star.answered:
        keys["response"] = F.col("claimnumber")
    roles = [(name, name, key, None) for name, key in keys.items()]
    if REGISTER in claimtypes:
        register = F.col("claimtype") == REGISTER
        roles += [("factory", f"factory_{r}", clean_bk(f"factory{r}"), register) for r in FACTORY_ROLES]
    lists = star.repeats(dict.fromkeys(name for name, *_ in roles))
    for name, role, key, only in roles:
        many = lists[name].select(
            F.col(f"__{name}_key").alias(f"__{role}_k"), F.col(f"__{name}_n").alias(f"__{role}_times")
        )
        f = f.join(many, key == F.col(f"__{role}_k"), "left").drop(f"__{role}_k")
        times = F.coalesce(f"__{role}_times", F.lit(1))
        weight = weight * (times if only is None else F.when(only, times).otherwise(F.lit(1)))
    cols = ["claimtype", "claimnumber", "submission_date_id", "expectedresponse_date_id", weight.alias("weight")]
    if answers:
        f = _response(star, f, True)
        cols += ["response", "response_date_id"]
    return f.select(*cols)


REGISTER = "REGISTER"
REFUND = "REFUND"


def _fact_rows(claimtype: str) -> Column:
    """Claims that enter a fact: every registration claim; reimbursement
    claims only with a price (neither SQL null nor the ``'null'`` marker)."""
    is_type = F.col("claimtype") == claimtype
    return is_type & has_price("drugprice") if claimtype == REFUND else is_type


def _claims(star: Star, claimtypes: tuple[str, ...]) -> DataFrame:
    """Claim source rows that enter the facts of ``claimtypes`` (filtered
    before any lookup, so the filter reaches the scan), with the cleaned
    claim number and the computed submission and expected date keys."""
    cond = None
    for t in claimtypes:
        cond = _fact_rows(t) if cond is None else (cond | _fact_rows(t))
    c = star.sources.claim.where(cond)
    cleaned = {} if star.answered else {"claimnumber": clean_bk("claimnumber")}
    return c.withColumns(
        {
            **cleaned,
            "expectedresponse_date_id": date_key("expectedresponsedate"),
            "submission_date_id": date_key("submissiondate"),
        }
    )


def claim_lookups(star: Star, claimtypes: tuple[str, ...], *, with_attributes: bool = False, deal=None) -> DataFrame:
    """Claims of ``claimtypes`` with the lookups both facts share (product,
    response, indication, country, date keys). Both facts are finished from
    this frame; ``materialize`` writes it, so the lookups run once."""
    return _shared_lookups(star, _claims(star, claimtypes), with_attributes, deal)


def finish_registration(f: DataFrame, star: Star, *, with_attributes: bool = False) -> DataFrame:
    """Registration fact from shared lookups: the three factory roles
    (fan-out through non-unique factory codes happens here, after every
    shuffle) and the reference columns."""
    f = role_lookup(
        f.where(F.col("claimtype") == REGISTER),
        star.factory,
        roles={role: clean_bk(f"factory{role}") for role in FACTORY_ROLES},
        dim_key="factory_bk",
        carry={"factory_id": "factory_{role}_id", **({"factory_bk": "factory_{role}_bk"} if with_attributes else {})},
    )
    cols = list(REGISTRATION_COLUMNS)
    if with_attributes:
        cols += list(ATTRIBUTE_COLUMNS) + [f"factory_{r}_bk" for r in FACTORY_ROLES]
    return f.select(*cols)


def finish_reimbursement(f: DataFrame, *, with_attributes: bool = False) -> DataFrame:
    """Reimbursement fact from shared lookups: the price split into amount
    and currency, the percentage under its claimed and approved names."""
    f = f.where(_fact_rows(REFUND)).withColumns(
        {
            "drug_price": price_amount("drugprice"),
            "drug_price_currency": price_currency("drugprice"),
            "reimbursement_claimed_prc": F.col("reimbursementprct"),
            "reimbursement_app_prc": F.col("reimbursementprct"),
        }
    )
    cols = list(REIMBURSEMENT_COLUMNS)
    if with_attributes:
        cols += list(ATTRIBUTE_COLUMNS)
    return f.select(*cols)


def registration_fact(star: Star, *, with_attributes: bool = False, deal=None) -> DataFrame:
    """Registration claims: every ``REGISTER`` claim, with product, indication,
    three factory roles, three date roles, country and response keys."""
    f = claim_lookups(star, (REGISTER,), with_attributes=with_attributes, deal=deal)
    return finish_registration(f, star, with_attributes=with_attributes)


def reimbursement_fact(star: Star, *, with_attributes: bool = False, deal=None) -> DataFrame:
    """Reimbursement claims: ``REFUND`` claims with a price, with product,
    indication, three date roles, country and response keys."""
    f = claim_lookups(star, (REFUND,), with_attributes=with_attributes, deal=deal)
    return finish_reimbursement(f, with_attributes=with_attributes)
