"""Conformed dimensions: surrogate key + business key + attributes.

Surrogate keys hash the raw source columns of each row (before cleaning or
recoding), because de-duplication runs on raw rows: two raw rows that clean
to the same business key stay two dimension rows with two keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstar.functions import clean_bk, parse_date, surrogate_key
from regstar.operators import latest_source, recode, union_distinct
from regstar.sources.schemas import COUNTRY_COLUMNS, FACTORIES, RESPONSE_COLUMNS


def dim_country(countries: DataFrame) -> DataFrame:
    c = countries.toDF(*COUNTRY_COLUMNS)
    return c.select(
        F.col("alpha_2_code").alias("country_bk"),
        F.col("country_name"),
        surrogate_key("alpha_2_code", "country_name").alias("country_id"),
    )


def _rows(files: list[DataFrame], key: str, dedupe: str) -> DataFrame:
    if dedupe == "latest_source":
        return latest_source(files, clean_bk(key))
    if dedupe != "rows":
        raise ValueError("dedupe is 'rows' or 'latest_source'")
    return union_distinct(files)


def factory_rows(factories: Sequence[DataFrame], dedupe: str = "rows") -> DataFrame:
    """Distinct raw rows of all factory files (code, name, country); with
    ``dedupe='latest_source'`` only those of the last file that lists a code."""
    names = [f.name for f in FACTORIES.fields]
    return _rows([f.toDF(*names) for f in factories], "code", dedupe)


def dim_factory(factories: Sequence[DataFrame], dedupe: str = "rows") -> DataFrame:
    """Grain: a distinct raw (code, name, country) row, not a code. A code
    listed with two names or two countries gives two rows (see
    ``quality.duplicate_keys`` on ``factory_bk``). The code is cleaned after
    de-duplication, so ``'F105 '`` and ``'F105'`` would be two rows."""
    rows = factory_rows(factories, dedupe)
    return rows.select(
        clean_bk("code").alias("factory_bk"),
        F.col("name").alias("factory_name"),
        F.col("country").alias("factory_country"),
        surrogate_key("code", "name", "country").alias("factory_id"),
    )


def dim_indication(indication: DataFrame) -> DataFrame:
    return indication.select(
        F.col("indicationid").alias("indication_bk"),
        F.col("indicationdescription").alias("indication_description"),
        surrogate_key("indicationid", "recordstatus", "indicationdescription").alias("indication_id"),
    )


def response_rows(responses: Sequence[DataFrame], dedupe: str = "rows") -> DataFrame:
    """Distinct raw response rows of all response files; with
    ``dedupe='latest_source'`` only those of the last file that has a claim."""
    return _rows([r.toDF(*RESPONSE_COLUMNS) for r in responses], "claim_number", dedupe)


def dim_response(responses: Sequence[DataFrame], dictionary: DataFrame, dedupe: str = "rows") -> DataFrame:
    """Recoded responses. Grain: a distinct raw response row whose code the
    dictionary knows (unknown codes drop; ``quality.unmapped_codes``).
    The date text is parsed once; unparsable text becomes null."""
    return recoded_responses(response_rows(responses, dedupe), dictionary)


def recoded_responses(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Response dimension of raw rows that are distinct already."""
    coded = recode(rows, dictionary, code="response", out="__recoded")
    return coded.select(
        surrogate_key("claim_number", "response_date", "response").alias("response_id"),
        clean_bk("claim_number").alias("response_bk"),
        parse_date("response_date").alias("response_date"),
        F.col("__recoded").alias("response"),
    )


def dim_product(drugproduct: DataFrame, family: DataFrame) -> DataFrame:
    """Products with their family name (left lookup: a missing family stays null)."""
    fam = family.select(
        F.col("drugproductfamilyid").alias("__fid"), F.col("drugproductfamilyname")
    )
    p = drugproduct.join(fam, F.col("drugproductfamilyid") == F.col("__fid"), "left")
    return p.select(
        surrogate_key(
            "drugproductid", "recordstatus", "drugproductname", "ronumber", "drugproductfamilyid"
        ).alias("product_id"),
        clean_bk("drugproductid").alias("product_bk"),
        F.col("drugproductname").alias("product_name"),
        F.col("drugproductfamilyname").alias("product_family_name"),
    )
