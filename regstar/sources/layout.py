"""Sources from the production layout: four relational tables over JDBC and
delimited files (a country list, factory lists, response files, a response
dictionary).

Every source is opened lazily, so building the star touches only what a plan
uses. The claim table, the one that grows with the business, is read in
parallel: ``claim_partitions`` queries, each for a hash bucket of the claim
number, so that parts are even whatever the dates are. The small tables are
read in one query each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from regstar.sources import schemas
from regstar.sources.delimited import read_delimited
from regstar.sources.driver_tables import Sources
from regstar.sources.jdbc import claim_predicates, read_jdbc


def _jdbc(spark: SparkSession, url: str, table: str, creds: dict, **partitioning) -> DataFrame:
    return read_jdbc(spark, url, table, **creds, **partitioning)


def jdbc_and_file_sources(
    spark: SparkSession,
    *,
    jdbc_url: str,
    countries: str,
    factories: Sequence[str],
    responses: Sequence[str],
    dictionary: str,
    table_prefix: str = "public.",
    claim_partitions: int,
    user: str | None = None,
    password: str | None = None,
) -> Sources:
    """Claim-shaped sources read from a database and delimited files.

    ``factories`` and ``responses`` may name several files each; each group
    is read as one scan. Files are read strictly (a wrong field count or a
    wrong header fails the job), with every column as text.
    """
    creds = {"user": user, "password": password}
    def table(name: str, **part):
        return lambda: _jdbc(spark, jdbc_url, f"{table_prefix}{name}", creds, **part)

    return Sources(
        claim=table("claim", predicates=claim_predicates(claim_partitions)),
        drugproduct=table("drugproduct"),
        drugproductfamily=table("drugproductfamily"),
        indication=table("indication"),
        countries=lambda: read_delimited(spark, countries, schemas.COUNTRIES, header=True),
        factories=lambda: [read_delimited(spark, list(factories), schemas.FACTORIES, header=False, sep="\t")],
        responses=lambda: [read_delimited(spark, list(responses), schemas.RESPONSES, header=True)],
        dictionary=lambda: read_delimited(
            spark, dictionary, schemas.RESPONSE_DICTIONARY, header=False, sep="\t"
        ),
    )
