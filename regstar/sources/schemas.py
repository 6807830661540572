"""Fixed schemas of the claim sources, so no read needs an inference pass.

Relational tables follow the source database DDL; files are read as text
(every column a string) and cast later, exactly once.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


CLAIM = StructType(
    [
        StructField("ronumber", StringType(), True),
        StructField("productfamily", StringType(), True),
        StructField("countrycode", StringType(), True),
        StructField("submissiondate", DateType(), True),
        StructField("expectedresponsedate", DateType(), True),
        StructField("claimnumber", StringType(), False),
        StructField("productcodeid", StringType(), True),
        StructField("indicationid", StringType(), True),
        StructField("claimtype", StringType(), True),
        StructField("factoryapi", StringType(), True),
        StructField("factorybulk", StringType(), True),
        StructField("factorypackage", StringType(), True),
        StructField("drugprice", StringType(), True),
        StructField("reimbursementprct", ShortType(), True),
    ]
)

DRUGPRODUCT = StructType(
    [
        StructField("drugproductid", StringType(), False),
        StructField("recordstatus", StringType(), True),
        StructField("drugproductname", StringType(), True),
        StructField("ronumber", StringType(), True),
        StructField("drugproductfamilyid", IntegerType(), True),
    ]
)

DRUGPRODUCTFAMILY = StructType(
    [
        StructField("drugproductfamilyid", IntegerType(), False),
        StructField("drugproductfamilyname", StringType(), True),
    ]
)

INDICATION = StructType(
    [
        StructField("indicationid", StringType(), False),
        StructField("recordstatus", StringType(), True),
        StructField("indicationdescription", StringType(), True),
    ]
)

# Delimited files. Header files keep their header names so that a reader
# with ``enforceSchema=false`` can verify the header; headerless files get
# positional names.
COUNTRIES = _strings(
    "English short name (upper/lower case)",
    "Alpha-2 code",
    "Alpha-3 code",
    "Numeric code",
    "Link to ISO 3166-2 subdivision codes",
)
FACTORIES = _strings("code", "name", "country")
RESPONSES = _strings("Claim number", "Response Date", "Response")
RESPONSE_DICTIONARY = _strings("from", "to")

# Positional names used after reading.
COUNTRY_COLUMNS = ("country_name", "alpha_2_code", "alpha_3_code", "numeric_code", "link")
RESPONSE_COLUMNS = ("claim_number", "response_date", "response")


# Driver tables (Parquet). Declared so that opening a table needs no footer
# inference job; a file with other types fails loudly at read time.
def _fields(*spec: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in spec])


_S, _I, _L, _D, _TS = StringType(), IntegerType(), LongType(), DoubleType(), TimestampNTZType()

DRIVER = {
    "region": _fields(("r_regionkey", _I), ("r_name", _S)),
    "nation": _fields(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _fields(
        ("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D), ("c_mktsegment", _S)
    ),
    "supplier": _fields(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _fields(
        ("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S), ("p_size", _I),
        ("p_retailprice", _D),
    ),
    "orders": _fields(
        ("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _D),
        ("o_orderdate", _TS), ("o_orderpriority", _S),
    ),
    "lineitem": _fields(
        ("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L), ("l_linenumber", _I),
        ("l_quantity", _D), ("l_extendedprice", _D), ("l_discount", _D), ("l_tax", _D),
        ("l_returnflag", _S), ("l_linestatus", _S), ("l_shipdate", _TS),
    ),
}
