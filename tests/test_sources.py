"""Sources: delimited files (header, BOM, strictness, NA), JDBC options,
driver tables with declared schemas."""

import pytest
from pyspark.sql import functions as F

from regstar.sources.jdbc import claim_predicates
from regstar.sources import jdbc_options, load_tables, read_delimited, schemas
from tests.conftest import SF_SMALL


def _write(path, text, bom=False):
    with open(path, "wb") as fh:
        if bom:
            fh.write(b"\xef\xbb\xbf")
        fh.write(text.encode("utf-8"))
    return str(path)


def test_tsv_without_header_drops_bom_and_keeps_blanks(spark, tmp_path):
    p1 = _write(tmp_path / "f1.tsv", "F1\tAlpha\tPoland\nF2 \tBeta\tSpain\n", bom=True)
    p2 = _write(tmp_path / "f2.tsv", "F1\tAlpha\tGermany\n")
    df = read_delimited(spark, [p1, p2], schemas.FACTORIES, header=False, sep="\t")
    codes = sorted(r.code for r in df.collect())
    assert codes == ["F1", "F1", "F2 "]  # BOM gone, trailing blank kept


def test_csv_with_header_keeps_na_as_text(spark, tmp_path):
    header = ",".join(f'"{f.name}"' for f in schemas.COUNTRIES.fields)
    p = _write(tmp_path / "c.csv", header + '\n"Nalandia","NA","NAX",901,"ISO 3166-2:NA"\n')
    df = read_delimited(spark, p, schemas.COUNTRIES, header=True).toDF(*schemas.COUNTRY_COLUMNS)
    r = df.collect()[0]
    assert r.alpha_2_code == "NA" and r.country_name == "Nalandia"


def test_strict_mode_rejects_wrong_field_count(spark, tmp_path):
    p = _write(tmp_path / "bad.tsv", "F1\tAlpha\n")
    df = read_delimited(spark, p, schemas.FACTORIES, header=False, sep="\t")
    with pytest.raises(Exception):
        df.collect()
    lenient = read_delimited(spark, p, schemas.FACTORIES, header=False, sep="\t", strict=False)
    assert lenient.collect()[0].country is None


def test_strict_mode_rejects_wrong_header(spark, tmp_path):
    p = _write(tmp_path / "r.csv", '"claim","date","code"\n"C1",2009-06-01,"y"\n')
    with pytest.raises(Exception):
        read_delimited(spark, p, schemas.RESPONSES, header=True).collect()


def test_null_marker_option(spark, tmp_path):
    p = _write(tmp_path / "d.tsv", "y\tApproved\nNULL\tNULL\n")
    plain = read_delimited(spark, p, schemas.RESPONSE_DICTIONARY, header=False, sep="\t")
    assert sorted(r["to"] for r in plain.collect()) == ["Approved", "NULL"]
    marked = read_delimited(spark, p, schemas.RESPONSE_DICTIONARY, header=False, sep="\t", null_value="NULL")
    assert sorted(r["to"] is None for r in marked.collect()) == [False, True]


def test_jdbc_options_partitioned_and_credentials(monkeypatch):
    monkeypatch.setenv("PGUSER", "reader")
    monkeypatch.setenv("PGPASSWORD", "secret")
    o = jdbc_options(
        "jdbc:postgresql://db/x", "public.claim",
        partition_column="id", lower_bound=0, upper_bound=1000, num_partitions=16,
    )
    assert o["user"] == "reader" and o["password"] == "secret"
    assert o["partitionColumn"] == "id" and o["numPartitions"] == "16"
    assert o["lowerBound"] == "0" and o["upperBound"] == "1000"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:postgresql://db/x", "t", partition_column="id")
    plain = jdbc_options("jdbc:postgresql://db/x", "t", user="u", password="p")
    assert "partitionColumn" not in plain and plain["user"] == "u"


def test_driver_tables_use_declared_schemas(spark):
    t = load_tables(spark, SF_SMALL)
    assert dict(t["orders"].dtypes)["o_orderdate"] == "timestamp_ntz"
    assert t["lineitem"].where(F.col("l_returnflag") == "R").count() > 0
    assert set(t) >= {"lineitem", "orders", "customer", "supplier", "part", "nation"}


def test_jdbc_and_file_sources_open_lazily(spark, tmp_path, monkeypatch):
    import regstar.sources.layout as layout
    from regstar.plans.dims import dim_country, dim_factory, dim_response

    header = ",".join(f'"{f.name}"' for f in schemas.COUNTRIES.fields)
    countries = _write(tmp_path / "c.csv", header + '\n"Pelland","PL","PLX",902,"ISO 3166-2:PL"\n')
    f1 = _write(tmp_path / "f1.tsv", "F1\tAlpha\tPoland\n", bom=True)
    f2 = _write(tmp_path / "f2.tsv", "F1\tAlpha\tGermany\n")
    rh = ",".join(f'"{f.name}"' for f in schemas.RESPONSES.fields)
    r1 = _write(tmp_path / "r1.csv", rh + '\n"C1",2009-06-01,"y"\n')
    r2 = _write(tmp_path / "r2.csv", rh + '\n"C1",2009-06-01,"y"\n"C2",2009-07-01,"N"\n')
    dic = _write(tmp_path / "d.tsv", "y\tApproved\nN\tDeclined\n")

    calls = []
    monkeypatch.setattr(layout, "_jdbc", lambda spark, url, table, creds, **part: calls.append((table, part)))
    src = layout.jdbc_and_file_sources(
        spark, jdbc_url="jdbc:postgresql://db/claims", countries=countries, factories=[f1, f2],
        responses=[r1, r2], dictionary=dic, claim_partitions=64,
    )
    assert dim_country(src.countries).collect()[0].country_bk == "PL"
    assert dim_factory(src.factories).count() == 2
    assert sorted(r.response for r in dim_response(src.responses, src.dictionary).collect()) == ["Approved", "Declined"]
    assert calls == []  # no table was opened for file-based dimensions
    src.claim
    assert calls == [("public.claim", {"predicates": claim_predicates(64)})]
    jdbc = jdbc_options("jdbc:postgresql://db/claims", "public.claim", partition_column="submissiondate",
                        lower_bound="1900-01-01", upper_bound="2100-01-01", num_partitions=64)
    assert jdbc["lowerBound"] == "1900-01-01" and jdbc["numPartitions"] == "64"
