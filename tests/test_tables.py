"""Parquet, CSV, table-or-empty, append sink, DDL schema, SQL on a path."""

from pyspark.sql import types as T

from scorebook import schemas
from scorebook.sources.tables import (read_csv, read_table, read_table_or_empty, schema_from_dict,
                                      sql_parquet, write_table)


def test_table_or_empty_and_append(spark, tmp_path):
    path = str(tmp_path / "registry")
    empty = read_table_or_empty(spark, path, schemas.REGISTRY)
    assert empty.count() == 0 and empty.schema == schemas.REGISTRY
    rows = spark.createDataFrame([("1", "A Ann", "p1")], schemas.REGISTRY)
    write_table(rows, path)
    write_table(rows, path)  # append
    assert read_table(spark, path, schemas.REGISTRY).count() == 2
    assert sql_parquet(spark, path).count() == 2


def test_csv_reads_strings(spark, tmp_path):
    p = tmp_path / "people.csv"
    p.write_text("identifier,key_cricinfo,name\np1,11,Ann\np2,,Bob\n")
    df = read_csv(spark, str(p))
    assert all(t == "string" for _, t in df.dtypes)
    assert [tuple(r) for r in df.orderBy("identifier").collect()] == [("p1", "11", "Ann"), ("p2", None, "Bob")]


def test_schema_from_dict(spark):
    s = schema_from_dict(spark, {"match_id": "string", "win margin": "double", "d": "date"})
    assert [f.name for f in s.fields] == ["match_id", "win margin", "d"]
    assert isinstance(s["d"].dataType, T.DateType)
