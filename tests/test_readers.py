"""Landed files: columns by the file's own word, standard quoting, nothing cut."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tiermart.operators.clean import apply_spec
from tiermart.operators.frames import java_pattern
from tiermart.plans.silver import SPECS
from tiermart.sources import proxies, readers

SF = "/root/testdata/sf0.001"
AB = StructType([StructField("a", LongType()), StructField("b", StringType())])


def put(spark, path, text):
    spark.createDataFrame([(text.rstrip("\n"),)], "value string").coalesce(1).write.text(path)
    return path


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_csv_columns_go_by_header(spark, scratch):
    path = put(spark, f"{scratch}/f", "b,x,a\nBEE,1.5,7\n")
    assert rows(readers.read_csv(spark, path, AB)) == [{"b": "BEE", "x": "1.5", "a": 7}]


def test_csv_quoting(spark, scratch):
    path = put(spark, f"{scratch}/f", 'a,b\n1,"say ""hi"", ok"\n2,"two\nlines"\n3, padded \n')
    got = rows(readers.read_csv(spark, path, AB, multi_line=True))
    assert got == [{"a": 1, "b": 'say "hi", ok'}, {"a": 2, "b": "two\nlines"}, {"a": 3, "b": " padded "}]


def test_csv_bad_value_and_other_header_fail(spark, scratch):
    with pytest.raises(Exception):
        readers.read_csv(spark, put(spark, f"{scratch}/f", "a,b\nx,y\n"), AB).collect()
    put(spark, f"{scratch}/g/1", "a,b\n1,y\n")
    put(spark, f"{scratch}/g/2", "b,a\ny,1\n")
    with pytest.raises(Exception):
        readers.read_csv(spark, f"{scratch}/g/*", AB).collect()


def test_csv_without_header(spark, scratch):
    path = put(spark, f"{scratch}/f", "1,x\n2,y\n")
    assert rows(readers.read_csv(spark, path, AB, header=False)) == [{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
@pytest.mark.parametrize("table", ["policies", "agents"])
def test_undeclared_columns_stay_and_missing_required_raise(spark, scratch, fmt, table):
    df = proxies.BUILDERS[table](spark, SF).drop("fetched_at")
    required = SPECS[table].required

    def land(name, frame):
        path = f"{scratch}/{name}"
        readers.write_csv(frame, path) if fmt == "csv" else getattr(frame.write, fmt)(path)
        return readers.landed(spark, table, path, fmt)
    wide = readers.ingest(land("wide", df.select(F.lit("e").alias("extra"), *reversed(df.columns))), table, "x")
    assert sorted(wide.columns) == sorted([*df.columns, "extra", "fetched_at"])
    assert {f.name: f.dataType for f in wide.schema if f.name in df.columns} == {f.name: f.dataType for f in df.schema}
    assert wide.where("extra = 'e'").count() == df.count()
    for name in required:
        with pytest.raises(ValueError, match="Missing required columns"):
            readers.ingest(land(f"no_{name}", df.drop(name)), table, "x")


def test_clean_needs_every_column_that_a_rule_names(spark):
    df = proxies.customers(spark, SF)
    with pytest.raises(ValueError, match="phone"):
        apply_spec(df.drop("phone"), SPECS["customers"])
    assert "more" in apply_spec(df.withColumn("more", F.lit(1)), SPECS["customers"]).columns


def test_flatten_takes_any_names(spark):
    df = spark.createDataFrame([(1, (2, (3,)), 4)], "customer_id long, `a.b` struct<c_d: long, `e.f`: struct<g: long>>, h long")
    assert rows(readers.flatten(df, "_")) == [{"customer_id": 1, "a.b_c_d": 2, "a.b_e.f_g": 3, "h": 4}]
    assert rows(readers.flatten(df)) == [{"customer_id": 1, "a.b.c_d": 2, "a.b.e.f.g": 3, "h": 4}]


def test_datetime_patterns(spark):
    assert java_pattern("%F %T") == "yyyy-MM-dd HH:mm:ss"
    assert java_pattern("%d/%m/%y %R") == "dd/MM/yy HH:mm" and java_pattern("%H:%M:%S%.3f") == "HH:mm:ss.SSS"
    assert java_pattern("day %d [it's] 100%%") == "'day 'dd' [it''s] 100%'"
    for bad in ("%Q", "%", "%e", "x%5"):
        with pytest.raises(ValueError, match="directive"):
            java_pattern(bad)
    got = spark.sql("SELECT '2024-02-03T04:05:06' AS t").select(
        F.to_timestamp_ntz("t", F.lit(java_pattern("%Y-%m-%dT%H:%M:%S"))).cast("string").alias("t"))
    assert got.first().t == "2024-02-03 04:05:06"
