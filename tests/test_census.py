"""Landed files that do not agree on their columns: every column is kept, a file without a required one is named."""

import gzip

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DecimalType, DoubleType, LongType, StringType, StructField, StructType

from tiermart.plans import silver
from tiermart.sources import census, proxies, readers

SF = "/root/testdata/sf0.001"
FORMATS = ("csv", "json", "parquet")


def land(df, path, fmt):
    if fmt == "csv":
        df.write.options(**readers.CSV_OPTIONS).option("header", True).mode("append").csv(path)
    else:
        getattr(df.write.mode("append"), fmt)(path)


def policies(spark):
    return proxies.policies(spark, SF).drop("fetched_at")


@pytest.mark.parametrize("fmt", FORMATS)
def test_a_file_without_a_required_column_is_named(spark, scratch, fmt):
    df, path = policies(spark), f"{scratch}/p"
    land(df.where("policy_id % 2 = 0").drop("premium").coalesce(1), path, fmt)
    bad = {f.rsplit("/", 1)[1] for f in spark.read.text(path).inputFiles()}
    land(df.where("policy_id % 2 = 1").coalesce(1), path, fmt)
    with pytest.raises(ValueError, match=r"Missing required columns: \['premium'\]") as raised:
        readers.landed(spark, "policies", path, fmt)
    files = {f.rsplit("/", 1)[1] for f in spark.read.text(path).inputFiles()}
    assert len(files) == 2 and [f for f in files if f in str(raised.value)] == list(bad)


@pytest.mark.parametrize("fmt", FORMATS)
def test_columns_of_all_files_are_kept(spark, scratch, fmt):
    df, path = policies(spark), f"{scratch}/p"
    three = [df.where(F.pmod("policy_id", F.lit(3)) == k).coalesce(2) for k in range(3)]
    land(three[0], path, fmt)
    land(three[1].select(*reversed(df.columns)).drop("deductible"), path, fmt)
    land(three[2].select(F.lit("n, \"1\"").alias("note"), *df.columns).withColumn("score", F.lit(1.5)), path, fmt)
    got = readers.ingest(readers.landed(spark, "policies", path, fmt), "policies", "x")
    assert sorted(got.columns) == sorted([*df.columns, "note", "score", "fetched_at"])
    third = F.pmod("policy_id", F.lit(3))
    want = df.withColumn("deductible", F.when(third != 1, F.col("deductible"))).withColumn(
        "note", F.when(third == 2, F.lit("n, \"1\""))).withColumn("score", F.when(third == 2, F.lit(1.5).cast("string" if fmt == "csv" else "double")))
    have = got.select(want.columns)
    assert have.exceptAll(want).isEmpty() and want.exceptAll(have).isEmpty()


@pytest.mark.parametrize("fmt", FORMATS)
def test_null_is_not_absent(spark, scratch, fmt):
    df, path = policies(spark), f"{scratch}/p"
    null = df.withColumn("premium", F.lit(None).cast("double")).coalesce(1)
    if fmt == "json":
        null.write.option("ignoreNullFields", False).mode("append").json(path)
    else:
        land(null, path, fmt)
    land(df.limit(5).coalesce(1), path, fmt)
    got = readers.ingest(readers.landed(spark, "policies", path, fmt), "policies", "x")
    assert got.where("premium is null").count() == df.count() and got.schema["premium"].dataType == DoubleType()


def test_healthy_parquet_files_are_told_by_their_footers(spark, scratch):
    """The question is pushed to the scan; no row of a file that has the columns comes out of it."""
    path = f"{scratch}/p"
    policies(spark).coalesce(1).write.parquet(path)
    missing = census.parquet_missing(spark, path, ["policy_id", "premium"], census.parquet_schema(spark, path))
    plan = missing._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(EqualTo(policy_id,-9223372036854775807),EqualTo(premium,-1.7123456789E308))]" in plan
    assert missing.count() == 0


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz",
                                  "string", "decimal(12,2)", "boolean", "array<int>"])
def test_every_type_is_told_absent(spark, scratch, kind):
    path = f"{scratch}/t"
    spark.range(3).select("id", F.lit(None).cast(kind).alias("v")).coalesce(1).write.mode("append").parquet(path)
    spark.range(3).coalesce(1).write.mode("append").parquet(path)
    found = census.parquet_missing(spark, path, ["v", "id", "nowhere"], census.parquet_schema(spark, path)).collect()
    assert sorted(r["column"] for r in found) == ["nowhere", "nowhere", "v"]
    with pytest.raises(ValueError, match="nowhere"):
        census.require(census.parquet_missing(spark, path, ["nowhere"], census.parquet_schema(spark, path)))


def test_parquet_types_that_do_not_fit_raise(spark, scratch):
    path = f"{scratch}/t"
    spark.range(3).write.mode("append").parquet(path)
    spark.range(3).select(F.col("id").cast("string")).write.mode("append").parquet(path)
    with pytest.raises(Exception, match="id"):
        readers.landed(spark, "policies", path, "parquet")


def test_files_without_rows_say_nothing(spark, scratch):
    df = policies(spark)
    for fmt in FORMATS:
        path = f"{scratch}/{fmt}"
        land(df.coalesce(1), path, fmt)
        if fmt != "csv":  # an empty CSV file has no header
            land(df.drop("premium").limit(0).coalesce(1), path, fmt)
        else:
            spark.range(0).select(F.lit("").alias("value")).coalesce(1).write.mode("append").text(path)
        assert readers.landed(spark, "policies", path, fmt).count() == df.count()


def test_csv_headers_packed_quoted_long_and_with_a_byte_order_mark(spark, tmp_path):
    wide = ",".join(f"c{i}" for i in range(20_000))
    (tmp_path / "a b.csv").write_text('\n\n"x ""1""\nz",b\n1,2\n')
    (tmp_path / "bom.csv").write_bytes("\ufeffx,b\r\n1,2\r\n".encode())
    (tmp_path / "wide.csv").write_text(wide + "\n" + ",".join("1" * 20_000) + "\n")
    (tmp_path / "empty.csv").write_text("")
    with gzip.open(tmp_path / "packed.csv.gz", "wt") as f:
        f.write("x,b\n5,6\n")
    got = census.csv_headers(spark, str(tmp_path))
    assert {k: [f.rsplit("/", 1)[1] for f in v] for k, v in got.items()} == {
        '"x ""1""\nz",b': ["a b.csv"], "x,b": ["bom.csv", "packed.csv.gz"], wide: ["wide.csv"]}


def test_csv_landing_without_any_file_content(spark, scratch):
    spark.range(0).select(F.lit("").alias("value")).coalesce(1).write.text(f"{scratch}/e")
    got = readers.landed(spark, "claims", f"{scratch}/e", "csv")
    assert got.count() == 0 and "claimed_amount" in got.columns


def test_sparse_json_keeps_declared_columns_as_typed_nulls(spark, scratch):
    claims = proxies.claims(spark, SF).drop("fetched_at")
    path = f"{scratch}/c"
    claims.drop("approved_amount", "description").write.json(path)
    got = readers.ingest(readers.landed(spark, "claims", path, "json"), "claims", "x")
    assert got.schema["approved_amount"].dataType == DoubleType() and got.schema["description"].dataType == StringType()
    cleaned = silver.clean("claims", got, "x")
    assert cleaned.where("approved_amount <> 0 or description is not null").isEmpty() and not cleaned.isEmpty()


def test_json_required_key_must_stand_in_some_record_of_each_file(spark, scratch):
    path = f"{scratch}/j"
    claims = proxies.claims(spark, SF).drop("fetched_at").coalesce(1)
    once = claims.withColumn("status", F.when(F.col("claim_id") == claims.first()["claim_id"], F.lit("A")))
    once.write.json(path)  # the writer leaves nulls out: one record has the key
    assert readers.landed(spark, "claims", path, "json").where("status is null").count() == claims.count() - 1
    claims.drop("status").write.mode("append").json(path)
    with pytest.raises(ValueError, match=r"\['status'\]"):
        readers.landed(spark, "claims", path, "json")


def test_found_fields_join_declared_ones_all_the_way_down():
    declared = StructType([StructField("a", LongType()), StructField("s", StructType([StructField("x", DecimalType(9, 2))])),
                           StructField("l", ArrayType(StructType([StructField("p", LongType())])))])
    found = StructType([StructField("z", BooleanType()), StructField("a", StringType()),
                        StructField("s", StructType([StructField("y", StringType()), StructField("x", DoubleType())])),
                        StructField("l", ArrayType(StructType([StructField("q", DoubleType())])))])
    got = readers.with_found(declared, found)
    assert got.simpleString() == ("struct<a:bigint,s:struct<x:decimal(9,2),y:string>,l:array<struct<p:bigint,q:double>>,z:boolean>")
    assert readers.with_found(LongType(), StructType([])) == LongType()


def test_invalid_json_fails_the_read(spark, scratch):
    path = f"{scratch}/bad"
    claims = proxies.claims(spark, SF).drop("fetched_at").limit(3)
    claims.write.json(path)
    spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(path)
    with pytest.raises(Exception):
        readers.landed(spark, "claims", path, "json").collect()
