"""Readers, dirty input, rerunnable loads, schema evolution."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom import session
from lakeloom.session import scratch_path
from lakeloom.sources import dirty, generators, incremental, readers, writers
from lakeloom.streaming import flows
from tests.conftest import rows


def put(spark, text: str, name: str = "text") -> str:
    path = scratch_path(spark, name)
    spark.createDataFrame([(line,) for line in text.strip().splitlines()], "value string").coalesce(1).write.text(path)
    return path


def test_csv_schema_binds_by_name(spark):
    path = put(spark, "id,city,email\n1,Oslo,a@x\n2,,b@x\nx,Rome,c@x")
    got = readers.read_csv(spark, path, "email string, id int")
    assert got.columns == ["email", "id"]
    assert sorted((r["email"], r["id"]) for r in got.collect() if r["id"]) == [("a@x", 1), ("b@x", 2)]
    assert got.filter("id IS NULL").count() == 1


def test_csv_options(spark):
    path = put(spark, "# note\na|b|c\n 1 |'x|y'|NA\n2|''|3")
    got = readers.read_csv(spark, path, sep="|", quote="'", nullValue="NA", comment="#", ignoreLeadingWhiteSpace=True,
                           ignoreTrailingWhiteSpace=True).orderBy("a").collect()
    assert (got[0]["a"], got[0]["b"], got[0]["c"], got[1]["c"]) == (1, "x|y", None, 3)


def test_csv_multiline_and_nan(spark):
    path = put(spark, 'a,b\n1,"two\nlines"\nnone,x')
    got = readers.read_csv(spark, path, "a double, b string", by_name=False, multiLine=True, nanValue="none").collect()
    assert {r["b"] for r in got} == {"two\nlines", "x"} and sum(r["a"] != r["a"] for r in got) == 1


def test_json_options(spark):
    path = put(spark, "{'a': 007, 'b': NaN /* c */}\n{a: 1, 'b': 2.5}")
    got = readers.read_json(spark, path, "a int, b double", allowSingleQuotes=True, allowNumericLeadingZeros=True,
                            allowNonNumericNumbers=True, allowComments=True, allowUnquotedFieldNames=True)
    assert sorted(r["a"] for r in got.collect()) == [1, 7]
    whole = put(spark, '[{"a": 1},\n {"a": 2}]')
    assert readers.read_json(spark, whole, multiLine=True).count() == 2


def test_read_files_has_metadata(spark):
    path = put(spark, "a,b\n1,2")
    got = readers.read_files(spark, path, "csv")
    assert got.schema["a"].dataType == T.IntegerType()
    assert got.first()["source_file_size"] > 0 and got.first()["load_ts"] is not None


def test_direct_path_query_formats(spark):
    path = put(spark, '{"a": 1}')
    assert readers.query_path(spark, "json", path).first()["a"] == 1
    assert readers.query_path(spark, "csv", path).columns == ["_c0"]


def test_jdbc_options():
    options = readers.jdbc_options("jdbc:x", "orders", "id", 0, 100, 4)
    assert options["numPartitions"] == "4" and options["partitionColumn"] == "id" and options["pushDownPredicate"] == "true"


BAD = "id,day\n1,2024-01-05\n2,NOT_A_DATE\n3,2024-02-01"


def test_parse_modes(spark):
    path = put(spark, BAD)
    read = lambda mode: dirty.read_with_mode(spark, path, "csv", "id int, day date", mode)
    kept = read("PERMISSIVE")
    assert kept.select("id", dirty.CORRUPT).filter(F.col(dirty.CORRUPT).isNotNull()).collect()[0][dirty.CORRUPT] == "2,NOT_A_DATE"
    assert read("DROPMALFORMED").select("id").count() == 2  # judged by all columns, though one is read
    with pytest.raises(Exception, match="malformed|MALFORMED"):
        read("FAILFAST").select("id").collect()


def test_bad_records_path(spark):
    out = scratch_path(spark, "bad")
    good = dirty.split_bad_records(spark, put(spark, BAD), "csv", "id int, day date", out)
    assert good.columns == ["id", "day"] and good.count() == 2
    bad = dirty.read_bad_records(spark, out).collect()
    assert [b["record"] for b in bad] == ["2,NOT_A_DATE"] and bad[0]["path"]


def test_rescue_unparsable_line_and_nested_value(spark):
    lines = spark.createDataFrame([('{"id": 1, "tags": {"a": [1, 2]}}',), ("not json",), ('{"id": "x"}',)], "value string")
    got = {r["id"]: r["_rescued_data"] for r in dirty.rescue_json(lines.filter("value <> 'not json'"), "id int").collect()}
    assert got == {1: '{"tags":"{\\"a\\":[1,2]}"}', None: '{"id":"x"}'}
    assert dirty.rescue_json(lines.filter("value = 'not json'"), "id int").first()["_rescued_data"] == '{"_corrupt_record":"not json"}'


def numbers(spark, a, b):
    return spark.range(a, b).select("id", (F.col("id") * 2).alias("v"))


def test_copy_into_is_idempotent_and_survives_a_crash(spark):
    source, target = scratch_path(spark, "in"), scratch_path(spark, "out")
    numbers(spark, 0, 10).coalesce(1).write.mode("append").json(source)
    assert incremental.copy_into(spark, target, source, "json") == 1
    assert incremental.copy_into(spark, target, source, "json") == -1
    numbers(spark, 50, 60).write.parquet(f"{target}/rows/load_id=2")  # a load that died before its ledger rows
    assert incremental.read_loaded(spark, target).count() == 10
    numbers(spark, 10, 15).withColumn("extra", F.lit("e")).coalesce(1).write.mode("append").json(source)
    assert incremental.copy_into(spark, target, source, "json") == 2
    loaded = incremental.read_loaded(spark, target)
    assert loaded.count() == 15 and loaded.filter("extra IS NULL").count() == 10  # the second load widened the table
    assert incremental.copy_into(spark, target, source, "json", force=True) == 3
    assert incremental.read_loaded(spark, target).count() == 30


def test_copy_into_transforms(spark):
    source, target = scratch_path(spark, "in"), scratch_path(spark, "out")
    numbers(spark, 0, 4).coalesce(1).write.option("header", True).csv(source)
    incremental.copy_into(spark, target, source, "csv", select=["CAST(id AS BIGINT) AS id", "CAST(v AS DOUBLE) / 2 AS half"], pattern="*.csv")
    assert incremental.read_loaded(spark, target).select("id", "half").filter("half = id").count() == 4


def test_once_runs_once(spark):
    target = scratch_path(spark, "once")
    assert incremental.once(spark, target, "a", numbers(spark, 0, 3))
    assert not incremental.once(spark, target, "a", numbers(spark, 0, 3))
    assert incremental.once(spark, target, "b", numbers(spark, 3, 5))
    assert incremental.read_loaded(spark, target).count() == 5


def test_evolution_modes():
    old, seen = T.StructType.fromDDL("a int"), T.StructType.fromDDL("a int, b string")
    assert incremental.evolve(old, seen, "addNewColumns").names == ["a", "b"]
    assert incremental.evolve(old, seen, "none").names == ["a"]
    assert incremental.evolve(old, seen, "rescue").names == ["a"]
    assert incremental.evolve(old, old, "failOnNewColumns").names == ["a"]
    with pytest.raises(incremental.NewColumns):
        incremental.evolve(old, seen, "failOnNewColumns")
    with pytest.raises(ValueError):
        incremental.evolve(old, seen, "guess")


def test_rescue_keeps_new_fields_and_misfits(spark):
    root, state = scratch_path(spark, "in"), scratch_path(spark, "state")
    target = scratch_path(spark, "out")

    def run():
        flows.drain(flows.append_flow(flows.evolving_stream(spark, root, "json", state, "rescue"), target, f"{state}/checkpoint"), 120)

    spark.createDataFrame([(1, 2)], "id bigint, n bigint").write.mode("append").json(root)
    run()
    spark.createDataFrame([(2, "many", "e")], "id bigint, n string, extra string").write.mode("append").json(root)
    spark.createDataFrame([("no json",)], "value string").write.mode("append").text(root)
    run()
    got = {(r["id"], r["n"], r["_rescued_data"]) for r in spark.read.schema("id bigint, n bigint, _rescued_data string").parquet(target).collect()}
    assert got == {(1, 2, None), (2, None, '{"n":"many","extra":"e"}'), (None, None, '{"_corrupt_record":"no json"}')}
    with pytest.raises(ValueError):
        flows.evolving_stream(spark, root, "csv", scratch_path(spark, "s"), "rescue")


def test_loads_with_other_types_stay_readable(spark):
    target = scratch_path(spark, "typed")
    for n, (price, tag) in enumerate(((1, 7), (1.5, 8), (2, "x"))):
        source = scratch_path(spark, "in")
        spark.createDataFrame([(n, price, tag)], ["id", "price", "tag"]).write.json(source)
        assert incremental.copy_into(spark, target, source, "json") == n + 1
    got = incremental.read_loaded(spark, target)
    assert dict(got.dtypes)["price"] == "double" and dict(got.dtypes)["tag"] == "string"
    assert sorted((r["id"], r["price"], r["tag"]) for r in got.collect()) == [(0, 1.0, "7"), (1, 1.5, "8"), (2, 2.0, "x")]


def test_csv_by_name_with_differing_headers(spark):
    path = scratch_path(spark, "headers")
    spark.createDataFrame([(1, 2)], "id int, qty int").write.option("header", True).mode("append").csv(path)
    spark.createDataFrame([(20, 10)], "qty int, id int").write.option("header", True).mode("append").csv(path)
    got = readers.read_csv(spark, path, "id int, qty int").collect()
    assert sorted((r["id"], r["qty"]) for r in got) == [(1, 2), (10, 20)]
    with pytest.raises(Exception):
        readers.read_csv(spark, path, "id boolean", mode="FAILFAST").collect()


def test_schema_store(spark):
    source, where = scratch_path(spark, "in"), scratch_path(spark, "schema")
    numbers(spark, 0, 3).select("id").write.json(source)
    assert incremental.refresh_schema(spark, source, "json", where).names == ["id"]
    assert incremental.refresh_schema(spark, source, "json", where).names == ["id"]
    numbers(spark, 3, 5).write.mode("append").json(source)
    assert incremental.refresh_schema(spark, source, "json", where).names == ["id", "v"]
    text = incremental.refresh_schema(spark, source, "json", scratch_path(spark, "s2"), infer_types=False)
    assert {f.dataType for f in text} == {T.StringType()}


def test_bronze_ingest_counts(spark):
    source, target = scratch_path(spark, "in"), scratch_path(spark, "bronze")
    numbers(spark, 0, 7).write.json(source)
    for _ in range(2):
        loaded = writers.ingest_to_bronze(spark, {"n": ("json", source)}, target)
    assert loaded["n"].count() == 7 and {"_source_file", "_ingestion_timestamp"} <= set(loaded["n"].columns)


def test_managed_table_loses_files_and_external_keeps_them(spark):
    db = writers.create_database(spark)
    location = spark.sql(f"DESCRIBE DATABASE {db}").filter("info_name = 'Location'").first()["info_value"]
    writers.save_managed(numbers(spark, 0, 3), f"{db}.m")
    spark.sql(f"DROP TABLE {db}.m")
    assert not incremental.path_exists(spark, f"{location}/m")


def test_random_batches_split_all_rows(spark):
    parts = generators.random_batches(numbers(spark, 0, 500), [0.2, 0.8])
    assert sum(p.count() for p in parts) == 500
    assert rows(generators.fatal_orders(spark.range(1, 1003).select(F.col("id").alias("o_orderkey"))).filter("o_orderkey IS NULL")) == ["(None,)"]


def test_session_helpers(spark):
    assert session.shuffle_partitions(100 << 40) == 819200
    assert session.shuffle_partitions(1) == 200
    assert session.setting(spark, "unset", 7) == 7
    staged = session.stage(numbers(spark, 0, 5))
    assert rows(staged) == rows(numbers(spark, 0, 5))
    where = staged.inputFiles()[0].rsplit("/", 1)[0]
    assert session.drop_staged(spark) >= 1 and not incremental.path_exists(spark, where)
    assert session.drop_staged(spark) == 0
