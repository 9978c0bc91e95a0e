"""Readers, writers, tables and partitions."""

from unittest.mock import MagicMock, call

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lakeloom.operators import columns, joins, partitions, scripts
from lakeloom.session import workspace
from lakeloom.sources import catalog, readers, writers

PEOPLE_JSON = """[
  {"firstName": "Ana", "age": 24,
   "address": {"city": "Nis", "state": "RS"},
   "phones": [{"type": "home", "number": "1"}, {"type": "work", "number": "2"}]},
  {"firstName": "Bo", "age": 34, "address": {"city": "Ub", "state": "RS"}, "phones": []}
]"""


def test_multiline_json_is_nested(spark, tmp_path, rows):
    (tmp_path / "people.json").write_text(PEOPLE_JSON)
    df = readers.read_json(spark, str(tmp_path), multiline=True)
    assert rows(df.select("firstName", "address.city", F.size("phones"), F.col("phones.number"))) == [
        ("Ana", "Nis", 2, ["1", "2"]), ("Bo", "Ub", 0, [])]


def test_json_lines_inferred_and_with_schema(spark, tmp_path, rows):
    (tmp_path / "p.json").write_text('{"name": "Ana", "age": 24}\n{"name": "Bo"}\n')
    assert readers.read_json(spark, str(tmp_path)).dtypes == [("age", "bigint"), ("name", "string")]
    assert rows(readers.read_json(spark, str(tmp_path), schema="name string, age int")) == [("Ana", 24), ("Bo", None)]


def test_csv_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,score\n1,"x, y",2.5\n2,z,\n')
    path = str(tmp_path)
    assert [t for _, t in readers.read_csv(spark, path).dtypes] == ["string"] * 3
    assert [t for _, t in readers.read_csv(spark, path, infer=True).dtypes] == ["int", "string", "double"]
    typed = readers.read_csv(spark, path, schema="id bigint, name string, score float")
    assert typed.first() == Row(id=1, name="x, y", score=2.5)


def test_delimited_lines_are_one_array(spark, tmp_path):
    (tmp_path / "p.txt").write_text("Mira;31;Nurse\n")
    df = readers.read_delimited(spark, str(tmp_path))
    assert df.dtypes == [("fields", "array<string>")]
    assert df.first().fields == ["Mira", "31", "Nurse"]


def test_rows_with_default_given_and_nested_names(spark):
    data = [("oak", 12), ("elm", 7)]
    assert readers.from_rows(spark, data).columns == ["_1", "_2"]
    assert readers.from_rows(spark, data, ["tree", "height"]).columns == ["tree", "height"]
    nested = readers.from_rows(
        spark, [(("Eva", "Lu", "Park"), "", "-1")],
        "name struct<first:string,middle:string,last:string>, id string, pay string")
    assert nested.where("name.last = 'Park'").select(F.col("pay").try_cast("double") * 100).first()[0] == -100


def test_integer_range(spark):
    assert readers.integer_range(spark, 3, 6).collect() == [Row(id=3), Row(id=4), Row(id=5)]


def test_record_kinds(lines, rows):
    countries, people = readers.split_record_kinds(lines(
        "Italy|IT", " Ann|valued|IT ", "Bob|not bad|JA|extra", "junk", "Spain|ES", "Cid|valued|IT"))
    assert rows(countries) == [("Italy", "IT"), ("Spain", "ES")]
    assert rows(joins.people_per_country(countries, people)) == [
        ("Italy", "valued", 2), ("JA - Unkown Country", "not bad", 1)]


def test_lookup_takes_the_last_of_several_names(spark, rows):
    dim = spark.createDataFrame([("IT", "Italia"), ("IT", "Italy")], "code string, name string")
    fact = spark.createDataFrame([("IT",), ("XX",)], "code string")
    assert rows(joins.lookup_or_unknown(fact, dim, "code", "name")) == [
        ("IT", "Italy"), ("XX", "XX - Unkown Country")]


def test_inner_join_of_text_and_number_keys(spark, rows):
    emp = spark.createDataFrame([(1, "7"), (2, "9"), (3, "8"), (4, "x")], "emp_id int, emp_dept string")
    dept = spark.createDataFrame([("Lab", 7), ("Shop", 9), ("Yard", 6)], "dept_name string, dept_id int")
    assert rows(joins.inner_join(emp, dept, "emp_dept", "dept_id", "int")) == [
        (1, "7", "Lab", 7), (2, "9", "Shop", 9)]


def test_generated_measures(spark):
    df = readers.generate_measures(spark, 2000, seed=5)
    assert df.where(~F.col("value").rlike(r"^[a-z]{10},[789]\.[0-9]+,[a-z]{10}$")).count() == 0
    x = F.split("value", ",")[1].cast("double")
    low, high, n = df.agg(F.min(x), F.max(x), F.count_distinct("value")).first()
    assert 7.5 <= low < 7.6 and 9.4 < high < 9.5 and n == 2000
    assert df.collect() == readers.generate_measures(spark, 2000, seed=5).collect()


def test_jdbc_options():
    assert writers.jdbc_options("jdbc:x", "marts.revenue") == {
        "url": "jdbc:x", "dbtable": "marts.revenue", "batchsize": "5000"}
    full = writers.jdbc_options("jdbc:x", "t", "a.Driver", "me", "secret", 2000, 1, truncate=True)
    assert full == {"url": "jdbc:x", "dbtable": "t", "driver": "a.Driver", "user": "me", "password": "secret",
                    "batchsize": "2000", "numPartitions": "1", "truncate": "true"}


def test_jdbc_writer_calls():
    """Without a database: the calls that reach Spark's writer."""
    df = MagicMock()
    options = writers.jdbc_options("jdbc:x", "t", truncate=True)
    writers.write_mart(df, options, "overwrite")
    assert df.mock_calls == call.write.format("jdbc").options(**options).mode("overwrite").save().call_list()


def test_jdbc_batch_carries_its_number(spark, monkeypatch):
    written = []
    monkeypatch.setattr(writers, "write_mart", lambda df, options: written.append((df.collect(), options)))
    writers.write_mart_batch_jdbc({"url": "jdbc:x"})(spark.range(1), 4)
    assert written == [([Row(id=0, batch_id=4)], {"url": "jdbc:x"})]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    write = writers.write_mart_batch(str(tmp_path / "mart"))
    for batch, n in [(0, 3), (1, 2), (1, 2)]:
        write(spark.range(n), batch)
    assert spark.read.parquet(str(tmp_path / "mart")).count() == 5


def test_partitioned_files_and_append(spark, tmp_path, rows):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, p string")
    writers.write_partitioned(df, path, "p")
    writers.write_partitioned(spark.createDataFrame([(3, "y")], "a int, p string"), path, "p")
    # Dynamic overwrite touches only the partitions written.
    assert rows(spark.read.parquet(path)) == [(1, "x"), (3, "y")]


def test_jsonl_append_and_key_values(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    writers.write_jsonl(df, str(tmp_path / "j"))
    writers.write_jsonl(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 4
    writers.write_key_values(df, str(tmp_path / "kv"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "kv")).collect()) == ["a\t1", "b\t"]


def test_insert_keeps_the_sessions_overwrite_mode(spark, rows):
    where = workspace(spark, "cat")
    catalog.create_database(spark, "parts_db", where)
    catalog.create_table(spark, "parts_db.t", {"a": "int", "p": "string"}, "csv", ["p"])
    spark.conf.set(catalog.OVERWRITE_MODE, "static")
    df = spark.createDataFrame([(1, "x"), (2, "y")], "a int, p string")
    catalog.insert_partitioned(df, "parts_db.t")
    catalog.insert_partitioned(df.where("a = 2").withColumn("a", F.lit(9)), "parts_db.t", overwrite=True)
    assert rows(spark.table("parts_db.t")) == [(1, "x"), (9, "y")]
    assert spark.conf.get(catalog.OVERWRITE_MODE) == "static"
    spark.conf.set(catalog.OVERWRITE_MODE, "dynamic")


def test_bad_values_of_a_typed_table_read_as_null(spark, tmp_path, rows):
    (tmp_path / "t.csv").write_text("1,2.5\nx,3.5\n")
    catalog.create_database(spark, "typed_db", workspace(spark, "typed"), use=True)
    catalog.create_delimited_table(spark, "star", {"a": "int", "b": "double"}, str(tmp_path))
    assert rows(spark.table("typed_db.star")) == [(1, 2.5), (None, 3.5)]
    spark.sql("USE default")


def test_quoted_csv_table_is_all_text(spark, tmp_path):
    (tmp_path / "f.csv").write_text('name,number\n"a, b","12"\n')
    catalog.create_database(spark, "quoted_db", workspace(spark, "quoted"))
    catalog.create_csv_table(spark, "quoted_db.f", ["name", "number"], str(tmp_path))
    assert spark.table("quoted_db.f").collect() == [Row(name="a, b", number="12")]


def test_avro_ddl_names_schema():
    ddl = catalog.avro_table_ddl("t", '{"type": "record", "name": "t", "fields": []}')
    assert ddl.startswith("CREATE TABLE t STORED AS AVRO") and '"name": "t"' in ddl


def test_views(spark):
    df = spark.range(3)
    assert catalog.temp_view(df, "v1").count() == 3
    assert catalog.global_view(df, "v2").count() == 3


def test_schema_operators(spark, rows):
    df = spark.createDataFrame([(1, "?", None), (2, "a", 1.5)], "`the id` int, s string, x double")
    assert columns.sanitize_names(df).columns == ["the_id", "s", "x"]
    assert rows(columns.clean(df)) == [(2, "a", 1.5)]
    assert columns.null_counts(columns.sanitize_names(df)).first() == Row(the_id=0, s=0, x=1)
    assert rows(columns.describe_schema(df))[1] == (1, "s", "string", "string", '"string"', True)


def test_pivot_and_back(spark, rows):
    data = [("tea", 70, "north"), ("tea", 5, "east"), ("salt", 12, "north"), ("salt", 30, "south"),
            ("salt", 1, "south")]
    df = spark.createDataFrame(data, "product string, amount int, region string")
    wide = columns.pivot_sum(df, ["product"], "region", ["east", "south", "north"], F.sum("amount"))
    assert rows(wide) == [("salt", None, 31, 12), ("tea", 5, None, 70)]
    assert rows(columns.unpivot_present(wide, ["product"], {"east": "E", "south": "S"}, "region", "total")) == [
        ("salt", "S", 31), ("tea", "E", 5)]


def test_kept_frame_is_released(spark):
    df = spark.range(10).coalesce(2)
    with partitions.kept(df) as cached:
        assert cached.is_cached and cached.count() == 10
    assert not df.is_cached
    assert partitions.partition_sizes(df).count() == 2


def test_user_scripts(lines, rows):
    pairs = scripts.map_lines(
        lines("a b a", "", "b c"), lambda x, n: [(w, n) for w in x.split()], "w string, n int", n=1)
    total = scripts.reduce_groups(
        pairs, "w", lambda g: g.groupby("w", as_index=False)["n"].sum(), "w string, n int")
    assert rows(total) == [("a", 2), ("b", 2), ("c", 1)]


def test_workspace_follows_the_cluster_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert workspace(spark, "x").startswith(root + "/x-")
    assert workspace(spark, "x") != workspace(spark, "x")


def test_approx_distinct_is_close(spark):
    from lakeloom.operators.aggregates import approx_distinct

    df = spark.range(50_000).select((F.col("id") % 20_000).alias("v"))
    assert approx_distinct(df, "v").first().n_distinct == pytest.approx(20_000, rel=0.1)
