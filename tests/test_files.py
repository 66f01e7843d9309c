import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablework import workspace
from tablework.sinks import files as sinks
from tablework.sinks import tables
from tablework.sources import badrecords, files, generate


@pytest.fixture
def path(spark):
    return workspace.new_path(spark, "test")


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(1, 'say "hi", twice\nand\\again', "2024-01-01 00:00:00.000001"), (2, None, None), (3, "-", "1969-12-31 23:59:59.999999")]
    return spark.createDataFrame(rows, "id int, text string, at string").withColumn(
        "at", F.col("at").cast("timestamp_ntz")
    )


def test_csv_keeps_quotes_breaks_and_microseconds(spark, awkward, path, rows_of):
    sinks.write_csv(awkward, path)
    assert rows_of(files.read_csv(spark, path, awkward.schema, multiLine="true")) == rows_of(awkward)


def test_json_keeps_quotes_breaks_and_microseconds(spark, awkward, path, rows_of):
    sinks.write_json(awkward, path)
    assert rows_of(files.read_json(spark, path, awkward.schema)) == rows_of(awkward)


def test_json_arrays_lie_in_several_files(spark, path, rows_of):
    df = spark.range(1000).withColumn("text", F.lit('a "b"\nc'))
    sinks.write_json_arrays(df, path, rows_per_file=100)
    assert files.file_sizes(spark, path, ".txt").count() == 10
    assert rows_of(files.read_json(spark, path, df.schema, multiLine="true")) == rows_of(df)


def test_nothing_becomes_no_array(spark, path):
    df = spark.range(0)
    sinks.write_json_arrays(df, path)
    assert files.read_json(spark, path, "id bigint", multiLine="true").count() == 0


def test_inferred_types(spark, path):
    sinks.write_csv(spark.range(5).select("id", (F.col("id") / 2).alias("half"), F.lit("x").alias("s")), path)
    assert dict(files.read_csv_inferred(spark, path).dtypes) == {"id": "int", "half": "double", "s": "string"}


def test_short_and_unreadable_fields_are_null(spark, path):
    spark.createDataFrame([("1,a",), ("x,b,2.5",), ("",)], "value string").write.text(path)
    rows = files.read_fields(spark, path, {"id": "int", "name": "string", "v": "double"})
    assert {tuple(row) for row in rows.collect()} == {(1, "a", None), (None, "b", 2.5), (None, None, None)}


def test_missing_path_gives_an_empty_table(spark, path):
    rows = files.read_or_empty(spark, path, "id int, name string")
    assert rows.count() == 0 and rows.columns == ["id", "name"]


def test_file_count_and_size(spark, path):
    df = spark.range(1000).repartition(7)
    sinks.write_sized(df, f"{path}/sized", rows_per_file=300)
    assert 4 <= files.file_sizes(spark, f"{path}/sized", ".parquet").count() <= 5
    sinks.write_files(df, f"{path}/three", 3)
    assert files.file_sizes(spark, f"{path}/three", ".parquet").count() == 3


def test_folders_per_value(spark, path):
    df = spark.range(600).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("part"))
    sinks.write_partitioned(df, path, ["part"])
    found = files.file_sizes(spark, path, ".parquet").select("path").collect()
    folders = {row["path"].rsplit("/", 2)[1] for row in found}
    assert folders == {"part=1", "part=2", "part=__HIVE_DEFAULT_PARTITION__"}
    assert len(found) == 3
    assert spark.read.schema(df.schema).parquet(path).exceptAll(df).count() == 0


def test_overwriting_replaces_and_appending_adds(spark, path):
    sinks.write_csv(spark.range(4), path)
    sinks.write_csv(spark.range(2), path, mode="overwrite")
    sinks.write_csv(spark.range(3), path, mode="append")
    sinks.write_csv(spark.range(9), path, mode="ignore")
    assert files.read_csv(spark, path, "id bigint").count() == 5
    with pytest.raises(AnalysisException):
        sinks.write_csv(spark.range(1), path)


@pytest.fixture(scope="module")
def dirty(spark):
    path = workspace.new_path(spark, "dirty")
    lines = ["id,name,v", "1,a,1.5", "BAD,x", "3,c,oops", "4,d,2.5"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    return path


SCHEMA = "id int, name string, v double"


def test_permissive_keeps_the_line(spark, dirty):
    rows = badrecords.read_permissive(spark, dirty, SCHEMA)
    bad = rows.filter(F.col(badrecords.CORRUPT).isNotNull())
    assert {row[badrecords.CORRUPT] for row in bad.collect()} == {"BAD,x", "3,c,oops"}
    assert bad.count() == 2 and rows.count() == 4
    good = rows.filter(F.col(badrecords.CORRUPT).isNull())
    assert sorted(row["id"] for row in good.select("id").collect()) == [1, 4]


def test_dropping_counts_right_whatever_is_read(spark, dirty):
    rows = badrecords.read_dropping(spark, dirty, SCHEMA)
    assert rows.count() == 2
    assert sorted(row["id"] for row in rows.select("id").collect()) == [1, 4]


def test_gate_rejects_bad_records_only(spark, dirty, path):
    assert badrecords.gate(spark, dirty, SCHEMA) == ("rejected", None)
    one_bad_value = f"{path}-value"
    spark.createDataFrame([("1,a,x",)], "value string").write.text(one_bad_value)
    assert badrecords.gate(spark, one_bad_value, SCHEMA, header=False) == ("rejected", None)
    sinks.write_csv(spark.range(3), path)
    assert badrecords.gate(spark, path, "id bigint") == ("accepted", 3)
    with pytest.raises(AnalysisException):
        badrecords.gate(spark, f"{path}-missing", SCHEMA)


def test_quarantine_keeps_every_line(spark, dirty, path):
    good, bad = badrecords.quarantine(badrecords.read_permissive(spark, dirty, SCHEMA), path)
    assert good.columns == ["id", "name", "v"]
    assert sorted(row["id"] for row in good.collect()) == [1, 4]
    assert bad.count() == 2


def test_dropping_a_table_deletes_only_its_own_files(spark, path):
    database = workspace.new_name("drops")
    tables.create_database(spark, database, f"{path}/db")
    df = spark.range(5)
    tables.create_managed(df, f"{database}.owned")
    tables.create_external(spark, f"{database}.linked", df.schema, f"{path}/linked")
    tables.append(df, f"{database}.linked")
    for name in ("owned", "linked"):
        tables.drop_table(spark, f"{database}.{name}")
    assert files.read_any(spark, "parquet", f"{path}/linked").count() == 5
    with pytest.raises(AnalysisException):
        spark.read.parquet(f"{path}/db/owned")


def test_appending_is_checked(spark, path):
    database = workspace.new_name("checked")
    tables.create_database(spark, database, path)
    tables.create_managed(spark.range(2), f"{database}.t")
    with pytest.raises(ValueError):
        tables.append(spark.range(2).withColumn("extra", F.lit(1)), f"{database}.t")


def test_varchar_is_enforced(spark, path):
    database = workspace.new_name("lengths")
    tables.create_database(spark, database, path)
    spark.sql(f"CREATE TABLE {database}.t (id int, name varchar(3)) USING parquet")
    spark.sql(f"INSERT INTO {database}.t VALUES (1, 'abc')")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        spark.sql(f"INSERT INTO {database}.t VALUES (2, 'abcd')")


def test_lookups_are_short(spark):
    assert generate.lookup(spark, [{"a": 1, "b": "x"}], "a int, b string").first()["b"] == "x"
    with pytest.raises(ValueError):
        generate.lookup(spark, [(1,)] * (generate.MAX_LOOKUP_ROWS + 1), "a int")


def test_calendar_has_every_day(spark):
    days = spark.sql("SELECT explode(array(DATE'2024-02-27', DATE'2024-03-02')) AS day")
    assert generate.calendar(days, "day").count() == 5
    assert generate.calendar(days.limit(0), "day").count() == 0


def test_shared_folder_is_the_configured_one(spark, monkeypatch):
    assert workspace.shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    first, second = (workspace.new_path(spark, "x") for _ in range(2))
    assert first != second and first.startswith(workspace.shared_root(spark))


def test_checkpointed_rows_do_not_depend_on_their_source(spark):
    kept = workspace.checkpointed(spark.range(10).withColumn("r", F.rand()), "rows")
    assert kept.exceptAll(kept).count() == 0 and kept.count() == 10
    assert "Range" not in kept._jdf.queryExecution().toString()


def test_storage_uri_with_and_without_rows(spark):
    for n in (3, 0):
        path = workspace.new_path(spark, "by-uri")
        spark.range(n).write.parquet(path)
        uri = files.storage_uri(spark, path)
        assert uri.startswith("file://") and uri.endswith(path)
        assert files.storage_uri(spark, uri) == uri
        assert files.read_any(spark, "parquet", uri).count() == n
