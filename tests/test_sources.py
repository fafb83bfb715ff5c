import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.plans import exchanges, explain
from weft.sources import catalog, files, jdbc, scratch, tables
from weft.session import session_builder

PEOPLE = [("Rosa", None), ("Imre", 41), ("Noor", 15), ("Olu", 41), ("Olu", 55)]


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, "name string, age long")


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    left, right = (sorted(map(repr, df.select(columns).collect())) for df in (a, b))
    assert left == right


def test_text_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x y  x\nz x\n\n")
    path = str(tmp_path / "a.txt")
    df = files.read_lines(spark, path)
    assert df.dtypes == [("value", "string")]
    assert [r.value for r in df.collect()] == ["x y  x", "z x", ""]
    assert df.count() == 3
    assert files.read_lines(spark, path, whole=True).first().value == "x y  x\nz x\n\n"
    cells = files.read_lines(spark, path, line_sep=" ").collect()
    assert cells[0].value == "x"
    assert files.read_lines(spark, path, min_partitions=4).rdd.getNumPartitions() == 4
    assert files.read_lines(spark, path, min_partitions=1).rdd.getNumPartitions() == 1


def test_pair_lines(spark, tmp_path):
    df = spark.createDataFrame([("m", 5), (None, 1)], "word string, n long")
    path = str(tmp_path / "out")
    files.pair_lines(df, "word", "n").write.text(path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["(m,5)", "(null,1)"]


@pytest.mark.parametrize("word", ["two\nlines", "one\rmore", "null"])
def test_pair_lines_refuse_unclear_texts(spark, word):
    df = spark.createDataFrame([(word, 5)], "word string, n long")
    with pytest.raises(Exception, match="no place on a line"):
        files.pair_lines(df, "word", "n").collect()


ODD = [" a ", "b\nc", "", None, 'q"u"o', "\\N", "back\\nslash\\\\", "\r\n", ",;", "\t", "null", "é ", "#x", "\\"]


@pytest.mark.parametrize("options", [{}, {"sep": ";", "header": True}])
@pytest.mark.parametrize("columns", [1, 2])
def test_csv_keeps_every_text(spark, options, columns):
    df = spark.createDataFrame([(t,) for t in ODD], "a string").repartition(3)
    if columns == 2:
        df = df.select("a", F.reverse("a").alias("b"))
    same(files.round_trip(df, "csv", **options), df)


def test_csv_refuses_nested_columns(spark):
    with pytest.raises(ValueError, match="cannot hold"):
        files.round_trip(spark.range(1).select(F.array("id").alias("a")), "csv")


@pytest.mark.parametrize(
    "fmt,options",
    [
        (None, {}),
        ("parquet", {}),
        ("json", {}),
        ("orc", {"orc.bloom.filter.columns": "name", "orc.dictionary.key.threshold": "1.0"}),
        ("csv", {"sep": ";", "header": True}),
        ("csv", {}),
    ],
)
def test_round_trips(people, fmt, options):
    same(files.round_trip(people, fmt, **options), people)


def test_json_inference(spark, tmp_path, people):
    path = str(tmp_path / "people")
    people.select("name", F.col("age").cast("int").alias("age")).coalesce(1).write.json(path)
    text = open(glob.glob(f"{path}/part-*")[0]).read()
    assert '{"name":"Rosa"}' in text
    read = spark.read.json(path)
    assert read.dtypes == [("age", "bigint"), ("name", "string")]
    same(read, people)


def test_csv_inference(spark, tmp_path):
    (tmp_path / "people.csv").write_text("town;size;kind\nLund;94;old\nBrno;400;large\n")
    df = spark.read.csv(str(tmp_path / "people.csv"), sep=";", header=True, inferSchema=True)
    assert df.dtypes == [("town", "string"), ("size", "int"), ("kind", "string")]
    assert df.count() == 2


def test_arrays_and_pairs_survive_parquet(spark):
    rows = spark.createDataFrame(
        [("Rosa", None, [4, 8]), ("Imre", "grey", [])],
        "name string, colour string, numbers array<int>",
    )
    same(files.round_trip(rows, "parquet"), rows)
    same(files.round_trip(rows, "orc"), rows)
    pairs = spark.createDataFrame([("m", 7)], ["_1", "_2"])
    same(files.round_trip(pairs), pairs)


def test_sql_on_file(spark, tmp_path, people):
    for fmt in ("parquet", "orc", "json"):
        path = str(tmp_path / fmt)
        people.write.format(fmt).save(path)
        same(tables.sql_on_file(spark, path, fmt), people)


def test_merged_schema(spark, tmp_path):
    number = F.col("id").cast("int").alias("a")
    squares = spark.range(1, 5).select(number, (F.col("id") ** 2).cast("int").alias("b"))
    cubes = spark.range(6, 10).select(number, (F.col("id") ** 3).cast("int").alias("c"))
    root = str(tmp_path / "data")
    files.write_keyed({1: squares, 2: cubes}, root)
    merged = files.merged_schema_read(spark, root)
    assert dict(merged.dtypes) == {"a": "int", "b": "int", "c": "int", "key": "int"}
    assert merged.count() == 8
    in_memory = squares.withColumn("key", F.lit(1)).unionByName(
        cubes.withColumn("key", F.lit(2)), allowMissingColumns=True
    )
    same(merged, in_memory)


def test_partitioned_write(spark, tmp_path, people):
    path = str(tmp_path / "by-age")
    files.write_partitioned(people, path, "age")
    assert os.path.isdir(f"{path}/age=__HIVE_DEFAULT_PARTITION__")
    read = spark.read.parquet(path)
    assert read.columns == ["name", "age"]
    same(read.select("name", F.col("age").cast("long")), people)
    text = explain(read.filter("age = 41"))
    assert "PartitionFilters: [isnotnull(age" in text
    # Rows of one value are gathered before they are written.
    assert len(glob.glob(f"{path}/age=41/*.parquet")) == 1


def test_a_hot_partition_value_is_written_by_several_tasks(spark, tmp_path):
    path = str(tmp_path / "hot")
    rows = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 3).alias("p"),
        F.sha2(F.col("id").cast("string"), 256).alias("s"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        files.write_partitioned(rows, path, "p")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(glob.glob(f"{path}/p=__HIVE_DEFAULT_PARTITION__/*.parquet")) > 3
    assert spark.read.parquet(path).count() == 200_000


def test_range_layout_gives_disjoint_files(spark, tmp_path):
    path = str(tmp_path / "ranges")
    df = spark.range(0, 40_000).select((F.col("id") * 7919 % 40_000).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files.write_range_layout(df, path, "k", ties=["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = spark.read.parquet(path)
    files_read = read.groupBy(F.input_file_name().alias("f"))
    spans = files_read.agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    spans = [(r.lo, r.hi) for r in spans.orderBy("lo").collect()]
    assert len(spans) == 8
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    hits = read.filter(files.key_between("k", 100, 300))
    assert hits.count() == 201
    assert "GreaterThanOrEqual(k,100), LessThanOrEqual(k,300)" in explain(hits)


def test_catalog_statements(spark, people):
    spark.sql("CREATE DATABASE IF NOT EXISTS study")
    try:
        assert "study" in [d.name for d in spark.catalog.listDatabases()]
        assert "study" in [r[0] for r in spark.sql("SHOW DATABASES").collect()]
        spark.sql("USE study")
        assert spark.catalog.currentDatabase() == "study"
        create = "CREATE TABLE IF NOT EXISTS member (name VARCHAR(64), age INT) USING parquet"
        spark.sql(create)
        spark.sql(create)
        assert "member" in [t.name for t in spark.catalog.listTables("study")]
        spark.sql("INSERT INTO TABLE member VALUES ('Imre', 41), ('Olu', 55)")
        spark.sql("INSERT INTO TABLE member VALUES ('Rosa', NULL)")
        assert spark.table("member").count() == 3
        catalog.truncate(spark, "study.member")
        assert spark.table("member").count() == 0
        assert spark.table("member").columns == ["name", "age"]
        spark.sql("DROP TABLE IF EXISTS member")
        assert not spark.catalog.tableExists("study.member")
        same(catalog.save_table(people, "study.people"), people)
        with pytest.raises(Exception, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
            catalog.save_table(people, "study.people")
        catalog.save_table(people.limit(1), "study.people", mode="overwrite")
        assert spark.table("study.people").count() == 1
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE study CASCADE")


def test_bucketed_tables_join_without_a_shuffle(spark):
    database = catalog.scratch_database(spark)
    left = spark.range(1_000).select(F.col("id").alias("k"), F.lit(1).alias("l"))
    right = spark.range(3_000).select((F.col("id") % 1_000).alias("k"), F.col("id").alias("r"))
    a = catalog.save_bucketed(left, f"{database}.a", ["k"], 4, sort=["k"], mode="overwrite")
    b = catalog.save_bucketed(right, f"{database}.b", ["k"], 4, sort=["r"], mode="overwrite")
    joined = a.join(b.hint("merge"), "k")
    assert "SortMergeJoin" in explain(joined)
    assert exchanges(joined) == 0
    assert joined.count() == 3_000
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        assert "SelectedBucketsCount: 1 out of 4" in explain(a.filter("k = 17"))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    files_written = {os.path.basename(f) for f in a.inputFiles()}
    assert len(files_written) == 4
    spark.sql(f"DROP TABLE {database}.a")
    spark.sql(f"DROP TABLE {database}.b")


def test_scratch_tables_are_dropped_by_their_owner(spark, people):
    with catalog.scratch_tables(spark) as owned:
        table = owned.name("people")
        found = owned.result(catalog.save_table(people, table))
        assert spark.catalog.tableExists(table)
    assert not spark.catalog.tableExists(table)
    same(found, people)
    with pytest.raises(RuntimeError), catalog.scratch_tables(spark) as owned:
        table = owned.name("people")
        catalog.save_table(people, table)
        raise RuntimeError
    assert not spark.catalog.tableExists(table)


def test_bucket_count_stays_below_the_limit():
    assert catalog.bucket_count(0) == 1
    assert catalog.bucket_count(3 * catalog.BUCKET_BYTES + 1) == 4
    assert catalog.bucket_count(10**18) == catalog.MOST_BUCKETS == 100_000


def test_bucketed_join_with_many_shuffle_partitions(spark):
    from weft.plans import REGISTRY

    before = spark.sql("SHOW TABLES IN weft_scratch").count()
    spark.conf.set("spark.sql.shuffle.partitions", "200000")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "8")
    try:
        assert REGISTRY["bucketed_join"](spark, "/root/testdata/sf0.001").count() == 1500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    assert spark.sql("SHOW TABLES IN weft_scratch").count() == before


def test_views(spark, people):
    people.createOrReplaceTempView("people_v")
    assert spark.sql("SELECT name, age AS a FROM people_v WHERE age BETWEEN 13 AND 19").count() == 1
    sql = "SELECT count(*) AS n FROM global_temp.people_g"
    other = tables.query_global_view(people, "people_g", sql)
    assert other.first().n == 5
    with pytest.raises(Exception, match="TEMP_TABLE_OR_VIEW_ALREADY_EXISTS"):
        people.createGlobalTempView("people_g")
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        spark.newSession().sql("SELECT * FROM people_v").collect()
    spark.catalog.dropGlobalTempView("people_g")


def test_register_tables(spark):
    views = tables.register_tables(spark, "/root/testdata/sf0.001", ["nation", "region"], prefix="t_")
    assert views == ["t_nation", "t_region"]
    sql = "SELECT n_name FROM t_nation JOIN t_region ON n_regionkey = r_regionkey"
    assert spark.sql(sql).count() == 25


def test_widened_scans(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    assert tables.widened(one).rdd.getNumPartitions() == 8
    wide = spark.range(0, 100, 1, 12)
    assert tables.widened(wide) is wide


def test_schema_and_session(spark, people, capsys):
    people.printSchema()
    assert "|-- age: long (nullable = true)" in capsys.readouterr().out
    assert people.schema == T.StructType(
        [T.StructField("name", T.StringType()), T.StructField("age", T.LongType())]
    )
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    # The running session is kept and takes the settings that may still change.
    again = session_builder(
        "x", max_partition_bytes=4096, shuffle_partitions=3, settings={"spark.sql.ansi.enabled": "true"}
    ).getOrCreate()
    try:
        assert again.sparkContext is spark.sparkContext
        assert again.conf.get("spark.sql.files.maxPartitionBytes") == "4096"
        assert again.conf.get("spark.sql.shuffle.partitions") == "3"
    finally:
        again.conf.set("spark.sql.shuffle.partitions", "8")
        again.conf.unset("spark.sql.files.maxPartitionBytes")


def test_scratch_uses_the_session_folder(spark, people):
    root = scratch.scratch_root(spark)
    assert scratch.scratch_root(spark) == root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert root == configured.rstrip("/")
    assert scratch.scratch_path(spark, "a") != scratch.scratch_path(spark, "a")
    same(scratch.stored(people, "people"), people)


class FakeContext:
    """Stands for a session without a checkpoint folder, and for its context."""

    def __init__(self, master):
        self.master, self.folder = master, None
        self.sparkContext = self.conf = self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_makes_a_folder_in_local_mode_only():
    local = FakeContext("local[2]")
    root = scratch.scratch_root(local)
    assert os.path.isdir(root)
    # One folder per process; the session's own checkpoint folder is left alone.
    assert scratch.scratch_root(local) == root and local.folder is None
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(FakeContext("spark://host:7077"))


class FakeSession:
    """Stands for a session and records what is asked of its reader."""

    def __init__(self, first=None):
        self.calls = []
        self.first_row = first
        self.read = self

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        return self

    def first(self):
        return self.first_row


def test_jdbc_scan_is_cut_into_ranges():
    session = FakeSession(first=(3, 90))
    jdbc.read_jdbc(session, "jdbc:x", "t", column="id", partitions=4, properties={"user": "u"})
    (bounds_sql, _), (table, options) = session.calls
    assert "min(id)" in bounds_sql and "max(id)" in bounds_sql
    assert table == "t"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == (3, 90, 4)
    assert options["properties"] == {"user": "u"}


def test_jdbc_scan_without_ranges():
    for session, arguments in (
        (FakeSession(), {}),
        (FakeSession(first=(None, None)), {"column": "id"}),
        (FakeSession(first=(4, 4)), {"column": "id"}),
    ):
        jdbc.read_jdbc(session, "jdbc:x", "t", **arguments)
        assert session.calls[-1] == ("t", {"properties": {}})
    session = FakeSession()
    jdbc.read_jdbc(session, "jdbc:x", "t", column="id", bounds=(0, 9), partitions=2)
    assert len(session.calls) == 1


def test_jdbc_write_bounds_connections():
    class Writer:
        def __init__(self):
            self.options, self.call = {}, None
            self.write = self

        def option(self, key, value):
            self.options[key] = value
            return self

        def jdbc(self, url, table, **rest):
            self.call = (url, table, rest)

    frame = Writer()
    jdbc.write_jdbc(frame, "jdbc:x", "t", mode="overwrite", connections=3)
    assert frame.options == {"numPartitions": 3, "batchsize": 10_000}
    assert frame.call == ("jdbc:x", "t", {"mode": "overwrite", "properties": {}})
