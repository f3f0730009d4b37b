"""Sources and sinks on the reference's samples (FIXTURES 6)."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows, write_lines
from tidewell.sources import files, sinks


def test_text_line_separators_and_whole_file(spark, tmp_path):
    p = write_lines(str(tmp_path / "people.txt"), ["Michael, 29", "Andy, 30", "Justin, 19"])
    assert files.read_text(spark, p).count() == 3
    by_comma = files.read_text(spark, p, line_sep=",")
    assert by_comma.count() == 4
    assert any("\n" in r["value"] for r in by_comma.collect())
    whole = files.read_text(spark, p, whole=True)
    assert whole.count() == 1 and whole.first()["value"] == "Michael, 29\nAndy, 30\nJustin, 19\n"


def test_one_file_per_key_in_one_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "_FILES_PER_TASK", 7)
    texts = [(i, None if i == 5 else f"a{i}\r\nb\n" * (i % 3)) for i in range(40)]
    d = str(tmp_path / "rows")
    ids = sinks.write_text_per_key(spark.createDataFrame(texts, "id long, value string").repartition(5), d, "value", ["id"])
    names = os.listdir(d)
    assert sum(f.startswith("part-") for f in names) == 40
    assert not any(f.endswith(".crc") and f.startswith(".part-") for f in names)
    read = files.read_text(spark, d, whole=True).withColumn("file", sinks.file_number(F.col("_metadata.file_name")))
    got = read.join(ids, "file").select("id", "value").collect()
    assert sorted(tuple(r) for r in got) == [(i, (t or "") + "\n") for i, t in texts]


def test_one_file_per_key_of_no_rows(spark, tmp_path):
    d = str(tmp_path / "none")
    ids = sinks.write_text_per_key(spark.createDataFrame([], "id long, value string"), d, "value", ["id"])
    assert ids.columns == ["id", "file"] and ids.count() == 0
    assert files.read_text(spark, d, whole=True).count() == 0


def test_scan_text_whole_makes_no_folder_per_document(spark, tmp_path, monkeypatch):
    from tidewell.plans import io
    made = []
    monkeypatch.setattr(io, "fresh_dir", lambda s, label: made.append(str(tmp_path / label)) or made[-1])
    docs = [(-3, "x"), (7, None), (8, ""), (9, "a\nb"), (9, None), (9, "c"), (None, "n")]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = io.scan_text_whole(spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id or 0), r.value) for r in got) == [
        (-3, "x\n"), (0, "n\n"), (7, "\n"), (8, "\n"), (9, "a\nb\n\nc\n")]
    assert len([f for f in os.listdir(made[0]) if f.startswith("part-")]) == 5
    assert not any(os.path.isdir(os.path.join(made[0], f)) for f in os.listdir(made[0]))


def test_text_files_in_several_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "_FILES_PER_FOLDER", 10)
    monkeypatch.setattr(sinks, "_FILES_PER_TASK", 4)
    monkeypatch.setattr(files, "_FOLDERS_AT_ONCE", 2)
    monkeypatch.setattr(files, "fresh_dir", lambda s, label: str(tmp_path / label))
    d = str(tmp_path / "rows")
    texts = [(i - 3, "a", None if i == 5 else f"{i}\r\n\u00e9\n" * (i % 3)) for i in range(40)]
    texts += [(0, "b", "other"), (7, "a", "again"), (None, "a", "x"), (None, "a", None)]
    df = spark.createDataFrame(texts, "id long, input string, value string").repartition(3, "input")
    written = sinks.write_text_files(df, d, "value", ["id", "input"], "id")
    folders = sorted(os.listdir(d))
    assert len(folders) == 5 and {f for f, _, _ in written} == {f"{d}/{f}" for f in folders}
    assert sum(n for _, _, n in written) == sum(len(os.listdir(f"{d}/{f}")) for f in folders) == 42
    # a file that a failed task left is not read
    with open(f"{d}/{folders[0]}/part-00000-999999-c000000-7.txt", "w") as f:
        f.write("left\n")
    read = files.read_text_files(spark, written)
    assert not any(f.endswith(".txt") for f in read.inputFiles())  # no list of all files is kept
    got = [(r.label and int(r.label), r.value) for r in read.collect()]
    want = [(i, (t or "") + "\n") for i, x, t in texts[:41] if i != 7] + [(7, f"{texts[10][2]}\nagain\n")]
    assert sorted(x for x in got if x[0] is not None) == sorted(want)
    assert [v for i, v in got if i is None] in (["x\n\n"], ["\nx\n"])


def test_a_folder_of_text_files_that_cannot_be_read_fails_the_read(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id long, value string")
    written = sinks.write_text_files(df, str(tmp_path / "rows"), "value", ["id"], "id")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        files.read_text_files(spark, [*written, (str(tmp_path / "gone"), "00000-0", 1)])


def test_text_files_of_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "id long, value string")
    written = sinks.write_text_files(df, str(tmp_path / "none"), "value", ["id"], "id")
    assert files.read_text_files(spark, written).collect() == []


def test_scan_text_whole_where_only_spark_writes(spark, tmp_path, monkeypatch):
    from tidewell.plans import io
    docs = [(-3, "x"), (7, None), (9, "a\nb"), (9, "c"), (None, "n")]
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    want = rows(io.scan_text_whole(spark, str(tmp_path)))
    assert want == [(None, "n\n"), (-3, "x\n"), (7, "\n"), (9, "a\nb\nc\n")]
    monkeypatch.setattr(sinks, "mounted", lambda s, path: None)
    assert rows(io.scan_text_whole(spark, str(tmp_path))) == want
    with pytest.raises(ValueError, match="mounted"):
        sinks.write_text_files(spark.createDataFrame(docs, "id long, value string"), "/none", "value", ["id"], "id")


def test_csv_separator_header_and_wrong_separator(spark, tmp_path):
    p = write_lines(str(tmp_path / "people.csv"), ["name;age;job", "Jorge;30;Developer", "Bob;32;Developer"])
    plain = files.read_csv(spark, p, header=False)
    assert plain.columns == ["_c0"] and plain.count() == 3
    good = files.read_csv(spark, p, header=False, options={"sep": ";", "header": "true", "inferSchema": "true"})
    assert rows(good) == [("Bob", 32, "Developer"), ("Jorge", 30, "Developer")]
    alt = spark.read.option("delimiter", ";").option("header", "true").csv(p)
    assert alt.columns == ["name", "age", "job"]


def test_json_between_view_and_prefix(spark, tmp_path):
    p = write_lines(str(tmp_path / "people.json"),
                    ['{"name":"Michael"}', '{"name":"Andy", "age":30}', '{"name":"Justin", "age":19}',
                     '{"name":"Andy", "age":30}'])
    df = files.read_json(spark, p)
    df.createOrReplaceTempView("tw_people")
    teen = spark.sql("SELECT name FROM tw_people WHERE age BETWEEN 13 AND 19")
    assert rows(teen) == [("Justin",)]
    assert teen.select(F.concat(F.lit("Name: "), "name")).first()[0] == "Name: Justin"


def test_merge_schema_squares_and_cubes(spark, tmp_path):
    d = str(tmp_path / "data")
    spark.range(1, 6).select(F.col("id").cast("int").alias("value"),
                             (F.col("id") * F.col("id")).cast("int").alias("square")).write.parquet(f"{d}/key=1")
    spark.range(6, 11).select(F.col("id").cast("int").alias("value"),
                              (F.col("id") ** 3).cast("int").alias("cube")).write.parquet(f"{d}/key=2")
    m = files.read_parquet(spark, d, merge_schema=True)
    assert sorted(m.columns) == ["cube", "key", "square", "value"] and m.count() == 10


def test_recursive_glob_and_corrupt(spark, tmp_path):
    d = str(tmp_path / "dir1")
    spark.createDataFrame([("file1.parquet",)], "file string").write.parquet(f"{d}")
    spark.createDataFrame([("file2.parquet",)], "file string").write.parquet(f"{d}/dir2")
    write_lines(f"{d}/file3.json", ['{"file":"corrupt.json"}'])
    rec = files.read_parquet(spark, d, recursive=True, glob="*.parquet")
    assert rows(rec) == [("file1.parquet",), ("file2.parquet",)]
    skip = files.read_parquet(spark, d, ignore_corrupt=True, schema="file string")
    assert rows(skip) == [("file1.parquet",)]


def test_sinks_round_trip(spark, tmp_path):
    users = spark.createDataFrame([("Alyssa", None, [3, 9, 15, 20]), ("Ben", "red", [])],
                                  "name string, favorite_color string, favorite_numbers array<int>")
    p = sinks.write_parquet(users, str(tmp_path / "users"), partition_by="favorite_color")
    back = spark.read.parquet(p)
    assert back.count() == 2 and "favorite_color" in back.columns
    o = sinks.write_orc(users.select("name", "favorite_color"), str(tmp_path / "orc"),
                        bloom_columns=["favorite_color"], dictionary_threshold=1.0, direct_encoding=["name"])
    assert spark.read.orc(o).count() == 2
    q = sinks.write_parquet_tuned(users, str(tmp_path / "pq"), bloom_ndv={"favorite_color": 10},
                                  dictionary=True, page_checksum=False)
    assert spark.read.parquet(q).count() == 2
    g = sinks.write_text(users.select("name"), str(tmp_path / "gz"), compression="gzip")
    assert any(f.endswith(".gz") for f in os.listdir(g)) and spark.read.text(g).count() == 2


def test_sql_on_file(spark, tmp_path):
    p = str(tmp_path / "u")
    spark.createDataFrame([("Alyssa",), ("Ben",)], "name string").write.parquet(p)
    assert files.sql_on_file(spark, "parquet", p).count() == 2


# The reference's "spike" people rows (FIXTURES.md section 1).
SPIKE = [("David", "Cooker", "17", "Redmond"), ("Kate", "Lucy", "27", "Bellevue"),
         ("Mike", "Patrick", "44", "Seattle")]


def test_partition_aligned_delete_and_catalog_upkeep(spark, tmp_path):
    """Metadata delete of location = 'Redmond' on a table partitioned by
    location; REFRESH and DROP TABLE on the catalog table."""
    t = "tw_spike_partitioned"
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    df = spark.createDataFrame(SPIKE, "firstName string, lastName string, age string, location string")
    df.write.partitionBy("location").option("path", str(tmp_path / "spike")).saveAsTable(t)
    sinks.drop_partitions(spark, t, {"location": "Redmond"})
    spark.sql(f"REFRESH TABLE {t}")
    assert sorted(r[0] for r in spark.table(t).select("firstName").collect()) == ["Kate", "Mike"]
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    assert not spark.catalog.tableExists(t)


def test_column_docs_record_inferred_types(spark, tmp_path):
    from tidewell.operators.evolve import document_types
    p = write_lines(str(tmp_path / "d.csv"), ["a,b", "1,x", "2,y"])
    t = "tw_docs"
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    sinks.replace_table(files.read_csv(spark, p), t, str(tmp_path / "docs"))
    document_types(spark, t, files.read_csv(spark, p, infer=True).schema)
    docs = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE {t}").collect()}
    assert docs["a"] == "integer" and docs["b"] == "string"


def test_console_sink_streams(spark, tmp_path):
    p = str(tmp_path / "in")
    spark.createDataFrame([("a",)], "v string").write.parquet(p)
    q = (spark.readStream.schema("v string").parquet(p).writeStream.format("console")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    assert not q.isActive


def test_parquet_path_list_and_insert_values(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1,)], "v int").write.parquet(a)
    spark.createDataFrame([(2,)], "v int").write.parquet(b)
    assert rows(files.read_parquet(spark, a, b)) == [(1,), (2,)]
    assert spark.read.load(a).count() == 1            # Parquet is the default format
    t = "tw_insert_values"
    spark.sql(f"DROP TABLE IF EXISTS {t}")
    spark.sql(f"CREATE TABLE {t} (v INT, s STRING) USING parquet LOCATION '{tmp_path / 't'}'")
    spark.sql(f"INSERT INTO {t} VALUES (1, 'x'), (2, 'y')")
    spark.sql(f"INSERT INTO {t} SELECT v + 10, 'z' FROM parquet.`{a}`")
    assert sorted(tuple(r) for r in spark.table(t).collect()) == [(1, "x"), (2, "y"), (11, "z")]


def test_display_rows_and_schema(spark, capsys):
    """Show (default 20 rows, and 50 untruncated) and printSchema."""
    df = spark.createDataFrame([(i, "x" * 30) for i in range(60)], "id int, s string")
    df.show()
    df.show(50, False)
    df.printSchema()
    out = capsys.readouterr().out
    assert "only showing top 20 rows" in out and "x" * 30 in out and "|-- id: integer" in out


def _files(path):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.startswith("part-"))


def test_bucketed_writes_one_file_per_bucket(spark, tmp_path):
    df = spark.range(0, 4000, 1, 8).selectExpr("id", "id % 3 AS g")
    for label, kw in (("plain", {}), ("folders", {"partition_by": "g"})):
        path, table = str(tmp_path / label), f"tw_files_{label}"
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        sinks.save_bucketed(df, table, 6, "id", path=path, **kw)
        assert len(_files(path)) == 6 * (3 if kw else 1)
        assert spark.table(table).count() == 4000
        info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
        assert info["Num Buckets"] == "6" and "id" in info["Bucket Columns"]
        spark.sql(f"DROP TABLE {table}")


def test_bloom_filter_is_in_the_file(spark, tmp_path):
    import pyarrow.parquet as pq
    df = spark.range(2000).selectExpr("id * 7 AS k", "CAST(id AS STRING) AS s")
    plain = sinks.write_parquet(df.coalesce(1), str(tmp_path / "plain"))
    tuned = sinks.write_parquet_tuned(df.coalesce(1), str(tmp_path / "tuned"), bloom_ndv={"k": 2000}, dictionary=False)
    a, b = (_files(p)[0] for p in (plain, tuned))
    assert os.path.getsize(b) > 2000 and "PLAIN_DICTIONARY" not in str(pq.ParquetFile(b).metadata.row_group(0).column(0).encodings)
    jvm = spark._jvm
    def bloom(path):
        conf = spark._jsc.hadoopConfiguration()
        f = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
        r = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(f)
        try:
            block = r.getFooter().getBlocks().get(0)
            return r.readBloomFilter(block.getColumns().get(0)) is not None
        finally:
            r.close()
    assert bloom(b) and not bloom(a)


def test_modified_window_leaves_old_files_out(spark, tmp_path):
    d = str(tmp_path / "m")
    spark.range(3).write.parquet(f"{d}/old")
    files.set_modified(spark, f"{d}/old", "1999-06-01T00:00:00")
    spark.range(10, 15).write.parquet(f"{d}/new")
    got = files.read_parquet(spark, d, recursive=True, modified_after="2000-01-01T00:00:00", time_zone="CST")
    assert sorted(r["id"] for r in got.collect()) == [10, 11, 12, 13, 14]
    old = files.read_parquet(spark, d, recursive=True, modified_before="2000-01-01T00:00:00", time_zone="CST")
    assert old.count() == 3


def test_new_session_and_current_timestamp(spark):
    """A session of its own views on the same context; F7: load time."""
    other = spark.newSession()
    spark.range(1).createOrReplaceTempView("tw_only_here")
    assert other.sparkContext is spark.sparkContext and not other.catalog.tableExists("tw_only_here")
    loaded = spark.range(2).withColumn("loaded_at", F.current_timestamp())
    assert loaded.select("loaded_at").distinct().count() == 1


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace
    from tidewell.session import scratch_root
    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(master="spark://host:7077", applicationId="app-1", getConf=lambda: conf)
    import pytest
    with pytest.raises(RuntimeError):
        scratch_root(SimpleNamespace(conf=conf, sparkContext=sc))
