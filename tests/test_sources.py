from __future__ import annotations

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from flowlab.sources import exports, flow_csv, storage, tables


def write(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)


def test_all_files_of_a_directory_are_one_text_table(spark, tmp_path):
    folder = tmp_path / "raw"
    write(folder, "a.csv", "flow_id,duration,label\nf1, 1.5 ,Benign\nf2,,DoS\n")
    write(folder, "b.csv", "flow_id,duration,label\nf3,Infinity, Web_XSS \n")
    df = flow_csv.read_flows(spark, str(folder))
    assert {t for _, t in df.dtypes} == {"string"}
    assert sorted(map(tuple, df.collect())) == [("f1", "1.5", "Benign"), ("f2", None, "DoS"), ("f3", "Infinity", "Web_XSS")]


def test_padded_and_repeated_headers_bind_by_position(spark, tmp_path):
    folder = tmp_path / "raw"
    write(folder, "a.csv", " a ,b,a, label\n1,2,3,x\n")
    write(folder, "b.csv", " a ,b,a, label\n4,5,6,y\n")
    df = flow_csv.read_flows(spark, str(folder))
    assert df.columns == ["a", "b", "label"]
    assert sorted(map(tuple, df.collect())) == [("1", "2", "x"), ("4", "5", "y")]


def test_positional_names():
    assert flow_csv.positional_names(["x", " x", "y", "x "]) == (["x", "x__dup1", "y", "x__dup3"], ["x", "y"])


def test_a_file_with_other_columns_fails(spark, tmp_path):
    folder = tmp_path / "raw"
    write(folder, "a.csv", "a,b\n1,2\n")
    write(folder, "b.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        flow_csv.read_flows(spark, str(folder)).collect()


@pytest.mark.parametrize("header", ["b,a,a", "a,b", "a,b,c", "a,a,b"])
def test_repeated_names_do_not_switch_the_check_off(spark, tmp_path, header):
    folder = tmp_path / "raw"
    write(folder, "a.csv", " a,b,a \n1,2,3\n")
    write(folder, "b.csv", f"{header}\n4,5,6\n")
    with pytest.raises(ValueError, match="headers differ"):
        flow_csv.read_flows(spark, str(folder))


def test_padding_does_not_switch_the_check_off(spark, tmp_path):
    folder = tmp_path / "raw"
    write(folder, "a.csv", " a , b\n1,2\n")
    write(folder, "b.csv", "a,b \n3,4\n")
    assert sorted(map(tuple, flow_csv.read_flows(spark, str(folder)).collect())) == [("1", "2"), ("3", "4")]
    write(folder, "c.csv", "b,a\n5,6\n")
    with pytest.raises(Exception, match="(?i)header"):
        flow_csv.read_flows(spark, str(folder)).collect()


def test_kept_corrupt_rows_still_need_equal_headers(spark, tmp_path):
    folder = tmp_path / "raw"
    write(folder, "a.csv", "a,b\n1,2\n")
    write(folder, "b.csv", "b,a\n1,2\n")
    with pytest.raises(ValueError, match="headers differ"):
        flow_csv.read_flows(spark, str(folder), keep_corrupt=True)


def test_partitioned_write_makes_few_files(spark, tmp_path):
    rows = spark.range(0, 10_000, 1, 20).withColumn("k", F.col("id") % 3)
    tables.write_table(rows, str(tmp_path / "out"), ["k"])
    assert len(list((tmp_path / "out").glob("k=*/*.parquet"))) == 3
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10_000


def test_rows_with_a_wrong_field_count_are_kept_and_marked(spark, tmp_path):
    folder = tmp_path / "raw"
    write(folder, "a.csv", "a,b\n1,2\n3\n4,5,6\n")
    rows = flow_csv.read_flows(spark, str(folder), keep_corrupt=True).collect()
    assert {(r["a"], r["b"], r[flow_csv.CORRUPT]) for r in rows} == {("1", "2", None), ("3", None, "3"), ("4", "5", "4,5,6")}


def test_pruned_scan_reads_only_its_columns(spark, sf_dir):
    df = tables.read_table(spark, f"{sf_dir}/lineitem.parquet", ["l_tax"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_tax:double>" in plan


def test_missing_table_is_empty_and_a_broken_one_fails(spark, tmp_path):
    schema = spark.range(1).schema
    df, found = tables.read_if_present(spark, str(tmp_path / "none"), schema)
    assert not found and df.isEmpty() and df.schema == schema
    write(tmp_path / "bad", "part.parquet", "no parquet")
    with pytest.raises(Exception):
        tables.read_if_present(spark, str(tmp_path / "bad"), schema)[0].collect()


def test_exported_csv_has_empty_fields_and_readable_vectors(spark, tmp_path):
    df = spark.createDataFrame([("a", None, Vectors.dense(0.25, 0.75)), ("", 1.0, Vectors.sparse(2, [1], [2.0]))], ["k", "x", "v"])
    exports.write_csv(df, str(tmp_path / "out"), one_file=True)
    (part,) = [p for p in (tmp_path / "out").iterdir() if p.suffix == ".csv"]
    assert part.read_text().splitlines() == ["k,x,v", 'a,,"[0.25,0.75]"', ',1.0,"[0.0,2.0]"']


def test_sample_is_the_same_on_any_layout(spark):
    rows = spark.range(100).select(F.format_string("%03d", "id").alias("k"), "id")
    for n in (1, 5):
        sample = exports.sample_rows(rows.repartition(n), 3, "k", ["id", "nothing"])
        assert [tuple(r) for r in sample.collect()] == [(0,), (1,), (2,)]
    assert exports.preferred(rows, ["nothing"]).columns == ["k", "id"]


def test_schema_tables(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in exports.schema_table(df).collect()] == [(0, "a", "int", True), (1, "b", "string", True)]
    counts = {r["name"]: r["filled"] for r in exports.schema_with_counts(df).collect()}
    assert counts == {"a": 2, "b": 1}


def test_shared_folder_comes_from_the_session(spark):
    assert storage.shared_folder(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert storage.new_folder(spark, "x") != storage.new_folder(spark, "x")


def test_durable_rows_have_no_lineage(spark):
    kept = storage.durable(spark.range(10).filter("id > 3"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 6 and "Range" not in plan


def test_headed_lines_go_to_many_files(spark, tmp_path):
    lines = spark.range(0, 40, 1, 4).select(F.concat(F.lit(' "'), F.col("id").cast("string"), F.lit(', x"  ')).alias("value"))
    exports.write_lines(lines, str(tmp_path / "lines"), " a ,b  ")
    files = sorted((tmp_path / "lines").glob("*.csv"))
    assert len(files) == 4
    for file in files:
        head, *rest = file.read_text().splitlines()
        assert head == " a ,b  " and len(rest) == 10 and all(line.startswith(' "') and line.endswith('x"  ') for line in rest)


def test_quarantine_splits_lines_in_one_pass(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,2\n3\n4,5,6\n,\n")
    (folder / "b.csv").write_text("x,y\n7,8\n")
    rows, bad = flow_csv.quarantine_flows(spark, str(folder), str(tmp_path / "parsed"))
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([("1", "2"), (None, None), ("7", "8")], key=str)
    found = {(r.text, r.file.rsplit("/", 1)[1]) for r in bad.collect()}
    assert found == {("3", "a.csv"), ("4,5,6", "a.csv")}
    assert rows.columns == ["x", "y"] and {p.name for p in (tmp_path / "parsed").glob("_quarantined=*")} == {
        "_quarantined=false", "_quarantined=true"
    }
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_quarantined" in plan


def test_nothing_to_quarantine(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    rows, bad = flow_csv.quarantine_flows(spark, str(tmp_path / "a.csv"), str(tmp_path / "parsed"))
    assert rows.count() == 1 and bad.isEmpty()


def test_replaced_partitions_leave_others(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(100).select("id", (F.col("id") % 3).alias("part"))
    tables.replace_partitions(rows, path, ["part"])
    files = {p: sorted((tmp_path / "t" / f"part={p}").glob("*.parquet")) for p in range(3)}
    tables.replace_partitions(rows.filter("part = 1").limit(5), path, ["part"])
    assert spark.read.parquet(path).groupBy("part").count().orderBy("part").collect() == [(0, 34), (1, 5), (2, 33)]
    assert all(sorted((tmp_path / "t" / f"part={p}").glob("*.parquet")) == files[p] for p in (0, 2))


def test_rows_are_dealt_out_by_their_number_and_the_setting(spark, monkeypatch):
    """A small table is not cut into as many parts as a large one; no table into more than the setting says."""
    monkeypatch.setattr(tables, "DEALT_ROWS", 10)
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for rows, parts in ((0, 1), (1, 1), (10, 1), (11, 2), (30, 3), (1000, most)):
        for files in (1, 7):
            made = tables.dealt(spark.range(0, rows, 1, files), "id")
            assert made.rdd.getNumPartitions() == parts and made.count() == rows


def test_dealt_rows_are_kept_batch_by_batch(spark):
    """Serialized, a partition comes back from disk as one array."""
    with tables.dealt_once(spark.range(100), "id") as rows:
        level = rows.storageLevel
        assert level.useDisk and level.useMemory and level.deserialized


def test_small_tables_are_dealt_to_several_cores(spark):
    """100,000 training rows went to two partitions, and the passes of an estimator to two cores."""
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tables.dealt(spark.range(100_000), "id").rdd.getNumPartitions() == min(most, 7) > 2
