import os

import pytest
from pyspark.sql import functions as F

from asksift.sources import readers, stages


def write_text(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_missing_text_column(spark):
    with pytest.raises(ValueError, match="Query"):
        readers.prepare_log(spark.createDataFrame([("x",)], "Text string"))


def test_null_texts_go_blank_texts_stay(spark):
    df = spark.createDataFrame([(1, None), (2, " "), (3, "a\xa0 b")], "n int, Query string")
    rows = readers.prepare_log(df).collect()
    assert {r.n: r.Query for r in rows} == {2: "", 3: "a b"}


@pytest.mark.parametrize("max_split", ["64", "128MB"])
def test_csv_order_over_files_and_splits(spark, folder, max_split):
    expected = []
    for part in range(3):
        texts = [f"q{part}-{i}" for i in range(60 * (part + 1))]
        write_text(f"{folder}/part{part}.csv", [f"{t};{i}" for i, t in enumerate(texts)])
        expected += texts
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", max_split)
    try:
        log = readers.read_log(spark, folder, "csv", schema="Query string, n int", sep=";")
        rows = log.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len({r.ordinal for r in rows}) == len(expected)
    assert [r.Query for r in sorted(rows, key=lambda r: r.ordinal)] == expected
    assert set(log.columns) == {"ordinal", "Query", "n"}


def test_parquet_order_over_files(spark, folder):
    expected = []
    for part in range(3):
        texts = [f"q{part}-{i}" for i in range(50)]
        spark.createDataFrame([(t,) for t in texts], "Query string").coalesce(1).write.parquet(f"{folder}/{part}")
        expected += texts
    log = readers.read_log(spark, [f"{folder}/{p}" for p in (2, 0, 1)])
    assert [r.Query for r in sorted(log.collect(), key=lambda r: r.ordinal)] == expected


def test_orc_order(spark, folder):
    texts = [f"q{i}" for i in range(5000)]
    df = spark.createDataFrame([(t,) for t in texts], "Query string")
    df.coalesce(1).write.orc(f"{folder}/x")
    rows = readers.read_log(spark, f"{folder}/x", "orc").collect()
    assert [r.Query for r in sorted(rows, key=lambda r: r.ordinal)] == texts


def test_json_log_with_own_order(spark, folder):
    write_text(f"{folder}/log.json", ['{"Query": " b ", "at": 2}', '{"Query": null, "at": 3}', '{"Query": "a", "at": 1}'])
    log = readers.read_log(spark, f"{folder}/log.json", "json", schema="Query string, at long", ordinal="at")
    assert [(r.ordinal, r.Query) for r in log.orderBy("ordinal").collect()] == [(1, "a"), (2, "b")]


def test_empty_cells(spark, folder):
    spark.createDataFrame([("nan",), ("N/A",), ("",), ("nano",)], "Query string").write.parquet(f"{folder}/x")
    kept = readers.read_log(spark, f"{folder}/x", empty_cells=readers.EMPTY_CELLS)
    assert [r.Query for r in kept.collect()] == ["nano"]
    assert readers.read_log(spark, f"{folder}/x").count() == 4


def test_rating_table(spark, folder):
    write_text(f"{folder}/r.csv", ["a;b", "1.0;FALSE", "NA;TRUE", ";0", " 2 ;T"])
    df = readers.read_ratings(spark, f"{folder}/r.csv")
    assert dict(df.dtypes) == {"a": "int", "b": "int"}
    assert sorted(map(tuple, df.collect()), key=str) == [(1, 0), (2, 1), (None, 0), (None, 1)]


@pytest.mark.parametrize("cell", ["x", "1.5", "yes"])
def test_cells_that_are_no_whole_numbers(spark, folder, cell):
    write_text(f"{folder}/r.csv", ["a;b", f"1;{cell}"])
    with pytest.raises(Exception, match="no whole number in b"):
        readers.read_ratings(spark, f"{folder}/r.csv").collect()


def test_files_follow_each_other_by_number(spark):
    paths = ["d/part-100000-x.parquet", "d/part-99999-x.parquet", "d/part-2.parquet", "c/part-5.parquet", "d/part-02.parquet"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string")
    got = rows.select("p", readers.natural_key(F.col("p")).alias("k")).orderBy("k", "p").collect()
    assert [r.p for r in got] == [
        "c/part-5.parquet", "d/part-02.parquet", "d/part-2.parquet", "d/part-99999-x.parquet", "d/part-100000-x.parquet",
    ]


def test_both_natural_orders_agree(spark):
    paths = ["a/1x", "a/01x", "a/10x", "a/9x", "b1/c", "b10/c", "b9/c", "x" * 50, "1" * 50, "2", "\u0663", "\u00b2"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r.p for r in rows.orderBy(readers.natural_key(F.col("p")), "p").collect()]
    assert got == sorted(paths, key=readers.natural_order)


def test_file_order_costs_no_shuffle(spark, folder):
    spark.range(100).select(F.concat(F.lit("q"), "id").alias("Query")).repartition(3).write.parquet(f"{folder}/x")
    log = readers.read_log(spark, f"{folder}/x")
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
    assert plan.count("Exchange") == plan.count("BroadcastExchange") and plan.count("BroadcastHashJoin") == 1
    assert dict(log.dtypes)["ordinal"] == "bigint"


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_texts_of_files_meet_in_a_hash_aggregate(spark, folder, fmt):
    from asksift.operators.identity import distinct_texts

    rows = spark.range(300).select(F.concat(F.lit("q"), F.col("id") % 50).alias("Query")).repartition(3)
    rows.write.format(fmt).save(f"{folder}/x")
    log = readers.read_log(spark, f"{folder}/x", fmt, schema="Query string")
    found = distinct_texts(log)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert found.count() == 50


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_order_of_files_in_odd_folders(spark, folder, fmt):
    expected = []
    for part in ("9 b", "10%41", "100+c"):
        texts = [f"q{part}-{i}" for i in range(50)]
        spark.createDataFrame([(t,) for t in texts], "Query string").coalesce(1).write.format(fmt).save(f"{folder}/{part}")
        expected += texts
    log = readers.read_log(spark, [f"{folder}/{p}" for p in ("100+c", "9 b", "10%41")], fmt, schema="Query string")
    rows = log.collect()
    assert [r.Query for r in sorted(rows, key=lambda r: r.ordinal)] == expected


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_list_of_files_that_is_too_long_to_send(spark, folder, fmt, monkeypatch):
    monkeypatch.setattr(readers, "LISTING_BYTES", 10)
    expected = []
    for part in range(3):
        texts = [f"q{part}-{i}" for i in range(50)]
        spark.createDataFrame([(t,) for t in texts], "Query string").coalesce(1).write.format(fmt).save(f"{folder}/{part}")
        expected += texts
    rows = readers.read_log(spark, [f"{folder}/{p}" for p in (2, 0, 1)], fmt, schema="Query string").collect()
    assert [r.Query for r in sorted(rows, key=lambda r: r.ordinal)] == expected


def test_rows_that_do_not_fit_the_header(spark, folder):
    write_text(f"{folder}/r.csv", ["a;b;c", "1;0;1", "1;0", "1", '"1";"0";', "1;0;1;; ;", ";;"])
    rows = readers.read_ratings(spark, f"{folder}/r.csv").collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(1, 0, 1), (1, 0, None), (1, None, None), (1, 0, None), (1, 0, 1), (None, None, None)], key=str
    )


@pytest.mark.parametrize("row", ["1;0;1;0", "1;0;1;0;1", "1;0;1;;1", '1;0;1;"x"', '"1";0;1;"a;b"'])
@pytest.mark.parametrize("column", ["a", "c"])
def test_surplus_cells_are_an_error(spark, folder, row, column):
    write_text(f"{folder}/r.csv", ["a;b;c", "1;0;1", row])
    with pytest.raises(Exception, match="more than 3 cells: " + row.replace('"', '.')):
        readers.read_ratings(spark, f"{folder}/r.csv").select(column).collect()


def test_stage_table(spark, folder):
    df = stages.stage(spark.range(5), f"{folder}/s")
    assert df.count() == 5
    with pytest.raises(ValueError):
        stages.read_table(spark, f"{folder}/s", "other")


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    one, two = stages.shared_folder(spark), stages.shared_folder(spark)
    assert one != two
    if base:
        assert one.startswith(base.rstrip("/") + "/")


class Elsewhere:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(name, default=None):
            return default

    class sparkContext:
        master = "yarn"


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        stages.shared_folder(Elsewhere)


def test_stages_can_be_dropped(spark, folder):
    stages.stage(spark.range(5), f"{folder}/s/one")
    stages.drop_stages(spark, f"{folder}/s")
    assert not os.path.exists(f"{folder}/s")
