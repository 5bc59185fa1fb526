"""Database files: ranges, filters, types, all input tables."""

from __future__ import annotations

import json
import os
import sqlite3

import pytest
from hand_tables import compounds, curated, hand_tables, measurements, targets
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pairloom.config import PairConfig
from pairloom.plans import pair_table
from pairloom.schema import INPUT_DDL
from pairloom.sources import database
from pairloom.sources.database import PushdownReader, read_database, read_tables_database, write_database


@pytest.fixture
def path(tmp_path):
    file = str(tmp_path / "a file?#.db")
    db = sqlite3.connect(file)
    db.execute('CREATE TABLE t (id INTEGER, x REAL, name TEXT, "odd ""name" INT, flag BOOLEAN, extra BLOB, day DATE)')
    rows = [(i, i / 4, f"n{i % 7}", None if i % 5 else i, i % 2, b"\x00", "2024-02-29") for i in range(1000)]
    db.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?, ?, ?)", [*rows, (None,) * 7])
    db.execute("CREATE TABLE bare (k INTEGER PRIMARY KEY, v TEXT) WITHOUT ROWID")
    db.executemany("INSERT INTO bare VALUES (?, ?)", [(i, str(i)) for i in range(5)])
    db.execute("CREATE TABLE none (k INTEGER)")
    db.execute("CREATE TABLE loose (k)")
    db.executemany("INSERT INTO loose VALUES (?)", [(1,), ("x",)])
    db.commit()
    db.close()
    return file


def test_ranges_and_declared_types(spark, path):
    df = read_database(spark, path, "t", keys_per_range="100")
    assert df.rdd.getNumPartitions() == 11
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "double", "string", "bigint", "boolean", "binary", "string"]
    assert df.columns[3] == 'odd "name' and df.count() == 1001
    assert df.agg(F.sum("id"), F.sum("x"), F.count_if("flag")).first() == (499500, 124875.0, 500)


def test_ranges_of_a_column_keep_rows_without_it(spark, path):
    df = read_database(spark, path, "t", "id BIGINT, name STRING", key="id", keys_per_range="300")
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 1001 and df.filter("id is null").count() == 1 and df.select("id").distinct().count() == 1001


def test_tables_without_row_numbers_and_empty_ones(spark, path):
    assert sorted(r.v for r in read_database(spark, path, "bare").collect()) == list("01234")
    assert read_database(spark, path, "none").count() == 0


def reader(path, ddl, filters):
    out = PushdownReader(path, False, "t", StructType.fromDDL(ddl), "rowid", 400)
    left = list(out.pushFilters(filters))
    return out, left


def test_filters_and_columns_reach_the_file(path):
    filters = [
        ds.GreaterThanOrEqual(("id",), 990),
        ds.In(("name",), ("n1", "n2")),
        ds.Not(ds.EqualTo(("x",), 248.0)),
        ds.IsNotNull(("x",)),
        ds.StringContains(("name",), "n"),
        ds.EqualTo(("day",), "2024-02-29"),
    ]
    read, left = reader(path, "id BIGINT, name STRING, x DOUBLE, day DATE", filters)
    assert left == filters[4:]
    sql, values = read.query(read.partitions()[2])
    assert sql.startswith('SELECT "id", "name", "x", "day" FROM "t" WHERE') and values == [990, "n1", "n2", 248.0, 801, 1201]
    rows = [r for part in read.partitions() for batch in read.read(part) for r in batch.to_pylist()]
    assert [r["id"] for r in rows] == [i for i in range(990, 1000) if i % 7 in (1, 2) and i != 992]


def test_pushed_filters_give_the_same_rows(spark, path):
    conditions = ["id > 995", "name = 'n3' and x < 2.5", "`odd \"name` is null and id <= 6", "name >= 'n6' or id = 0",
                  "not flag and id < 10", "name <=> null", "id in (1, 2, null)", "name like 'n%' and id = 5", "x = 1 / 0.8",
                  "not (id >= 3)", "id not in (0, 1)"]
    rows = read_database(spark, path, "t").collect()
    plain = spark.createDataFrame(rows, read_database(spark, path, "t").schema)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        for condition in conditions:
            found = read_database(spark, path, "t", pushdown="true").filter(condition).collect()
            assert sorted(map(str, found)) == sorted(map(str, plain.filter(condition).collect())), condition
        plan = read_database(spark, path, "t", pushdown="true").filter("id > 995")._jdf.queryExecution().executedPlan().toString()
        assert not plan.strip().startswith("*(1) Filter") and "+- *(1) Filter" not in plan
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_one_frame_serves_several_queries(spark, path):
    df = read_database(spark, path, "t", "id BIGINT, name STRING")
    assert df.filter("id is null").count() == 1 and df.filter("id < 10").count() == 10 and df.count() == 1001
    assert df.filter("id < 3").unionAll(df.filter("name = 'n6' and id < 20")).count() == 5


def test_conditions_given_when_reading(spark, path):
    where = [("id", ">=", 990), ("name", "in", ["n1", "n2"]), ("x", "!=", 248.0), ("x", "not null")]
    df = read_database(spark, path, "t", "id BIGINT, name STRING, x DOUBLE", where)
    assert sorted(r.id for r in df.collect()) == [i for i in range(990, 1000) if i % 7 in (1, 2) and i != 992]
    assert read_database(spark, path, "t", "id BIGINT", [("id", "null")]).count() == 1
    for wrong in (("day", "=", "2024-02-29"), ("id", "like", "1"), ("id", "=", "1"), ("absent", "null")):
        with pytest.raises(Exception, match="cannot be decided in the file"):
            read_database(spark, path, "t", "id BIGINT, day DATE", [wrong]).count()


def test_values_that_do_not_fit_are_named(spark, path):
    with pytest.raises(Exception, match=r"loose\.k holds a value that is no bigint"):
        read_database(spark, path, "loose", "k BIGINT").collect()
    assert sorted(r.k for r in read_database(spark, path, "loose", "k STRING").collect()) == ["1", "x"]
    assert read_database(spark, path, "t", "day DATE").distinct().count() == 2


def test_written_files_read_back(spark, tmp_path):
    ddl = "a BIGINT, b INT, c DOUBLE, d FLOAT, e STRING, f BOOLEAN, g DATE, h TIMESTAMP, i BINARY, `j\"` STRING"
    df = spark.range(500).selectExpr(
        "id a", "cast(id as int) b", "id / 3 c", "float(id / 3) d", "if(id % 9 = 0, null, concat('é', id)) e", "id % 2 = 0 f",
        "date'2024-01-01' + cast(id as int) g", "timestamp'2024-01-01 10:00:00.123456' h", "cast('x' as binary) i", "'q' as `j\"`",
    )
    folder = str(tmp_path / "out")
    write_database(df.repartition(4), folder, "t")
    with open(f"{folder}/{database.MANIFEST}") as listed:
        assert len(json.load(listed)) == 4
    read = read_database(spark, folder, "t", ddl)
    assert read.exceptAll(df).count() == 0 and df.exceptAll(read).count() == 0
    with open(f"{folder}/part-left-over.db", "w") as broken:  # of a task that failed: no part of the table
        broken.write("no database")
    write_database(df, folder, "t")
    assert read_database(spark, folder, "t", ddl).count() == 1000
    write_database(df.limit(0), folder, "t", "overwrite")
    assert read_database(spark, folder, "t", ddl).count() == 0


def test_no_manifest_after_a_failure(spark, tmp_path):
    folder = str(tmp_path / "out")
    with pytest.raises(Exception, match="stop"):
        write_database(spark.range(100).selectExpr("if(id = 77, raise_error('stop'), id) id"), folder, "t")
    assert not os.path.exists(f"{folder}/{database.MANIFEST}")


def test_shipped_files(spark, path, tmp_path):
    spark.sparkContext.addFile(path)
    df = read_database(spark, os.path.basename(path), "t", "id BIGINT", shipped="true", keys_per_range="250")
    assert df.filter("id >= 900").count() == 100
    with pytest.raises(Exception, match="all nodes see"):
        read_database(spark, "hdfs://host/file.db", "t").count()


def test_all_input_tables(spark, tmp_path):
    tables = hand_tables(
        spark,
        **compounds(1, 2, 3, phase={1: 4.0}, parents={3: 2}),
        **targets(5, 6),
        **measurements((1, 5, 5.0), (2, 5, 6.25), (3, 5, 7.0, "F", "V600E", 2000), (2, 6, 6.0)),
        **curated((1, 5)),
    )
    file = str(tmp_path / "snapshot.db")
    db = sqlite3.connect(file)
    for name, ddl in INPUT_DDL.items():
        renamed = ddl.replace("potency", "own_value")
        db.execute(f"CREATE TABLE {name} ({renamed}, not_read TEXT)")
        for row in tables[name].collect():
            db.execute(f"INSERT INTO {name} VALUES ({', '.join('?' * len(row))}, 'x')", tuple(row))
    db.commit()
    db.close()
    read = read_tables_database(spark, file, rename={"own_value": "potency"})
    assert len(read) == 18 and all(read[n].schema == tables[n].schema for n in read)
    cfg = PairConfig(min_pairs_bf=1, min_pairs_b=1)
    found = [pair_table.full_table(pair_table.core(t, cfg), t, cfg).orderBy("cpd_target_pair_mutation").collect() for t in (tables, read)]
    assert found[0] == found[1] and len(found[0]) == 3
