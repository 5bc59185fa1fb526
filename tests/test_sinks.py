from __future__ import annotations

import os

import pytest
from hand_tables import compounds, curated, hand_tables, measurements, targets
from pyspark.sql import functions as F

from pairloom.config import OutputConfig, PairConfig
from pairloom.operators import quality
from pairloom.plans import pair_table
from pairloom.plans import publish as plans
from pairloom.plans.publish import publish, read_release
from pairloom.sinks import csv, files
from pairloom.sinks.csv import read_csv, write_csv, write_verified
from pairloom.sinks.staging import shared_folder, stage

TEXTS = ["plain", 'with "quotes"', "a;b", "line\nbreak", "cr\r\nlf", " blanks ", "null", "nan", "back\\slash", "ünï", '"', "'"]


def frame(spark):
    rows = [(i, t, i % 2 == 0, i / 7) for i, t in enumerate(TEXTS)] + [(99, None, None, None)]
    return spark.createDataFrame(rows, "id BIGINT, text STRING, truth BOOLEAN, number DOUBLE")


@pytest.mark.parametrize("delimiter", [";", ",", "\t", "|"])
def test_text_round_trip(spark, tmp_path, delimiter):
    df = frame(spark)
    read = write_verified(df, str(tmp_path / "out"), delimiter)
    assert read.schema == df.schema
    assert sorted(read.collect()) == sorted(df.collect())


def test_truth_values_and_header(spark, tmp_path):
    write_csv(frame(spark).filter("id < 2").coalesce(1), str(tmp_path / "out"))
    part = next(f for f in os.listdir(tmp_path / "out") if f.endswith(".csv"))
    lines = (tmp_path / "out" / part).read_text().splitlines()
    assert lines[0] == "id;text;truth;number"
    assert lines[1] == "0;plain;True;0.0"


def test_changed_file_is_found(spark, tmp_path):
    df = frame(spark)
    write_csv(df.withColumn("number", F.col("number") + 1), str(tmp_path / "out"))
    read = read_csv(spark, str(tmp_path / "out"), df.schema)
    assert not quality.bag_difference(df, read).isEmpty()


@pytest.mark.parametrize(
    "change",
    [
        lambda df: df.withColumn("number", F.when(F.col("id") == 3, F.col("number") + 1e-9).otherwise(F.col("number"))),
        lambda df: df.filter("id <> 4"),
        lambda df: df.unionAll(df.filter("id = 4")),
        lambda df: df.withColumns({"text": F.when(F.col("id") == 99, "x").otherwise(F.col("text"))}),
    ],
)
def test_what_was_not_written_as_it_was_is_found(spark, tmp_path, monkeypatch, change):
    """A changed, a lost, a doubled row, and a value where there was none."""
    wrong = lambda own, path, delimiter: write_csv(change(own), path, delimiter)
    monkeypatch.setattr(csv, "write_csv", wrong)
    with pytest.raises(ValueError, match="differs from its source"):
        write_verified(frame(spark), str(tmp_path / "out"))


def test_marks_tell_bags_apart(spark):
    marks = lambda rows: spark.createDataFrame(rows, "a string, b string").transform(lambda d: d.agg(*quality.bag_marks(d))).first()
    bag = [("x", None), ("y", "z"), ("y", "z")]
    assert marks(bag) == marks(bag[::-1])
    others = [[(None, "x"), *bag[1:]], bag[:2], [*bag, bag[0]], [bag[0], bag[0], bag[1]], [("x", ""), *bag[1:]], [("z", "y"), *bag[:2]]]
    assert len({marks(bag), *map(marks, others)}) == 7
    assert marks([]).rows == 0


def test_wrong_type_fails(spark, tmp_path):
    write_csv(frame(spark), str(tmp_path / "out"))
    wrong = spark.createDataFrame([], "id BIGINT, text BIGINT, truth BOOLEAN, number DOUBLE").schema
    with pytest.raises(Exception, match="(?i)malformed|cannot parse"):
        read_csv(spark, str(tmp_path / "out"), wrong).collect()


def test_bag_difference_counts_copies(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a BIGINT, b STRING")
    right = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "a BIGINT, b STRING")
    got = sorted((r.a, r.b, r.surplus) for r in quality.bag_difference(left, right).collect())
    assert got == [(1, None, 1), (3, "y", -1)]
    with pytest.raises(ValueError, match="different columns"):
        quality.bag_difference(left, right.drop("b"))


def test_stage_writes_to_the_shared_folder(spark):
    staged = stage(spark.range(1000).repartition(4), "numbers")
    assert staged.rows == staged.frame.count() == 1000
    assert all(shared_folder(spark) in f for f in staged.frame.inputFiles())
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_publish(spark, tmp_path):
    tables = hand_tables(
        spark,
        **compounds(1, 2, 3, phase={1: 4.0}),
        **targets(5, 6),
        **measurements((1, 5, 5.0), (2, 5, 6.0), (3, 5, 7.0, "F", None, 2000), (2, 6, 6.0)),
        **curated((1, 5)),
    )
    cfg = PairConfig(min_pairs_bf=3, min_pairs_b=2)
    out = OutputConfig(str(tmp_path), release="r1", write_bf=True, write_b=True, write_sizes=True)
    paths = publish(tables, cfg, out)
    names = [os.path.basename(p) for p in paths]
    base = "r1_CTI_literature_only"
    assert names == [
        f"{base}_full_dataset",
        *[f"{base}_{x}" for x in ("BF", "BF_3", "BF_3_c_dt_d_dt", "BF_3_d_dt", "B", "B_2", "B_2_c_dt_d_dt", "B_2_d_dt")],
        f"{base}_targets_w_more_than_one_tclass",
        "debug_sizes_all",
        "debug_sizes_measured",
    ]
    rows = {n: spark.read.options(header=True, sep=";").csv(p) for n, p in zip(names, paths)}
    assert rows[f"{base}_full_dataset"].count() == 3
    assert [r.cpd_target_pair_mutation for r in rows[f"{base}_full_dataset"].collect()] == ["1_5", "2_5", "3_5"]
    assert rows[f"{base}_B_2_d_dt"].count() == 2
    stats = spark.read.options(header=True, sep=";").csv(f"{paths[0]}_stats")
    assert stats.count() == 40
    got = {(r.column, r.subset_type): int(r.counts) for r in stats.collect()}
    assert got[("parent_molregno", "all")] == 3 and got[("tid", "drugs")] == 1 and got[("tid", "candidates")] == 0
    sizes = {r.step: r for r in rows["debug_sizes_all"].collect()}
    assert len(sizes) == 15
    assert [sizes[step].cpd_target_pair_all for step in pair_table.STEPS] == ["4", "4", "3", "3", "3", "3", "3"]
    assert read_release(spark, str(tmp_path), base) == dict(zip(names, paths))


class Stopped(Exception):
    pass


def test_a_run_that_stops_leaves_the_release(spark, tmp_path, monkeypatch):
    def tables(value):
        return hand_tables(spark, **compounds(1, 2), **targets(5), **measurements((1, 5, value), (2, 5, 6.0)), **curated((1, 5)))

    def stop_at_third(df, path, delimiter, own=plans.write_artifact, seen=[]):  # noqa: B006
        seen.append(path)
        if len(seen) == 3:
            raise Stopped
        own(df, path, delimiter)

    cfg, out = PairConfig(min_pairs_bf=1, min_pairs_b=1), OutputConfig(str(tmp_path), release="r1", write_bf=True)
    name = plans.release_name(cfg, out)
    means = lambda: sorted(
        r.potency_mean_BF
        for r in spark.read.options(header=True, sep=";").csv(read_release(spark, str(tmp_path), name)[f"{name}_full_dataset"]).collect()
    )
    staged = shared_folder(spark)
    before = set(os.listdir(staged))
    publish(tables(5.0), cfg, out)
    assert set(os.listdir(staged)) == before  # what was staged is gone
    with monkeypatch.context() as m:
        m.setattr(plans, "write_artifact", stop_at_third)
        with pytest.raises(Stopped):
            publish(tables(7.0), cfg, out)
    assert means() == ["5.0", "6.0"] and set(os.listdir(staged)) == before
    old = read_release(spark, str(tmp_path), name)
    publish(tables(7.0), cfg, out)
    publish(tables(7.0), cfg, out)  # again: harmless
    assert means() == ["6.0", "7.0"] and set(read_release(spark, str(tmp_path), name)) == set(old)
    assert len(os.listdir(tmp_path / "_runs")) == 4
    assert len(plans.drop_other_runs(spark, str(tmp_path), [name])) == 3 and means() == ["6.0", "7.0"]
    assert plans.drop_other_runs(spark, str(tmp_path), [name]) == []


def test_a_file_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "new folder" / "x.json")
    for text in ("one", "twö"):
        files.replace(spark, path, text)
        assert files.text_of(spark, path) == text
    assert [f for f in os.listdir(tmp_path / "new folder") if not f.endswith(".crc")] == ["x.json"]
    files.delete(spark, path)
    assert not files.exists(spark, path) and files.folders(spark, str(tmp_path / "absent")) == []


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        get = staticmethod(lambda name, default=None: {"spark.sql.warehouse.dir": "/warehouse/"}.get(name, default))

    class Context:
        master = "local[8]"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf, sparkContext = Conf, Context

    assert shared_folder(Session) == "/warehouse/_staged"
    for master in ("yarn", "local-cluster[3,2,1000]", "spark://host:7077"):
        Context.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(Session)


def test_publish_stops_at_violations(spark, tmp_path):
    tables = hand_tables(
        spark, **compounds(1), **targets(5, pref_name="nan"), **measurements((1, 5, 5.0)), **curated((1, 5))
    )
    with pytest.raises(ValueError, match="literal:nan.: 1"):
        publish(tables, PairConfig(), OutputConfig(str(tmp_path / "out")))
    assert not os.path.exists(tmp_path / "out" / "snapshot_CTI_literature_only.json")


def test_stage_of_nothing(spark):
    """Also where the optimizer sees that there are no rows."""
    for empty in (spark.range(0), spark.range(10).filter("id > 20"), spark.range(10).filter("false")):
        staged = stage(empty, "nothing")
        assert staged.rows == staged.frame.count() == 0


def test_no_known_pairs(spark):
    """Without curated pairs no target is a known one, so no pair remains."""
    tables = hand_tables(spark, **compounds(1), **targets(5), **measurements((1, 5, 5.0)))
    cfg = PairConfig()
    pairs = pair_table.core(tables, cfg)
    assert pairs.rows == 0
    assert pair_table.full_table(pairs, tables, cfg).count() == 0
