"""Each stage of the pipeline on what its predecessor kept, against a plain version of it."""

from __future__ import annotations

import re

import numpy as np
import plain
import public_tokenizers
import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql.readwriter import DataFrameWriter
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from conftest import ODD
from pairloom.llm import decontaminate, quality, shared
from pairloom.llm.shared import documents, written

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """The rows before the first stage and after each."""
    docs, out = documents(spark, SF_DIR), []
    for name, stage in corpus_pipeline.STAGES:
        out.append(docs)
        docs = written(stage(spark, docs, SF_DIR), name)
    return [*out, docs]


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_keep_the_columns(kept):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(df.schema.simpleString() == kept[0].schema.simpleString() for df in kept[:5])


def test_quality(spark, kept):
    scores = quality.scored(kept[0], spark.read.parquet(f"{SF_DIR}/labels.parquet")).collect()
    assert set(texts(kept[1])) == {r.doc_id for r in scores if r.score >= 0.3}
    before = texts(kept[0])
    marked = [d for d, t in before.items() if t.count("%%%") > 10 or t.count("!!") > 10]
    assert marked and not set(marked) & set(texts(kept[1]))


def test_near_dedup(kept):
    before, after = texts(kept[1]), texts(kept[2])
    least: dict = {}
    for (doc_id, _, root) in plain.near_groups(list(before.items())):
        least[root] = min(doc_id, least.get(root, doc_id))
    assert set(after) == set(least.values()) and len(after) < len(before)


def test_decontamination(spark, kept):
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    plainly = lambda t: " ".join(re.findall(r"[^\W_]+", t.lower()))
    before, after = texts(kept[2]), texts(kept[3])
    held = {d for d, t in before.items() if any(plainly(i) in plainly(t) for i in items)}
    assert held and set(after) == set(before) - held


def test_secrets(kept):
    before, after = texts(kept[3]), texts(kept[4])
    assert set(before) == set(after)
    changed = {d for d in before if before[d] != after[d]}
    assert changed == {d for d, t in before.items() if plain.base_spans(t)}
    for d in changed:
        out, at = "", 0
        for span in plain.base_spans(before[d]).split(","):
            _, a, b = span.split(":")
            if int(a) >= at:
                out += before[d][at : int(a)] + "<secret>"
            at = max(at, int(b))
        assert after[d] == out + before[d][at:]


def test_packing(kept):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts(kept[4]).items()}
    got: dict[int, int] = {}
    for p in kept[5].collect():
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
    assert got == want


def test_run_is_all_stages(spark, kept):
    columns = ["doc_id", "start", "length", "ids_crc32"]
    run = contract.queries()["pipeline"](spark, SF_DIR).select("doc_id", "doc_tokens").distinct()
    assert sorted(run.collect()) == sorted(kept[5].select("doc_id", "doc_tokens").distinct().collect())
    assert set(columns) <= set(kept[5].columns) and np.isfinite(kept[5].count())


def test_odd_rows_through_all_stages(spark, frame, tmp_path):
    """Nulls, empty, very long and repeated texts, clashing names, in a label table with nulls and repeats too."""
    frame(ODD + [(20, None)] * 3).write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(1, 1, 0), (6, 0, 0), (7, 1, 1), (7, 1, 1), (8, None, None), (None, 1, 0), (5, 1, 0), (2, 0, 1), (3, 0, 0)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    items = [(1, "a passage of the benchmark that no document holds at all anywhere"), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark, str(tmp_path))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        assert docs.columns == columns
        docs = written(stage(spark, docs, str(tmp_path)), name)
    pieces = docs.collect()
    assert {p.doc_id for p in pieces} <= {d for d, _ in ODD} | {20}
    assert all(0 < p.length <= 4096 for p in pieces)


def test_empty_tables(spark, frame, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_steps_are_deleted_and_results_stay(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(shared, "folder", lambda _: str(tmp_path))
    out = corpus_pipeline.run(spark, SF_DIR)
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["packing"] and out.count() > 0


def python_nodes(plan):
    """How many nodes of each stage of a physical plan have a Python worker of their own in every task."""
    counts, path = [0], [(-1, 0)]
    for line in plan.splitlines():
        depth = re.search(r"[A-Za-z]", line)
        if not depth:
            continue
        while path[-1][0] >= depth.start():
            path.pop()
        stage = path[-1][1]
        counts[stage] += bool(re.match(r"MapIn|\w*EvalPython|\w*InPandas|\w*InArrow", line[depth.start() :]))
        if re.match(r"\w*Exchange", line[depth.start() :]):
            stage = len(counts)
            counts.append(0)
        path.append((depth.start(), stage))
    return counts


def test_a_task_has_one_python_worker(spark, kept, monkeypatch):
    """Executors keep the workers for the stages that follow, each with the tokenizer and other tables of its own."""
    plans = []

    def noted(owner, name, frame):
        plain_way = getattr(owner, name)

        def run(self, *args, **kwargs):
            plans.append(re.sub(r"\*\(\d+\) ", "", frame(self)._jdf.queryExecution().executedPlan().toString()))
            return plain_way(self, *args, **kwargs)

        monkeypatch.setattr(owner, name, run)

    noted(DataFrame, "collect", lambda df: df)
    noted(DataFrameWriter, "parquet", lambda writer: writer._df)
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 5)
    for (name, stage), before in zip(corpus_pipeline.STAGES, kept):
        plans.clear()
        done = written(stage(spark, before, SF_DIR), name)
        found = [n for plan in plans for n in python_nodes(plan)]
        assert max(found) <= 1, (name, plans)
        assert max(found) == 1 or name == "secret_scans"
        if name == "benchmark_decontamination":
            assert sum(found) > 2 and sorted(texts(done)) == sorted(texts(kept[3]))


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        get = staticmethod(lambda name, default=None: {"spark.sql.warehouse.dir": "/warehouse"}.get(name, default))

    class Context:
        master = "local[8]"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf, sparkContext = Conf, Context

    assert shared.folder(Session) == "/warehouse/_steps"
    Context.master = "yarn"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.folder(Session)
