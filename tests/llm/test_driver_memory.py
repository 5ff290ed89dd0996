"""What the pipeline's driver holds: few stages in the join and in mixing, and a small sample."""

import random
import tracemalloc
import uuid

import numpy as np
import pyarrow as pa
import pytest

from veedor.llm import jaccard_join, language_id, mixing, storage


def stages_of(spark, run):
    """What ``run`` gives, and how many stages its jobs had."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    out, tracker = run(), spark.sparkContext.statusTracker()
    return out, sum(len(tracker.getJobInfo(k).stageIds) for k in tracker.getJobIdsForGroup(group))


def forest(seed):
    rng = random.Random(seed)
    pairs = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(250)] + [(k, k + 1) for k in range(1000, 1060)]
    least = {n: n for p in pairs for n in p}
    for _ in least:
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    return pairs, least


def test_few_links_are_joined_up_in_few_stages(spark):
    pairs, least = forest(1)
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(7)
    got, stages = stages_of(spark, lambda: jaccard_join.components(edges).collect())
    assert {r["node"]: r["comp"] for r in got} == least and len(got) == len(least)
    assert stages <= 8


@pytest.mark.parametrize("links", [1, 20])
def test_many_links_give_the_same_components(spark, monkeypatch, links):
    monkeypatch.setattr(jaccard_join, "LINKS", links)
    pairs, least = forest(2)
    edges = spark.createDataFrame(pairs, "a long, b long").repartition(3)
    with storage.small_batches(spark):
        got = {r["node"]: r["comp"] for r in jaccard_join.components(edges).collect()}
    assert {n: got.get(n, n) for n in least} == least and set(got) <= set(least)


def test_running_sums_of_few_rows(spark):
    rows = spark.createDataFrame([("c", 3), ("a", 1), (None, 7), ("b", 2)], "k string, n long").repartition(4)
    few, many = (sorted(map(tuple, storage.running_sums(rows, ["k"], {"upto": "n"}, x).collect()), key=str) for x in (True, False))
    assert few == many == sorted([(None, 7, 7), ("a", 1, 8), ("b", 2, 10), ("c", 3, 13)], key=str)


def test_mixing_is_the_same_with_many_sources(spark, docs, monkeypatch):
    few, stages = stages_of(spark, lambda: sorted(map(tuple, mixing.mix(docs).collect()), key=str))
    monkeypatch.setattr(storage, "FEW", 0)
    many, more = stages_of(spark, lambda: sorted(map(tuple, mixing.mix(docs).collect()), key=str))
    assert few == many and stages < more - 8


def test_the_language_sample_is_small_in_the_driver():
    rng = np.random.default_rng(5)
    counts = np.zeros((2048, language_id.CELLS), np.int32)
    for k in range(len(counts)):
        counts[k, rng.integers(0, language_id.CELLS // 2, 300) + k % 2 * language_id.CELLS // 2] += 1
    labels = ["one" if k % 2 else "other" for k in range(len(counts))]
    packed = [language_id._pack(n) for n in counts]
    assert max(map(len, packed)) <= 1800 and (language_id._unpack(packed) == counts).all()
    (sent,) = language_id._vectorise(iter([pa.RecordBatch.from_arrays([pa.array(["x"]), pa.array(["one small text"])], ["label", "text"])]))
    assert len(sent["counts"][0].as_py()) < 200
    tracemalloc.start()
    model = language_id._train(labels, packed)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80e6  # all vectors together took over 100 MB
    assert (np.array(model.languages)[model.nearest(model.vectors(counts))[0]] == labels).all()
    assert language_id._train(["x"], [b""]) is None
