import random

import corpus
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from veedor.llm import jaccard_join, language_id, mixing, queries, sharding


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A tiny set of tables with near-duplicates, test passages and texts of no language."""
    rng = random.Random(12)
    parts = {"aa": ["ka", "lo", "mi", "tu", "be"], "bb": ["schr", "ung", "eit", "ver", "tz"]}
    word = lambda lang: "".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 5)))
    items = [(k, " ".join(word("aa") for _ in range(14))) for k in range(3)]
    rows = []
    for k in range(120):
        lang = ("aa", "bb")[k % 2]
        w = [word(lang) for _ in range(rng.randint(20, 120))]
        if k % 12 == 0:
            w[10:10] = items[k % 3][1].split()
        rows.append((k, " ".join(w), lang, f"s{k % 4}", None))
        if k % 10 == 3:
            w[3] = "edited"
            rows.append((500 + k, " ".join(w), lang, "s0", None))
    rows += [(900, None, "aa", "s0", None), (901, "12 34 !!", "aa", "s1", None), (902, "", "bb", None, None)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, items


def test_stages_decide_as_brute_force_does(spark, folder):
    path, rows, items = folder
    docs, seen = spark.read.parquet(f"{path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = stage(spark, docs, path).cache()
        docs = seen[name]
        assert set(columns) <= set(docs.columns) and (name == "sharding" or docs.columns == columns)
    ids = {n: sorted(r["doc_id"] for r in d.collect()) for n, d in seen.items()}
    text = {r[0]: r for r in rows}
    assert ids["language_id"] == sorted(set(text) - {900, 901, 902})
    near = corpus.near_components([text[d] for d in ids["language_id"]])
    assert ids["jaccard_join"] == sorted({c for _, c in near.values()})
    holds = lambda d: any(f" {q} " in f" {text[d][1]} " for _, q in items)
    assert ids["decontamination"] == [d for d in ids["jaccard_join"] if not holds(d)]
    words = lambda d: d.agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert words(seen["mixing"]) == pytest.approx(1.5 * words(seen["decontamination"]), rel=0.15) and set(ids["mixing"]) <= set(ids["decontamination"])
    assert ids["sharding"] == ids["mixing"] and seen["sharding"].groupBy("text").agg(F.count_distinct("shard").alias("n")).filter("n > 1").isEmpty()


def test_run_gives_the_last_stage(spark, folder):
    out = corpus_pipeline.run(spark, folder[0])
    assert "shard" in out.columns and out.count() > 50


def test_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontamination", "mixing", "sharding"]


#: Names that the stages use for columns of their own.
INTERNAL = [
    "shard", "_group_key", "_item", "_own", "_bundled", "item", "load", "_found_by_key", "doc_key", "_key", "item_key", "hash", "shingle", "_stays", "_id", "node", "n", "comp", "component_id", "holder",
    "_rejected", "_text", "_lang_pred", "_score", "label", "bucket", "_whole", "_draw", "_times", "row", "draw", "size", "taken", "target", "source_key", "block", "_hot", "_cell", "_page", "_bits", "w", "s", "h", "b",
]


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_hand_columns_of_any_name_through(spark, tmp_path, stage):
    rows = [(k, f"the quick fox {k} jumps over many lazy dogs in the field near river {k % 30}" if k % 7 else None, "en", f"s{k % 3}", k) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    spark.createDataFrame([(1, "jumps over many lazy dogs in the field near river 4")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    run = dict(corpus_pipeline.STAGES)[stage]
    extra = docs.withColumns({c: F.concat(F.lit(f"my {c} "), F.col("doc_id")) for c in INTERNAL})
    plain, wide = run(spark, docs, str(tmp_path)), run(spark, extra, str(tmp_path))
    assert sorted(r["doc_id"] for r in plain.collect()) == sorted(r["doc_id"] for r in wide.collect()) and plain.count() > 0
    kept = [c for c in INTERNAL if c != "shard" or stage != "sharding"]
    assert set(extra.columns) <= set(wide.columns) and wide.filter(" OR ".join(f"`{c}` != concat('my {c} ', doc_id)" for c in kept)).isEmpty()


def test_the_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_the_join_sends_small_batches_and_puts_the_setting_back(spark, folder, monkeypatch):
    key, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    was, join = spark.conf.get(key), jaccard_join._near_duplicates
    monkeypatch.setattr(jaccard_join, "_near_duplicates", lambda docs: seen.append(int(spark.conf.get(key))) or docs)
    jaccard_join.near_duplicates(spark.range(1))
    monkeypatch.setattr(jaccard_join, "_near_duplicates", lambda docs: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jaccard_join.near_duplicates(spark.range(1))
    assert seen == [1000] and spark.conf.get(key) == was
    monkeypatch.setattr(jaccard_join, "_near_duplicates", join)
    plan = jaccard_join.near_duplicates(spark.range(1).selectExpr("id AS doc_id", "'a b' AS text"))._jdf.queryExecution().toString()
    assert "InArrow" not in plan  # no Python worker runs after the setting is back


def test_texts_reach_the_language_model_once_and_the_shard_plan_without_python(spark):
    docs = spark.range(9).selectExpr("id AS doc_id", "string(id) AS text", "'en' AS lang", "id % 2 AS more")
    assert "_text" not in language_id.accepted(docs)._jdf.queryExecution().analyzed().toString()
    plan = sharding.schedule(docs.selectExpr("doc_id + 1 AS size", "text AS _group_key"), 4)
    assert plan.count() == 9 and "LocalRelation" in plan._jdf.queryExecution().analyzed().toString()
