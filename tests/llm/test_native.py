import hashlib
import re
import zlib

import corpus
import pytest
from pyspark.sql import functions as F

from veedor.llm import chat_format, decontamination, exact_dedup, mixing, sharding, storage

SAID = "</s>[INST] ok [/INST]"
TURNS = [
    (1, 0, "system", "be <|end|> kind \\", 9), (1, 1, "user", "hi", 9), (1, 2, "assistant", SAID, 9), (1, 3, "user", None, 9), (1, 4, "assistant", "<|turn|>\\<|body|>", 9), (1, 5, "user", "bye", 9),
    (2, 0, "assistant", "é😀", 9), (2, 0, "assistant", "é😀", 9), (2, None, None, "first", 9), (None, 1, "user", "lost", 9), (3, 0, "user", "", 9),
] + [(7, k, ("user", "assistant")[k % 2], f"t{k} [INST]", 9) for k in range(150)]


@pytest.fixture(scope="module")
def formatted(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string, e long")
    return chat_format.format_conversations(turns).cache()


def expected_conversations():
    out = {}
    for conv in {t[0] for t in TURNS}:
        mine = sorted((t for t in TURNS if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        said = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in mine)
        loss = "".join(t[3] or "" for t in mine if t[2] == "assistant")
        out[conv] = (len(mine), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_chat_digest_reads_back_every_turn(formatted):
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat_format.digest(formatted).collect()}
    assert got == expected_conversations()


def test_chat_examples_are_prefixes_with_one_trained_reply(formatted):
    rows = chat_format.explode_examples(formatted.filter("conv_id = 1")).orderBy(F.char_length("text")).collect()
    assert [r["turn_index"] for r in rows] == [2, 4, -1]
    assert rows[1]["text"].startswith(rows[0]["text"]) and rows[2]["loss_chars"] == 0
    first = rows[0]["text"][rows[0]["loss_start"] : rows[0]["loss_start"] + rows[0]["loss_chars"]]
    assert SAID not in first and re.sub(r"\\(.)", r"\1", first) == SAID
    assert len(chat_format.explode_examples(formatted.filter("conv_id = 7")).collect()) == 75


def test_chat_of_very_many_turns_and_long_texts(spark):
    turns = spark.range(12_000).selectExpr("5L AS conv_id", "id AS turn", "if(id % 40 = 39, 'assistant', 'user') AS role", "if(id = 7, repeat('</s>', 50000), 'hm') AS text")
    (row,) = chat_format.digest(chat_format.format_conversations(turns)).collect()
    assert row["n_turns"] == 12_000 and row["loss_chars"] == 600 and row["n_examples"] == 300


def test_chat_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.digest(chat_format.format_conversations(none)).collect() == []


def test_exact_dedup(docs, rows):
    norm = {r[0]: re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows}
    groups = {}
    for d, t in norm.items():
        groups.setdefault(t, []).append(d)
    got = {r["doc_id"]: r for r in exact_dedup.exact_dedup(docs).collect()}
    assert len(got) == len(rows)
    for d, t in norm.items():
        assert (got[d]["keep_id"], got[d]["group_size"]) == (min(groups[t]), len(groups[t]))
        assert got[d]["kept"] == (d == min(groups[t])) and got[d]["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()


def test_bloom_passes_proven_unique_rows(spark):
    keys = exact_dedup.digests(spark.range(5000).selectExpr("id AS doc_id", "cast(id % 4900 AS string) AS text"))
    marked = exact_dedup.mark_possible_repeats(keys, 5000).cache()
    assert marked.filter("doc_id % 4900 < 100 AND NOT possible").count() == 0
    assert marked.filter("possible").count() < 600


def test_exact_dedup_when_the_filter_is_full(docs, monkeypatch):
    want = sorted(map(tuple, exact_dedup.exact_dedup(docs).collect()))
    monkeypatch.setattr(exact_dedup, "MAX_BITS", 1)
    monkeypatch.setattr(exact_dedup, "_PAGE", 8)
    assert sorted(map(tuple, exact_dedup.exact_dedup(docs).collect())) == want


def test_exact_dedup_nulls_and_repeats(spark, empty):
    assert exact_dedup.exact_dedup(empty).collect() == []
    rows = spark.createDataFrame([(None, "a"), (None, "b"), (5, "a"), (5, "a")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(rows).collect())
    assert got == [("5", "5", 3, True), ("5", "5", 3, True), ("None", "5", 3, False), ("None", "None", 1, True)]


def test_attach_groups_with_a_hot_key(spark):
    rows = spark.range(6000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k")
    groups = rows.groupBy("k").count()
    got = storage.attach_groups(rows, groups, "k", "count", 6000)
    assert got.count() == 6000 and got.filter("k = -1 AND count = 2000").count() == 2000


def test_least_loaded_takes_the_largest_first():
    placed = sharding.least_loaded([(5, "a"), (4, "b"), (3, "c"), (3, "d"), (3, "e")], 2)
    loads = [sum(s for s, n in [(5, "a"), (4, "b"), (3, "c"), (3, "d"), (3, "e")] if placed[n] == k) for k in (0, 1)]
    assert sorted(loads) == [8, 10]


def test_sharding(docs, rows, empty):
    got = {r["doc_id"]: r for r in sharding.shard_documents(docs).collect()}
    text = {r[0]: r[1] for r in rows}
    assert got.keys() == text.keys()
    home, slots, loads = {}, {}, {}
    for d, r in got.items():
        raw = (text[d] or "").encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw) and r["law"] == "bytes"
        assert home.setdefault(text[d], r["shard"]) == r["shard"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(loads) <= set(range(16))
    assert sharding.shard_documents(empty).collect() == []


def test_sharding_levels_many_small_groups(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "repeat('x', cast(id % 700 AS int)) || id AS text")
    loads = [r["s"] for r in sharding.shard_documents(docs).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(loads) == 16 and max(loads) < 1.002 * min(loads)


def test_sharded_rows_keep_their_columns(docs):
    out = sharding.sharded_rows(docs)
    assert set(out.columns) == set(docs.columns) and out.count() == docs.count()


def targets(sizes):
    """Resharing by rounds, as the contract words it."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_, got = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        if not full:
            return got | {s: level * weight[s] for s in open_}
        for s in full:
            got[s] = 2 * sizes[s]
            left -= got[s]
            open_.remove(s)
    return got


def test_mixing(docs, rows, empty):
    got = mixing.mix(docs).collect()
    sizes, taken = {}, {}
    source = {r[0]: r[3] for r in rows}
    n = {r[0]: len(corpus.words(r[1])) for r in rows}
    for r in got:
        assert r["size"] == n[r["doc_id"]] and 0 <= r["taken"] <= 2 * r["size"]
        s = source[r["doc_id"]]
        sizes[s], taken[s] = sizes.get(s, 0) + r["size"], taken.get(s, 0) + r["taken"]
    want = targets(sizes)
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
    for s, t in want.items():
        assert abs(taken[s] - t) <= 0.01 * t + mixing.BLOCK
    again = sorted((r["doc_id"], r["taken"]) for r in mixing.mix(docs.repartition(5)).collect())
    assert again == sorted((r["doc_id"], r["taken"]) for r in got)
    assert mixing.mix(empty).collect() == []


def test_mixed_rows_keep_columns_and_targets(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', cast(id % 90 + 1 AS int)) || id AS text", "'s' || (id % 3) AS source")
    out = mixing.mix_rows(docs)
    assert out.columns == docs.columns
    whole = docs.agg(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert out.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == pytest.approx(1.5 * whole, rel=0.05)


def test_slots_visit_every_block_before_any_again(spark):
    plan = spark.createDataFrame([("s", 1000, 1300)], "source_key string, blocks long, slots long")
    counts = [r["n"] for r in mixing.draw_slots(plan, 1).groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(counts) == 1000 and sorted(counts) == [1] * 700 + [2] * 300


ITEMS = [(1, "one two three four five six seven eight nine ten"), (2, "tiny item"), (3, None), (4, "!!"), (5, "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu.")]


def brute_matches(docs, items):
    cut = lambda t: [w for w in re.split(r"[^\w]+|_+", (t or "").lower()) if w]
    sets = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    for d, t in docs:
        for i, q in items:
            q = sets(cut(q))
            if q and len(q & sets(cut(t))) >= 0.75 * len(q):
                yield d, i


def test_decontamination(spark, empty):
    long = " ".join(f"w{k}" for k in range(3000))
    docs = [
        (1, f"{long} One, two THREE four five six seven eight nine ten {long}"), (2, "tiny item"), (3, "a tiny item here"), (4, None), (5, ""), (6, "one two three four five six seven nope nope nope nope"),
        (7, "alpha beta gamma delta epsilon zeta eta theta iota kappa changed here"), (8, long), (1, f"{long} One, two THREE four five six seven eight nine ten {long}"), (None, "tiny -- item"),
    ]
    rows = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, n long")
    items = spark.createDataFrame([(*i, 1) for i in ITEMS], "item_id long, text string, n long")
    got = sorted((str(r["doc_id"]), r["item_id"]) for r in decontamination.find_matches(rows, items).collect())
    assert got == sorted({(str(d), i) for d, i in brute_matches(docs, ITEMS)})
    kept = decontamination.clean_rows(rows, items)
    assert kept.columns == rows.columns and sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6, 8]
    assert decontamination.find_matches(empty, items).collect() == [] and decontamination.find_matches(rows, items.limit(0)).collect() == []


def test_decontamination_beyond_the_broadcast_line_and_of_shared_ids(spark, monkeypatch):
    docs = [(1, "x one two three four five six seven eight nine ten y"), (1, "a clean text that shares its id"), (None, "tiny item"), (None, "clean"), (2, "c d")]
    rows = spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, _found long")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted({(str(d), i) for d, i in brute_matches(docs, ITEMS)})
    for most in (200_000, 0):
        monkeypatch.setattr(decontamination, "BROADCAST_ROWS", most)
        assert sorted((str(r["doc_id"]), r["item_id"]) for r in decontamination.find_matches(rows, items).collect()) == want
    kept = decontamination.clean_rows(rows, items)
    assert kept.columns == rows.columns and sorted(r["text"] for r in kept.collect()) == ["a clean text that shares its id", "c d", "clean"]
