"""The mix against a plain version that repeats every draw, block by block."""

import struct
from collections import Counter, defaultdict

import corpus
import pytest
from pyspark.sql import functions as F
from test_native import targets

from veedor.llm import mixing

xxhash = pytest.importorskip("xxhash")


def spark_hash(*values):
    """Spark's xxhash64; pairs ("i", n) are 4-byte integers."""
    h = 42
    for v in values:
        raw = v.encode() if isinstance(v, str) else struct.pack("<i", v[1]) if isinstance(v, tuple) else struct.pack("<q", v)
        h = xxhash.xxh64(raw, seed=h).intdigest()
    return h - 2**64 if h >= 2**63 else h


def permuted(x, n, seed, source, cycle):
    for i in range(1, mixing.ROUNDS + 1):
        key = spark_hash(("i", seed), source, ("i", cycle + 1), ("i", i)) % n
        partner = (key - x) % n
        if spark_hash(key, max(x, partner)) % 2:
            x = partner
    return x


def key_of(source):
    return "t" if source is None else f"s{source}"


def mixed_by_hand(rows, seed):
    """Slots ``(shard, place) -> (source key, k, block)`` and words taken of each row number."""
    size = [len(corpus.words(r[1])) for r in rows]
    sizes = defaultdict(int)
    for r, n in zip(rows, size):
        sizes[r[3]] += n
    blocks = {key_of(s): -(-n // mixing.BLOCK) for s, n in sizes.items()}
    want = {key_of(s): t for s, t in targets({s: n for s, n in sizes.items()}).items()}
    total_of = {key_of(s): n for s, n in sizes.items()}
    slots = {s: min(2 * b, int(want[s] / total_of[s] * b + 0.5)) if b else 0 for s, b in blocks.items()}
    order, numbers, total = sorted(s for s in slots if slots[s]), {}, 0
    for s in order:
        numbers[s] = range(total, total + slots[s])
        total += slots[s]
    drawn = []
    for g in range(total):
        shard, place = divmod(g, mixing.SHARD_SLOTS)
        u = spark_hash(("i", seed), "source", shard, place) % total
        drawn.append((next(s for s in order if u in numbers[s]), shard, place))
    counts, slot_of, spare = Counter(), {}, []
    for s, shard, place in sorted(drawn):
        if counts[s] < slots[s]:
            slot_of[shard, place] = (s, counts[s])
        else:
            spare.append((shard, place))
        counts[s] += 1
    lacking = [(s, k) for s in order for k in range(counts[s], slots[s])]
    assert len(lacking) == len(spare)
    slot_of |= dict(zip(spare, lacking))
    slot_of = {at: (s, k, permuted(k % blocks[s], blocks[s], seed, s, k // blocks[s])) for at, (s, k) in slot_of.items()}
    times = Counter((s, b) for s, _, b in slot_of.values())
    taken, at = [0] * len(rows), defaultdict(int)
    for i in sorted(range(len(rows)), key=lambda i: spark_hash(*[("i", seed)] + [v for v in (rows[i][0], rows[i][1]) if v is not None])):
        s = key_of(rows[i][3])
        taken[i] = sum(times[s, (at[s] + j) // mixing.BLOCK] for j in range(size[i]))
        at[s] += size[i]
    return slot_of, taken, Counter((s, shard) for s, shard, _ in drawn)


@pytest.fixture(scope="module")
def short(rows):
    return [r for r in rows if len(corpus.words(r[1])) < 5000]


def test_taken_is_what_the_draws_say(spark, short, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_SLOTS", 40)
    docs = spark.createDataFrame([(*r, 1, 2) for r in short], corpus.SCHEMA + ", _draw int, row int").repartition(3)
    want_slots, taken, _ = mixed_by_hand(short, 7)
    placed, sources = mixing.streams(docs, 7)
    got = {(r["shard"], r["place"]): (r["source_key"], r["k"], r["block"]) for r in mixing.draw_slots(sources, 7).collect()}
    assert got == want_slots
    assert {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()} == {r[0]: t for r, t in zip(short, taken)}


def test_counts_of_a_shard_are_drawn_with_the_targets_as_weights(spark):
    sources = spark.createDataFrame([("sa", 30_000, 20_000), ("sb", 60_000, 60_000), ("sc", 10, 0), ("sd", 15_000, 20_000)], "source_key string, blocks long, slots long")
    counts = mixing.draw_sources(sources, 3).groupBy("shard", "source_key").agg(F.count(F.lit(1)).alias("n")).collect()
    whole = [r["n"] for r in counts if r["source_key"] == "sb" and r["shard"] < 24]
    mean, spread = sum(whole) / len(whole), (sum((n - 4096 * 0.6) ** 2 for n in whole) / len(whole)) ** 0.5
    assert mean == pytest.approx(4096 * 0.6, rel=0.01) and 0.5 < spread / (4096 * 0.6 * 0.4) ** 0.5 < 1.6
    slots = mixing.draw_slots(sources, 3).groupBy("source_key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("block").alias("b"))
    assert {r["source_key"]: (r["n"], r["b"]) for r in slots.collect()} == {"sa": (20_000, 20_000), "sb": (60_000, 60_000), "sd": (20_000, 15_000)}
    # Neighbours in a source's order of slots stand for blocks at no constant stride.
    blocks = [r["block"] for r in mixing.draw_slots(sources, 3).filter("source_key = 'sb' AND k < 2000").orderBy("k").collect()]
    assert len({b - a for a, b in zip(blocks, blocks[1:])}) > 1900


def test_block_texts_are_packed_to_length(spark, short):
    docs = spark.createDataFrame(short, corpus.SCHEMA)
    got = mixing.block_texts(docs).collect()
    slots, taken, _ = mixed_by_hand(short, 7)
    assert {(r["shard"], r["place"]) for r in got} == set(slots) and sum(len(r["text"].split(" ")) for r in got) == sum(taken)
    length = Counter(len(r["text"].split(" ")) for r in got)
    assert set(length) - {mixing.BLOCK} <= set(range(1, mixing.BLOCK)) and sum(n for k, n in length.items() if k != mixing.BLOCK) <= 8
    words = Counter(w for r in short for w in set(corpus.words(r[1])))
    assert all(w in words for r in got for w in r["text"].split(" "))


def test_repeated_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d", "x"), (1, "a b c d", "x"), (None, "e f", "x"), (None, None, None), (2, "", None)], "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert len(got) == 5 and all(0 <= r["taken"] <= 2 * r["size"] for r in got) and sum(r["taken"] for r in got) == 20
    assert {r["source_size"] for r in got} == {0, 10} and {r["target"] for r in got} == {0, 15}
