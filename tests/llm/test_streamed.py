import functools
import hashlib
import random

import corpus
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veedor.llm import jaccard_join, kernel, language_id, substring_dedup, token_count, toxicity

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path(TOKENIZER)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\n\x0b é漢\x1c", max_size=30)), max_size=12))
def test_words_are_found_as_the_pattern_finds_them(texts):
    got = [0] * len(texts)
    for w in kernel.split_words(pa.array(texts, pa.string())):
        for k, row in enumerate(w.rows):
            got[row] = [w.data[w.starts[i] : w.ends[i]].tobytes().decode() for i in range(w.first[k], w.first[k + 1])]
    assert got == [corpus.words(t) for t in texts]


def test_equal_words_hash_alike_wherever_they_are():
    (w,) = kernel.split_words(pa.array(["ab cd ab", "x cd"]))
    h = w.hashes.tolist()
    assert h[0] == h[2] and h[1] == h[4] and len(set(h)) == 3


def test_a_text_beyond_the_block_size():
    text = "word " * 300_000
    (w,) = kernel.split_words(pa.array([text]))
    assert len(w.hashes) == 300_000 and len(np.unique(w.hashes)) == 1


def test_sketches_of_linked_sets_share_a_word():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 5, jaccard_join.CELLS).astype(np.uint32)
    for size in (1, 2, 3, 4, 7, 20, 100, 390, 410, 900, 3500, 12_000):
        for _ in range(4):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            grown = rng.integers(0, size // 3 + 1)
            kept = -(-3 * (size + grown) // 4)  # the least overlap that still links
            b = np.concatenate([a[: min(kept, size)], rng.integers(0, 2**63, size + grown - min(kept, size), dtype=np.uint64)])
            if 4 * min(kept, size) >= 3 * (size + len(b) - min(kept, size)):
                assert np.intersect1d(jaccard_join.sketch_words(np.unique(a), counts), jaccard_join.sketch_words(np.unique(b), counts)).size


def test_folded_bit_sketches_bound_the_difference():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    b = np.concatenate([a[:2000], rng.integers(0, 2**63, 100, dtype=np.uint64)])
    x, y = (np.frombuffer(jaccard_join.bit_sketch(np.unique(s)), np.uint8) for s in (a, b))
    x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    assert np.bitwise_count(x ^ y).sum() <= 1100


def test_near_duplicates(docs, rows, empty):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(docs).collect()}
    assert got == corpus.near_components(rows)
    assert jaccard_join.near_duplicates(empty).collect() == []


def test_near_duplicates_of_many_edited_copies(spark):
    rng = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for _ in range(150):
        w = list(base)
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    rows = [(k, t) for k, t in enumerate(texts)] + [(1000, None), (None, "a b"), (None, "a b"), (7, texts[7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(docs).collect() if r["doc_id"] is not None}
    assert got == {d: c for d, (_, c) in corpus.near_components([r for r in rows if r[0] is not None]).items()}
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect() if r["doc_id"] is not None} == set(got.values())


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (100, 102)], "a long, b long")
    got = {r["node"]: r["comp"] for r in jaccard_join.components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}


def test_substring_dedup(docs, rows, empty):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.substring_dedup(docs).collect()}
    want = {d: (n, gone, hashlib.sha256(" ".join(kept).encode()).hexdigest()) for d, (n, gone, kept) in corpus.removed_words(rows).items()}
    assert got == want
    assert substring_dedup.substring_dedup(empty).collect() == []


def test_substring_dedup_of_nulls_repeats_and_near_misses(spark):
    said = " ".join(f"p{k}" for k in range(60))
    rows = [(3, said), (None, said), (3, said), (9, f"z {said[: said.index('p49') - 1]} y"), (8, f"x  {said} {said}"), (1, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in substring_dedup.substring_dedup(docs).collect())
    assert got == sorted([("3", 60, 0), ("3", 60, 0), ("None", 60, 60), ("9", 51, 0), ("8", 121, 120), ("1", 0, 0), ("2", 0, 0)])


def test_substring_dedup_when_40_bits_of_all_windows_agree(spark, monkeypatch):
    real, low = substring_dedup.windows, np.uint64((1 << 42) - 1)
    monkeypatch.setattr(substring_dedup, "windows", lambda h, n: real(h, n) & ~low)  # one part of 4 gets all
    said = {c: " ".join(f"{c}{k}" for k in range(50)) for c in "abc"}
    rows = [(2, said["a"]), (5, said["b"]), (9, f"x {said['b']} y"), (3, said["c"]), (7, f"{said['c']} {said['b']}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.substring_dedup(docs).collect()}
    assert got == {d: (n, gone) for d, (n, gone, _) in corpus.removed_words(rows).items()}
    assert got[9] == (52, 50) and got[7] == (100, 100)


def library_counts(texts):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    return [len(x.ids) for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@functools.cache
def characters():
    return token_count.read_characters(tokenizer_path())


def compiled_counts(texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    return pa.Table.from_batches(token_count._counter(tokenizer_path(), characters())(iter([batch])))["n_tokens"].to_pylist()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(list("abrevlstmd'''!. \n\t12²éÉΣςİß|<>_\x1c\x85")), st.characters(codec="utf-8")), max_size=60), min_size=1, max_size=8))
def test_token_counts_agree_with_the_library(texts):
    assert compiled_counts(texts) == library_counts(texts)


def test_token_counts_of_special_and_long_texts(spark, docs, rows, empty):
    hard = ["<|endoftext|>", "a<|startoftext|>b", "<|END", "it's we'll they're I'd 'tis ''s 's's 'r 're", "é", None, "", "ab " * 70_000, "z" * 2000]
    assert compiled_counts(hard) == library_counts(hard)
    got = {r["doc_id"]: r for r in token_count.count_tokens(docs, tokenizer_path()).collect()}
    texts = {r[0]: r[1] for r in rows}
    want = dict(zip(texts, library_counts(list(texts.values()))))
    assert {d: r["n_tokens"] for d, r in got.items()} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) and r["n_bytes"] == len((texts[d] or "").encode()) for d, r in got.items())
    assert token_count.count_tokens(empty, tokenizer_path()).collect() == []


def test_token_counts_of_scripts_without_spaces_marks_emoji_and_unknown_code_points():
    rng = random.Random(12)
    alphabets = ["漢字仮名交じり文。、", "한국어각각", "😀👍🏽\u200d♥️", "e\u0301a\u0323\u0302Å\u212b", "αΣςσΐ", "\u1c89\ua7cb\U00010d50\U00010d4e\U0003ffff\U000effff", "zzzab", "'’srtvel d", "<|endoftext|>"]
    texts = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(1, 80))) for _ in range(1500)]
    texts += ["".join(rng.choice(a) for _ in range(rng.choice([3, 40, 700]))) for a in alphabets for _ in range(40)]
    assert compiled_counts(texts) == library_counts(texts)


def test_every_token_of_the_vocabulary_and_a_full_store(monkeypatch):
    import json

    signs = token_count._byte_signs()
    with open(tokenizer_path()) as f:
        words = [bytes(signs[c] for c in t.removesuffix("</w>")).decode(errors="ignore") for t in json.load(f)["model"]["vocab"]]
    assert compiled_counts(words) == library_counts(words)
    notes = token_count._annotations(tokenizer_path())
    monkeypatch.setattr(token_count, "KEPT", len(notes.keys))
    texts = [f"unseen{k}x{k * k} piece" for k in range(300)]
    before = len(notes.keys)
    assert compiled_counts(texts) == library_counts(texts) and len(notes.keys) == before


def test_chunk_maps_agree_with_one_sweep():
    after, out = token_count._machine()
    kind = np.random.default_rng(4).integers(0, 10, 5000).astype(np.uint8)
    kind[-1] = 0
    state, begins = 0, np.zeros(5000, bool)
    for k, c in enumerate(kind):
        said = out[state, c]
        begins[k] |= bool(said & 1)
        if said & 2:
            begins[k - 1] = True
        state = after[state, c]
    assert (token_count.piece_starts(kind, after, out) == begins).all()


def segments_by_hand(scores):
    """Maximal segments by their definition: recursively the best segment, then both sides of it."""
    best = max(((sum(scores[i:j]), -i, -(j - i)) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    i, j = -best[1], -best[1] - best[2]
    return segments_by_hand(scores[:i]) + [(i, j - 1)] + [(a + j, b + j) for a, b in segments_by_hand(scores[j:])]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([-3.2, -1.05, -0.3, 1.0, 2.3, 5.7]), max_size=14))
def test_maximal_segments(scores):
    got = toxicity.maximal_segments(np.array(scores, float))
    assert [(a, b) for a, b, _ in got] == segments_by_hand(scores)
    assert toxicity.best_segment(np.array(scores, float)) == pytest.approx(max([0.0, *(s for _, _, s in got)]))


def labelled(n, seed):
    rng = random.Random(seed)
    clean, bad = [f"c{k}" for k in range(300)], [f"bad{k}" for k in range(6)]
    rows, labels = [], []
    for k in range(n):
        toxic = k % 5 == 0
        w = [rng.choice(clean) for _ in range(rng.randint(20, 200))]
        for _ in range(rng.randint(2, 5) if toxic else 0):
            w[rng.randrange(len(w))] = rng.choice(bad)
        rows.append((k, " ".join(w)))
        labels.append((k, 1, int(toxic)))
    return rows, labels


def test_toxicity_held_out(spark, empty):
    rows, labels = labelled(900, 5)
    docs = spark.createDataFrame([*rows, (5000, None), (5001, "")], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1, 1), (7, None, None), (99_999, 0, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, marks).collect()}
    held = [(got[k]["predicted"], y) for k, _, y in labels if got[k]["held_out"]]
    assert len(held) > 100 and sum(p == y for p, y in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[5000]["predicted"] == got[5001]["predicted"] == 0
    assert toxicity.toxicity(empty, marks).collect() == []
    none = toxicity.toxicity(docs, marks.filter("toxic = 0")).collect()
    assert {r["score"] for r in none} == {0.0}


def test_language_id_held_out(spark, empty):
    rng = random.Random(6)
    parts = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["schr", "ung", "eit", "ver"], "cc": ["ção", "ões", "lh", "que"]}
    rows = []
    for k in range(600):
        lang = rng.choice(list(parts))
        text = " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(5, 80)))
        rows.append((k, text.upper() if k % 9 == 0 else text, lang if k % 10 else None, lang))
    docs = spark.createDataFrame([(a, b, c, 1.0) for a, b, c, _ in rows] + [(1000, None, "aa", 1.0), (1001, "123 !!", "aa", 1.0), (1002, "", None, 1.0), (None, "kalo mitu", None, 1.0)], "doc_id long, text string, lang string, score double")
    got = {r["doc_id"]: r for r in language_id.identify_languages(docs).collect()}
    held = [(got[k]["lang_pred"], lang) for k, _, _, lang in rows if got[k]["held_out"]]
    assert len(held) > 100 and sum(p == y for p, y in held) >= 0.99 * len(held)
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 and got[k]["rejected"] for k in (1000, 1001, 1002))
    assert got[None]["lang_pred"] == "aa" and all(0 <= r["score"] <= 1 for r in got.values())
    kept = language_id.accepted(docs)
    assert kept.columns == docs.columns and kept.count() >= 599
    assert language_id.identify_languages(empty).collect() == []
    assert {r["lang_pred"] for r in language_id.identify_languages(docs.withColumn("lang", docs.lang.substr(9, 1)).filter("false")).collect()} == set()


def test_language_id_rejects_long_texts_of_no_learned_language():
    rng = random.Random(7)
    parts = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["schr", "ung", "eit", "ver"], "cc": ["ção", "ões", "lh", "que"], "dd": ["wy", "żó", "szcz", "ąc"]}
    latin, han = "abcdefghijklmnopqrstuvwxyz", [chr(c) for c in range(0x4E00, 0x9FA5)]
    said = lambda letters, most, n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, most))) for _ in range(n))
    names = [list(parts)[k % 4] for k in range(600)]
    # Short texts hold a secret besides a word, so they are far from their language.
    learned = [said(latin, 8, 5) + " " + said(parts[x], 4, 4) if k // 4 % 4 == 0 else said(parts[x], 4, (30, 300, 2000)[k // 4 % 4 - 1]) for k, x in enumerate(names)]
    strange = [said(letters, 8, n) for letters in (latin, han, ["при", "вет", "го", "да"]) for n in (300, 2000, 10_000)]
    model = language_id.train(names, np.stack([n for _, n in language_id._counts(pa.array(learned))]))
    (out,) = language_id._predictor(model)(iter([pa.RecordBatch.from_arrays([pa.array(learned + strange)], ["_text"])]))
    assert out["_rejected"].to_pylist() == [False] * 600 + [True] * 9


def test_thinning_keeps_the_owner_and_the_shards_that_have_another():
    rng = np.random.default_rng(0)
    for _ in range(100):
        n = rng.integers(1, 60)
        ids, window = rng.integers(0, 8, n), rng.integers(0, 5, n).astype(np.uint64)
        shards = (ids % 3).astype(np.int32)
        kept = substring_dedup._thin(ids, shards, window)
        for w in set(window.tolist()):
            facts = [(ids[m].min(), {int(s) for i, s in zip(ids[m], shards[m], strict=True) if i > ids[m].min()}) for m in (window == w, (window == w) & kept)]
            assert facts[0] == facts[1]
