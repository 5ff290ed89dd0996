import hashlib
import re
import zlib

import corpus
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veedor.llm import fill_in_middle, line_dedup, merkle_manifest, queries

BLANK = " \t\n\x0b\x0c\r"
FOLD = {c: c + 32 for c in range(65, 91)}
H = lambda text: hashlib.sha256(text.encode()).hexdigest()
LONG = "x" * 39 + "é"
CLASH = ["ref", "rest", "drops", "digest", "may", "c", "page", "bits", "keep", "n", "tree", "pos", "block", "level", "part", "at", "skip", "size", "tampered", "row", "made", "none", "output", "form", "top", "l", "r", "text2", "n_lines", "_hot"]


def table(spark, texts, partitions=3):
    rows = [(k, t, "en", ("s0", "s0", None, "", "s1")[k % 5], k) if isinstance(t, (str, type(None))) else t for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(partitions)


def deduped(rows, min_docs=5):
    """doc_id, text -> lines, dropped and what is left, line by line."""
    key = lambda line: line.strip(BLANK).translate(FOLD)
    holders = {}
    for k, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                holders.setdefault(key(line), set()).add(k)
    keep = {}
    for line, held in holders.items():
        if len(held) >= min_docs:
            keep[line] = max((rows[k][0] for k in held if rows[k][0] is not None), default=None)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if key(x) not in keep or keep[key(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def odd_lines():
    texts = [f"{LONG}\nown line {k} of this one document, long enough\n  {LONG.upper()}\t" for k in range(30)]
    texts += [None, "", "\n", "\n\n", LONG, LONG + "\n" + LONG, "y" * 39, "y" * 39, "y" * 39, "y" * 39, "y" * 39, "z" * 40, "z" * 40, "z" * 40, "z" * 40]
    texts += [f"{'😀' * 40}\r\nrest", f"a\x85{'😀' * 40}"] + [f"{'😀' * 40} \n" for _ in range(4)] + ["\n".join(f"a line of the long text, number {k % 700:030d}" for k in range(60_000))]
    texts += [f"a line of the long text, number {k:030d}" for k in range(0, 700, 9) for _ in range(4)]
    return texts


@pytest.mark.parametrize("hot", [1000, 1])
def test_lines_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rows = [(k, t) for k, t in enumerate(odd_lines())] + [(None, LONG), (None, LONG), (None, "z" * 40), (3, LONG + "\nagain"), (3, LONG + "\nagain")] + [(None, "n" * 44)] * 6
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in line_dedup.dedup_lines(docs).collect()), key=repr)
    assert got == deduped(rows)


def test_lines_when_the_filter_is_full(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "MAX_CELLS", 1 << 16)
    rows = [(k, "\n".join(f"line {(k * 7919 + j) % 9000:040d}" for j in range(900))) for k in range(60)]
    got = sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()), key=repr)
    assert got == deduped(rows)


def test_no_line_that_repeats_is_missed_and_few_others_are_suspected(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "concat(lpad(string(id), 50, '0'), '\n', lpad(string(id % 19900), 50, 'q')) AS text").repartition(7)
    array = line_dedup.twice_seen(docs)
    at = lambda text: line_dedup.held(array, line_dedup.cells_of(next(line_dedup.split_lines(pa.array([text]))).hashes, len(array) * 8))[0]
    assert all(at(f"{k:q>50}") for k in range(100))
    assert np.mean([at(f"{k:0>50}") for k in range(3000)]) < 0.05


def test_columns_of_any_name_are_handed_through(spark):
    docs = table(spark, odd_lines()[:40])
    extra = docs.withColumns({c: F.lit(f"my {c}") for c in CLASH})
    kept = line_dedup.dedup_lines(extra)
    assert all(kept.filter(F.col(c) != f"my {c}").isEmpty() for c in CLASH if c != "n_lines") and kept.agg(F.sum("n_lines")).first()[0] > 40
    cut = fill_in_middle.fill_in_middle(extra)
    assert all(cut.filter(F.col(c) != f"my {c}").isEmpty() for c in CLASH if c not in ("n", "form", "output")) and cut.count() == 40
    assert merkle_manifest.manifest(extra).count() == 40
    assert line_dedup.dedup_lines(docs.select("doc_id", "text")).columns == ["doc_id", "text", "n_lines", "n_dropped"]


def test_empty_tables(spark, empty):
    assert line_dedup.dedup_lines(empty).collect() == [] and merkle_manifest.manifest(empty).collect() == [] and fill_in_middle.fill_in_middle(empty).collect() == []


def leaf(row):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H("".join(map(part, (row[0], row[3], row[2], row[4], row[1]))))


def grown(nodes):
    """The root over a list of nodes, and the siblings of each, level by level."""
    paths, where, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for k, at in enumerate(where):
            start = at - at % 3
            paths[k].append((level[start:at], level[at + 1 : start + 3]))
            where[k] = at // 3
        level = [H("".join(level[k : k + 3])) for k in range(0, len(level), 3)]
    return level[0], paths


def manifest_by_hand(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[3], []).append(r)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    grown_trees = []
    for s in names:
        mine = sorted(trees[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        grown_trees.append((mine, *grown([leaf(r) for r in mine])))
    root, over = grown([g[1] for g in grown_trees])
    out = []
    for (mine, subroot, paths), end in zip(grown_trees, over):
        for r, path in zip(mine, paths):
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            have = leaf((r[0], None if r[1] is None else r[1].replace("\n", ""), *r[2:])) if changed else leaf(r)
            for left, right in path + end:
                have = H("".join([*left, have, *right]))
            out.append((r[0], leaf(r), subroot, root, H("".join("".join(x + y) for x, y in path + end)), have, have == root))
    return sorted(out, key=repr)


MANIFEST_ROWS = [(k, f"text {k}\n" if k % 3 else f"text {k}", "en" if k % 4 else None, ("hot", "hot", None, "", "é", "z")[k % 6], k) for k in range(400)]
MANIFEST_ROWS += [(None, None, None, None, None), (None, "a\nb", None, "hot", 3), (7, "x", "en", "hot", 1), (7, "x", "en", "hot", 1), (5, "", "en", "alone", None), (6, "w\n" * 100_000, "en", "😀", 2)]
MANIFEST_ROWS += [(10_000 + k, "t\n", None, f"s{k}", k) for k in range(30)]


@pytest.mark.parametrize("stride", [5, 2, 1])
def test_manifest_against_brute_force(spark, tmp_path, monkeypatch, stride):
    monkeypatch.setattr(merkle_manifest.NodeStore.__init__, "__defaults__", (stride,))
    spark.createDataFrame(MANIFEST_ROWS, "doc_id long, text string, lang string, source string, n_chars long").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, queries.op12_merkle_manifest(spark, str(tmp_path)).collect()), key=repr)
    assert got == manifest_by_hand(MANIFEST_ROWS)


def test_manifest_of_a_single_row(spark):
    (row,) = merkle_manifest.manifest(table(spark, ["only"])).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and (row["lefts"], row["rights"]) == ([], [])


def test_proofs_of_chosen_places_come_from_the_store(spark, tmp_path):
    nodes = [H(str(k)) for k in range(100)]
    store = merkle_manifest.NodeStore(spark, str(tmp_path / "s"), 2).build(spark.createDataFrame([("t", k, 100, d) for k, d in enumerate(nodes)], "tree string, pos long, n long, digest string"))
    root, paths = grown(nodes)
    assert store.roots().first()["root"] == root and store.strides == 3 and store.level(5).count() == 1
    wanted = spark.createDataFrame([("t", 99, "a"), ("t", 40, "b"), ("t", 40, "c")], "tree string, pos long, name string")
    got = {r["name"]: r for r in store.proofs(wanted).collect()}
    for name, pos in (("a", 99), ("b", 40), ("c", 40)):
        assert (got[name]["lefts"], got[name]["rights"]) == (["".join(x) for x, _ in paths[pos]], ["".join(y) for _, y in paths[pos]])
    # A leaf that was changed does not lead to the root.
    checked = store.proofs(wanted).select(merkle_manifest.fold(F.lit(nodes[40])).alias("up"), "name")
    assert {r["name"]: r["up"] == root for r in checked.collect()} == {"a": False, "b": True, "c": True}


def middle_by_hand(doc, text, rate=100):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, digest = len(units), H(f"7:{'' if doc is None else doc}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= rate:
        return (doc, n, "plain", None, None, text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    return (doc, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 50 else (doc, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("rate", [100, 60, 0])
def test_middle_against_brute_force(spark, rate):
    texts = [f"é{k}\n😀\n\n<\nS>\n<P" + "\n" * (k % 3) + "<" for k in range(60)] + [None, "", "\n", "\n\n", "a<S>b\n", "one", "x\r\ny\x85 z", "w\n" * 50_000, "<", ">"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "a\nb\nc"), (None, "a\nb\nc"), (5, "p\nq"), (5, "p\nq")]
    made = fill_in_middle.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rate=rate)
    got = made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fill_in_middle.restored().alias("back"), F.coalesce("text", F.lit("")).alias("was")).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted((middle_by_hand(d, t, rate) for d, t in rows), key=repr)
    assert all(r["back"] == r["was"] for r in got)


def test_middle_cuts_at_units_of_any_pattern():
    words = re.compile(r"\S+\s*|\s+")
    text = "  one two\tthree  "
    ends = [0] + [m.end() for m in words.finditer(text)]
    assert fill_in_middle.count_units(words, text) == len(ends) - 1
    for i in range(len(ends)):
        for j in range(i, len(ends)):
            assert fill_in_middle.cut_points(words, text, i, j) == (ends[i], ends[j])


def test_small_corpus_has_the_same_lines_as_by_hand(docs, rows):
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {d: tuple(x) for d, *x in deduped([(r[0], r[1]) for r in rows])} and len(got) == len(corpus.make())
