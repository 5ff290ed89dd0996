"""Substring dedup with repeated-phrase automata.

1. Every window of 50 words is hashed and sent, packed by part, to where equal windows meet by all 64 bits. Of a
   window that a task has often, only what can matter is sent. Windows of two or more documents are
   recurring; the smallest document that has one owns it.
2. Each owner's recurring windows, joined where they adjoin, are passages. A passage goes to those
   document shards alone that hold another document with one of its windows.
3. Each shard compiles an Aho-Corasick automaton of its passages, in which a word is one symbol and
   every passage is entered as consecutive phrases of 25 words; each window of 50 words holds a whole
   one. All documents of the shard are streamed through it. Where a phrase occurs, the windows around
   it are confirmed against the passages' own windows, and words in confirmed ones are removed.

All work is in proportion to the text: automata hold what recurs in their own shard, so more shards
do not mean more passes.

Defined results: a null text has no words; a null doc_id counts as the largest, so it owns nothing
that another has; rows that share a doc_id never remove from each other; windows are judged on the
input; a text with no word left has the digest of the empty string; an empty table gives no row;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veedor.llm.kernel import Words, mix, split_words, windows
from veedor.llm.storage import cut, keep_possible, shuffle_width

#: Words of a window, and of the phrases that passages are cut into.
WINDOW, PHRASE = 50, 25
#: Windows that a task buffers before it sends them, and that one task sorts, about.
FLUSH, PER_TASK = 2_000_000, 2_000_000
#: Bytes of text in a shard, about.
SHARD_BYTES = 12 << 20
_LAST = np.int64(2**63 - 1)


def _thin(ids: np.ndarray, shards: np.ndarray, window: np.ndarray) -> np.ndarray:
    """Which entries of one task's windows must be sent: of each window and shard the two smallest documents.

    More cannot matter: what counts is the smallest of all, and which shards have any other.
    """
    keep = np.ones(len(window), bool)
    order = np.argsort(window, kind="stable")
    first = np.flatnonzero(np.diff(window[order], prepend=~window[order[:1]]))
    size = np.diff(first, append=len(window))
    many = order[np.repeat(size > 2, size)]
    if len(many):
        many = many[np.lexsort((ids[many], shards[many], window[many]))]
        group = np.append(True, (np.diff(window[many]) != 0) | (np.diff(shards[many]) != 0))
        fresh = group | np.append(True, np.diff(ids[many]) != 0)
        seen = np.cumsum(fresh)
        rank = seen - seen[group][np.cumsum(group) - 1]
        keep[many] = fresh & (rank < 2)
    return keep


def _sender(parts: int):
    """Make the mapper that sends all windows that matter, packed by part."""

    def pack(ids: list, shards: list, found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        run = np.repeat(np.arange(len(ids), dtype=np.int32), [len(w) for w in found])
        window = np.concatenate(found)
        found.clear()
        ids, shards = np.array(ids, np.int64), np.array(shards, np.int32)
        keep = _thin(ids[run], shards[run], window)
        run, window = run[keep], window[keep]
        part = ((window >> np.uint64(40)) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, run, window = part[order], run[order], window[order]
        del keep, order
        rows, held, kinds = [], 0, (pa.int32(), *[pa.binary()] * 4)
        first = np.flatnonzero(np.diff(part, prepend=-1))
        for a, b in zip(first, np.append(first[1:], len(part)), strict=True):
            at = np.flatnonzero(np.diff(run[a:b], prepend=-1))
            own = run[a:b][at]
            rows.append((int(part[a]), ids[own].tobytes(), shards[own].tobytes(), np.diff(at, append=b - a).astype(np.uint32).tobytes(), window[a:b].tobytes()))
            held += b - a
            if held >= FLUSH // 8 or b == len(part):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "ids", "shards", "runs", "windows"])
                rows, held = [], 0

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, shards, found, held = [], [], [], 0
        for batch in batches:
            names, homes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for words in split_words(batch.column(2)):
                for k, row in enumerate(words.rows):
                    w = windows(words.hashes[words.first[k] : words.first[k + 1]], WINDOW)
                    if len(w):
                        ids.append(_LAST if names[row] is None else names[row])
                        shards.append(homes[row])
                        found.append(w)
                        held += len(w)
                if held >= FLUSH:
                    yield from pack(ids, shards, found)
                    ids, shards, found, held = [], [], [], 0
        if held:
            yield from pack(ids, shards, found)

    return send


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per owner: its recurring windows in this part, each with a shard that has it too."""
    keys, docs, homes, sizes = [], [], [], []
    for batch in batches:
        for ids, shards, runs, sent in zip(*(batch.column(k) for k in range(1, 5)), strict=True):
            docs.append(np.frombuffer(ids.as_buffer(), np.int64))
            homes.append(np.frombuffer(shards.as_buffer(), np.int32))
            sizes.append(np.frombuffer(runs.as_buffer(), np.uint32))
            keys.append(np.frombuffer(sent.as_buffer(), np.uint64))
    if not keys:
        return
    key, doc, home, ends = np.concatenate(keys), np.concatenate(docs), np.concatenate(homes), np.cumsum(np.concatenate(sizes), dtype=np.int64)
    del keys, docs, homes, sizes, batch, ids, shards, runs, sent
    order = np.argsort(key, kind="stable")
    key = key[order]
    same = key[1:] == key[:-1]
    keep = np.zeros(len(key), bool)
    keep[1:] |= same
    keep[:-1] |= same
    order = order[keep]
    run = np.searchsorted(ends, order, side="right")
    key, doc, home = key[keep], doc[run], home[run]
    if not len(key):
        return
    first = np.flatnonzero(np.diff(key, prepend=key[:1] ^ np.uint64(1)))
    owner = np.repeat(np.minimum.reduceat(doc, first), np.diff(first, append=len(key)))
    other = doc > owner
    key, owner, home = key[other], owner[other], home[other]
    order = np.lexsort((home, key, owner))
    key, owner, home = key[order], owner[order], home[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1]) | (home[1:] != home[:-1])
    key, owner, home = key[fresh], owner[fresh], home[fresh]
    first = np.flatnonzero(np.diff(owner, prepend=owner[:1] - 1)) if len(owner) else np.zeros(0, np.int64)
    ends = np.append(first[1:], len(owner))
    for k in range(0, len(first), 5000):
        some = range(k, min(k + 5000, len(first)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(owner[first[k : k + 5000]]), pa.array([key[first[i] : ends[i]].tobytes() for i in some], pa.binary()), pa.array([home[first[i] : ends[i]].tobytes() for i in some], pa.binary())],
            ["owner", "keys", "shards"],
        )


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the recurring passages out of their owners' texts, once for each shard that needs them."""
    for batch in batches:
        owners, packs = batch.column(0).to_pylist(), batch.column(2)
        for words in split_words(batch.column(1)):
            to, own, texts = [], [], []
            for k, row in enumerate(words.rows):
                first = words.first[k]
                w = windows(words.hashes[first : words.first[k + 1]], WINDOW)
                if not len(w):
                    continue
                pack = packs[row].as_py()
                key = np.concatenate([np.frombuffer(p["keys"], np.uint64) for p in pack])
                shard = np.concatenate([np.frombuffer(p["shards"], np.int32) for p in pack])
                by = np.argsort(w, kind="stable")
                low, high = np.searchsorted(w[by], key, "left"), np.searchsorted(w[by], key, "right")
                n = high - low
                at = by[np.repeat(low - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())]
                shard = np.repeat(shard, n)
                order = np.lexsort((at, shard))
                at, shard = at[order], shard[order]
                if not len(at):
                    continue
                begin = np.flatnonzero((np.diff(shard, prepend=shard[0] - 1) != 0) | (np.diff(at, prepend=at[0] - 2) > 1))
                for a, b in zip(begin, np.append(begin[1:], len(at)) - 1, strict=True):
                    to.append(int(shard[a]))
                    own.append(owners[row])
                    texts.append(words.data[words.starts[first + at[a]] : words.ends[first + at[b] + WINDOW - 1]].tobytes())
            if to:
                yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(own, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())], ["shard", "doc_id", "text"])


class _Automaton:
    """The passages of one shard: an automaton of their phrases, and their windows with owners."""

    def __init__(self):
        self.rows: list[tuple[list, pa.Array]] = []
        self.phrases = None
        self.keys = self.owners = np.zeros(0, np.int64)

    def compile(self) -> None:
        import ahocorasick

        phrases, keys, owners = ahocorasick.Automaton(), [], []
        for ids, texts in self.rows:
            for words in split_words(texts):
                for k, row in enumerate(words.rows):
                    h = words.hashes[words.first[k] : words.first[k + 1]]
                    said = _symbols(h)
                    for j in range(0, len(h) - PHRASE + 1, PHRASE):
                        phrases.add_word(said[j : j + PHRASE], True)
                    keys.append(windows(h, WINDOW))
                    owners.append(np.full(len(keys[-1]), ids[row], np.int64))
        self.rows = []
        if not keys:
            return
        phrases.make_automaton()
        self.phrases = phrases
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.lexsort((owner, key))
        key, owner = key[order], owner[order]
        first = np.append(True, key[1:] != key[:-1])
        self.keys, self.owners = key[first], owner[first]

    def removed(self, h: np.ndarray, doc: int) -> np.ndarray:
        """Which words of a document lie in a window that a smaller document has."""
        n = len(h)
        gone = np.zeros(n + 1, np.int64)
        if self.phrases is None or n < WINDOW:
            return gone[:n] > 0
        ends = np.fromiter((end for end, _ in self.phrases.iter(_symbols(h))), np.int64)
        if not len(ends):
            return gone[:n] > 0
        near = np.zeros(n + 1, np.int64)
        np.add.at(near, np.maximum(ends - WINDOW + 1, 0), 1)
        np.add.at(near, ends - PHRASE + 2, -1)
        at = np.flatnonzero(np.cumsum(near)[: n - WINDOW + 1] > 0)
        w = windows(h, WINDOW)[at]
        place = np.minimum(np.searchsorted(self.keys, w), len(self.keys) - 1)
        at = at[(self.keys[place] == w) & (self.owners[place] < doc)]
        np.add.at(gone, at, 1)
        np.add.at(gone, at + WINDOW, -1)
        return np.cumsum(gone)[:n] > 0


def _symbols(h: np.ndarray) -> str:
    """Words as characters beyond the surrogates: the alphabet of the automata."""
    return (h % np.uint64(1_000_000) + np.uint64(0xE000)).astype("<u4").tobytes().decode("utf-32-le")


def _kept_digests(words: Words, gone: np.ndarray) -> list[str]:
    """SHA-256 of each document's kept words, joined by one space."""
    edge = np.zeros(len(words.data) + 1, np.int8)
    starts, ends = words.starts[~gone], words.ends[~gone]
    edge[starts] += 1
    edge[ends] -= 1
    mask = np.cumsum(edge[:-1], dtype=np.int8) > 0
    doc = np.searchsorted(words.first, np.flatnonzero(~gone), side="right")
    inner = np.append(doc[1:] == doc[:-1], False) if len(doc) else np.zeros(0, bool)
    data = words.data.copy()
    data[ends[inner]] = 32
    mask[ends[inner]] = True
    kept, sums = data[mask], np.append(0, np.cumsum(mask))
    # A document's bytes run from its first kept word to its last.
    lows = np.searchsorted(doc, np.arange(1, len(words.first)), "left")
    highs = np.searchsorted(doc, np.arange(1, len(words.first)), "right")
    raw = memoryview(kept)
    return [hashlib.sha256(raw[sums[starts[a]] : sums[ends[b - 1]]] if b > a else b"").hexdigest() for a, b in zip(lows, highs, strict=True)]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream one shard after another: its passages first, then its documents."""
    shard, automaton = None, _Automaton()
    for batch in batches:
        homes, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((np.diff(homes) != 0) | (np.diff(kinds) != 0)) + 1
        for a, b in zip(np.append(0, cuts), np.append(cuts, len(homes)), strict=True):
            if a == b:
                continue
            if homes[a] != shard:
                shard, automaton = homes[a], _Automaton()
            part = batch.slice(a, b - a)
            ids, texts = part.column(2).to_pylist(), part.column(3)
            if kinds[a] == 0:
                automaton.rows.append((ids, texts))
                continue
            if automaton.rows:
                automaton.compile()
            for words in split_words(texts):
                names = ids[words.rows.start : words.rows.stop]
                gone = [automaton.removed(words.hashes[words.first[k] : words.first[k + 1]], _LAST if d is None else d) for k, d in enumerate(names)]
                every = np.concatenate(gone)
                counts = [int(g.sum()) for g in gone]
                sizes = np.diff(words.first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array(_kept_digests(words, every), pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept_sha256"],
                )


def substring_dedup(docs: DataFrame) -> DataFrame:
    """What is removed from every row: ``doc_id, n_words, n_removed, kept_sha256``."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    width = shuffle_width(spark)
    parts, shards = max(width, size // 6 // PER_TASK + 1), max(width, size // SHARD_BYTES + 1)
    placed = docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"), "text")
    sent = placed.mapInArrow(_sender(parts), "part int, ids binary, shards binary, runs binary, windows binary")
    owned = cut(sent.repartition(parts, "part").mapInArrow(_meet, "owner long, keys binary, shards binary"))
    packs = owned.groupBy("owner").agg(F.collect_list(F.struct("keys", "shards")).alias("packs")).withColumnRenamed("owner", "doc_id")
    owners = keep_possible(docs.select("doc_id", "text"), owned.select(F.col("owner").alias("doc_id")), "doc_id")
    passages = owners.join(packs, "doc_id").select("doc_id", "text", "packs").mapInArrow(_passages, "shard int, doc_id long, text string")
    stream = passages.select("shard", F.lit(0).alias("kind"), "doc_id", "text").union(placed.select("shard", F.lit(1), "doc_id", "text"))
    stream = stream.repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    return stream.mapInArrow(_remove, "doc_id long, n_words long, n_removed long, kept_sha256 string")
