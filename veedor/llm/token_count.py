"""Token counts by finite-state transducers, without tokenizing documents one by one.

Two machines are compiled from the tokenizer's file, of the word-end BPE kind over bytes.

1. The splitting rule (contractions, runs of letters, single digits, runs of other signs) is a
   deterministic transducer over character classes. A block of text is cut into chunks of equal
   length; for all chunks at once, and from every state, the map from the state before a chunk to the
   state after it is computed, these maps are composed by a parallel prefix scan, and a second sweep
   then knows each chunk's true state and writes where words of the tokenizer, its pieces, begin.
2. Inside a piece the vocabulary machine runs. It is a trie of all tokens; where a token ends, its
   state is that token. The transition from state a by token b exists if merging both side by side gives
   a and b again: no merge across their border comes before one inside them, which the merge ranks along
   the right edge of a and the left edge of b decide. As merging is deterministic, exactly one path leads
   to each place of a piece; a transition emits one token. Each piece starts the machine anew, so its map
   of a chunk is constant from the first piece on, and all pieces of a block run side by side.

Equal pieces of a block run once, and a worker keeps the counts of up to ``KEPT`` pieces by their
64-bit hash; when that is full it stays as it is and further pieces run each time. The library itself
gives the character classes, once on the driver, and brings texts into its normal form that are not
in it yet; it tokenizes nothing.

Strings of special tokens count as one token each and part the text around them, as the library does.

Defined results: a null text is empty and has no token; repeated rows count each by itself; a very
long text is one block, in about 100 bytes a character; an empty table gives no row; further columns
are ignored.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veedor.llm.kernel import blocks, mix

#: Characters in a chunk of a block.
CHUNK = 512
#: Pieces whose counts one worker keeps.
KEPT = 2_000_000
#: Bytes of the longest pieces that run side by side, and cells of one such table.
WIDEST, CELLS = 256, 4_000_000
#: Code points, and the end of the planes that scripts are in; all beyond are signs.
_CODES, _USED = 0x110000, 0x40000
# Classes: 0 white, 1 letter, 2 number, 3 other, 4 apostrophe, 5 one of s t m d, 6 r, 7 v, 8 l, 9 e.
_LETTERS = {"s": 5, "t": 5, "m": 5, "d": 5, "r": 6, "v": 7, "l": 8, "e": 9}
# States: 0 between pieces, 1 in letters, 2 in other signs, 3 after an apostrophe that begins a
# piece, 4 after 'r, 5 after 'v, 6 after 'l.
_STATES = 7
_HERE, _BEFORE = 1, 2  # a piece begins at this character; at the one before


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """Next state and output of each state and class."""
    after, out = np.zeros((_STATES, 10), np.uint8), np.zeros((_STATES, 10), np.uint8)
    fresh = {0: 0, 2: 0, 3: 2, 4: 3} | {c: 1 for c in (1, 5, 6, 7, 8, 9)}
    for state in range(_STATES):
        for c in range(10):
            after[state, c], out[state, c] = fresh[c], _HERE if c else 0
    for c in (1, 5, 6, 7, 8, 9):
        out[1, c] = 0  # letters go on
    for c in (3, 4):
        after[2, c], out[2, c] = 2, 0  # other signs go on
        after[3, c], out[3, c] = 2, 0
    after[3, 5], out[3, 5] = 0, 0  # 's 't 'm 'd
    for c, held in ((6, 4), (7, 5), (8, 6)):
        after[3, c], out[3, c] = held, 0  # not known yet whether a contraction
    for held, c in ((4, 9), (5, 9), (6, 8)):
        for any_class in range(10):
            out[held, any_class] |= _BEFORE
            if any_class in (1, 5, 6, 7, 8, 9):
                after[held, any_class], out[held, any_class] = 1, _BEFORE  # the held letter began a word
        after[held, c], out[held, c] = 0, 0  # 're 've 'll
    return after, out


@dataclass
class Characters:
    """Class and lower case of every code point, and which ones this Python's Unicode does not know."""

    kind: np.ndarray
    lower: np.ndarray
    new: np.ndarray


def read_characters(path: str) -> Characters:
    """The classes as the tokenizer's own splitter has them."""
    library = _library(path)
    new, lower, kind = np.zeros(_CODES, bool), np.arange(_CODES, dtype=np.uint32), np.full(_CODES, 3, np.uint8)
    for c in range(_USED):
        char, g = chr(c), unicodedata.category(chr(c))
        if g == "Cn":
            new[c] = True
        elif g != "Co" and g != "Cs":
            small = char.lower()
            if len(small) == 1:
                lower[c] = ord(small)
            kind[c] = 1 if g[0] == "L" else 2 if g[0] == "N" else 0 if char.isspace() and not 0x1C <= c <= 0x1F else 3
    # Of code points that only the library may know: a letter goes on after a letter, a sign is gone on with.
    for k in range(0, len(unknown := np.flatnonzero(new)), 50_000):
        some = unknown[k : k + 50_000]
        begins = np.zeros(4 * len(some) + 4, bool)
        begins[[a for _, (a, _) in library.pre_tokenizer.pre_tokenize_str("".join(f"a{chr(c)}! " for c in some))]] = True
        kind[some] = np.where(~begins[1 : 4 * len(some) : 4], 1, np.where(~begins[2 : 4 * len(some) : 4], 3, 2))
    kind = kind[lower]
    kind[ord("'")] = 4
    for c, k in _LETTERS.items():
        kind[[ord(c), ord(c.upper())]] = k
    return Characters(kind, lower, new)


def piece_starts(kind: np.ndarray, after: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Which characters begin a piece; ``kind`` holds classes and must end in white space."""
    n = len(kind)
    rows = -(-n // CHUNK)
    grid = np.zeros(rows * CHUNK, np.uint8)
    grid[:n] = kind
    grid = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)
    flat = after.reshape(-1)
    # Map of each chunk: the state that every state ends in.
    maps = np.repeat(np.arange(_STATES, dtype=np.uint8)[:, None], rows, 1)
    for step in grid:
        maps = flat[maps * np.uint8(10) + step]
    # Prefix scan: after it, a chunk's map holds all chunks up to it.
    shift = 1
    while shift < rows:
        maps[:, shift:] = np.take_along_axis(maps[:, shift:], maps[:, :-shift].copy(), 0)
        shift *= 2
    state = np.zeros(rows, np.uint8)
    state[1:] = maps[0, :-1]
    said, emit = np.empty((CHUNK, rows), np.uint8), out.reshape(-1)
    for k, step in enumerate(grid):
        at = state * np.uint8(10) + step
        said[k] = emit[at]
        state = flat[at]
    said = said.T.reshape(-1)[:n]
    begins = (said & _HERE) > 0
    begins[:-1] |= (said[1:] & _BEFORE) > 0
    return begins


_STEP = 0xD1342543DE82EF95


def _library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_signs() -> dict[str, int]:
    """The sign by which byte-level vocabularies write each byte: itself if it is printable, else one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabulary:
    """The vocabulary machine: a trie of tokens over bytes (256 more for the last byte of a piece), and merge ranks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        end, ids, signs = model["end_of_word_suffix"], model["vocab"], _byte_signs()
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        n = max(ids.values()) + 1
        #: Rank of the merge that makes a token, -1 for single bytes, and its two parts.
        self.born, self.left, self.right = (np.full(n, -1, np.int64) for _ in range(3))
        left, right, made = (np.array([ids[x] for x in side], np.int64) for side in zip(*((a, b, a + b) for a, b in pairs), strict=True))
        if len(np.unique(made)) != len(made):
            raise ValueError("a token that two merges make is beyond this machine")
        self.born[made], self.left[made], self.right[made] = np.arange(len(made)), left, right
        key = left * n + right
        order = np.argsort(key)
        self.n, self.pair, self.rank = n, key[order], order
        edges: dict[int, int] = {}
        ends: dict[int, int] = {}
        for token, number in ids.items():
            body, last = (token[: -len(end)], 256) if token.endswith(end) and token != end else (token, 0)
            said = [signs[c] for c in body]
            said[-1] += last
            node = 0
            for x in said:
                node = edges.setdefault(node * 512 + x, len(edges) + 1)
            ends[node] = number
        self.edges, self.token = edges, np.full(len(edges) + 1, -1, np.int64)
        self.token[list(ends)] = list(ends.values())
        step = np.fromiter(edges, np.int64)
        order = np.argsort(step)
        self.step, self.child = step[order], np.fromiter(edges.values(), np.int64)[order]
        self.known: dict[int, bool] = {}

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens ``a`` and ``b`` side by side stay as they are.

        Going back in time, the later made of the two tokens at the border is undone again and again;
        a merge across the border would have happened if its rank comes before the undone ones'.
        """
        never = np.int64(len(self.rank))
        good, at = np.ones(len(a), bool), np.arange(len(a))
        a, b, until_a, until_b = a.copy(), b.copy(), np.full(len(a), never), np.full(len(a), never)
        while len(at):
            key = a * self.n + b
            place = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
            rank = np.where(self.pair[place] == key, self.rank[place], never)
            # Of equal merges the left one comes first.
            crossed = (rank < until_a) & (rank <= until_b) & (rank < never)
            good[at[crossed]] = False
            born_a, born_b = self.born[a], self.born[b]
            on = ~crossed & (np.maximum(born_a, born_b) >= 0)
            first = born_a > born_b
            until_a, until_b = np.where(first, born_a, until_a)[on], np.where(first, until_b, born_b)[on]
            a, b, at = np.where(first, self.right[a], a)[on], np.where(first, b, self.left[b])[on], at[on]
        return good

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """The number of tokens of each piece."""
        size = np.array([len(p) for p in pieces], np.int64)
        out, order = np.zeros(len(pieces), np.int64), np.argsort(size, kind="stable")
        at = 0
        while at < len(order) and size[order[at]] <= WIDEST:
            # Pieces of up to twice the shortest one's length run together.
            most = min(WIDEST, 2 * int(size[order[at]]))
            stop = min(int(np.searchsorted(size[order], most, "right")), at + CELLS // (most + 1))
            some = order[at:stop]
            out[some] = self._side_by_side([pieces[i] for i in some], size[some])
            at = stop
        for i in order[at:]:
            out[i] = self._alone(pieces[i])
        return out

    def _side_by_side(self, pieces: list[bytes], size: np.ndarray) -> np.ndarray:
        wide, rows = int(size.max()), np.arange(len(pieces))
        said = np.zeros((len(pieces), wide + 1), np.int64)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        row = np.repeat(rows, size)
        said[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
        said[rows, size - 1] += 256
        state, emitted = np.full((len(pieces), wide + 1), -1, np.int64), np.zeros((len(pieces), wide + 1), np.int64)
        for start in range(wide):
            row = np.flatnonzero(size > start) if start == 0 else np.flatnonzero((size > start) & (state[:, start] >= 0))
            node, at, found = np.zeros(len(row), np.int64), start, []
            while len(row):
                key = node * 512 + said[row, at]
                place = np.minimum(np.searchsorted(self.step, key), len(self.step) - 1)
                there = self.step[place] == key
                row, node, at = row[there], self.child[place[there]], at + 1
                token = self.token[node]
                ends = token >= 0
                found.append((row[ends], token[ends], np.full(int(ends.sum()), at)))
                on = size[row] > at
                row, node = row[on], node[on]
            if found:
                row, token, at = (np.concatenate(x) for x in zip(*found, strict=True))
                good = self.compatible(state[row, start], token) if start else np.ones(len(row), bool)
                row, token, at = row[good], token[good], at[good]
                state[row, at], emitted[row, at] = token, emitted[row, start] + 1
        return emitted[rows, size]

    def _alone(self, piece: bytes) -> int:
        """The same for one long piece."""
        said, state, emitted = [*piece[:-1], piece[-1] + 256], [-1] * (len(piece) + 1), [0] * (len(piece) + 1)
        for start in range(len(said)):
            node, at = 0, start
            while at < len(said) and (node := self.edges.get(node * 512 + said[at], 0)):
                at += 1
                token = int(self.token[node])
                if token >= 0:
                    key = state[start] * self.n + token
                    if start and key not in self.known:
                        if len(self.known) >= KEPT:
                            self.known.clear()
                        self.known[key] = bool(self.compatible(np.array([state[start]]), np.array([token]))[0])
                    if not start or self.known[key]:
                        state[at], emitted[at] = token, emitted[start] + 1
        return emitted[-1]


class _Annotations:
    """The compiled vocabulary, and the counts of pieces kept by their hash."""

    def __init__(self, path: str):
        self.library, self.vocabulary = _library(path), Vocabulary(path)
        self.specials = [x.content for x in self.library.get_added_tokens_decoder().values()]
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def look_up(self, hashes: np.ndarray, cut) -> np.ndarray:
        """Counts of pieces; ``cut(i)`` gives the bytes of piece i when it is new."""
        known, first, where = np.unique(hashes, return_index=True, return_inverse=True)
        counts, new = np.zeros(len(known), np.int64), np.arange(len(known))
        if len(self.keys):
            place = np.minimum(np.searchsorted(self.keys, known), len(self.keys) - 1)
            there = self.keys[place] == known
            counts[there], new = self.counts[place[there]], np.flatnonzero(~there)
        if len(new):
            counts[new] = self.vocabulary.count([cut(i) for i in first[new]])
            if len(self.keys) + len(new) <= KEPT:
                keys = np.concatenate([self.keys, known[new]])
                order = np.argsort(keys, kind="stable")
                self.keys, self.counts = keys[order], np.concatenate([self.counts, counts[new]])[order]
        return counts[where]


def _annotations(path: str) -> _Annotations:
    """This worker's annotations; they outlive a task, as module state that travels does not."""
    home = sys.modules.setdefault("_veedor_kept", types.ModuleType("_veedor_kept"))
    if getattr(home, "path", None) != path:
        home.path, home.annotations = path, _Annotations(path)
    return home.annotations


def _counter(path: str, characters: Characters | None = None):
    known = characters or read_characters(path)
    after, out = _machine()

    def normal(text: str, library) -> np.ndarray:
        """Code points of a text as the library would have them, before lower case."""
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        if not text.isascii() and (known.new[codes].any() or "\u0130" in text or not unicodedata.is_normalized("NFC", text)):
            codes = np.frombuffer(library.normalizer.normalize_str(text).encode("utf-32-le"), np.uint32)
        return codes

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        notes = _annotations(path)
        special = re.compile("|".join(map(re.escape, sorted(notes.specials, key=len, reverse=True)))) if notes.specials else None
        up, down = _char_powers(1 << 20)
        gap = np.full(1, 32, np.uint32)
        for batch in batches:
            sizes, totals = [], []
            for _rows, data, at in blocks(batch.column(1)):
                texts = [bytes(data[a:b]).decode() for a, b in zip(at[:-1], at[1:], strict=True)]
                parts = [special.split(t) if special else [t] for t in texts]
                # All parts of all texts, one space after each.
                codes = [x for some in parts for t in some for x in (normal(t, notes.library), gap)]
                bounds = np.append(0, np.cumsum([len(a) + 1 for a in codes[::2]]))
                edges = bounds[np.append(0, np.cumsum([len(some) for some in parts]))]
                text = np.concatenate(codes)
                kind, text = known.kind[text], known.lower[text]
                begins = piece_starts(kind, after, out)
                starts = np.flatnonzero(begins)
                counts = np.array([len(some) - 1 for some in parts], np.int64)
                if len(starts):
                    if len(text) > len(up):
                        up, down = _char_powers(len(text))
                    sums = np.append(np.uint64(0), np.cumsum((mix(text.astype(np.uint64)) | np.uint64(1)) * up[: len(text)]))
                    # A piece ends where the next begins or white space does.
                    white = np.flatnonzero(kind == 0)
                    ends = np.minimum(np.append(starts[1:], len(text)), white[np.searchsorted(white, starts)])
                    hashes = mix((sums[ends] - sums[starts]) * down[starts])
                    cut = lambda i, t=text, s=starts, e=ends: t[s[i] : e[i]].tobytes().decode("utf-32-le").encode()
                    tokens = np.append(0, np.cumsum(notes.look_up(hashes, cut)))
                    edge = np.searchsorted(starts, edges)
                    counts += tokens[edge[1:]] - tokens[edge[:-1]]
                sizes.append(np.diff(at))
                totals.append(counts)
            n, t = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (sizes, totals))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(t, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return count


def _char_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _STEP, np.uint64), np.full(n, pow(_STEP, -1, 2**64), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row; ``tokenizer`` is the path of its file."""
    counted = docs.select("doc_id", "text").mapInArrow(_counter(tokenizer), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
