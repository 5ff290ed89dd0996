"""A small corpus with every awkward case, and plain-Python versions of what operators must find."""

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, node long, shard int"


def make(n=60, seed=3):
    """Rows with copies, near copies, shared passages, junk, nulls, empty, blank and very long texts."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(70))
    texts = []
    for k in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 30, 90, 200]))]
        if k % 5 == 0:
            words[len(words) // 2 : 0] = passage.split()[: rng.choice([49, 50, 60, 70])]
        texts.append(" ".join(words))
    for k in range(0, n, 4):
        texts.append(texts[k])
        words = texts[k].split()
        words[rng.randrange(len(words))] = "edited"
        texts.append("\t".join(words).upper() if k % 8 else " ".join(words))
    texts += [None, None, "", "  \n ", "<|endoftext|> idiot 's 'll", "é à ü ß 漢字 😀", "a", "a a a a a", "the same " * 120, "the same " * 100, "x" * 5000, "long " + " ".join(rng.choice(vocabulary) for _ in range(60_000))]
    rows = [(k, t, rng.choice(["en", "de", None]), rng.choice(["s0", "s0", "s1", "", None]), None, 1, 2, 3) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def words(text):
    return WORD.findall(text or "")


def fold(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def shingles(text):
    w = words(fold(text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_components(rows):
    """doc_id -> (set size, smallest doc_id of its component), by comparing all that share a shingle."""
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = {}
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in where.setdefault(x, []))
        for j, k in shared.items():
            if 100 * k >= 75 * (len(s) + len(sets[j]) - k):
                root[max(find(i), find(j))] = min(find(i), find(j))
        for x in s:
            where[x].append(i)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return {r[0]: (len(sets[i]), least[find(i)]) for i, r in enumerate(rows)}


def removed_words(rows):
    """doc_id -> (words, words removed, words kept) by the window rule, window by window."""
    first = {}
    for doc, text, *_ in rows:
        w = words(text)
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            first[key] = min(first.get(key, doc), doc)
    out = {}
    for doc, text, *_ in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < doc:
                gone[k : k + 50] = [True] * 50
        out[doc] = (len(w), sum(gone), [x for x, g in zip(w, gone) if not g])
    return out
