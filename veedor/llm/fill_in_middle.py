"""Fill-in-middle: cut a text at two of its units and put the middle last, in constant memory.

A unit is a match of a pattern (by default a line with its break), found lazily from left to right.
The first pass counts the matches; two hashes of the row's name, modulo the count, choose the ranks
of both cuts; the second pass advances a fresh match iterator to either rank and reads off where it
stands. No unit is stored, so beyond the text itself a row takes the same memory at any length.

Hashes come from SHA-256 of a seed and the doc_id, so reruns and any dealing of rows agree.

Defined results: a null text counts as empty; an empty text, or one that contains a control string,
stays plain, and so does one that the rate leaves out; a null doc_id hashes as no digits, so rows
without one are cut by the same hashes; repeated rows give repeated rows; very long texts are
scanned whole; an empty table gives no row. Further columns are handed through; those named like
an output are replaced.
"""

from __future__ import annotations

import itertools
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The control strings, and a unit.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
LINE = r"[^\n]*\n|[^\n]+"
#: Percent of texts that are cut, and percent of these whose suffix comes first.
RATE, SUFFIX_FIRST = 100, 50

_OUT = "n long, form string, prefix_chars long, middle_chars long, output string"


def row_hashes(seed: int) -> list[Column]:
    """Four 32-bit hashes of ``doc_id``: the first groups of eight digits of one SHA-256."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def count_units(pattern: re.Pattern, text: str) -> int:
    """First pass: the number of matches."""
    return sum(1 for _ in pattern.finditer(text))


def cut_points(pattern: re.Pattern, text: str, first: int, second: int) -> tuple[int, int]:
    """Second pass: where the first ``first`` and the first ``second`` matches end, ``first <= second``."""
    matches, ends, at = pattern.finditer(text), [], 0
    for steps in (first, second - first):
        last = next(itertools.islice(matches, steps - 1, None), None) if steps else None
        at = at if last is None else last.end()
        ends.append(at)
    return ends[0], ends[1]


def transform(pattern: re.Pattern, text: str, hashes: tuple[int, int, int, int], rate: int, suffix_first: int) -> tuple[int, str, int | None, int | None, str]:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    n = count_units(pattern, text)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or hashes[2] % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((hashes[0] % (n + 1), hashes[1] % (n + 1)))
    i, j = cut_points(pattern, text, low, high)
    if hashes[3] % 100 < suffix_first:
        return n, "spm", i, j - i, f"{SUFFIX}{text[j:]}{PREFIX}{text[:i]}{MIDDLE}{text[i:j]}"
    return n, "psm", i, j - i, f"{PREFIX}{text[:i]}{SUFFIX}{text[j:]}{MIDDLE}{text[i:j]}"


def fill_in_middle(docs: DataFrame, pattern: str = LINE, seed: int = 7, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """All columns of ``docs`` and ``n, form, prefix_chars, middle_chars, output``.

    ``pattern`` must match somewhere in every text it is to cut, and no match may be empty.
    """
    compiled, names = re.compile(pattern), [part.split()[0] for part in _OUT.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    @F.arrow_udf(f"struct<{', '.join(part.replace(' ', ': ') for part in _OUT.split(', '))}>")
    def moved(text: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        rows = (transform(compiled, t.as_py() or "", (a.as_py(), b.as_py(), c.as_py(), d.as_py()), rate, suffix_first) for t, a, b, c, d in zip(text, h1, h2, h3, h4))
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds)], names)

    others = [c for c in docs.columns if c not in names]
    made = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), moved("text", *row_hashes(seed)).alias("made"))
    return made.select("row.*", "made.*")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text that an output was made from, by its form alone: a Column of built-in functions.

    A text that was cut holds no control string, so the first of each in the output is the right one.
    """
    out = F.col(output)
    size = len(PREFIX)
    first_end = F.when(F.col(form) == "psm", F.locate(SUFFIX, out)).otherwise(F.locate(PREFIX, out))
    first = F.substr(out, F.lit(size + 1), first_end - size - 1)
    rest = F.substr(out, first_end + size)
    middle_at = F.locate(MIDDLE, rest)
    second, middle = F.substr(rest, F.lit(1), middle_at - 1), F.substr(rest, middle_at + size)
    return F.when(F.col(form) == "plain", out).when(F.col(form) == "psm", F.concat(first, middle, second)).otherwise(F.concat(second, middle, first))
