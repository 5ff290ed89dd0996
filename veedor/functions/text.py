"""Text functions: trimming, slugs and canonical forms, as Column expressions.

White space means Unicode white space with the separators U+001C to U+001F, as the catalogue rules
count them; Spark's own ``trim`` removes blanks only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What stands for white space and for words within brackets of a pattern; Java's ``\\w`` has marks and joiners too, and neither powers nor fractions.
_SPACE = r"\s\x1c-\x1f"
_WORD = r"\p{L}\p{N}_"
#: Letters and numbers of Unicode 14 and 15, which the patterns of Java 17 do not know.
_NEWER = "".join("-".join(rf"\x{{{end}}}" for end in ends.split("-")) for ends in (
    "870-887 889-88e 8b5 8c8-8c9 c5d cdd 170d 171f 1b4c 2c2f 2c5f 9ffd-9fff a7c0-a7c1 a7d0-a7d1 a7d3 a7d5-a7d9 a7f2-a7f4 10570-1057a 1057c-1058a 1058c-10592 10594-10595 "
    "10597-105a1 105a3-105b1 105b3-105b9 105bb-105bc 10780-10785 10787-107b0 107b2-107ba 10f70-10f81 11071-11072 11075 1123f-11240 11740-11746 11ab0-11abf 11f02 11f04-11f10 "
    "11f12-11f33 11f50-11f59 12f90-12ff0 1342f 13441-13446 16a70-16abe 16ac0-16ac9 1aff0-1aff3 1aff5-1affb 1affd-1affe 1b11f-1b122 1b132 1b155 1d2c0-1d2d3 1df00-1df1e "
    "1df25-1df2a 1e030-1e06d 1e290-1e2ad 1e4d0-1e4eb 1e4f0-1e4f9 1e7e0-1e7e6 1e7e8-1e7eb 1e7ed-1e7ee 1e7f0-1e7fe 2a6de-2a6df 2b735-2b739 31350-323af "
).split())


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c, space: str = _SPACE) -> Column:
    """Remove white space at both ends."""
    return F.regexp_replace(col(c), rf"(?U)^[{space}]+|[{space}]+\z", "")


def collapse(c, space: str = _SPACE) -> Column:
    """Strip, and turn each run of white space into one blank."""
    return F.trim(F.regexp_replace(col(c), rf"(?U)[{space}]+", " "))


def blank_to_null(c) -> Column:
    return F.nullif(col(c), F.lit(""))


def normalize_space(c, space: str = _SPACE + r"\ufeff") -> Column:
    """Byte order marks count as white space; an empty result is null."""
    return blank_to_null(collapse(c, space))


def clean_text(c) -> Column:
    """Strip; an empty result is null."""
    return blank_to_null(strip(c))


def upper_text(c) -> Column:
    """Strip and upper-case; an empty result is null."""
    return F.upper(clean_text(c))


def clean_identity(c, space: str = _SPACE) -> Column:
    """Collapse white space, then delete all but word characters and ``-/().,+``; empty is null."""
    kept = F.regexp_replace(collapse(c, space), rf"(?U)[^{_WORD}{space}\-/().,+{_NEWER}]", "")
    return blank_to_null(strip(kept, space))


def key_text(c) -> Column:
    """Upper-case with single blanks, as keys use it; null is empty."""
    return F.coalesce(collapse(F.upper(col(c))), F.lit(""))


def slug_ascii(c) -> Column:
    """Lower case; runs of anything but ``a-z0-9`` become one hyphen; accented letters do too."""
    return F.regexp_replace(F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def slug_unicode(c, space: str = _SPACE) -> Column:
    """Lower case; signs are deleted, runs of blanks, underscores and hyphens become one hyphen."""
    kept = F.regexp_replace(F.lower(strip(c, space)), rf"(?U)[^{_WORD}{space}{_NEWER}-]", "")
    return blank_to_null(F.regexp_replace(F.regexp_replace(kept, rf"(?U)[{space}_-]+", "-"), "^-+|-+$", ""))


def canon(c) -> Column:
    """Canonical form for lookups: lower case, only ``a-z0-9`` and Spanish letters, single blanks."""
    spaced = F.regexp_replace(F.lower(strip(c)), r"[()]", " ")
    return F.coalesce(collapse(F.regexp_replace(spaced, "[^a-z0-9áéíóúüñ]+", " ")), F.lit(""))


def id_slug(c) -> Column:
    """Canonical form joined by underscores, for identifiers."""
    return F.replace(canon(c), F.lit(" "), F.lit("_"))


def first_present(*cs) -> Column:
    """The first value that is neither null nor blank."""
    return F.coalesce(*[F.when(strip(c) != "", col(c)) for c in cs])


def normalize_url(source, href) -> Column:
    """Make ``href`` absolute against the page it is on; absolute ones stay as they are."""
    source, href = col(source), col(href)
    root = F.concat(F.coalesce(F.try_parse_url(source, F.lit("PROTOCOL")), F.lit("")), F.lit("://"), F.coalesce(F.try_parse_url(source, F.lit("AUTHORITY")), F.lit("")))
    path = F.coalesce(F.try_parse_url(source, F.lit("PATH")), F.lit(""))
    base = F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise(path)
    relative = F.replace(F.concat(root, base, F.lit("/"), href), F.lit("//es"), F.lit("/es"))
    return (
        F.when(F.coalesce(href, F.lit("")) == "", None)
        .when(href.startswith("http://") | href.startswith("https://") | (F.coalesce(source, F.lit("")) == ""), href)
        .when(href.startswith("/"), F.concat(root, href))
        .otherwise(relative)
    )


def alias(c, names: dict[str, str], keep_unknown: bool = False) -> Column:
    """Look a text up, in lower case with single blanks, among ``names``; unknown ones are null or kept."""
    key = collapse(F.lower(col(c)))
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    found = F.try_element_at(table, key)
    return F.coalesce(found, key) if keep_unknown else found
