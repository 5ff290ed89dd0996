import hashlib

import pytest
from pyspark.sql import functions as F

from veedor.functions import numbers as n
from veedor.functions import text as t
from veedor.plans import catalogue


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "fn, text, want",
    [
        (t.normalize_space, "﻿ a \t\n b ", "a b"), (t.normalize_space, "  ", None), (t.strip, "\x1c a b ", "a b"),
        (t.slug_ascii, " 1.9 TDI 100 ", "1-9-tdi-100"), (t.slug_ascii, "Córdoba", "c-rdoba"), (t.slug_unicode, "1.9 TDI 100", "19-tdi-100"), (t.slug_unicode, " Ñandú__x - y! ", "ñandú-x-y"),
        (t.slug_unicode, "!!", None), (t.id_slug, "1.9 TDI (100)", "1_9_tdi_100"), (t.canon, "***", ""), (t.canon, None, ""), (t.clean_identity, "A & B  c", "A  B c"), (t.clean_identity, "&", None),
        (t.upper_text, " ab ", "AB"), (t.key_text, None, ""), (t.key_text, " a  b", "A B"),
        (n.number_thousands, "1.896 cc", 1896.0), (n.number_thousands, "10,5 x", 10.5), (n.int_thousands, "2,5", 2), (n.int_thousands, "3,5", 4), (n.number_thousands, "x", None),
        (n.first_number, "1.142 kg", 1.142), (n.first_number, "267-960 L", 267.0), (n.first_number, "-3,5", -3.5), (n.first_int, "2.5", 2), (n.kilograms, "1.142 kg", 1142), (n.kilograms, "10,5", 105), (n.kilograms, "kg", None),
        (n.millimetres, "3.953 mm", 3953), (n.millimetres, "3.953", 3953), (n.millimetres, "1750", 1750), (n.cubic_centimetres, "1.896 cc", 1896), (n.cubic_centimetres, "1,9 Litro", 1900), (n.cubic_centimetres, "1896", 1896),
        (n.last_int, "3-5", 5), (n.last_int, "no", None), (n.rpm, "100 CV @ 4.000 RPM", 4000), (n.rpm, "100 CV", None),
        (n.lenient_double, " 1_000.5 ", 1000.5), (n.lenient_double, "1d", None), (n.lenient_double, "nan", None), (n.lenient_double, "1e3", 1000.0),
    ],
)
def test_single_values(spark, fn, text, want):
    assert one(spark, fn("v"), v=text) == want


def test_structs(spark):
    assert tuple(one(spark, n.years("v"), v="de 1999 a 2005, 12001")) == (1999, 2005)
    assert tuple(one(spark, n.valves("v"), v="2 (8v Total)")) == (2, 8)
    assert tuple(one(spark, n.bore_stroke("v"), v="79,5 x 95,5 mm")) == (79.5, 95.5, "79,5 x 95,5 mm")
    assert tuple(one(spark, n.displacement("v"), v=["1,9 Litro", "1.896 cc"])) == (1896, 1.9)
    assert tuple(one(spark, n.displacement("v"), v=["1,9 Litro"])) == (1900, 1.9)
    assert tuple(one(spark, n.ratio_and_label("v"), v=["0,83:1", "Subcuadrado"])) == (0.83, "Subcuadrado")
    assert tuple(one(spark, n.drive_type("v"), v=["FWD", "Tracción Delantera"])) == ("FWD", "Tracción Delantera")
    assert tuple(one(spark, n.towing("v"), v="500 / 1.000 kg")) == (1.0, 500.0)
    assert tuple(one(spark, n.gearbox("v"), v="5 Velocidades")) == ("5 Velocidades", 5)


def test_first_present_and_urls(spark):
    assert one(spark, t.first_present("a", "b", "c"), a=None, b="  ", c="x") == "x"
    url = lambda s, h: one(spark, t.normalize_url("s", "h"), s=s, h=h)
    assert url("https://a.b:8/c/d", "/x") == "https://a.b:8/x" and url("https://a.b/c/d", "x") == "https://a.b/c/x"
    assert url("https://a.b/c/d", "http://z") == "http://z" and url(None, "x") == "x" and url("https://a.b/c", None) is None


def test_alias_keeps_or_drops_unknown_names(spark):
    assert one(spark, t.alias("v", {"a b": "x"}), v=" A  B ") == "x"
    assert one(spark, t.alias("v", {"a": "x"}), v="Zed") is None and one(spark, t.alias("v", {"a": "x"}, True), v="Zed") == "zed"
    assert F is not None


def digests(spark, folder, query, *columns):
    """Rows of a query over documents, by their text: what each column is the digest of, where that is among the texts given."""
    texts = dict(enumerate(columns[0]))
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    want = [tuple(None if x is None else hashlib.md5(x.encode()).hexdigest() for x in row) for row in zip(*columns[1:], strict=True)]
    return [tuple(r)[1:] for r in catalogue.QUERIES[query](spark, str(folder)).orderBy("doc_id").collect()], want


def test_slugs_have_the_words_and_blanks_of_the_sql(spark, tmp_path):
    texts = ["é x² ½", "!!", "", None, "a\xa0b\x0bc ", "ΑΣ ΟΔΟΣ", "a‿b ⓐ_ࡰ", " -\n"]
    got, want = digests(spark, tmp_path, "slug_unicode", texts, ["e-x²-½", "", "", None, "abc", "ασ-οδοσ", "ab-ࡰ", ""])
    assert got == want
    assert one(spark, t.slug_unicode("v"), v="é x² \x1c½") == "e-x²-½" and one(spark, t.slug_unicode("v"), v="a\xa0b") == "a-b"


def test_cleaned_texts_have_the_words_and_blanks_of_the_sql(spark, tmp_path):
    texts = ["é x² ½", "!!", "", None, "\xa0 a\xa0b\x0bc ", "﻿a", "ⓐࡰ  (1)\n"]
    got, want = digests(spark, tmp_path, "text_clean", texts, ["é x² ½", "", "", None, "abc", "a", "ࡰ (1)"], ["é x² ½", "!!", "", None, "a\xa0b\x0bc", "﻿a", "ⓐࡰ (1)"])
    assert got == want
    assert one(spark, t.clean_identity("v"), v="é x²\xa0½ ") == "é x² ½"
