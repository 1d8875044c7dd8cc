"""Scalar rules of FIXTURES.md section 3."""

from pyspark.sql import functions as F

from folio.functions import values as V
from folio.functions.links import content_id_from_path, encode_uri_component, link_fields
from folio.functions.text import row_text, search_gate


def col_values(spark, data, schema, expr):
    df = spark.createDataFrame([(v,) for v in data], schema)
    return [r[0] for r in df.select(expr).collect()]


def test_parse_int_prefix(spark):
    data = ["12abc", "  7", "-3", "3.9", "1e3", "abc", "", None, "0x1f", "+5", "0x"]
    got = col_values(spark, data, "x string", V.parse_int("x"))
    assert got == [12, 7, -3, 3, 1, None, None, None, 31, 5, None]


def test_year_and_quantity_from_form_text(spark):
    assert col_values(spark, ["0", "x", "2024"], "x string", V.parse_int_or_null("x")) == [None, None, 2024]
    assert col_values(spark, ["0", "", "5"], "x string", V.parse_int_or_zero("x")) == [0, 0, 5]


def test_falsy_and_null_defaults(spark):
    assert col_values(spark, [None, "", "a"], "x string", V.falsy_default("x", "d")) == ["d", "d", "a"]
    assert col_values(spark, [0, None, 4], "x int", V.falsy_default("x", 9, numeric=True)) == [9, 9, 4]
    assert col_values(spark, [None, "0", ""], "x string", V.null_default("x", "d")) == ["d", "0", ""]
    assert col_values(spark, [float("nan"), 1.5], "x double", V.falsy_text("x", "—", numeric=True)) == ["—", "1.5"]


def test_blank_date_versus_blank_text(spark):
    df = spark.createDataFrame([("", "")], "birthdate string, bio string")
    row = df.select(V.parse_date("birthdate").alias("d"), F.col("bio")).first()
    assert row.d is None and row.bio == ""


def test_template_text_and_copies(spark):
    assert col_values(spark, [None, 3], "x int", V.template_text("x")) == ["null", "3"]
    assert col_values(spark, [None, 0, 3], "x int", V.copies_text("x")) == [None, "0 quyển", "3 quyển"]


def test_search_gate():
    assert not search_gate("")
    assert not search_gate("   ")
    assert not search_gate("　")
    assert search_gate(" a")
    assert search_gate("A")


def test_encode_uri_component(spark):
    got = col_values(spark, ["a b+c~*!()'Sá"], "x string", encode_uri_component("x"))
    assert got == ["a%20b%2Bc~*!()'S%C3%A1"]


def test_link_read(spark):
    df = spark.createDataFrame([("reader.html?id=3&title=a%20b",), ("reader.html?title=x",),
                                ("http://a b/?id=3",), ("reader.html?id=4&title=100%+sure",)], "u string")
    rows = df.select(*[c.alias(n) for n, c in link_fields("u").items()]).collect()
    # A bare "%" stands for itself.
    assert rows[3].link_id == "4" and rows[3].link_title == "100% sure"
    assert (rows[0].link_id, rows[0].link_title, rows[0].missing_id) == ("3", "a b", False)
    assert rows[1].missing_id and rows[1].link_title == "x"
    assert rows[2].link_id == "3" and not rows[2].missing_id


def test_content_id(spark):
    got = col_values(spark, ["/c/12.pdf", "/c/x12.pdf", "/c/12.txt"], "p string", content_id_from_path("p"))
    assert got == [12, None, None]


def test_entity_label_and_route(spark):
    assert col_values(spark, ["book", "author", "x"], "e string", V.entity_label("e")) == ["sách", "tác giả", None]
    assert col_values(spark, [None, 0, 7], "i long", V.editing_route("i")) == ["insert", "insert", "update"]


def test_row_text_keeps_cells_apart(spark):
    df = spark.createDataFrame([("ab", "cd")], "t string, a string")
    text = df.select(row_text([F.col("t"), F.col("a")]).alias("r")).first().r
    assert "bc" not in text.lower()
    assert text.startswith("\n" + " " * 10 + "ab\n")
