"""Search through the trigram index against the scan."""

import random

import pytest

from folio.operators.search import text_search
from folio.sources import gram_index, keyed

SCHEMA = "id long, title string, author string"
ODD = ["İstanbul ILIK", "ΟΔΟΣ οδος Σ", "straße STRASSE", "a.b*c(d", "line\none two", "🙂🙃🙂 mixed 日本語テキスト", "aaaa", "", None, "   ", "ab", "x\ty  z", "É́clair"]


def stored(spark, scratch, rows, block, span):
    root = f"{scratch}/docs"
    keyed.create(spark.createDataFrame(rows, SCHEMA), root, keyed.Layout("span", span))
    gram_index.build(spark, root, ["title", "author"], f"{scratch}/index", block=block, folders=8)
    return root


def test_same_rows_as_the_scan(spark, scratch):
    rng = random.Random(6)
    words = ["the", "And", "lesson", "ΣΟΦΟΣ", "größe", "日本", "end.", "THE END"]
    rows = [(k * 3 - 40, ODD[k] if k < len(ODD) else " ".join(rng.choices(words, k=rng.randrange(6))), rng.choice(["Ann", "Bob Lee", None])) for k in range(120)]
    root = stored(spark, scratch, rows, block=16, span=32)
    frame = keyed.read(spark, root)
    for query in ["the end", "İST", "ΟΔΟΣ", "straße", "a.b*c(", "e\no", "🙂🙃🙂", "aaaaa", "Lee", "x", "  ", None, " the", "É́c", "The Ann"]:
        want = sorted(r["id"] for r in text_search(frame, query).collect())
        got = sorted(r["id"] for r in gram_index.search(spark, root, f"{scratch}/index", query, ("title", "author")).collect())
        assert got == want, query


def test_share_of_rows_read(spark, scratch):
    rng = random.Random(1)
    rows = [(k, " ".join(rng.choices(["lorem", "ipsum", "dolor"], k=8)) + (" quixotic" if k in (77, 1500) else ""), None) for k in range(2000)]
    root = stored(spark, scratch, rows, block=64, span=100)
    found = gram_index.search(spark, root, f"{scratch}/index", "Quixotic", ("title",))
    assert sorted(r["id"] for r in found.collect()) == [77, 1500]
    ids = gram_index.candidates(spark, f"{scratch}/index", "Quixotic", 1)
    assert sorted(r["id"] for r in ids.collect()) == [77, 1500]
    # Two of twenty folders are opened for it: a tenth of the rows.
    opened = {f.split(f"{keyed.FOLDER}=")[1].split("/")[0] for f in found.inputFiles() if keyed.FOLDER in f}
    assert opened == {"0", "15"}
    # A trigram that every document holds prunes nothing and loses nothing.
    assert gram_index.search(spark, root, f"{scratch}/index", "or", ("title",)).count() == sum("or" in t for _, t, _ in rows)
    # Postings hold at most a block's places.
    data = spark.read.parquet(f"{scratch}/index/_index").first()["data"]
    assert spark.read.parquet(data).selectExpr("max(size(places))").first()[0] == 64


def test_an_index_belongs_to_one_version(spark, scratch):
    root = stored(spark, scratch, [(1, "first text", None)], block=16, span=32)
    keyed.merge(spark, root, spark.createDataFrame([(2, "second text", None)], SCHEMA))
    with pytest.raises(ValueError):
        gram_index.search(spark, root, f"{scratch}/index", "text", ("title",))
    gram_index.build(spark, root, ["title", "author"], f"{scratch}/index")
    assert gram_index.search(spark, root, f"{scratch}/index", "TEXT", ("title",)).count() == 2


def test_empty_documents(spark, scratch):
    root = f"{scratch}/docs"
    keyed.create(spark.createDataFrame([], SCHEMA), root, keyed.Layout("span", 32))
    gram_index.build(spark, root, ["title"], f"{scratch}/index")
    assert gram_index.search(spark, root, f"{scratch}/index", "text", ("title",)).count() == 0


def test_postings_by_definition_and_no_listing_of_the_whole_table(spark, scratch, monkeypatch):
    rng = random.Random(4)
    rows = [(k * 2 - 150, " ".join(rng.choices(["abc", "Bcd", "xyz"], k=2)) + (" lonely" if k == 140 else ""), rng.choice(["Ann", None])) for k in range(300)]
    root = stored(spark, scratch, rows, block=192, span=32)
    want = {}
    for key, title, author in rows:
        for text in (title, author or ""):
            for at in range(len(text) - 2):
                want.setdefault((text[at:at + 3].lower(), key // 192), set()).add(key % 192)
    data = spark.read.parquet(f"{scratch}/index/_index").first()["data"]
    got = {(r["gram"], r["block"]): r["places"] for r in spark.read.parquet(data).collect()}
    assert got == {at: sorted(places) for at, places in want.items()}
    # A query that has trigrams never asks for all rows.
    monkeypatch.setattr(keyed, "read", lambda *_: pytest.fail("the whole table was asked for"))
    assert [r["id"] for r in gram_index.search(spark, root, f"{scratch}/index", "LONELY", ("title",)).collect()] == [130]
