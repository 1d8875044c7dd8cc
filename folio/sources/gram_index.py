"""Text search through an index of trigrams.

The reference searches at every keystroke; a scan reads every text each time.
The index holds, for every trigram of the lower-cased texts, which documents
have it, as one row per trigram and block of ``block`` ids with the ids'
places in the block (so a trigram that every document holds is many rows and
never one list).  The rows are dealt to folders by a hash of the trigram and
sorted by it: a query of n characters opens at most n - 2 folders, and the row
groups that cannot hold its trigrams are skipped.

A text that contains the query holds all its trigrams, so the documents that
have all of them are the candidates; they are read from the stored documents
(``sources.keyed``, only the folders that hold one) and confirmed on their
whole texts by the predicate the scan uses.  Queries under three characters
have no trigram: they are scanned.

Texts are built and searched in lower case as Spark makes it.  The documents'
key is an integer and unique (the keyed table sees to both).  An index belongs
to one version of its documents and refuses another.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions.text import any_contains_ci, search_gate
from folio.session import shared_checkpoint_dir
from folio.sources import keyed

GRAM = 3
BLOCK = 4096
FOLDERS = 256
FOLDER = "gramfolder"
WORD = 64
# Every three characters in a row; the lookahead lets matches overlap.
_GRAMS = "(?s)(?=(.{3}))"


def grams(text: Column) -> Column:
    """The trigrams of a lower-cased text, with repeats."""
    return F.regexp_extract_all(F.lower(text), F.lit(_GRAMS), F.lit(1))


def _folder(gram: Column, folders: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(folders)).cast("int")


def build(spark: SparkSession, docs_root: str, columns: list[str], root: str, block: int = BLOCK, folders: int = FOLDERS) -> None:
    """Index the ``columns`` of the newest version of a keyed table."""
    v = keyed.version(spark, docs_root)
    key = F.col(v.layout.key)
    docs = keyed.read(spark, docs_root, v.number)
    held = F.array_distinct(F.flatten(F.array(*[F.coalesce(grams(F.col(c)), F.array().cast("array<string>")) for c in columns])))
    place = F.pmod(key, F.lit(block)).cast("int")
    rows = docs.select(F.explode(held).alias("gram"), F.call_function("div", key - place, F.lit(block)).cast("bigint").alias("block"), place.alias("place"))
    # Sixty-four places are one number, so that most repeats of a trigram are
    # added up before the shuffle; a row then gathers at most ``block`` / 64.
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place") % WORD)
    words = rows.groupBy("gram", "block", F.floor(F.col("place") / WORD).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    gathered = words.groupBy("gram", "block").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words"))
    set_bits = F.transform("words", lambda w: F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda k: F.getbit(w["bits"], k) == 1), lambda k: w["word"] * WORD + k))
    # At most ``block`` places a row, ascending.
    postings = gathered.select("gram", "block", F.flatten(set_bits).alias("places"))
    postings = postings.withColumn(FOLDER, _folder(F.col("gram"), folders)).repartition(FOLDER, F.pmod(F.xxhash64("block"), F.lit(8)))
    data = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    postings.sortWithinPartitions(FOLDER, "gram", "block").write.partitionBy(FOLDER).parquet(data)
    spark.createDataFrame([(data, v.number, block, folders)], "data string, version long, block int, folders int") \
        .coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/_index")


def candidates(spark: SparkSession, root: str, query: str, version: int) -> DataFrame | None:
    """``id``: the documents that hold all trigrams of a query; null where the
    query has none."""
    entry = spark.read.schema("data string, version long, block int, folders int").parquet(f"{root.rstrip('/')}/_index") \
        .filter(F.col("version") == version).first()
    if entry is None:
        raise ValueError(f"{root} holds no index of version {version}")
    wanted = spark.range(1).select(F.explode(F.array_distinct(grams(F.lit(query)))).alias("g"))
    # The trigrams of one query, with their folders.
    wanted = wanted.select("g", _folder(F.col("g"), entry["folders"]).alias("f")).collect()
    if not wanted:
        return None
    rows = spark.read.schema(f"gram string, block long, places array<int>, {FOLDER} int").parquet(entry["data"]).filter(
        F.col(FOLDER).isin(sorted({w["f"] for w in wanted})) & F.col("gram").isin([w["g"] for w in wanted]))
    # A block has one row for each trigram at most.
    both = rows.groupBy("block").agg(F.collect_list("places").alias("all")).filter(F.size("all") == len(wanted))
    places = F.aggregate(F.slice("all", 2, len(wanted)), F.col("all")[0], F.array_intersect)
    return both.select(F.col("block"), F.explode(places).alias("place")).select((F.col("block") * entry["block"] + F.col("place")).alias("id"))


def search(spark: SparkSession, docs_root: str, root: str, query: str | None, columns: tuple[str, ...]) -> DataFrame:
    """F5 through the index: the rows ``text_search`` would keep.  ``columns``
    are (some of) those indexed."""
    v = keyed.version(spark, docs_root)
    if not search_gate(query):
        return keyed.read(spark, docs_root, v.number)
    ids = candidates(spark, root, query, v.number)
    if ids is None:
        docs = keyed.read(spark, docs_root, v.number)
    else:
        # Asked for twice: for the folders to open and for their rows.
        shared_checkpoint_dir(spark)
        docs = keyed.read_matching(spark, docs_root, ids.checkpoint(), v.number)
    return docs.filter(any_contains_ci(list(columns), query))
