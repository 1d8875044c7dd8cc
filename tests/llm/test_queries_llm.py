"""Every registered query against its DuckDB oracle, and the pipeline."""

import random

import duckdb
import pytest

import corpus_pipeline
from folio.llm import language, line_runs, minhash, mixing, packing
from folio.llm.registry import ORACLE_SQL, QUERIES
from tests.llm.helpers import WORD, components, docs_frame, odd_rows, rows_of

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages labels benchmark".split()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert got == sorted(want, key=repr)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages_match_their_operators(spark, scratch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, frames[-1], SF)
        out.write.parquet(f"{scratch}/{k}")
        frames.append(spark.read.parquet(f"{scratch}/{k}"))
        if k < 4:
            assert out.dtypes == docs.dtypes
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    assert ids(frames[1]) == ids(docs)          # every document has a language
    assert ids(frames[2]) == ids(docs)
    kept = minhash.near_duplicates(frames[2]).filter("kept")
    assert ids(frames[3]) == ids(kept)
    taken = sum(r["taken"] for r in mixing.taken_words(frames[3]).collect())
    assert sum(r["w"] for r in frames[4].select(mixing.word_count(frames[4]["text"]).alias("w")).collect()) == taken
    tokens = sum(len(x) // 2 + 1 for x in packing.encode_texts([r["text"] for r in frames[4].collect()],
                                                               corpus_pipeline.public_tokenizers.path("byte_bpe_50k.tiktoken")))
    assert sum(r["length"] for r in frames[5].collect()) == tokens


def test_pipeline_stages_take_odd_rows_and_empty_tables(spark):
    docs = docs_frame(spark, odd_rows() + [(30 + k, "the and of that was with", "en", "a") for k in range(9)]
                      + [(50 + k, "der und die das ist nicht", "de", "b") for k in range(9)])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert len(rows_of(out)) > 0
        assert stage(spark, docs.limit(0), SF).count() == 0
    kept = {r["doc_id"] for r in rows_of(corpus_pipeline.language_id(spark, docs, SF))}
    assert {4, 5, 30, 50} <= kept and not {1, 2, 3, 8} & kept
    assert language and line_runs


def planted_corpus():
    """Documents of two languages and one without labels, with exact and near
    copies, a passage that several hold, repeated long lines and letterless rows."""
    rng = random.Random(17)
    words = {"en": "the and of that was with for this from they have been".split(),
             "de": "der und die das ist nicht ein auch mit sich auf wird".split(),
             None: "kůň žluť který jsou byla pouze nebo také protože když".split()}

    def text(lang, n):
        return "\n".join(" ".join(rng.choice(words[lang]) + str(rng.randrange(400)) for _ in range(12)) for _ in range(n))

    rows = [(k, text(lang, rng.randrange(3, 8)), lang, source) for k in range(60)
            for lang, source in [rng.choice([("en", "a"), ("en", "b"), ("de", "b"), (None, "c")])]]
    passage = text("en", 4)
    for k in (3, 11, 25):
        rows[k] = (k, rows[k][1] + "\n" + passage, "en", "a")
    rows += [(60 + k, rows[k][1], rows[k][2], "d") for k in (5, 6, 7)]
    near = text("de", 9).split(" ")
    rows += [(70, " ".join(near), "de", "d"), (71, " ".join(near[:50] + ["anders"] + near[51:]).replace("\n", " "), "de", "d")]
    rows += [(80, "12345 -- 678", None, "a"), (81, None, "en", "a"), (82, "", None, "b")]
    return rows


def brute_lines(rows):
    """A line goes with an earlier equal line of 40 characters, or as one of
    three in a row that stand earlier."""
    at = [(d, k, t) for d, text, *_ in rows for k, t in enumerate((text or "").split("\n"))]
    first = {}
    for d, k, t in sorted(at):
        first.setdefault(t, (d, k))
    three, gone = {}, set()
    lines = {d: (text or "").split("\n") for d, text, *_ in rows}
    for d, k, t in sorted(at):
        if len(t) >= 40 and first[t] < (d, k):
            gone.add((d, k))
        if k + 2 < len(lines[d]):
            window = tuple(lines[d][k:k + 3])
            if three.setdefault(window, (d, k)) < (d, k):
                gone |= {(d, k), (d, k + 1), (d, k + 2)}
    return {d: "\n".join(t for k, t in enumerate(ls) if (d, k) not in gone) for d, ls in lines.items()}


def brute_near(texts):
    """The smallest id of every group of texts that share 75 % of their shingles."""
    sets = {}
    for d, text in texts.items():
        words = WORD.findall(text.lower())
        sets[d] = {tuple(words[k:k + 5]) for k in range(max(len(words) - 4, min(len(words), 1)))}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    group = components(list(texts), links)
    return {d for d in texts if group[d] == d}


def test_pipeline_against_plain_python(spark, scratch):
    rows = planted_corpus()
    docs_frame(spark, rows).write.parquet(f"{scratch}/documents.parquet")
    kept = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    lines = brute_lines(kept)
    alone = brute_near(lines)
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    for k, want in enumerate([{r[0]: r[1] for r in kept}, lines, {d: lines[d] for d in alone}]):
        docs = corpus_pipeline.STAGES[k][1](spark, docs, scratch)
        docs.write.parquet(f"{scratch}/stage{k}")
        docs = spark.read.parquet(f"{scratch}/stage{k}")
        assert {r["doc_id"]: r["text"] for r in docs.collect()} == want
    # Exact copies have lost their lines; of the near ones the first stays; the
    # unlabelled language stays, letterless rows go.
    assert not lines[65] and {70} <= alone and 71 not in alone
    out = corpus_pipeline.run(spark, scratch).collect()
    # Sources in order weigh 3, 1, 2, 3; together they take 150 % of the words,
    # none more than twice its own.
    size = {}
    for d in alone:
        size.setdefault(next(r[3] for r in rows if r[0] == d), []).append(len(WORD.findall(lines[d])))
    size = {k: sum(v) for k, v in size.items()}
    weight = dict(zip(sorted(size), [3, 1, 2, 3]))
    target, open_, left = {}, set(size), 1.5 * sum(size.values())
    while open_:
        share = {k: left * weight[k] / sum(weight[x] for x in open_) for k in open_}
        over = {k for k in open_ if share[k] > 2 * size[k]}
        if not over:
            target |= share
            break
        for k in over:
            target[k] = 2 * size[k]
            left -= target[k]
        open_ -= over
    encode = lambda text: packing.encode_texts([text], corpus_pipeline.public_tokenizers.path("byte_bpe_50k.tiktoken"))[0]
    tokens, whole = {}, {}
    for d in alone:
        source = next(r[3] for r in rows if r[0] == d)
        whole[source] = whole.get(source, 0) + len(encode(lines[d])) // 2
    for r in out:
        source = next(x[3] for x in rows if x[0] == r["doc_id"])
        tokens[source] = tokens.get(source, 0) + r["length"]
    assert {r["doc_id"] for r in out} <= alone
    for source in size:
        assert abs(tokens[source] / whole[source] - target[source] / size[source]) < 0.12 * target[source] / size[source] + 0.1
    # Sequences are full but for the last and have no gaps.
    used = {}
    for r in out:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(1 for p in used.values() if sum(n for _, n in p) < 1024) <= 1
