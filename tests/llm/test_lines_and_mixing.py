import random

from pyspark.sql import functions as F

from folio.llm import line_runs, mixing
from tests.llm.helpers import WORD, docs_frame, odd_rows, rows_of


def brute_lines(rows, min_lines, min_chars):
    docs = sorted((i, (t or "").split("\n")) for i, t in rows)
    first_one, first_run, gone = {}, {}, {i: set() for i, _ in docs}
    for i, lines in docs:
        for k, line in enumerate(lines):
            if first_one.setdefault(line, (i, k)) != (i, k) and len(line) >= min_chars:
                gone[i].add(k)
            run = tuple(lines[k:k + min_lines])
            if len(run) == min_lines and first_run.setdefault(run, (i, k)) != (i, k):
                gone[i].update(range(k, k + min_lines))
    return gone


def test_line_runs_against_brute_force(spark):
    rng = random.Random(3)
    for min_lines in (2, 3, 5):
        rows = [(k, "\n".join(rng.choice(["a", "b", "long line %d" % rng.randrange(6), "", "c"])
                              for _ in range(rng.randrange(1, 30)))) for k in range(40)]
        want = brute_lines(rows, min_lines, 11)
        out = line_runs.remove_repeated_runs(docs_frame(spark, rows), min_lines=min_lines, min_chars=11)
        for r in rows_of(out):
            lines, gone = dict(rows)[r["doc_id"]].split("\n"), want[r["doc_id"]]
            assert r["text"] == "\n".join(x for k, x in enumerate(lines) if k not in gone)
            assert (r["n_lines"], r["n_removed"]) == (len(lines), len(gone))
            assert r["n_runs"] == sum(k - 1 not in gone for k in gone)


def test_line_runs_odd_rows(spark):
    docs = docs_frame(spark, odd_rows()).withColumn("_gone", F.lit("x")).withColumn("n_runs", F.lit("y"))
    out = line_runs.remove_repeated_runs(docs, min_lines=1, min_chars=1)
    got = rows_of(out)
    assert len(got) == len(odd_rows())
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["text"] is None and by_id[4]["n_removed"] == 0 and by_id[5]["text"] == ""
    assert by_id[10]["text"] == "x"
    assert line_runs.remove_repeated_runs(docs.limit(0)).count() == 0


def water_fill(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mix_meets_targets_and_is_repeatable(spark):
    rng = random.Random(9)
    names = [None, "a", "B", "é", "z", "zz", "tiny", "hot"]
    rows = [(k, " ".join("w" for _ in range(rng.randrange(0, 60))), "en",
             "hot" if k % 3 == 0 else rng.choice(names[:6])) for k in range(900)] + [(1000, "only five words are here", "en", "tiny")]
    docs = docs_frame(spark, rows)
    got = rows_of(mixing.taken_words(docs))
    sizes = {}
    for _, text, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(text))
    want = water_fill(sizes)
    taken = {s: 0 for s in sizes}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    assert {s: abs(taken[s] - want[s]) <= 0.5 for s in sizes} == {s: True for s in sizes}
    again = rows_of(mixing.taken_words(docs.repartition(7)))
    key = lambda r: r["doc_id"]
    assert sorted(got, key=key) == sorted(again, key=key)


def test_schedule_follows_the_weights_everywhere(spark):
    rng = random.Random(2)
    rows = [(k, "a b c d e f g h", "en", "abc"[min(rng.randrange(6), 2)]) for k in range(2000)]
    laid, pieces = mixing.mix_sources(docs_frame(spark, rows))
    order = pieces.join(laid.select("_uid", "source"), "_uid").orderBy("slot", "_round", "start").collect()
    total = {s: sum(r["words"] for r in order if r["source"] == s) for s in "abc"}
    size, seen = sum(total.values()), dict.fromkeys("abc", 0)
    for k, r in enumerate(order):
        seen[r["source"]] += r["words"]
        if k % 100 == 0:
            assert all(abs(seen[s] - sum(seen.values()) * total[s] / size) < 60 + 0.02 * sum(seen.values()) for s in "abc")


def test_mixed_documents_have_the_words_taken(spark):
    docs = docs_frame(spark, odd_rows() + [(20 + k, "one two three four five six seven", "en", "e") for k in range(20)])
    counts = {}
    for r in rows_of(mixing.taken_words(docs)):
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + r["taken"]
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = {}
    for r in rows_of(out):
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(WORD.findall(r["text"]))
    assert words == {k: v for k, v in counts.items() if v}
    assert mixing.taken_words(docs.limit(0)).count() == 0
    assert mixing.taken_words(docs.filter("doc_id <= 3")).agg(F.sum("taken")).first()[0] == 0
