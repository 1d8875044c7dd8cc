import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from folio.llm import main_text, piecewise, suffix_runs
from tests.llm.helpers import docs_frame, odd_rows, rows_of


# -- operator 7 -----------------------------------------------------------------

def brute_spans(texts, length):
    count = Counter(t[k:k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if count[t[k:k + length]] > 1:
                gone[k:k + length] = True
        out.append(gone)
    return out


def copies_and_passages(rng, n, length):
    """Texts that share passages of lengths about ``length``, also within one."""
    alphabet = "abcde é"
    make = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    passages = [make(length + d) for d in (-3, -1, 0, 1, 2, 7, length, 3 * length)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(passages)
            a = rng.randrange(0, 4)
            parts += [make(rng.randrange(0, 2 * length)), p[a:] if rng.random() < 0.3 else p]
        texts.append("".join(parts))
    texts += texts[:4] + ["x" * (3 * length), "", make(length - 1), "ab" * length]
    return texts


def test_merge_yields_sorted_strings_and_their_common_prefixes():
    rng = random.Random(1)
    for _ in range(300):
        runs = [sorted("".join(rng.choice("ab") for _ in range(rng.randrange(0, 9))).encode() for _ in range(rng.randrange(0, 8)))
                for _ in range(rng.randrange(0, 7))]
        out = list(suffix_runs.merge_runs([[(k, rest, None) for k, rest in suffix_runs.front_code(r)] for r in runs]))
        assert [x[1] for x in out] == sorted(x for r in runs for x in r)
        assert all(b[0] == suffix_runs.common_prefix(a[1], b[1]) for a, b in zip(out, out[1:]))


@pytest.mark.parametrize("hot", [4096, 2])
def test_repeated_strings_against_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(suffix_runs, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(suffix_runs.repeated_spans, "__defaults__", (suffix_runs.LENGTH, suffix_runs.GRAM, hot))
    for seed in (1, 2):
        texts = copies_and_passages(random.Random(seed), 30, 40)
        want = brute_spans([t.encode() for t in texts], 40)
        rows = rows_of(suffix_runs.remove_repeated_strings(docs_frame(spark, list(enumerate(texts))), length=40))
        assert len(rows) == len(texts)
        for r in rows:
            data, gone = texts[r["doc_id"]].encode(), want[r["doc_id"]]
            kept = bytes(b for b, g in zip(data, gone) if not g)
            assert (r["n_bytes"], r["n_removed"]) == (len(data), int(gone.sum()))
            assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest() and bytes(r["kept"]) == kept
            assert r["n_spans"] == int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())


def test_production_length_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_runs, "BLOCK", 1 << 12)
    texts = copies_and_passages(random.Random(5), 12, 400)
    want = brute_spans([t.encode() for t in texts], 400)
    for r in rows_of(suffix_runs.remove_repeated_strings(docs_frame(spark, list(enumerate(texts))))):
        assert r["n_removed"] == int(want[r["doc_id"]].sum())


def test_scanner_blocks_give_the_same_anchors(monkeypatch):
    rng = random.Random(4)
    docs = ["".join(rng.choice("abcd ") for _ in range(n)).encode() for n in (30_000, 10, 399, 400, 401, 5000)]

    def found():
        return sorted((d, p, g, c, b, e) for batch in suffix_runs.Scanner().anchors(docs) for d, p, g, c, b, e in zip(*(x.tolist() for x in batch)))

    whole = found()
    monkeypatch.setattr(suffix_runs, "BLOCK", 1 << 11)
    assert found() == whole


def test_suffix_odd_rows(spark):
    docs = docs_frame(spark, odd_rows()).selectExpr("*", "'x' as uid", "1 as n_bytes")
    got = rows_of(suffix_runs.remove_repeated_strings(docs))
    assert len(got) == len(odd_rows())
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1]["n_bytes"] == 0 and by_id[4]["n_removed"] == 0 and by_id[7]["n_removed"] > 0
    assert suffix_runs.remove_repeated_strings(docs.limit(0)).count() == 0


# -- operator 6 -----------------------------------------------------------------

def test_fingerprint_neighbours_by_definition(spark, monkeypatch):
    monkeypatch.setattr(piecewise, "RANGE_CHARS", 3000)
    rng = random.Random(8)
    rows = [(k * 7 % 101, "".join(rng.choice("abcdefg hé") for _ in range(rng.randrange(0, 900)))) for k in range(60)] + [(200, None)]
    got = {r["doc_id"]: r for r in rows_of(piecewise.fingerprint_neighbours(docs_frame(spark, rows)))}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    make = piecewise.Fingerprinter()
    for k, (i, t) in enumerate(order):
        after = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == make.fingerprint(t.encode()) and r["edited_fingerprint"] == make.fingerprint(edited.encode())
        assert r["near_next"] == piecewise.likeness([(r["fingerprint"], make.fingerprint(after.encode()))])[0]
    long = [r for r in got.values() if r["n_chars"] > 300]
    assert np.mean([r["near_edited"] for r in long]) > 0.3 > np.mean([r["near_next"] for r in long])


def test_likeness_follows_edits():
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    make = piecewise.Fingerprinter()
    few = text[:5000] + "XYZ" + text[5000:]
    other = "".join(rng.choice("abcdefgh ") for _ in range(20_000))
    one, two, three = (make.fingerprint(x.encode()) for x in (text, few, other))
    assert piecewise.likeness([(one, one), (one, two), (one, three)]).tolist()[0] == 1
    assert piecewise.likeness([(one, two)])[0] > 0.9 and piecewise.likeness([(one, three)])[0] < 0.3


def test_piecewise_odd_rows(spark):
    docs = docs_frame(spark, odd_rows()).selectExpr("*", "'x' as stretch", "1 as tie")
    got = rows_of(piecewise.fingerprint_neighbours(docs))
    assert len(got) == len(odd_rows())
    prints = {r["doc_id"]: r["fingerprint"] for r in got}
    assert prints[4] == prints[5] == prints[6]
    assert piecewise.fingerprint_neighbours(docs.limit(0)).count() == 0
    one = rows_of(piecewise.fingerprint_neighbours(docs.filter("doc_id = 4")))
    assert one[0]["near_next"] == 1


# -- operator 5 -----------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header>Site</header>
<nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1>
<p>First   <b>par</b>agraph<br>goes on &copy;</p><aside>Related</aside><p>Second<script>var t="</p>";</script> one
<form><p>Mail</form><section id="comments"><p>Reader says</section></article><footer>&copy; {n}</footer></body></html>"""


def test_main_text_of_articles_and_of_unmarked_pages(spark):
    tail = "Sign up now for all the news that we will ever send"
    plain = [f"<body><div>{tail}</div><p>Story number {k} tells of {k * 17} things, and no other page does</p><div>{tail}" for k in range(6)]
    rows = [(0, "http://a.example.com/x", PAGE.format(n=1)), (1, "http://a.example.com/y", PAGE.format(n=2)), (2, None, None),
            (3, "", ""), (None, "::", "<p>a&nbsp;&lt;b&gt;<p>c<!-- <p>no --> d"), (4, "http://a.example.com", "no markup\n at all")]
    rows += [(10 + k, f"https://u@B.example.com:80/{k}", h) for k, h in enumerate(plain)] + [(16, "http://c.example.com/", plain[0])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as row")
    got = {r["page_id"]: r for r in rows_of(main_text.extract(pages))}
    assert got[0]["text"] == got[1]["text"] == "Head & line\nFirst paragraph goes on ©\nSecond one"
    assert got[2]["text"] == got[3]["text"] == "" and got[2]["n_chars"] == 0
    assert got[None]["text"] == "a <b>\nc d" and got[4]["text"] == "no markup at all"
    for k in range(6):
        assert got[10 + k]["text"] == f"Story number {k} tells of {k * 17} things, and no other page does"
    assert tail in got[16]["text"]
    assert main_text.extract(pages.limit(0)).count() == 0


def test_boilerplate_of_a_host_in_many_parts(spark, monkeypatch):
    """Three pages of a host are enough however many parts its pages fill."""
    rng = random.Random(9)
    tail = "Sign up now for all the news that we will ever send"
    story = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(30)) for _ in range(60)]
    rows = [(k, f"http://hot.example.com/{k}", f"<p>{s}</p>" + f"<div>{tail}</div>" * (k % 20 == 0)) for k, s in enumerate(story)]
    rows += [(100 + k, f"http://cold{k}.example.com/", f"<p>{story[k]}</p><div>{tail}</div>") for k in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = {k: s for k, s in enumerate(story)} | {100 + k: f"{story[k]}\n{tail}" for k in range(3)}
    for size in (main_text.PART_CHARS, 300):
        monkeypatch.setattr(main_text, "PART_CHARS", size)
        for split in (1, 7):
            assert {r["page_id"]: r["text"] for r in rows_of(main_text.extract(pages.repartition(split)))} == want


def test_articles_lose_the_host_s_notices_and_keep_quotes_and_copies(spark):
    rng = random.Random(12)
    words = lambda n: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(n))
    notice, quote, advert = (f"{x} " + words(11) for x in ("Notice", "Quote", "Advert"))
    story, aside = [words(40) for _ in range(12)], [f"Outside {words(9)}" for _ in range(12)]
    rows, want = [], {}
    for k in range(12):
        quoted = f"<p>{quote}</p>" * (k < 4)
        rows.append((k, f"http://a.example.com/{k}", f"<div>{aside[k]}</div><div>{advert}</div><article><p>{story[k]}</p>{quoted}<p>{notice}</p></article>"))
        want[k] = "\n".join([aside[k], story[k]] + [quote] * (k < 4))
    # A host whose pages are copies of one article.
    rows += [(100 + k, f"http://b.example.com/{k}", f"<main><p>{story[0]}</p><p>{story[1]}</p><p>{words(8)}</p></main>") for k in range(5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in rows_of(main_text.extract(pages))}
    assert {k: got[k] for k in range(12)} == want
    assert all(got[100 + k].startswith(f"{story[0]}\n{story[1]}\nw") for k in range(5))


def test_repeated_tokens_against_brute_force():
    rng = random.Random(3)
    for _ in range(100):
        streams = [np.array([rng.randrange(3) for _ in range(rng.randrange(0, 30))], np.int64) for _ in range(5)]
        where = {}
        for k, s in enumerate(streams):
            for i in range(len(s) - 3):
                where.setdefault(tuple(s[i:i + 4]), set()).add(k)
        for s, got in zip(streams, main_text.repeated_tokens(streams, 4, 3)):
            want = np.zeros(len(s), bool)
            for i in range(len(s) - 3):
                if len(where[tuple(s[i:i + 4])]) >= 3:
                    want[i:i + 4] = True
            assert (got == want).all()
