import base64
import random
import time
import zlib

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from folio.llm import packing
from tests.llm.helpers import docs_frame, odd_rows, rows_of

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def reference_ids(texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_ids_equal_the_tokenizers_library():
    texts = ["", "a", " a", "a  b", "a   b", "tab\t x", "line\n next", "x \n y", "don't we'll", "end ", "  lead", "\n\n a\r\n b",
             "<|endoftext|> here", "1234 567", "žluťoučký kůň  日本語", "a  b", "word. Word! (x) --- y"] + [r[1] for r in odd_rows()]
    got = [np.frombuffer(x, "<u2").tolist() for x in packing.encode_texts(texts, VOCABULARY)]
    assert got == reference_ids(texts)


def test_ids_of_any_white_space():
    """Texts with and without white space side by side go to two matchers."""
    rng = random.Random(5)
    parts = [" ", " ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "\u2028", "\u3000", "\u200b", "\ufeff", "a", "Word", "'ll", "'", "7", "42", "é",
             "日本", "!", "...", "_", "<|endoftext|>", "e\u0301", "😀", "x" * 70]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(4000)]
    texts += [" ".join(rng.choices(parts[12:], k=rng.randint(1, 12))) + rng.choice(["", " ", "\n"]) for _ in range(4000)]
    got = [np.frombuffer(x, "<u2").tolist() for x in packing.encode_texts(texts, VOCABULARY)]
    assert got == reference_ids(texts)


def test_texts_of_new_words_cost_no_more_than_one_plain_call():
    """Words met once or twice must not cost a call of the tokenizer each."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8)))
    texts = [" ".join(word() for _ in range(500)) for _ in range(400)]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    packing.encode_texts(["warm"], VOCABULARY)

    def seconds(run, chunk):
        start = time.process_time()
        run(chunk)
        return time.process_time() - start

    ours, theirs = [], []
    for k in range(0, 400, 100):        # texts not met before
        ours.append(seconds(lambda x: packing.encode_texts(x, VOCABULARY), texts[k: k + 100]))
        theirs.append(seconds(lambda x: [np.array(plain.encode_ordinary(t), "<u2").tobytes() for t in x], texts[k: k + 100]))
    assert min(ours) < 1.2 * min(theirs)


def check_pieces(rows, pieces, window=1024):
    """Every id in one piece, no padding, right checksums."""
    ids = [x + [0] for x in reference_ids([r[1] for r in rows])]
    by_doc = {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
    for r, x in zip(rows, ids):
        own = sorted(by_doc[(r[0], len(x))], key=lambda p: p["start"])
        copies = sum(q[0] == r[0] and len(y) == len(x) for q, y in zip(rows, ids))
        assert sum(p["length"] for p in own) == copies * len(x)
        if copies == 1:
            at = 0
            for p in own:
                assert p["start"] == at
                at += p["length"]
                assert p["ids_crc32"] == zlib.crc32(np.array(x[p["start"]:at], "<u4").tobytes())
    at = 0
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["sequence_id"] * window + p["offset"] == at and p["length"] > 0
        assert p["offset"] + p["length"] <= window
        at += p["length"]
    assert at == sum(map(len, ids))


def test_round_trip_of_odd_rows(spark):
    rows = [r for r in odd_rows() if r[0] is not None or r[1]]
    check_pieces(rows, rows_of(packing.pack(docs_frame(spark, rows), VOCABULARY)))
    assert packing.pack(docs_frame(spark, []), VOCABULARY).count() == 0


def test_windows_hold_the_mixture_across_partitions(spark, monkeypatch):
    monkeypatch.setattr(packing, "PARTITION_TOKENS", 30_000)
    rows = [(k, " ".join(f"some words {i}" for i in range(10 + k % 90)), "en", "hot" if k % 2 else "abc"[k % 3]) for k in range(700)]
    pieces = rows_of(packing.pack(docs_frame(spark, rows), VOCABULARY))
    check_pieces(rows, pieces)
    total = {}
    for p in pieces:
        total[p["source"]] = total.get(p["source"], 0) + p["length"]
    size = sum(total.values())
    seen, at = dict.fromkeys(total, 0), 0
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        seen[p["source"]] += p["length"]
        at += p["length"]
        if at < 0.8 * size:     # towards the end a partition's queues may run dry
            assert all(abs(seen[s] - at * total[s] / size) < 4000 for s in seen)


def off_target(pieces, shares=None):
    """Largest distance of a source from its share at any window's end."""
    total = {}
    for p in pieces:
        total[p["source"]] = total.get(p["source"], 0) + p["length"]
    size = sum(total.values())
    seen, at, worst = dict.fromkeys(total, 0), 0, 0
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        seen[p["source"]] += p["length"]
        at += p["length"]
        if at % 1024 == 0 or at == size:
            worst = max([worst] + [abs(seen[s] - at * total[s] / size) for s in seen])
    return worst


def test_no_partition_runs_dry(spark, monkeypatch):
    """A very long document and sources of uneven documents over 20 partitions:
    every window to the end is within two packets of the shares."""
    rows = [(k, " ".join(f"some words {i}" for i in range(10 + k * 37 % 190)), "en", "hot" if k % 2 else "abc"[k % 3]) for k in range(700)]
    rows.append((9000, " ".join(f"a very long one {i}" for i in range(20_000)), "en", "b"))
    rows += [(9001, "the same again and again " * 900, "en", None)] * 3
    found = []
    for size, split in ((10_000, 3), (10_000, 8), (2_000_000, 3)):
        monkeypatch.setattr(packing, "PARTITION_TOKENS", size)
        pieces = rows_of(packing.pack(docs_frame(spark, rows).repartition(split), VOCABULARY))
        check_pieces(rows, pieces)
        assert off_target(pieces) <= 256
        found.append(sorted(tuple(map(str, p.values())) for p in pieces))
    assert found[0] == found[1]


def test_shares_hold_until_a_source_is_served(spark, monkeypatch):
    """a (half of every window) ends first; b and c go on at 3 to 1."""
    monkeypatch.setattr(packing, "PARTITION_TOKENS", 8_000)
    rows = [(k, " ".join(f"some words {i}" for i in range(10 + k * 37 % 90)), "en", "abbbccd"[k % 7]) for k in range(700)]
    pieces = rows_of(packing.pack(docs_frame(spark, rows), VOCABULARY, shares={"a": 4, "b": 3, "c": 1}))
    check_pieces(rows, pieces)
    total = {s: sum(p["length"] for p in pieces if p["source"] == s) for s in "abcd"}
    seen, at = dict.fromkeys("abcd", 0), 0
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        seen[p["source"]] += p["length"]
        at += p["length"]
        if at % 1024 == 0 and at <= 2 * total["a"]:
            assert all(abs(seen[s] - at * w / 8) <= 256 for s, w in (("a", 4), ("b", 3), ("c", 1)))
        elif at % 1024 == 0 and seen["b"] < total["b"] - 1024:
            past = at - 2 * total["a"]
            assert all(abs(seen[s] - total["a"] * w / 4 - past * w / 4) <= 256 for s, w in (("b", 3), ("c", 1)))
        if seen["b"] < total["b"] or seen["c"] < total["c"]:
            assert seen["d"] <= 1024
    assert seen == total


def test_cuts_are_whole_and_ascend():
    for totals, shares in (({"a": 10, "b": 100_000, "c": 7}, {"a": 10, "b": 100_000, "c": 7}), ({"a": 900, "b": 40, "c": 3}, {"a": 1, "b": 5}), ({}, {})):
        cuts = packing._Schedule(totals, shares).cuts(64)
        size = sum(totals.values())
        assert cuts[-1] == totals and [sum(c.values()) for c in cuts] == [min(64 * k, size) for k in range(len(cuts))]
        assert all(a[s] <= b[s] for a, b in zip(cuts, cuts[1:]) for s in totals)


def test_deficits_are_carried_within_a_packet():
    from collections import deque
    queues = {"a": deque([(k, 50) for k in range(600)]), "b": deque([(k, 700) for k in range(15)]), "c": deque([(0, 5000)])}
    total = {s: sum(n for _, n in q) for s, q in queues.items()}
    size = sum(total.values())
    served = dict.fromkeys(total, 0)
    for s, _, _, n, at in packing._serve(queues, {s: t / size for s, t in total.items()}, {}, 0, 1024, 128):
        served[s] += n
        if (at + n) % 1024 == 0:
            assert all(abs(served[x] - (at + n) * total[x] / size) <= 256 for x in served)
    assert served == total
