"""Operator 12: pieces and spans against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2 as pb

from folio.llm import piece_codec, registry
from folio.llm.piece_codec import PieceModel, read_rules
from tests.llm.helpers import DOCS, docs_frame, odd_rows, rows_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RULES = {"ﬁ": "fi", "①": "1", "A": "a", "É": "e", "é": "é", "é́": "E", "　": " ", "\t": " ", "​": "",
         "ab": "ba", "abc": "  x y ", "½": "1/2", "…": ". . ."}


def compiled(rules):
    """A compiled character map of rules: every node has a block of its own in
    the double array."""
    nodes, edges, leaves, texts = {b"": 1}, [], {}, b""
    for key, value in sorted(rules.items()):
        data = key.encode()
        for k in range(1, len(data) + 1):
            if data[:k] not in nodes:
                nodes[data[:k]] = len(nodes) + 1
                edges.append(data[:k])
        leaves[data] = len(texts)
        texts += value.encode() + b"\0"
    # An unused place holds another label than the byte that leads to it.
    units = [(place ^ 1) & 255 for place in range(256 * (len(nodes) + 1))]

    def unit(place, base, label, leaf):
        return ((place ^ base) << 10) | (int(leaf) << 8) | label

    units[0] = unit(0, 256, 0, False)
    for name in edges:
        place, base = 256 * nodes[name[:-1]] ^ name[-1], 256 * nodes[name]
        units[place] = unit(place, base, name[-1], name in leaves)
        if name in leaves:
            units[base] = leaves[name] | 1 << 31
    trie = b"".join(u.to_bytes(4, "little") for u in units)
    return len(trie).to_bytes(4, "little") + trie + texts


def variant(rules=None, joins=False, prefix=True, bytes_too=True, user=(), suffix=False):
    proto = pb.ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    if rules:
        proto.normalizer_spec.name = "own"
        proto.normalizer_spec.precompiled_charsmap = compiled(rules)
    proto.normalizer_spec.remove_extra_whitespaces = joins
    proto.normalizer_spec.add_dummy_prefix = prefix
    proto.trainer_spec.treat_whitespace_as_suffix = suffix
    proto.trainer_spec.byte_fallback = bytes_too
    for piece in proto.pieces:
        if piece.piece in user:
            piece.type = piece_codec.USER_DEFINED
        if piece.type == piece_codec.BYTE and not bytes_too:
            piece.type = piece_codec.NORMAL
    return proto.SerializeToString()


VARIANTS = {
    "given": variant(),
    "rules": variant(RULES),
    "joined spaces": variant(RULES, joins=True),
    "no prefix": variant(RULES, joins=True, prefix=False),
    "no bytes": variant(RULES, bytes_too=False),
    "symbols": variant(RULES, user=("▁the", "th", "ab", "▁▁")),
    "space last": variant(joins=True, suffix=True),
}
PAIRS = {k: (PieceModel(v), sentencepiece.SentencePieceProcessor(model_proto=v)) for k, v in VARIANTS.items()}

texts = st.one_of(
    st.text(alphabet="ab cé éﬁ①AÉ　\t​½…▁日🙂\n", max_size=30),
    st.text(max_size=40),
    st.lists(st.sampled_from(["the", " the", "  ", "\n", "Thtieding.", "abc", "ab", "th", "žluť", "日本語", "\0", "<s>", "<0x41>", "12345", "▁", "▁▁the"]),
             max_size=20).map("".join),
)


def same(name, text):
    own, library = PAIRS[name]
    ids, starts, ends = own.encode(text)
    want = library.encode(text, return_type="proto")
    assert ids.tolist() == [p.id for p in want.pieces]
    assert starts.tolist() == [p.begin for p in want.pieces]
    assert ends.tolist() == [p.end for p in want.pieces]
    assert own.decode(ids.tolist()) == library.decode(ids.tolist())


@pytest.mark.parametrize("name", sorted(VARIANTS))
def test_ids_spans_and_text_as_the_library(name):
    @settings(max_examples=300, deadline=None)
    @given(texts)
    def check(text):
        same(name, text)

    check()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 31999)), max_size=20), st.sampled_from(sorted(VARIANTS)))
def test_decoding_of_any_ids(ids, name):
    own, library = PAIRS[name]
    assert own.decode(ids) == library.decode(ids)


def test_long_parts_without_cuts():
    rng = random.Random(5)
    for _ in range(5):
        same("given", "".join(rng.choice(["日本", "ab", "the", "e", "in", "on", "ä"]) for _ in range(3000)))
    same("given", " " * 777 + "x" * 5000)
    same("joined spaces", " \t " * 50)


@pytest.mark.parametrize("remembered", [100_000, 5])
def test_many_texts_together(monkeypatch, remembered):
    monkeypatch.setattr(piece_codec, "REMEMBERED", remembered)
    rng = random.Random(8)
    words = ["the", "Thtieding.", "žluť", "a\nb", "日本", "", "x" * 70, "▁▁", "the" * 30] + ["".join(rng.choices("abcdeñtin", k=rng.randrange(9))) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(80)]
    for own, library in PAIRS.values():
        for _ in range(2):
            bounds, ids, starts, ends = own.encode_many(texts)
            for text, a, b in zip(texts, bounds, bounds[1:]):
                want = library.encode(text, return_type="proto")
                assert ids[a:b].tolist() == [p.id for p in want.pieces]
                assert ends[a:b].tolist() == [p.end for p in want.pieces] and starts[a:b].tolist() == [p.begin for p in want.pieces]


def test_compiled_rules_are_read_back():
    assert read_rules(compiled(RULES)) == RULES
    assert read_rules(b"") == {}


def test_spans_cover_the_text():
    own, _ = PAIRS["given"]
    text = "The žluťoučký kůň 日本語  and\nso 🙂 on."
    ids, starts, ends = own.encode(text)
    assert starts[0] == 0 and ends[-1] == len(text.encode())
    assert b"".join(text.encode()[a:b] for a, b in zip(starts, ends)).decode() == text


def test_odd_rows(spark):
    rows = odd_rows()
    frame = docs_frame(spark, rows).withColumnRenamed("lang", "ids")
    out = rows_of(piece_codec.decode(piece_codec.encode(frame, MODEL), MODEL))
    library = PAIRS["given"][1]
    want = sorted((str(r[0]), library.encode(r[1] or ""), library.decode(library.encode(r[1] or ""))) for r in rows)
    assert sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in out) == want
    both = rows_of(piece_codec.encode(frame, MODEL, decoded=True))
    assert sorted((str(r["doc_id"]), r["ids"], r["decoded"]) for r in both) == want
    assert all(len(r["ids"]) == len(r["starts"]) == len(r["ends"]) for r in out)
    with pytest.raises(ValueError):
        piece_codec.decode(frame, MODEL, ids_col="ids", out_col="text")


def test_null_lists_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, None, "x"), (2, [], "y")], "k long, ids array<int>, kept string")
    assert [(r["k"], r["kept"], r["decoded"]) for r in rows_of(piece_codec.decode(frame, MODEL))] == [(1, "x", ""), (2, "y", "")]
    assert rows_of(piece_codec.decode(piece_codec.encode(spark.createDataFrame([], DOCS), MODEL), MODEL)) == []


def test_query_on_whole_documents(spark):
    sf_dir = "/root/testdata/sf0.001"
    library = PAIRS["given"][1]
    got = {r["doc_id"]: r for r in registry.op12_sentencepiece(spark, sf_dir).collect()}
    for doc in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids, row = library.encode(doc["text"] or ""), got.pop(doc["doc_id"])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        assert row["n_bytes"] == len((doc["text"] or "").encode())
    assert not got
