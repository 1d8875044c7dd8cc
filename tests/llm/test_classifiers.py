import math

import numpy as np

from folio.llm import language, toxicity
from folio.llm.common import crc_mod as spark_crc_mod
from folio.llm.registry import QUERIES
from tests.llm.helpers import crc_mod, docs_frame, odd_rows, rows_of

SF = "/root/testdata/sf0.01"


def test_language_on_held_out_documents(spark):
    got = rows_of(QUERIES["op4_language_id"](spark, SF))
    truth = {r["doc_id"]: r["lang"] for r in rows_of(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"))}
    assert {r["doc_id"] for r in got} == set(truth)
    assert all(r["held_out"] == (crc_mod(r["doc_id"], 3) == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    right = [truth[r["doc_id"]] == r["lang_pred"] for r in held]
    assert np.mean(right) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)
    assert abs(np.mean([r["score"] for r in held]) - np.mean(right)) < 0.05


def test_language_odd_rows(spark):
    docs = docs_frame(spark, odd_rows() + [(k, "der und die das ist nicht", "de") for k in range(30, 50)]
                      + [(k, "the and of this is not", "en") for k in range(50, 70)]).selectExpr("*", "'x' as score")
    model = language.train(docs, learn=spark_crc_mod("doc_id", 3) != 1)
    out = rows_of(language.predict(docs, model))
    assert len(out) == docs.count()
    got = {r["doc_id"]: r for r in out}
    assert [got[k]["lang_pred"] for k in (1, 2, 3, 8)] == ["und"] * 4 and got[1]["score"] == 0
    assert got[30]["lang_pred"] == "de" and got[50]["lang_pred"] == "en"
    assert language.predict(docs.limit(0), model).count() == 0
    empty = language.train(docs.limit(0))
    assert {r["lang_pred"] for r in rows_of(language.predict(docs, empty))} == {"und"}


def test_language_is_predicted_once_below_a_filter(spark):
    docs = docs_frame(spark, [(k, "der und die das ist nicht", "de") for k in range(20)]
                      + [(k, "the and of this is not", "en") for k in range(20, 40)] + [(40, "123", "en"), (41, None, None)])
    model = language.train(docs)
    kept = language.predict(docs, model).filter("lang_pred <> 'und'")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert sorted(r["doc_id"] for r in rows_of(kept)) == list(range(40))


def test_language_weights_are_sparse():
    model = language.fit(["der und die das"] * 40 + ["the and of this"] * 40, ["de"] * 40 + ["en"] * 40)
    assert (model.weights == 0).mean() > 0.99


def kernel(x, y):
    """Gapped triples of two words, by definition."""
    def parts(w):
        out = {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + toxicity.SPAN)):
                    out.setdefault((w[i], w[j], w[k]), []).append(toxicity.DECAY ** (k - i - 2))
        return out
    a, b = parts(x), parts(y)
    norm = lambda p: math.sqrt(sum(v * v for vs in p.values() for v in vs))
    return sum(sum(a[t]) * sum(b[t]) for t in a if t in b) / (norm(a) * norm(b))


def test_kernel_and_folding_match_the_definition():
    words = [np.frombuffer(w, np.uint8) % 64 for w in (b"idiot", b"idixot", b"moron", b"ororooro")]
    landmarks = np.zeros((toxicity.CLASSES ** 3, len(words)), np.float32)
    unit, triple, value = toxicity.features(words)
    np.add.at(landmarks, (triple, unit), value)
    got = toxicity._against(words, landmarks)
    assert np.allclose(got, [[kernel(x, y) for y in words] for x in words], atol=1e-5)
    w = np.array([0.5, -1, 2, 0.25])
    codes = np.concatenate([np.append(x, 0) for x in words]).astype(np.uint8)
    assert np.allclose(toxicity.unit_margins(codes, landmarks @ w, 0.1), got @ w + 0.1, atol=1e-4)


def labelled_texts():
    rng = np.random.default_rng(3)
    parts = ["the", "and", "ing", "er", "on", "tion", "re", "en", "at"]
    texts, labels = [], []
    for k in range(600):
        words = ["".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(rng.integers(5, 60))]
        labels.append(int(k % 6 == 0))
        if labels[-1]:
            for _ in range(2):
                words.insert(int(rng.integers(len(words))), str(rng.choice(["idiot", "moron", "scumbag", "clown"])))
        texts.append(" ".join(words) + ".")
    return texts, labels


def test_toxicity_tolerates_gaps_and_inserted_characters():
    texts, labels = labelled_texts()
    model, table = toxicity.fit(texts, labels), toxicity.letter_classes()
    bad = model.score(["the idiot and re", "the i d i o t and re", "the id.i.ot re", "an idiiot there", "the m*or*on"], table)
    good = model.score(["the and other thing", "", "ontion reer on at the", "a b c d e f"], table)
    assert min(bad) >= 0.5 > max(good)


def test_toxicity_query_on_held_out_documents(spark):
    got = rows_of(QUERIES["op3_toxicity"](spark, SF))
    assert len(got) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (crc_mod(r["doc_id"], 5) == 0) for r in got)
    truth = {r["doc_id"]: r["toxic"] for r in rows_of(spark.read.parquet(f"{SF}/labels.parquet"))}
    clean = [r["predicted"] for r in got if r["held_out"] and truth.get(r["doc_id"]) == 0]
    assert np.mean(clean) < 0.05


def test_toxicity_odd_rows(spark):
    docs = docs_frame(spark, odd_rows()).selectExpr("*", "'x' as predicted")
    labels = spark.createDataFrame([(4, 1), (5, 0), (4, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert len(rows_of(toxicity.predict(docs, model))) == len(odd_rows())
    none = toxicity.train(docs, labels.limit(0))
    assert {r["score"] for r in rows_of(toxicity.predict(docs, none))} == {0.5}
    assert toxicity.predict(docs.limit(0), model).count() == 0
