"""Toxicity: spellings restored, held-out labels, and planted texts."""

import time
import zlib

import numpy as np
import pytest

from rightsweave.llm import toxicity


@pytest.fixture(scope="module")
def many(spark):
    return spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")


@pytest.fixture(scope="module")
def scorer(many):
    docs, labels = many
    return toxicity.train(docs, labels, toxicity.char_model(docs))


@pytest.mark.parametrize("written,read", [
    ("1d10t", "idiot"), ("i d i o t", "idiot"), ("L o S e R", "loser"), ("lo$er", "loser"), ("p@thetic", "pathetic"),
    ("$cum,", "scum,"), ("the c.l.o.w.n is", "the clown is"), ("looooooser", "loser"), ("m0r0n!", "moron!"), ("s-t-u-p-i-d", "stupid"),
    ("ѕсum", "scum"), ("id\u200biot", "idiot"), ("hello 1234 there", "hello 1234 there"), ("", ""), ("and the on of", "and the on of"),
])
def test_spellings(scorer, written, read):
    assert scorer.model.restore(written) == read


def test_counts_are_those_of_the_texts(spark):
    frame = spark.createDataFrame([("ab",), (None,), ("",), ("AB c",)], "text string")
    model = toxicity.char_model(frame)
    counts = np.zeros(64 ** 3)
    for t in ["ab", "", "ab c"]:
        k = [0, 0] + [toxicity.char_class(c) for c in t] + [0]
        for a, b, c in zip(k, k[1:], k[2:]):
            counts[(a * 64 + b) * 64 + c] += 1
    padded = toxicity.CharModel(counts).log
    assert model.log.shape == padded.shape and np.abs(np.exp(model.log).sum(2) - 1).max() < 1e-4
    assert model.log[0, 1, 2] > model.log[0, 1, 3]


def test_held_out_rows(many, scorer, spark):
    docs, labels = many
    got = {r.doc_id: r for r in toxicity.score_texts(docs, ["doc_id"], scorer).join(
        docs.select("doc_id", toxicity.held_out(docs.doc_id).alias("held")), "doc_id").collect()}
    assert all(r.held == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    pairs = [(got[r.doc_id].score, r.toxic) for r in labels.collect() if got[r.doc_id].held]
    clean = [s for s, y in pairs if y == 0]
    toxic = [s for s, y in pairs if y == 1]
    assert len(clean) > 500 and sum(s >= 0.5 for s in clean) <= 0.01 * len(clean)
    assert len(toxic) > 80 and sum(s >= 0.5 for s in toxic) >= 0.85 * len(toxic)


def test_planted_texts(many, scorer):
    docs, _ = many
    clean = [r.text for r in docs.limit(300).collect()]
    clean = [t for t in clean if scorer.score(t) < 0.1][:40]
    for word in ("1d10t and $tupid", "i d i o t, such a l o s e r", "paaathetic worthleeess"):
        assert all(scorer.score(f"{t}\n{word}") >= 0.5 for t in clean)


def test_edge_rows_and_empty_tables(spark, edge, no_docs):
    labels = spark.createDataFrame([(3, 0, 1), (3, 0, 0), (4, 0, 0), (None, 0, 1), (7, 0, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity(edge, labels).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.toxicity(no_docs, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(edge, labels.limit(0)).collect()} == {0.0}
    kept = toxicity.drop_toxic(edge, labels.limit(0))
    assert kept.columns == edge.columns and kept.count() == edge.count()


@pytest.mark.parametrize("written,read", [
    ("tr-ash", "trash"), ("st.upid", "stupid"), ("lo_ser", "loser"), ("s/c/u/m", "scum"), ("ttrraasshh", "trash"),
    ("mmoron", "moron"), ("sccum", "scum"), ("$ t u p ! d", "stupid"), ("$ c u m", "scum"), ("s\tc\tu\tm", "scum"),
    ("$(#", None), ("i 0 u", None), ("1 2 3", "1 2 3"), ("* * *", "* * *"), ("hello", "hello"),
])
def test_more_spellings(scorer, written, read):
    got = scorer.model.restore(written)
    assert got == read if read else got.isalpha() or got.replace(" ", "").isalpha()


def test_more_planted_texts(many, scorer):
    docs, _ = many
    clean = [r.text for r in docs.limit(300).collect()]
    clean = [t for t in clean if scorer.score(t) < 0.1][:40]
    for word in ("tr-ash, st.upid", "lo_ser s/c/u/m", "mmoron sccum", "ttrraasshh mmoron", "$ t u p ! d $ c u m"):
        assert all(scorer.score(f"{t}\n{word}") >= 0.5 for t in clean), word


@pytest.mark.parametrize("text", ["x" * 200_000, "xx" * 100_000, "a1" * 100_000, "s.t.u." * 33_000, "! ? " * 50_000, "$$##" * 50_000,
                                  "ttrraasshh" * 20_000])
def test_time_is_linear_in_hostile_texts(scorer, text):
    began = time.time()
    scorer.known.clear()
    assert 0 <= scorer.score(text) <= 1
    assert time.time() - began < 10  # 200,000 letters; a quadratic search takes an hour


def test_readings_skipped_have_no_weight(many, scorer):
    """The gate before the lattice loses no weight: every token decoded gives the same."""
    docs, _ = many
    tokens = {t for r in docs.limit(400).collect() for t in toxicity.plain(r.text).split()}
    for token in tokens | {"st..upid", "t-trash", "id-diot", "looo.ser", "m.oron-ic", "scccum.of"}:
        words = toxicity._WORD.findall(token) + toxicity._WORD.findall(scorer.model.restore_token(token))
        assert scorer._weigh(token) == max((scorer.weights.get(f, 0.0) for w in words for f in toxicity.features_of(w)), default=0.0), token


def test_the_sample_holds_both_kinds(many, spark):
    docs, labels = many
    rare = labels.where("toxic = 0 or doc_id % 5 = 0")
    scorer = toxicity.train(docs, rare, toxicity.char_model(docs), sample=400)
    got = toxicity.score_texts(docs, ["doc_id"], scorer).join(labels, "doc_id").where("toxic = 0")
    assert scorer.fit is not None and got.where("score >= 0.5").count() <= 0.02 * got.count()
