"""Quality trees and language models: held-out accuracy, probabilities, odd input."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlake.llm import lang_kn as kn
from ledgerlake.llm import quality_gbt as gbt
from ledgerlake.llm import vectext as vt

SF = "/root/testdata/sf0.01"
ODD = [(9001, None, "xx"), (9002, "", "xx"), (9003, "12 34 ...", "xx"), (9004, "\n\n", None), (None, "the of and", None),
       (9005, "word " * 20000, None), (9006, "a" * 100000, None)]


def docs_with_odd(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    return docs.union(spark.createDataFrame(ODD, docs.schema)).withColumn("score", F.lit("clash"))


def test_quality_held_out_accuracy(spark):
    docs, labels = docs_with_odd(spark), spark.read.parquet(f"{SF}/labels.parquet")
    learn = "pmod(crc32(cast(doc_id as string)), 3) <> 1"
    got = gbt.score_quality(docs, labels, learn)
    rows = {r.doc_id: r for r in got.collect()}
    assert got.count() == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(rows[i].predicted, y) for i, y in truth.items() if rows[i].held_out]
    assert len(held) > 80 and np.mean([p == y for p, y in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())
    kept = gbt.keep_good(docs, labels, learn)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.score >= 0.5 for r in got.collect())


def test_quality_without_labels_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert {r.score for r in gbt.score_quality(docs, labels, "true").collect()} == {0.5}
    assert gbt.score_quality(docs.limit(0), labels, "true").count() == 0
    assert gbt.keep_good(docs, labels).count() == 2


def test_statistics_do_not_depend_on_neighbours():
    texts = ["", "One two two.\nOne two two.\n### x", "é" * 50, "A", "the the the the"]
    data, off = vt.text_buffer(pa.array(texts))
    together = gbt.statistics(data, off)
    for i, t in enumerate(texts):
        d, o = vt.text_buffer(pa.array([t]))
        assert np.allclose(gbt.statistics(d, o)[0], together[i])
    names = dict(zip(gbt.FEATURES, together[4]))
    assert np.isclose(names["distinct_words"], 0.25) and np.isclose(names["word_repeats"], 0.75)


def test_flat_trees_equal_a_walk_node_by_node():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3)).astype(np.float32)
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > 0)).astype(float)
    trees = gbt.grow(x, y, [np.unique(np.quantile(x[:, j], np.arange(1, 64) / 64).astype(np.float32)) for j in range(3)], trees=20)
    score = trees.score(x)
    assert ((score > 0.5) == y).mean() > 0.95
    for i in range(0, 400, 37):
        total = trees.base
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if x[i, f[node]] > t[node] else 1)
            total += leaf[node - len(f)]
        assert np.isclose(score[i], 1 / (1 + np.exp(-total)))


def test_language_held_out_accuracy(spark):
    docs = docs_with_odd(spark)
    learn = "pmod(crc32(cast(doc_id as string)), 4) <> 2"
    got = {r.doc_id: r for r in kn.identify(docs, learn).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [(got[i].lang_pred, y) for i, y in truth.items() if got[i].held_out]
    assert len(held) > 150 and np.mean([p == y for p, y in held]) > 0.96
    assert [got[i].lang_pred for i in (9001, 9002, 9003, 9004)] == ["und"] * 4
    assert not got[9001].accepted and got[9001].score == 0
    assert np.mean([got[i].accepted for i in truth]) > 0.995
    assert not got[9006].accepted
    assert kn.keep_identified(docs, learn).columns == docs.columns


def test_language_without_teaching_rows(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert kn.identify(docs, "true").first().lang_pred == "und"
    assert kn.identify(docs.limit(0), "true").count() == 0


def test_probabilities_of_the_next_symbol_add_up_to_one():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))) for _ in range(200)]
    codes, _, n = kn._codes(words, 4)
    assert len(codes) == sum(len(w) + 1 for w in words) == n.sum()
    grams, count = np.unique(codes, axis=0, return_counts=True)
    lang = np.arange(len(grams)) % 2
    model = kn.fit_models(["x", "y"], lang, grams, count)
    alphabet = np.unique(codes[:, -1])
    unseen = np.array([[ord("z")]], dtype=np.uint32)
    for row in grams[::17]:
        all_next = np.tile(row, (len(alphabet), 1))
        all_next[:, -1] = alphabet
        rest = row.copy()
        rest[-1] = unseen[0, 0]  # the one symbol kept for what was never seen
        total = np.exp(model.score(np.vstack([all_next, rest]))).sum(axis=0)
        assert np.allclose(total, 1, atol=1e-4)


def test_a_model_in_blocks_keeps_every_n_gram(spark, monkeypatch):
    """Every text is scored alike, whether the model is held at once or in blocks."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rare = [(8000 + i, "zyxq wvut zyxq", "rr") for i in range(3)]  # all its n-grams are rare
    docs = docs.union(spark.createDataFrame(rare + ODD, docs.schema))
    whole = kn.train(docs)
    blocks = kn.train(docs, cells=20_000)
    assert blocks.langs == whole.langs and "rr" in blocks.langs and len(blocks.blocks) > 3
    keys = [b.value[0] for b in blocks.blocks]
    assert max(len(k) for k in keys) * len(blocks.langs) < 1.2 * 20_000
    assert sum(map(len, keys)) == sum(len(whole.keys[k]) + len(whole.ctx[k]) for k in whole.keys)
    codes, _, _ = kn._codes(["zyxq", "the", "und", "qqqq", "日本", "niño", "x"], kn.ORDER)
    assert np.allclose(blocks.score(codes), whole.score(codes), atol=1e-4)
    monkeypatch.setattr(kn, "_CACHE", 500)
    texts = pa.array([r.text for r in docs.collect()])
    assert np.allclose(*(np.concatenate([s.sums(texts.slice(i, 64).to_pylist()) for i in range(0, len(texts), 64) if s.prepare(texts, i)])
                         for s in (kn.Scorer(blocks), kn.Scorer(whole))), rtol=1e-4)
    learn = "pmod(crc32(cast(doc_id as string)), 4) <> 2"
    one, many = ({(r.doc_id, r.lang_pred, round(r.score, 3), r.symbols, r.accepted) for r in kn.identify(docs, learn, cells=c).collect()}
                 for c in (kn.MODEL_CELLS, 20_000))
    assert one == many
    assert kn.keep_identified(docs, learn, cells=20_000).count() == kn.keep_identified(docs, learn).count()


def test_language_limits_come_from_all_teaching_rows(spark):
    """One row in 25,000 teaches a language; most of them are one text."""
    real = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'es'").select("doc_id", "text", "lang")
    many = spark.range(100_000, 125_000).selectExpr("id as doc_id", "'the of and to in is that it was for' as text", "'en' as lang")
    docs = real.limit(12).union(many)
    scores = [r for r in kn.identify(docs, "true").where("doc_id < 100000").collect() if r.lang_pred == "es"]
    assert len(scores) > 8
    mean = np.mean([r.cross_entropy for r in scores])
    far = 2 * max(1, max((r.cross_entropy - mean) * min(r.symbols, 400) ** 0.5 for r in scores))
    table = spark.createDataFrame([("es", "es", r.cross_entropy, r.symbols) for r in scores] + [("en", "es", 99.0, 400), ("es", "und", None, 0)],
                                  "lang string, lang_pred string, cross_entropy double, symbols long")
    got = kn.limits_of(table).collect()
    assert [r.lang for r in got] == ["es"] and np.allclose((got[0].mean, got[0].far), (mean, far))
    assert all(r.accepted for r in scores)  # every teaching row lies within its own limit
    ids = {r.doc_id for r in scores}
    kept = {r.doc_id for r in kn.keep_identified(docs, "true").where("doc_id < 100000").collect()}
    assert ids <= kept
