"""Codes, held-out accuracy and defined results of language identification."""

import numpy as np

from tillwise.llm import langid
from tillwise.llm.queries import QUERIES


def test_codewords_are_apart():
    for n in range(2, 13):
        code = langid.codewords(n).astype(int)
        gaps = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(gaps) >= (max(1, 2 ** (n - 2)) if n <= 7 else 6)


def test_held_out_accuracy(spark, sf_dir_small):
    rows = QUERIES["op5_language"](spark, sf_dir_small).collect()
    truth = dict(spark.read.parquet(f"{sf_dir_small}/documents.parquet").select("doc_id", "lang").collect())
    test = [r for r in rows if r.held_out and truth[r.doc_id] is not None]
    assert len(rows) == len(truth) and len(test) > 100
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in test]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_defined_results(spark, edge_docs, no_docs):
    labelled = spark.createDataFrame(
        [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de"), (None, "en"), ("x", None)] * 3)],
        "doc_id bigint, text string, lang string",
    )
    model = langid.fit(labelled)
    assert model.languages == ("de", "en")
    found = langid.identify(edge_docs, model)
    rows = {(r.doc_id, r.text): r for r in found.collect()}
    assert found.count() == edge_docs.count() and "lang" in found.columns
    for text in (None, "", "!!! ???"):
        row = next(r for (_, t), r in rows.items() if t == text)
        assert (row.lang_pred, row.score, row.ambiguous) == (langid.UNKNOWN, 0.0, True)
    assert langid.identify(no_docs, model).count() == 0
    kept = langid.keep_identified(edge_docs, model)
    assert kept.columns == edge_docs.columns and kept.where("text is null or text = '!!! ???'").count() == 0
    assert kept.where("text = 'the'").count() == 1


def test_nothing_learned(edge_docs, no_docs):
    model = langid.fit(no_docs)
    assert {r.lang_pred for r in langid.identify(edge_docs, model).collect()} == {langid.UNKNOWN}


def test_one_language(spark, edge_docs):
    model = langid.fit(spark.createDataFrame([(1, "abc", "xx")], "doc_id bigint, text string, lang string"))
    assert {r.lang_pred for r in langid.identify(edge_docs, model).collect()} == {"xx", langid.UNKNOWN}


def test_distant_codewords_make_ambiguity():
    model = langid.Model(("a", "b", "c"), langid.codewords(3), np.zeros((2 * langid.BUCKETS, 3), dtype=np.float32))
    language, score, ambiguous = langid.predictor(model)()("no weights, no lead")
    assert language == "a" and abs(score - 1 / 3) < 1e-9 and ambiguous


def test_sample_is_the_smallest_hashes(spark):
    from pyspark.sql import functions as F

    from tillwise.llm.common import hashed_sample

    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 50 == 0, "rare").otherwise("common").alias("lang"))
    got = {(r.doc_id, r.lang) for r in hashed_sample(rows.unionByName(rows), "lang", 100).collect()}
    hashed = rows.withColumn("h", F.xxhash64("doc_id")).orderBy("h").collect()
    want = {(r.doc_id, r.lang) for lang in ("rare", "common") for r in [x for x in hashed if x.lang == lang][:100]}
    assert got == want


def test_no_column_asks_the_same_question_twice():
    for n in range(2, 30):
        code = langid.codewords(n).astype(int)
        asked = {tuple(column * column[0]) for column in code.T}
        assert len(asked) == code.shape[1] and (np.abs(code.sum(axis=0)) < n).all()


def test_und_is_a_text_without_a_letter_of_any_category(spark):
    import sys
    import unicodedata

    rows = [(i, f"{x} {x} text {x}", x) for i, x in enumerate(["aaa bbb", "ccc ddd"] * 4)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    predict = langid.predictor(model)()
    kinds = {}
    for point in range(sys.maxunicode + 1):
        kinds.setdefault(unicodedata.category(chr(point)), []).append(chr(point))
    for kind, chars in kinds.items():
        if kind == "Cs":
            continue
        for char in chars[:: max(1, len(chars) // 50)]:
            assert (predict(f"1 {char}2")[0] == "und") == (not kind.startswith("L")), (kind, char)
    assert predict("½²①Ⅷ") == ("und", 0.0, True)


def plain_prediction(model, text):
    """Loss of every codeword, gram by gram."""
    data = f" {text.lower()} ".encode()
    grams = [data[i] | data[i + 1] << 8 for i in range(len(data) - 1)]
    for i in range(len(data) - 3):
        four = int.from_bytes(data[i : i + 4], "little")
        grams.append(langid.BUCKETS + (four * 2654435761 % 2**32 >> 16))
    margins = [sum(float(model.weights[g, b]) for g in grams) / len(grams) for b in range(model.code.shape[1])]
    losses = [
        sum(np.log1p(np.exp(-int(row[b]) * m * langid.SHARPNESS)) for b, m in enumerate(margins)) for row in model.code
    ]
    at = min(range(len(losses)), key=lambda k: (losses[k], k))
    return model.languages[at], 1 / sum(np.exp(losses[at] - x) for x in losses)


def test_fit_and_decoding_equal_a_plain_count(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang is not null and text is not null")
    model = langid.fit(docs)
    rows = docs.select("lang", "text").collect()
    totals = {}
    for lang, text in rows:
        total = totals.setdefault(lang, np.zeros(2 * langid.BUCKETS))
        for gram in langid.ngrams(text):
            total[gram] += 1
    assert model.languages == tuple(sorted(totals))
    rates = np.array([totals[x] / totals[x].sum() for x in model.languages])
    for bit in range(model.code.shape[1]):
        up, down = (rates[model.code[:, bit] == s].mean(axis=0) + langid.SMOOTHING / (2 * langid.BUCKETS) for s in (1, -1))
        assert np.allclose(model.weights[:, bit], np.log(up / up.sum()) - np.log(down / down.sum()), atol=1e-4)
    predict = langid.predictor(model)()
    for _, text in rows[:40]:
        lang, score, _ = predict(text[:3000])
        expected = plain_prediction(model, text[:3000])
        assert lang == expected[0] and abs(score - expected[1]) < 1e-6
