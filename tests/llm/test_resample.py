"""Importance resampling against a plain count, and the SQL of its query."""

import hashlib
import math
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwise.llm import resample
from tillwise.llm.queries import ORACLE, QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_grams(text, low, high):
    words = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(words[i : i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]
    return len(words), grams


def plain_resample(docs, target, grams, buckets, percent, min_words, seed):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    found = [plain_grams(t, *grams) for _, t in docs]
    s = Counter(bucket(g) for _, own in found for g in own)
    t = Counter(bucket(g) for text in target for g in plain_grams(text, *grams)[1])
    n_s, n_t = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
    rows = []
    for (i, _), (words, own) in zip(docs, found, strict=True):
        weight = sum(gain(bucket(g)) for g in own)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, words, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((-r[4], -1 if r[0] is None else r[0]) for r in rows if r[1] >= min_words)
    return rows, able[: percent * len(able) // 100]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aAzZ09 .,_\n\t\x00\x7féß日😀", max_size=60), st.integers(1, 3), st.integers(0, 2))
def test_overlapped_spans_are_all_runs_of_words(text, low, more):
    words, grams = plain_grams(text, low, low + more)
    counts = Counter(zlib.crc32(g.encode()) % 97 for g in grams)
    n_words, n_features, buckets, n = resample.gram_counter((low, low + more), 97)()(text)
    assert (n_words, n_features) == (words, len(grams))
    assert dict(zip(buckets, n, strict=True)) == counts


@pytest.mark.parametrize(("grams", "percent"), [((1, 1), 10), ((1, 3), 50), ((2, 2), 100), ((1, 1), 0)])
def test_equals_a_plain_draw(spark, edge_docs, edge_rows, grams, percent):
    target = ["the river and the cloud", None, "window window, Music?"]
    got = resample.resample(
        edge_docs, spark.createDataFrame([(t, 1) for t in target], "text string, rank int"), grams, 500, percent, 3, "x"
    ).collect()
    rows, drawn = plain_resample(edge_rows, target, grams, 500, percent, 3, "x")
    key = lambda r: tuple(repr(c) for c in r)
    assert sorted(((r[0], r[1], r[2], r[3]) for r in got), key=key) == sorted(((r[0], *r[2:]) for r in rows), key=key)
    ranked = sorted((r["rank"], -r["score"], -1 if r["doc_id"] is None else r["doc_id"]) for r in got if r["rank"])
    assert [r[0] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [r[1:] for r in ranked] == drawn


def test_one_score_for_a_third_of_all_rows(spark):
    rows = [(i, "many words that are all the same in each of these texts") for i in range(300)] + [(7, "x y z a b")] * 600
    got = resample.resample(
        spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5),
        spark.createDataFrame([("words",)], "text string"), percent=100, min_words=1,
    ).collect()
    ranked = sorted(got, key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, 901))
    assert [(r["score"], -r["doc_id"]) for r in ranked] == sorted(((r["score"], -r["doc_id"]) for r in got), reverse=True)


def test_empty_tables(spark, no_docs):
    assert resample.resample(no_docs, no_docs).collect() == []
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in resample.resample(docs, no_docs, percent=50, min_words=0).collect()}
    assert got[2]["weight"] == 0 and got[2]["n_features"] == 0
    assert sum(r["rank"] is not None for r in got.values()) == 1


@pytest.mark.parametrize("name", ["op11_resample", "op12_centroids"])
def test_query_equals_its_sql(spark, sf_dir_small, name):
    duck = duckdb.connect()
    for file in Path(sf_dir_small).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    expected = duck.execute(ORACLE[name])
    names = sorted(c[0] for c in expected.description)
    frame = QUERIES[name](spark, sf_dir_small)
    assert sorted(frame.columns) == names
    order = [frame.columns.index(c) for c in names]
    theirs = [[c[0] for c in expected.description].index(c) for c in names]
    key = lambda r: tuple(map(repr, r))
    assert sorted((tuple(r[i] for i in order) for r in frame.collect()), key=key) == sorted(
        (tuple(r[i] for i in theirs) for r in expected.fetchall()), key=key
    )
