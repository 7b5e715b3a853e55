"""SpotSigs against a plain version that keeps signatures as tuples."""

import hashlib
import re

from pyspark.sql import functions as F

from tillwise.llm import spotsigs
from tillwise.llm.order import next_key
from tillwise.llm.queries import QUERIES

ANCHORS = set(spotsigs.ANCHORS)


def plain_signatures(text):
    words = [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]
    content = [w for w in words if w not in ANCHORS]
    found, before = set(), 0
    for w in words:
        if w not in ANCHORS:
            before += 1
        elif before + 2 <= len(content):
            found.add((w, content[before], content[before + 1]))
    if not found and words:
        found = {tuple((words[i : i + 2] + [None])[:2]) for i in range(max(len(words) - 1, 1))}
    return found


def plain_likeness(a, b):
    if not a and not b:
        return 1.0
    return len(a & b) / len(a | b)


def check(rows, got):
    """``rows`` have distinct ids."""
    order = sorted(rows, key=lambda r: -r[0])
    for at, (i, text) in enumerate(order):
        text, after = text or "", order[(at + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = got[i]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        sets = [plain_signatures(x) for x in (text, edited, after)]
        assert len(row.fingerprint.split()) == len(sets[0]) and len(row.edited_fingerprint.split()) == len(sets[1])
        assert abs(row.near_edited - plain_likeness(sets[0], sets[1])) < 1e-9, (i, text[:80])
        assert abs(row.near_next - plain_likeness(sets[0], sets[2])) < 1e-9


def test_given_documents(spark, sf_dir, documents):
    got = {r.doc_id: r for r in QUERIES["op1_spotsigs"](spark, sf_dir).collect()}
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert len(got) == len(rows)
    check(rows, got)


def test_edge_cases(spark, edge_rows, tmp_path):
    rows = [(i, t) for i, t in edge_rows if i is not None and i != 200]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    frame = QUERIES["op1_spotsigs"](spark, str(tmp_path))
    check(rows, {r.doc_id: r for r in frame.collect()})


def test_repeated_and_null_ids(edge_docs, no_docs):
    pairs = spotsigs.edited_pairs(edge_docs)
    rows = pairs.select("doc_id", "next_doc_id", "n_chars").collect()
    assert len(rows) == edge_docs.count()
    assert {r.next_doc_id for r in rows if r.doc_id == 300} == {200}
    assert {r.next_doc_id for r in rows if r.doc_id == 0} == {None} and {r.next_doc_id for r in rows if r.doc_id is None} == {302}
    assert spotsigs.edited_pairs(no_docs).count() == 0


def test_single_document_is_its_own_next(spark):
    row = spotsigs.edited_pairs(spark.createDataFrame([(5, "abcd")], "doc_id bigint, text string")).first()
    assert (row.edited, row.next_doc_id) == ("abab", 5)


def test_order_over_many_ranges(spark):
    keys = [x * 7 for x in range(500)]
    got = dict(next_key(spark.createDataFrame([(k,) for k in keys], "key bigint").repartition(5)).collect())
    assert got == {k: (keys[i - 1] if i else keys[-1]) for i, k in enumerate(keys)}


def test_length_partitions(spark):
    sizes = spark.range(1, 400).select(F.col("id"), spotsigs.length_partition(F.sequence(F.lit(1), F.col("id").cast("int"))).alias("p"))
    part = {r.id: r.p for r in sizes.collect()}
    assert all(abs(part[a] - part[b]) <= 1 for a in part for b in range(a, min(int(a / 0.8), 399) + 1))


def test_main_path_is_native(spark, sf_dir):
    plan = QUERIES["op1_spotsigs"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def plain_pairs(rows, threshold):
    """Classes by set and all pairs of classes that are alike, by comparing everything."""
    ids = {}
    for i, s in rows:
        ids.setdefault(frozenset(s), []).append(i)
    names = {s: min((i for i in own if i is not None), default=None) for s, own in ids.items()}
    sets = [s for s in ids if s]
    pairs = set()
    for at, a in enumerate(sets):
        for b in sets[:at]:
            near = len(a & b) / len(a | b)
            if near >= threshold - 1e-12:
                pairs.add((*sorted((repr(names[a]), repr(names[b]))), round(near, 9)))
    return names, pairs


def compare_pairs(spark, rows, threshold):
    sets = spark.createDataFrame(rows, "doc_id bigint, signatures array<int>").repartition(4)
    members, pairs = spotsigs.near_pairs(sets, threshold)
    names, expected = plain_pairs(rows, threshold)
    got = [(*sorted((repr(r.class_a), repr(r.class_b))), round(r.near, 9)) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    assert sorted((repr(r.doc_id), repr(r.class_id)) for r in members.collect()) == sorted(
        (repr(i), repr(names[frozenset(s)])) for i, s in rows
    )
    return got


def test_near_pairs_of_given_documents(spark, sf_dir_small):
    docs = spark.read.parquet(f"{sf_dir_small}/documents.parquet")
    rows = [(r.doc_id, r.s) for r in docs.select("doc_id", spotsigs.signatures(F.col("text")).alias("s")).collect()]
    assert len(compare_pairs(spark, rows, 0.8)) > 10


def varied_sets(seed=6):
    import random

    pick = random.Random(seed)
    rows = []
    for family in range(40):
        base = sorted(pick.sample(range(-5000, 5000), pick.choice([1, 2, 5, 9, 10, 11, 40, 90])))
        for _ in range(pick.choice([1, 3, 6])):
            own = set(base)
            for _ in range(pick.choice([0, 0, 1, 2, 4, 8])):
                if own and pick.random() < 0.5:
                    own.discard(pick.choice(sorted(own)))
                else:
                    own.add(pick.randrange(-5000, 5000))
            rows.append((len(rows), sorted(own)))
    rows += [(1000, []), (1001, []), (None, [3]), (None, [3]), (1002, rows[0][1]), (1002, rows[0][1])]
    return rows


def test_near_pairs_at_any_threshold(spark):
    for threshold in (0.3, 0.5, 0.8, 0.95, 1.0):
        compare_pairs(spark, varied_sets(), threshold)


def test_near_pairs_with_signatures_that_a_third_of_all_share(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "LIST_PART", 8)
    shared = list(range(100, 130))
    rows = [(i, sorted({*shared, *range(1000 + 7 * i, 1000 + 7 * i + (i % 4) * 3)})) for i in range(90)]
    rows += [(500 + i, [5000 + 10 * i + k for k in range(9)]) for i in range(180)]
    assert len(compare_pairs(spark, rows, 0.8)) > 200


def test_planted_near_copies_are_found(spark):
    import random

    from tests.llm.conftest import prose

    pick = random.Random(9)
    rows = []
    for i in range(60):
        text = " ".join(f"{w} {chr(97 + pick.randrange(26))}{pick.randrange(9999)}" for w in prose(i, 400).split())
        words = text.split()
        for _ in range(8):
            words[pick.randrange(len(words))] = "changed"
        rows += [(2 * i, text), (2 * i + 1, " ".join(words))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = docs.select("doc_id", spotsigs.signatures(F.col("text")).alias("signatures"))
    found = {(min(a, b), max(a, b)) for a, b, _ in spotsigs.near_pairs(sets)[1].collect()}
    planted = {(2 * i, 2 * i + 1) for i in range(60)}
    assert len(found & planted) >= 0.9 * len(planted) and found <= planted


def test_near_pairs_of_nothing_and_without_python(spark, no_docs):
    sets = no_docs.select("doc_id", spotsigs.signatures(F.col("text")).alias("signatures"))
    members, pairs = spotsigs.near_pairs(sets)
    assert members.count() == 0 and pairs.count() == 0
    for frame in (members, pairs):
        assert not re.search("Python|Pandas|Arrow", frame._jdf.queryExecution().executedPlan().toString())


def test_comparisons_stay_in_neighbouring_partitions(spark):
    rows = [(i, list(range(i))) for i in range(1, 120)]
    sets = spark.createDataFrame(rows, "doc_id bigint, signatures array<int>")
    pairs = spotsigs.near_pairs(sets, 0.8)[1].collect()
    plan = spotsigs.near_pairs(sets, 0.8)[1]._jdf.queryExecution().executedPlan().toString()
    assert "partition_b" in plan and {(r.class_a, r.class_b) for r in pairs} | {(r.class_b, r.class_a) for r in pairs} == {
        (a, b) for a in range(1, 120) for b in range(1, 120) if a != b and min(a, b) >= 0.8 * max(a, b)
    }
