"""Fingerprints and components against brute force."""

import random

import xxhash
from pyspark.sql import functions as F

from tillwise.llm import simhash
from tillwise.llm.components import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def plain_roots(items, linked):
    items = list(dict.fromkeys(items))
    root = {x: x for x in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(items):
        for b in items[:i]:
            if linked(a, b):
                root[find(a)] = find(b)
    return {x: find(x) for x in items}


def plain_components(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    roots = plain_roots([p for _, p in prints], lambda a, b: (a ^ b).bit_count() <= 3)
    lowest = {}
    for i, p in prints:
        if i is not None:
            lowest[roots[p]] = min(i, lowest.get(roots[p], i))
    return sorted(((i, p, lowest.get(roots[p])) for i, p in prints), key=repr)


def got(frame):
    return sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in frame.collect()), key=repr)


def test_edge_cases_match_brute_force(edge_docs, edge_rows):
    assert got(simhash.near_duplicate_components(edge_docs)) == plain_components(edge_rows)


def test_given_documents_match_brute_force(documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert got(simhash.near_duplicate_components(documents)) == plain_components(rows)


def test_spark_hash_is_the_hash_of_the_contract(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_masks_cover_the_radius():
    masks = simhash.covering_masks()
    assert len(masks) == 15
    pick = random.Random(5)
    for _ in range(3000):
        flips = sum(1 << b for b in pick.sample(range(64), pick.randint(0, 3)))
        assert any(flips & m % 2**64 == 0 for m in masks)


def test_blocks_do_not_change_the_components(spark):
    pick = random.Random(2)
    seeds = [pick.getrandbits(63) for _ in range(6)]
    values = {s ^ sum(1 << b for b in pick.sample(range(20), pick.randint(0, 4))) for s in seeds for _ in range(60)}
    frame = spark.createDataFrame([(v,) for v in values], "fp bigint")
    want = plain_roots(sorted(values), lambda a, b: (a ^ b).bit_count() <= 3)
    for block in (4, 50, 2048):
        links = [(r.a, r.b) for r in simhash.near_links(frame, block=block).collect()]
        assert all((a ^ b).bit_count() <= 3 for a, b in links)
        roots = plain_roots(sorted(values), lambda a, b, s=set(links): (a, b) in s or (b, a) in s)
        groups = lambda r: sorted(sorted(x for x in r if r[x] == y) for y in set(r.values()))
        assert groups(roots) == groups(want)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (5, 4)]
    rows = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r.node: r.root for r in rows} == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 130)}}


def test_one_row_of_each_component_stays(edge_docs, edge_rows):
    kept = simhash.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    groups = {c for _, _, c in plain_components(edge_rows)}
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {i for i in ids if i is not None} >= {g for g in groups if g is not None}
    assert len(ids) == len({x[2] if x[2] is not None else repr(x) for x in plain_components(edge_rows)})


def test_empty_table(no_docs):
    assert simhash.near_duplicate_components(no_docs).count() == 0
    assert simhash.drop_near_duplicates(no_docs).count() == 0
