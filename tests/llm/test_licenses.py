"""License scans against plain containment over every stretch."""

import re

import numpy as np

from tillwise.llm import licenses
from tillwise.llm.queries import QUERIES


def grams(text):
    words = re.findall(r"\w+", (text or "").lower())
    size = min(5, len(words))
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)] if words else []


def plain_scan(text):
    """Templates of which some stretch, as long as the template and two windows, holds 0.8 of the shingles."""
    found, here = set(), grams(text)
    for name, template in licenses.TEMPLATES.items():
        want = grams(template)
        places = [i for i, g in enumerate(here) if g in set(want)]
        reach = 2 * len(want) + 2 * licenses.BLOCK
        if any(len({here[i] for i in places if p <= i < p + reach}) >= 0.8 * len(set(want)) for p in places):
            found.add(name)
    return found


def test_given_documents(spark, sf_dir_small):
    docs = dict(spark.read.parquet(f"{sf_dir_small}/documents.parquet").select("doc_id", "text").collect())
    got = {}
    for r in QUERIES["op8_licenses"](spark, sf_dir_small).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
        assert r.containment >= 0.8
    want = {i: s for i, t in docs.items() if (s := plain_scan(t))}
    assert len(want) > 20 and got == want


def test_every_template_is_found_where_it_stands():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    filler = " ".join(f"w{i}" for i in range(500))
    for name, template in licenses.TEMPLATES.items():
        text = f"{filler}\n{template.upper()}\n{filler}"
        hit = {n: (share, start) for n, share, start in scanner.scan([text])[0]}[name]
        assert hit == (1.0, len(filler) + 1)
        assert name not in {n for n, _, _ in scanner.scan([" ".join(template.split()[: len(template.split()) // 2])])[0]} or len(grams(template)) < 5


def test_bands_guarantee_a_collision():
    least = 1 / (2 * licenses.BLOCK)
    assert licenses.collision_probability(least) > 0.9999
    pick = np.random.default_rng(3)
    missed = 0
    scanner = licenses.Scanner({"t": "one two three four five"})
    shingle = next(iter(scanner.sets))[0]
    for _ in range(200):
        window = pick.integers(0, 2**63, 2 * licenses.BLOCK, dtype=np.uint64)
        window[pick.integers(len(window))] = shingle
        missed += not scanner.candidates([window])
    assert missed == 0


def test_defined_results(spark, edge_docs, no_docs):
    assert licenses.scan_documents(edge_docs).count() == 0 == licenses.scan_documents(no_docs).count()
    rows = spark.createDataFrame([(1, "Released under the MIT License.")] * 2 + [(None, "released  under the\nmit license")], "doc_id bigint, text string")
    assert sorted(str(r.doc_id) for r in licenses.scan_documents(rows).collect()) == ["1", "1", "None"]
    assert licenses.scan_documents(rows, {}).count() == 0
