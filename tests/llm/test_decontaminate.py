"""Edit matching against the plain dynamic program."""

import random

from tillwise.llm import decontaminate as d
from tillwise.llm.queries import QUERIES


def plain_best(item, text):
    """Least edits from ``item`` to any substring of ``text``."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def edited(pick, item, edits):
    chars = list(item)
    for _ in range(edits):
        at = pick.randrange(len(chars))
        chars[at : at + 1] = pick.choice([[], [pick.choice("xyz ")], [chars[at], "q"]])
    return "".join(chars)


def test_myers_is_the_edit_distance():
    pick = random.Random(1)
    for _ in range(400):
        item = "".join(pick.choices("abc ", k=pick.randint(1, 90)))
        text = "".join(pick.choices("abc ", k=pick.randint(0, 120)))
        distance, end = d.Pattern(item).best(text)
        assert distance == plain_best(item, text) == plain_best(item[::-1], text[:end][::-1])
        assert d.Pattern(item).may_hold(text, distance)


def test_matches_are_exactly_those_within_budget():
    pick = random.Random(4)
    words = "the of stone river cloud apple window music paper garden".split()
    items = [(i, " ".join(pick.choices(words, k=18))) for i in range(6)]
    match = d.matcher(items)
    for _ in range(120):
        i, item = pick.choice(items)
        around = [" ".join(pick.choices(words, k=30)) for _ in range(2)]
        text = f"{around[0]} {edited(pick, item, pick.randint(0, 14))} {around[1]}"
        want = {j: n for j, x in items if (n := plain_best(x, d.normalise(text))) <= d.budget(len(x))}
        got = match(text)
        assert {j: n for j, n, _, _ in got} == want
        for j, n, start, end in got:
            assert plain_best(dict(items)[j], d.normalise(text)[start:end]) == n


def test_pieces_cover_the_item():
    for n in range(1, 60):
        item = "".join(chr(97 + i % 26) for i in range(n))
        cut = d.pieces(item, d.budget(n))
        assert "".join(p for _, p in cut) == item and all(item[o : o + len(p)] == p for o, p in cut)


def test_defined_results(spark, edge_docs, edge_rows, no_docs):
    item = edge_rows[14][1][10:160]
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "  "), (4, "nowhere to be found at all")], "item_id bigint, text string")
    found = d.contaminations(edge_docs, items)
    hits = sorted((r.doc_id, r.item_id, r.distance) for r in found.collect())
    assert hits == [(edge_rows[14][0], 1, 0)] * 2
    kept = d.drop_contaminated(edge_docs, items)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count() - 1
    assert d.contaminations(no_docs, items).count() == 0 == d.drop_contaminated(no_docs, items).count()
    none = items.where("false")
    assert d.contaminations(edge_docs, none).count() == 0 and d.drop_contaminated(edge_docs, none).count() == edge_docs.count()


def test_blocks_of_items_do_not_change_the_matches(spark, sf_dir, documents):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    one = sorted(map(tuple, QUERIES["op9_decontaminate"](spark, sf_dir).collect()))
    many = sorted(map(tuple, d.contaminations(documents, items, block_chars=3000).collect()))
    assert one == many and len(one) > 0
    ids = {r[0] for r in one}
    assert {r.doc_id for r in d.drop_contaminated(documents, items, 3000).select("doc_id").collect()} == {
        r.doc_id for r in documents.select("doc_id").collect()
    } - ids


def test_short_items_are_found_as_whole_texts_only():
    match = d.matcher([(1, "a"), (2, "banana"), (3, "eleven char"), (4, "twelve chars"), (2, "banana")])
    assert match("banana") == [(2, 0, 0, 6), (2, 0, 0, 6)] and match(" Banana\n") == match("banana")
    assert match("a banana") == [] and match("a") == [(1, 0, 0, 1)]
    assert match("the eleven char text") == [] and match("Eleven  char") == [(3, 0, 0, 11)]
    assert [h[:2] for h in match("xx twelve charz yy")] == [(4, 1)] and match("") == match(None) == []


def test_pieces_are_found_at_every_place():
    pick = random.Random(7)
    items = ["".join(pick.choices("ab 日", k=pick.randint(12, 60))) for _ in range(40)]
    edits = [d.budget(len(x)) for x in items]
    index = d.PieceIndex(items, edits)
    for stretch in (1 << 20, 16):
        d.STRETCH, before = stretch, d.STRETCH
        try:
            for _ in range(30):
                text = "".join(pick.choices("ab 日", k=pick.randint(0, 200)))
                want = {
                    (at, where - offset)
                    for at, item in enumerate(items)
                    for offset, piece in d.pieces(item, edits[at])
                    for where in range(len(text))
                    if text.startswith(piece, where)
                }
                assert set(index.hits(text)) == want
        finally:
            d.STRETCH = before


def test_a_block_of_items_takes_little_memory():
    """In a process of its own, as a task's worker would hold it."""
    import subprocess
    import sys
    from pathlib import Path

    program = """
import random, resource
from tillwise.llm import decontaminate as d
pick = random.Random(2)
words = ["".join(pick.choices("abcdefghijklmnop", k=pick.randint(2, 9))) for _ in range(20000)]
items = [(i, " ".join(pick.choices(words, k=30))) for i in range(20000)]
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
match = d.matcher(items)
match(" ".join(x for _, x in items[:300]))
print(sum(len(x) for _, x in items), (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    root = Path(d.__file__).resolve().parents[2]
    out = subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, cwd=root, check=True).stdout.split()
    assert int(out[0]) > 3_500_000 and int(out[1]) < 200, out


def test_the_driver_holds_one_block_at_a_time(spark, edge_docs):
    items = spark.createDataFrame([(i, f"item number {i} of a longer list of items") for i in range(60)], "item_id bigint, text string")
    blocks = list(d.item_blocks(items, 500))
    assert len(blocks) > 3 and sorted(i for b in blocks for i, _ in b) == list(range(60))
    one = spark.createDataFrame([(5, "so item number 7 of a longer list of items it is")], "doc_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in d.contaminations(one, items, 500).collect()} >= {(5, 7)}
    assert d.drop_contaminated(one, items, 500).count() == 0
