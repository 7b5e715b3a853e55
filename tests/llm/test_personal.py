"""Base patterns against their plain regular expressions; what the field adds, on planted texts."""

import hashlib
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tillwise.llm import personal
from tillwise.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        n = int(c) * (2 if i % 2 else 1)
        total += n // 10 + n % 10
    return total % 10 == 0


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and plain_luhn(digits(m))]
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]
    return out


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab@..--%+ 0129()é_\n")), max_size=60))
def test_base_spans_match_the_patterns(text):
    assert personal.base_spans(text) == plain_spans(text)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "4111111111111111", "4111111111111112", "+1 (017) 555-7713", "10.0.0.1", "1.2.3.4.5.6.7.8", "300.1.1.1", "a@b.co", "x@y", "@c.d", " ", ",", "-", "7"]), max_size=9))
def test_base_spans_match_on_dense_texts(parts):
    text = "".join(parts)
    assert personal.base_spans(text) == plain_spans(text)


def test_long_runs_stay_linear():
    for text in ("1" * 200_000, "a" * 200_000, "1.1." * 50_000, "+1(" * 50_000, "a@" * 50_000, "4 " * 100_000):
        personal.all_spans(text, MODEL)


MODEL = personal.model_of(
    [("u", "checked", 3, 0, 200), ("u", "unchecked", 0, 0, 3), ("u", "quad", 2, 0, 300), ("u", "address", 1, 0, 300)]
    + [("u", "plus", 4, 0, 200), ("u", "spaced", 0, 0, 4), ("u", "number", 0, 0, 4), ("u", "handle", 0, 0, 4), ("u", "dotted", 0, 0, 3)]
    + [("c", "", a, b, 20) for a in range(5) for b in range(5)]
    + [("k", "", 0, 0, 240), ("s", "", 0, 0, 320), ("m", "", 0, 0, 1200), ("p", "", 0, 0, 3)]
)


def added(text):
    return [text[s:e] for _, s, e in personal.all_spans(text, MODEL)[1]]


def test_repeated_tokens_take_the_label():
    assert added("call +1 (017) 555-7713 or again 555-7713 after nine, or 0175557713") != []
    assert added("pay 4111111111111111 for it, card 411111111111111 1 and 9111111111111111 too") != []
    assert added("mail jo.doe@example.com today, or jo.doe@example soon") == ["jo.doe@example"]


def test_clean_texts_stay_clean():
    for text in ("in 1999 there were 1234567 people and 7654321 sheep", "order 4111111111111112 of 2024", "a @ b", "", "no number at all"):
        assert added(text) == []


def test_base_spans_stay_and_added_ones_do_not_overlap_them():
    text = "7536784127813050 4845168114407329 and +1 (017) 555-7713 and 555-7713"
    base, more = personal.all_spans(text, MODEL)
    assert base == plain_spans(text)
    assert all(e <= s2 or s >= e2 for _, s, e in more for _, s2, e2 in base)


def test_edges_are_linear():
    text = " ".join(["555-7713-22"] * 3000)
    found = personal.nodes(text, personal.base_spans(text))
    assert len(found) == 3000 and len(personal.edges(found)) <= 3 * len(found)
    assert personal.marginals(found, personal.edges(found), MODEL).shape == (3000, 5)


def test_query_against_the_patterns(spark, sf_dir_small):
    docs = dict(spark.read.parquet(f"{sf_dir_small}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op3_personal"](spark, sf_dir_small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain_spans(docs[r.doc_id] or "")
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base) for x in personal.KINDS]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_defined_results(edge_docs, no_docs):
    model = personal.fit(edge_docs)
    assert personal.find_personal_data(edge_docs, model).count() == edge_docs.count()
    assert personal.find_personal_data(no_docs, personal.fit(no_docs)).count() == 0


def test_factors_are_counted_over_all_documents(spark):
    texts = [f"call +1 (017) 555-77{i % 90 + 10} or a{i}@b.co" if i % 3 else "4111 1111 1111 1111 and 4111111111111112" for i in range(6000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    counts = sum((personal.count_factors(t) for t in texts), Counter())
    want = personal.model_of(personal.summed(counts))
    got = personal.fit(docs)
    assert got.unary.keys() == want.unary.keys() and np.allclose(got.pair, want.pair)
    assert all(np.allclose(got.unary[k], v) for k, v in want.unary.items())


# --- the field ---------------------------------------------------------------------------


def enumerated(found, links, model):
    """Marginals by summing over all labellings."""
    import itertools

    size = len(personal.LABELS)
    total = np.zeros((len(found), size))
    choices = [[n.label] if n.label else range(size) for n in found]
    for labels in itertools.product(*choices):
        score = sum(model.unary.get(n.shape, model.unary[""])[x] for n, x in zip(found, labels, strict=True) if not n.label)
        score += sum(model.pair[kind][labels[i], labels[j]] for i, j, kind in links)
        for at, x in enumerate(labels):
            total[at, x] += np.exp(score)
    return total / total.sum(axis=1, keepdims=True)


def field(seed, n, links):
    pick = np.random.default_rng(seed)
    shapes = [f"s{k}" for k in range(n)]
    unary = {k: np.log(pick.dirichlet(np.ones(5))) for k in shapes} | {"": np.log(np.full(5, 0.2))}
    chain = pick.normal(0, 0.7, (5, 5))
    pair = np.stack([chain + chain.T, np.diag([0, *pick.uniform(0, 3, 4)])])
    found = [personal.Node(k, k + 1, shapes[k], int(pick.integers(1, 5)) if k == 1 else 0, ()) for k in range(n)]
    return found, links, personal.Model(unary, pair)


def test_marginals_are_exact_on_trees():
    for seed, links in enumerate([[], [(0, 1, 0), (1, 2, 0), (2, 3, 1)], [(0, 1, 1), (0, 2, 0), (0, 3, 1), (3, 4, 0)], [(0, 4, 1), (1, 3, 0)]] * 5):
        case = field(seed, 5, links)
        assert np.allclose(personal.marginals(*case), enumerated(*case), atol=2e-3)


def test_marginals_are_near_on_small_loops():
    off = []
    for seed in range(30):
        case = field(seed, 5, [(0, 1, 0), (1, 2, 0), (2, 3, 0), (3, 4, 0), (0, 3, 1), (1, 4, 1)])
        off.append(np.abs(personal.marginals(*case) - enumerated(*case)).max())
    assert np.median(off) < 0.03 and max(off) < 0.25


def variants():
    """Texts with a match and, far from it, the same thing in a form that the patterns reject."""
    import random

    pick = random.Random(12)
    digits = lambda n: "".join(pick.choice("0123456789") for _ in range(n))
    filler = lambda: " ".join(pick.choices("the of stone river cloud window music paper".split(), k=40))
    rows = []
    for i in range(240):
        area, local = str(pick.randrange(200, 999)), f"555-{digits(4)}"
        name = f"{pick.choice('abcdefgh')}{digits(3)}.{pick.choice('xyz')}"
        quad = f"10.{pick.randrange(255)}.{pick.randrange(255)}.{pick.randrange(9)}"
        first, again = [
            (f"+1 {area} {local}", f"({area}) {local}"), (f"+1 ({area}) {local}", f"{area}-{local}"),
            (f"+49 {area} {local.replace('-', '')}", f"0{area} {local.replace('-', '')}"),
            (f"{name}@site.org", f"{name}@site"), (f"{name}@site.example.com", f"{name.upper()}@SITE"),
            (quad, quad),
        ][i % 6]
        rows.append((f"{filler()} {first} {filler()} {again} {filler()}", again, first))
    return rows


def clean():
    import random

    pick = random.Random(13)
    return [
        f"in {pick.randrange(1900, 2025)} the {pick.randrange(10**7, 10**8)} people of {pick.randrange(10**6)} towns "
        f"paid {pick.randrange(10**9)} for {pick.randrange(10**15, 10**16)} pieces, part {pick.randrange(10**6, 10**7)}"
        for _ in range(200)
    ]


def test_the_fitted_field_finds_variants_by_their_repetition_alone():
    rows, others = variants(), clean()
    counts = sum((personal.count_factors(t) for t in [r[0] for r in rows] + others), Counter())
    model = personal.model_of(personal.summed(counts))
    alone = personal.Model(model.unary, np.zeros_like(model.pair))
    changed = caught = planted = 0
    for text, again, first in rows:
        base, more = personal.all_spans(text, model)
        assert base == plain_spans(text)
        if again != first:
            planted += 1
            caught += any(text[s:e] == again for _, s, e in more)
            changed += personal.all_spans(text, alone)[1] != more
    assert planted == 200 and caught >= 0.9 * planted and changed >= 0.9 * planted
    assert not any(personal.all_spans(t, model)[1] for t in others)


def test_numbers_of_several_groups_are_one_candidate():
    found = lambda t: [t[n.start : n.end] for n in personal.nodes(t, personal.base_spans(t)) if not n.label]
    assert found("call (415) 555-0100 now") == ["(415) 555-0100"]
    assert found("call 0170 1234567, or 0170.1234567.") == ["0170 1234567", "0170.1234567"]
    assert found("+1 (826) 555-4081 190.137.223.204 x") == ["+1 (826) 555-4081"]
    assert found("1 2 3 4 5 6 7 8 9 10 11 12") == [] and found("x1234567y 12-34 a") == []
    assert found("1234567 7654321 1234567 7654321") == ["1234567", "7654321", "1234567", "7654321"]
