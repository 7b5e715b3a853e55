"""The automaton against edit distances, context windows, and held-out separation."""

import random

import numpy as np

from tillwise.llm import toxicity
from tillwise.llm.queries import QUERIES


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_finds_what_distances_find():
    pick = random.Random(3)
    word = lambda low, high: "".join(pick.choices("abc", k=pick.randint(low, high)))
    terms = {word(2, 9): float(i) for i in range(1, 40)} | {word(4, 4) + toxicity.STEM: 20.0 + i for i in range(4)}
    automaton = toxicity.TermAutomaton(terms)
    for _ in range(10_000):
        w, best = word(1, 11), 0.0
        for term, weight in terms.items():
            if term.endswith(toxicity.STEM):
                best = max(best, weight if w.startswith(term[:-1]) else 0.0)
            elif (d := distance(w, term)) <= toxicity.edits_for(term):
                best = max(best, weight * toxicity.EDIT_PENALTY**d)
        match = automaton.find(w)
        assert (match[1] * toxicity.EDIT_PENALTY ** match[2] if match else 0.0) == best


def test_quotation_is_told_from_abuse():
    features = toxicity.featurer({"worthless": 4.0})
    plain = features("you are a worthless man")[0]
    assert plain[0] > 0 and plain[2] == 0
    assert features("you are a wortless man")[0][0] > 0
    for text in ('he was "a worthless man" to them', "the word worthless is written here", "“worthless”"):
        quoted = features(text)[0]
        assert quoted[0] == 0 and quoted[2] > 0
    assert features("nothing")[1] == 0 and features(None)[0][0] == 0


def labelled(spark, n=1200):
    pick = random.Random(1)
    rows = []
    for i in range(n):
        words = pick.choices("the of stone river cloud apple window music paper garden".split(), k=30)
        toxic = i % 8 == 0
        if toxic:
            words[pick.randrange(30)] = pick.choice(["dreadful", "abominable", "grimstuck", "grimstall", "grimsted"])
        rows.append((i, " ".join(words), int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")


def fit(rows):
    return toxicity.fit(rows.drop("toxic"), rows.drop("text"))


def test_planted_terms_are_learned(spark):
    model = fit(labelled(spark))
    assert {"dreadful", "abominable"} <= set(model.lexicon) and any(t.startswith("grim") and t.endswith("*") for t in model.lexicon)
    texts = ["stone river dreadful cloud apple", "stone river dreadfull cloud apple", "a grimstock in the cloud", "stone river cloud apple", None]
    rows = toxicity.score_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), model).collect()
    assert [r.score >= 0.5 for r in sorted(rows)] == [True, True, True, False, False]


def test_defined_results(spark, edge_docs, no_docs):
    model = fit(labelled(spark, 100))
    rows = toxicity.score_documents(edge_docs, model, keep=["doc_id", "text"]).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.text in (None, "", "!!! ???")}) == 1
    assert toxicity.score_documents(no_docs, model).count() == 0
    for labels in (labelled(spark).where("false"), labelled(spark).where("toxic = 0")):
        bare = fit(labels)
        assert bare.lexicon == {} and all(0 <= r.score <= 1 for r in toxicity.score_documents(edge_docs, bare).collect())


def test_held_out_separation(spark, sf_dir_small):
    rows = {r.doc_id: r for r in QUERIES["op2_toxicity"](spark, sf_dir_small).collect()}
    labels = [(rows[r.doc_id], r.toxic) for r in spark.read.parquet(f"{sf_dir_small}/labels.parquet").collect() if r.doc_id in rows]
    test = [(r.score, y) for r, y in labels if r.held_out]
    toxic, clean = ([s for s, y in test if y == v] for v in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean])
    assert auc > 0.75
    assert all(r.predicted == int(r.score >= 0.5) for r in rows.values())


def swap_distance(a, b):
    """Edits between ``a`` and ``b``, where two neighbouring letters in each other's place are one."""
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_automaton_with_swaps_finds_what_distances_find(monkeypatch):
    monkeypatch.setattr(toxicity, "AUTOMATON_ENTRIES", 3_000)  # starts anew now and then
    pick = random.Random(4)
    word = lambda low, high: "".join(pick.choices("abc", k=pick.randint(low, high)))
    terms = {word(2, 12): float(i) for i in range(1, 40)} | {word(4, 5) + toxicity.STEM: 20.0 + i for i in range(4)}
    automaton = toxicity.TermAutomaton(terms, swaps=True)
    for _ in range(4_000):
        w, best = word(1, 14), 0.0
        for term, weight in terms.items():
            if term.endswith(toxicity.STEM):
                best = max(best, weight if w.startswith(term[:-1]) else 0.0)
            elif abs(len(w) - len(term)) <= 2 and (d := swap_distance(w, term)) <= toxicity.edits_for(term):
                best = max(best, weight * toxicity.EDIT_PENALTY**d)
        match = automaton.find(w)
        assert (match[1] * toxicity.EDIT_PENALTY ** match[2] if match else 0.0) == best, w


def test_every_length_forgives_its_edits():
    letters = "abcdefghijklmnop"
    for n in range(2, len(letters) + 1):
        term = letters[:n]
        find = toxicity.TermAutomaton({term: 4.0}, swaps=True).find
        edits = (n >= 4) + (n >= 8)
        assert toxicity.edits_for(term) == edits and find(term) == (term, 4.0, 0)
        once = {term[:i] + x + term[i + cut :] for i in range(n + 1) for x in ("z", "") for cut in (0, 1)}
        once |= {term[:i] + term[i + 1] + term[i] + term[i + 2 :] for i in range(n - 1)}
        for word in once - {term}:
            assert find(word) == ((term, 4.0, 1) if edits else None), word
        if n > 5:
            twice = {term[1] + term[0] + term[2:-2] + term[-1] + term[-2], "z" + term[:-1] + "y", "z" + term[1:] + "z", term[1:-1]}
            for word in twice:
                assert find(word) == ((term, 4.0, 2) if edits == 2 else None), word


def test_short_terms_are_found_misspelled():
    features = toxicity.featurer(dict.fromkeys(["idiot", "moron", "clown", "loser", "scum", "worthless"], 7.0))
    for word in ("idiott", "id1ot", "idoit", "morron", "clwon", "looser", "sucm", "wrothless", "wortles"):
        values, matches = features(f"you are a {word} and more")
        assert matches == 1 and values[0] > 0, word


def test_frequent_clean_words_are_no_misspellings(spark):
    rows = [(i, "you clown of the river" if i % 4 == 0 else f"the crown of the river w{i}", int(i % 4 == 0)) for i in range(200)]
    rows += [(1000 + i, "clowm of the river", 0) for i in range(2)]  # not frequent
    labels = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = fit(labels)
    assert "clown" in model.lexicon and "crown" in model.innocent and "clowm" not in model.innocent
    features = toxicity.featurer(model.lexicon, model.innocent)
    assert features("crown")[1] == 0 and features("clowm")[1] == 1 and features("clwon")[1] == 1
    assert toxicity.featurer({"crow*": 4.0, "clown": 9.0}, model.innocent)("crown")[0][1] == 4.0


def test_stray_marks_do_not_quote():
    features = toxicity.featurer({"worthless": 4.0})
    filler = "other " * (toxicity.QUOTE_WORDS + 5)
    for text in (
        'a 15" screen and you are worthless',
        'a 15" screen and you are worthless, he likes "this" and "that" here',
        'she began "well and you are worthless, then "no" and more',
        '"one paragraph\n"another paragraph\nyou are worthless\n"the last"',
        'so it ended" and you are worthless "fine"',
        '“one and you are worthless',
        '„one and you are worthless »two',
        '«one and you are worthless“ two',
        f'"{filler} you are worthless {filler}"',
        'a "fine" stone before, you are worthless, a "fine" stone after',
        'a 15 " screen, you are worthless, "this" too',
    ):
        plain = features(text)[0]
        assert plain[0] > 0 and plain[1] == 4.0 and plain[2] == 0, text
    for text in (
        'a 15" screen and "a worthless man" here',
        '"worthless"',
        'one " worthless man " two',
        '("so worthless.")',
        '„worthless“ eins',
        '»so worthless« eins',
        '« so worthless » un',
        '‹worthless›',
        '”so worthless” en',
        'the man“worthless”the man',
        'a “worthless "fine" man” here',
    ):
        quoted = features(text)[0]
        assert quoted[0] == 0 and quoted[2] > 0, text


def test_inflected_terms_are_found_misspelled(spark):
    forms = ["stupid", "stupidly", "stupidity", "stupider"]
    rows = [(i, f"river {forms[i // 4 % 4]} stone" if i % 4 == 0 else "river stone", int(i % 4 == 0)) for i in range(400)]
    model = fit(spark.createDataFrame(rows, "doc_id bigint, text string, toxic int"))
    assert any(t.endswith("*") for t in model.lexicon) and set(forms) <= set(model.lexicon)
    features = toxicity.featurer(model.lexicon, model.innocent)
    for word in ("stpid", "sutpid", "styupid", "stpidly", "sutpidity", "stupids", "stupid"):
        values, matches = features(f"river {word} stone")
        assert matches == 1 and values[0] > 0, word


def test_covered_terms():
    odds = {"stup*": 5.0, "stupi*": 5.5, "stupid": 5.5, "the": 5.0, "the*": 5.0}
    assert [toxicity._covered(t, v, odds) for t, v in odds.items()] == [False, True, False, False, False]
