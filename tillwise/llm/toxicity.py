"""Toxicity scores from a lexicon, matched through Levenshtein automata on a trie.

The lexicon is learned from labelled rows: terms whose presence separates toxic documents. A text's
words run through the product of the lexicon's trie with the Levenshtein automata of its terms,
determinised as far as the words seen need it, so a misspelled term costs as much as an exact one.
Words that clean labelled rows use often are no misspellings, however near to a term.
Every match is weighed by its context window: inside a pair of quotation marks or next to words of
reporting it counts as quotation, otherwise as abuse. A logistic model turns both sums into a score.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import append_by_text, hashed_sample, land

#: Labelled rows of each label that lexicon and weights are fitted on, chosen by the hash of their id.
SAMPLE_PER_LABEL = 10_000
#: Toxic documents that must have a term, and how surely it must separate.
MIN_TOXIC_DOCUMENTS = 3
MIN_Z = 3.5
MIN_ODDS = 3.5
#: Beginnings of words that may be terms, for languages that inflect; written with STEM at the end.
STEM_LENGTHS = (4, 5, 6, 7)
STEM = "*"
#: Term lengths from which one and two edits are forgiven; shorter terms must be exact.
ONE_EDIT = 4
TWO_EDITS = 8
#: A word of at least so many clean sampled documents, of lower log-odds, is no misspelling of a term.
MIN_CLEAN_DOCUMENTS = 3
VARIANT_ODDS = MIN_ODDS / 2
#: Words on either side that make up the context of a match.
WINDOW = 6
EDIT_PENALTY = 0.5
#: Entries after which a task starts its table of words, or its automaton, anew; bounds memory, not results.
MEMO = 200_000
AUTOMATON_ENTRIES = 1_000_000
WORD = re.compile(r"\w+")
#: Quotation marks and those that close them; a pair is of one kind, on one line, at most so many words apart.
CLOSED_BY = {'"': '"', "“": "”", "”": "”", "„": "“”", "«": "»", "»": "«", "‹": "›", "›": "‹"}
KIND = {'"': 0, "“": 1, "”": 1, "„": 1, "«": 2, "»": 2, "‹": 3, "›": 3}
QUOTE = re.compile(f"[{''.join(CLOSED_BY)}]")
QUOTE_WORDS = 50
#: Words that report what someone else said.
REPORTING = frozenset(
    "said says say quote quoted quotes wrote writes called word term meaning "
    "sagte schrieb zitat nannte wort dijo escribió cita llamó palabra dit écrit citation appelé mot".split()
)


def edits_for(term: str) -> int:
    """Edits forgiven in a term: by its length, none in a stem, which any ending may follow."""
    return 0 if term.endswith(STEM) else (len(term) >= ONE_EDIT) + (len(term) >= TWO_EDITS)


class TermAutomaton:
    """The lexicon's trie against the Levenshtein automata of its terms, determinised lazily.

    A nondeterministic state is (trie node, edits so far); a word is accepted with the term whose
    end it reaches within the edits forgiven for that term. With ``swaps``, two neighbouring
    letters in each other's place are one edit; a state (node, letter) has read the second of them.
    States are added when first met.
    """

    def __init__(self, weights: dict[str, float], swaps: bool = False) -> None:
        self.swaps = swaps
        self.children: list[dict[str, int]] = [{}]
        self.term: list[tuple[str, float] | None] = [None]
        self.stems: dict[int, int] = {}
        self.reach = [0]  # most edits forgiven by a term below the node
        self.bodies: dict[int, set[str]] = {}
        self.probes: dict[int, dict[tuple[int, int], set[str]]] = {}
        for term, weight in weights.items():
            node, allowed = 0, edits_for(term)
            self._probe(term, allowed)
            self.reach[0] = max(self.reach[0], allowed)
            for char in term.removesuffix(STEM):
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.reach.append(0)
                node = self.children[node][char]
                self.reach[node] = max(self.reach[node], allowed)
            if term.endswith(STEM):  # a node of its own, which no ending leaves
                self.stems[node] = node = len(self.children)
                self.children.append({})
                self.term.append(None)
                self.reach.append(0)
            self.term[node] = (term, weight)
        self.endless = set(self.stems.values())
        self._restart()

    def _probe(self, term: str, edits: int) -> None:
        """Note what a word must hold, and where, to be within ``edits`` of ``term``.

        A term is cut into edits + 1 pieces with a letter between them, so that an edit, a swap
        too, spoils one piece at most. A middle piece is needed where both outer ones are spoilt,
        by one edit each, so it moves by one place at most.
        """
        if term.endswith(STEM):
            self.bodies.setdefault(len(term) - 1, set()).add(term[:-1])
            return
        n, size = len(term), (len(term) - edits) // (edits + 1)
        for length in range(n - edits, n + edits + 1):
            places = self.probes.setdefault(length, {})
            places.setdefault((0, size), set()).add(term[:size])
            if edits:
                places.setdefault((length - size, length), set()).add(term[n - size :])
            if edits > 1:
                for at in range(size, size + 3):
                    places.setdefault((at, at + size), set()).add(term[size + 1 : 2 * size + 1])

    def _restart(self) -> None:
        self.entries = 0
        self.sets: list[dict] = []
        self.number: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.accepts: list[tuple[str, float, int] | None] = []
        self.dead = self._state({})
        self.start = self._state({0: 0})

    def _state(self, nodes: dict) -> int:
        closed: dict = {}
        queue = list(nodes.items())
        while queue:  # a term's characters that the word leaves out
            node, spent = queue.pop()
            swapped = isinstance(node, tuple)
            if spent > self.reach[node[0] if swapped else node] or closed.get(node, 99) <= spent:
                continue
            closed[node] = spent
            if swapped:
                continue
            if not spent and node in self.stems:
                queue.append((self.stems[node], 0))
            queue += [(child, spent + 1) for child in self.children[node].values()]
        key = frozenset(closed.items())
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.entries += len(closed) + 1
            self.sets.append(closed)
            self.steps.append({})
            ends = [
                (*self.term[n], e)
                for n, e in closed.items()
                if not isinstance(n, tuple) and self.term[n] and e <= edits_for(self.term[n][0])
            ]
            self.accepts.append(max(ends, key=lambda t: (t[1] * EDIT_PENALTY ** t[2], t[0]), default=None))
        return self.number[key]

    def _step(self, state: int, char: str) -> int:
        after: dict = {}

        def put(node: int | tuple[int, str], spent: int) -> None:
            if spent < after.get(node, 99):
                after[node] = spent

        for node, spent in self.sets[state].items():
            if isinstance(node, tuple):
                if node[1] == char:
                    put(node[0], spent)
                continue
            put(node, spent + (node not in self.endless))  # a character too many, or of a stem's ending
            for label, child in self.children[node].items():
                put(child, spent + (label != char))
                if self.swaps and label != char and char in self.children[child]:
                    put((self.children[child][char], label), spent + 1)
        self.steps[state][char] = to = self._state(after)
        return to

    def _may_match(self, word: str) -> bool:
        """False only if no term is near enough to ``word``."""
        return any(word[a:b] in there for (a, b), there in self.probes.get(len(word), {}).items()) or any(
            word[:n] in there for n, there in self.bodies.items()
        )

    def find(self, word: str) -> tuple[str, float, int] | None:
        """(term, weight, edits) of the best match of ``word``, or None."""
        if not self._may_match(word):
            return None
        if self.entries > AUTOMATON_ENTRIES:
            self._restart()
        state = self.start
        for char in word:
            to = self.steps[state].get(char)
            state = self._step(state, char) if to is None else to
            if state == self.dead:
                return None
        return self.accepts[state]


def exact_match(lexicon: dict[str, float], word: str) -> tuple[str, float, int] | None:
    """(term, weight, 0) of the weightiest term that ``word`` matches without an edit, or None."""
    terms = {word, *(word[:n] + STEM for n in STEM_LENGTHS if n <= len(word))}
    return max(((t, lexicon[t], 0) for t in terms if t in lexicon), key=lambda t: (t[1], t[0]), default=None)


def quoted_spans(text: str, starts: list[int]) -> list[tuple[int, int]]:
    """(start, end) of what stands between paired quotation marks, in order, apart from each other.

    ``starts`` are the places of the words. A mark before a word, after a blank, only opens; one
    after a word, before a blank, only closes; others do either. The last mark that opened counts.
    Marks without a partner of their kind on their line, at most QUOTE_WORDS words on, are ignored.
    """
    opened: dict[int, int] = {}
    spans: list[tuple[int, int]] = []
    for found in QUOTE.finditer(text):
        at, mark = found.start(), found.group()
        before, after = text[at - 1 : at], text[at + 1 : at + 2]
        blank_before = not before or before.isspace() or before in "([{<-–—/'" or before in KIND
        blank_after = not after or not (after.isalnum() or after in "([{<@#$€'" or after in KIND)
        closes, opens = blank_after or not blank_before, blank_before or not blank_after
        start = opened.get(KIND[mark])
        if closes and start is not None and mark in CLOSED_BY[text[start]]:
            del opened[KIND[mark]]
            words = bisect_left(starts, at) - bisect_left(starts, start)
            if words <= QUOTE_WORDS and "\n" not in text[start:at]:
                spans.append((start, at))
                continue
        if opens:
            opened[KIND[mark]] = at
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(end, merged[-1][1])
        else:
            merged.append((start, end))
    return merged


@dataclass(frozen=True)
class Model:
    """Lexicon, logistic weights (bias first), and words that are no misspellings of its terms."""

    lexicon: dict[str, float]
    weights: tuple[float, ...]
    innocent: frozenset[str] = frozenset()


FEATURES = 5


def featurer(lexicon: dict[str, float], innocent: frozenset[str] = frozenset()):
    """The function from a text to its features: abuse sum, best abuse match, quotation sum, density, length.

    ``innocent`` words match without edits only.
    """
    automaton = TermAutomaton(lexicon, swaps=True)
    memo: dict[str, tuple[str, float, int] | None] = {}

    def features(text: str | None) -> tuple[list[float], int]:
        nonlocal memo
        if len(memo) > MEMO:
            memo = {}
        lower = (text or "").lower()
        words = WORD.findall(lower)
        matched = {}
        for word in set(words):
            if word in memo:
                match = memo[word]
            else:
                match = automaton.find(word)
                if match and match[2] and word in innocent:
                    match = exact_match(lexicon, word)
                memo[word] = match
            if match:
                matched[word] = match
        abuse, quotation, best, hits = 0.0, 0.0, 0.0, 0
        if matched:
            starts = [found.start() for found in WORD.finditer(lower)]
            spans = quoted_spans(lower, starts)
            for at, word in enumerate(words):
                if word not in matched:
                    continue
                hits += 1
                _, weight, edits = matched[word]
                value = weight * EDIT_PENALTY**edits
                near = words[max(0, at - WINDOW) : at + WINDOW + 1]
                span = bisect_right(spans, (starts[at],)) - 1
                if (span >= 0 and starts[at] < spans[span][1]) or not REPORTING.isdisjoint(near):
                    quotation += value
                else:
                    abuse += value
                    best = max(best, value)
        size = max(1, len(words))
        return [math.log1p(abuse), best, math.log1p(quotation), 100 * abuse / (size + 20), math.log(size)], hits

    return features


def _distinct_words() -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{M}\p{N}_]+"), F.lit(0)))


def _odds(toxic: int, clean: int) -> Column:
    """Log-odds of a term in ``t`` of the toxic against ``c`` of the clean documents."""
    return F.log((F.col("t") + 0.5) / (toxic - F.col("t") + 0.5)) - F.log((F.col("c") + 0.5) / (clean - F.col("c") + 0.5))


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Terms that separate: log-odds of a term in toxic against other documents, by Spark.

    ``labelled`` is (text, toxic). A term needs MIN_TOXIC_DOCUMENTS toxic documents and a log-odds
    of at least MIN_ODDS and MIN_Z standard errors; all such terms are kept, so the lexicon is bounded by
    the sample alone. Terms are words and the beginnings of words.
    """
    totals = {int(t): n for t, n in labelled.groupBy("toxic").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return {}
    documents = labelled.select(_distinct_words().alias("words"), "toxic")

    def stem(word: Column, length: int) -> Column:
        return F.when(F.length(word) > length, F.concat(F.substring(word, 1, length), F.lit(STEM)))

    def stems(length: int) -> Column:
        return F.transform("words", lambda word: stem(word, length))

    terms = F.array_distinct(F.array_compact(F.concat("words", *[stems(n) for n in STEM_LENGTHS])))
    counted = (
        documents.select(F.explode(terms).alias("term"), "toxic")
        .groupBy("term")
        .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
        .where(F.col("t") >= MIN_TOXIC_DOCUMENTS)
        .withColumn("odds", _odds(toxic, clean))
        .withColumn("z", F.col("odds") / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5)))
        .where((F.col("z") >= MIN_Z) & (F.col("odds") >= MIN_ODDS) & (F.length("term") > 1))
    )
    found = land(counted.select("term", "odds"))
    # a stem that only one word has says no more than the word
    forms = documents.where("toxic = 1").select(F.explode("words").alias("word")).distinct()
    shared = (
        forms.select(F.explode(F.array(*[stem(F.col("word"), n) for n in STEM_LENGTHS])).alias("term"))
        .join(F.broadcast(found.select("term")), "term")
        .groupBy("term")
        .count()
        .where("count > 1")
    )
    rows = found.where(~F.col("term").endswith(STEM)).unionByName(found.join(shared.select("term"), "term")).collect()
    odds = {term: float(value) for term, value in rows}
    return {term: value for term, value in sorted(odds.items()) if not _covered(term, value, odds)}


def innocent_words(labelled: DataFrame, lexicon: dict[str, float]) -> frozenset[str]:
    """Words near a term that are words of their own: MIN_CLEAN_DOCUMENTS clean documents of
    ``labelled`` (text, toxic) have them, and their log-odds are under VARIANT_ODDS."""
    totals = {int(t): n for t, n in labelled.groupBy("toxic").count().collect()}
    if not lexicon:
        return frozenset()

    def make():
        automaton = TermAutomaton(lexicon, swaps=True)

        def edits(word: str | None) -> tuple[int]:
            match = automaton.find(word or "")
            return (match[2] if match else 0,)

        return edits

    frequent = (
        labelled.select(F.explode(_distinct_words()).alias("text"), "toxic")
        .groupBy("text")
        .agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
        .where((F.col("c") >= MIN_CLEAN_DOCUMENTS) & (_odds(totals.get(1, 0), totals.get(0, 0)) < VARIANT_ODDS))
    )
    near = append_by_text(frequent, make, [("edits", "bigint")], keep=["text"]).where("edits > 0")
    return frozenset(r.text for r in near.select("text").collect())


def _covered(term: str, value: float, odds: dict[str, float]) -> bool:
    """Whether a shorter stem of the lexicon says as much of the words that ``term`` matches.

    Stems forgive no edits, so a term that does is never covered: it alone finds its misspellings.
    """
    if edits_for(term):
        return False
    body = term.removesuffix(STEM)
    return any(odds.get(body[:n] + STEM, -math.inf) >= value - 1 for n in STEM_LENGTHS if n < len(body))


def sample(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """(text, toxic) of at most ``per_label`` rows of either label.

    Labels meet ids alone; the ids chosen, 2 * ``per_label`` at most, are broadcast to the texts.
    """
    labelled = docs.select("doc_id").join(labels.where("toxic in (0, 1)").select("doc_id", "toxic"), "doc_id")
    ids = F.broadcast(hashed_sample(labelled, "toxic", per_label))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(ids, "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Model:
    """Lexicon and weights from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0/1).

    Bounded by ``per_label``. Texts, not their features, stay in Spark; the driver sees a few
    numbers per sampled row. Documents without a label and labels without a document are left out.
    Rows of one label only: an empty lexicon and a score near that label for every text; no
    labelled rows: a score near 0.
    """
    rows = land(sample(docs, labels, per_label))
    lexicon = learn_lexicon(rows)
    innocent = innocent_words(rows, lexicon)
    measured = append_by_text(rows, _feature_maker(lexicon, innocent), [("f0", "double"), ("f1", "double"), ("f2", "double"), ("f3", "double"), ("f4", "double")], keep=["toxic"])
    data = np.array([tuple(r) for r in measured.collect()], dtype=float).reshape(-1, 1 + FEATURES)
    return Model(lexicon, tuple(_logistic(data[:, 1:], data[:, 0])), innocent)


def _feature_maker(lexicon: dict[str, float], innocent: frozenset[str]):
    def make():
        features = featurer(lexicon, innocent)
        return lambda text: tuple(features(text)[0])

    return make


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression, bias first, by Newton's method; classes weigh alike."""
    design = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(design.shape[1])
    if not len(y) or y.min() == y.max():
        w[0] = 8.0 if len(y) and y[0] else -8.0
        return w
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (y - p) - ridge * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


FIELDS = [("score", "double"), ("n_matches", "bigint")]


def scorer(model: Model):
    """The per-task factory of the function from a text to (score, n_matches)."""

    def make():
        features = featurer(model.lexicon, model.innocent)
        weights = np.array(model.weights)

        def score(text: str | None) -> tuple[float, int]:
            values, matches = features(text)
            odds = float(weights[0] + weights[1:] @ np.array(values))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))), matches

        return score

    return make


def score_documents(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default all) of ``docs`` with score (0 to 1) and n_matches.

    Only the text decides; null texts score as empty ones. Rows come back one for one.
    """
    return append_by_text(docs, scorer(model), FIELDS, keep=keep)
