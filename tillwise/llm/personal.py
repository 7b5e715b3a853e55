"""Personal data: base patterns, and a skip-chain conditional random field that adds what they miss.

Nodes are the base matches of a document and its other number-like or address-like strings, of one token
or of several digit groups. Chain edges join neighbours, skip edges join distant nodes that repeat each
other or look alike (same digits, same last digits with or without a country code, same local part).
Loopy belief propagation then lets a string that the patterns reject take the label of the matched one it
repeats. All factors are fitted to counts over all documents: node factors to the labels that the patterns
give a shape, chain factors to neighbouring labels beyond chance, the skip factor to how much more often matches share
a key within a document than across documents.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import append_by_text

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
SMOOTHING = 0.5
#: Weight, in nodes, of all labels' distribution in that of a shape or of a pair.
PRIOR = 20.0
ROUNDS = 20
DAMPING = 0.3
#: Marginal probability from which a token is added.
CERTAIN = 0.9
#: Digits from the end that make two numbers alike: a local number, and one with its area.
TAILS = (7, 9)
#: Digits of a number-like node.
DIGITS = (7, 19)

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# possessive runs and the look-behind keep long digit runs linear; they match what the plain forms match
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_MARK = re.compile("[0-9@]")
#: Two to eight digit groups with single separators; part of no word and of no longer run of groups.
_GROUPS = re.compile(r"(?<![\w+@.])(?<![0-9][ .()-])\+?\(?[0-9]{1,19}+\)?(?:[ .-]?\(?[0-9]{1,19}+\)?){1,7}(?![\w@])(?![ .()-]{1,2}[0-9])")
_EDGE = " \t\r\n\"'`.,;:!?*#%$&|()[]{}<>="


def luhn(digits: str) -> bool:
    """Whether the Luhn sum of ``digits`` is a multiple of ten."""
    total = 0
    for at, char in enumerate(reversed(digits)):
        value = ord(char) - 48
        total += value if at % 2 == 0 else value * 2 - 9 * (value > 4)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterable[tuple[int, int]]:
    done = 0
    for found in _DOMAIN.finditer(text):
        start = found.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < found.start():
            done = found.end()
            yield start, done


def _part_fits(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by kind as listed, then start; code points."""
    spans = [("email", *span) for span in _emails(text)] if "@" in text else []
    if not _MARK.search(text):
        return spans
    spans += [
        ("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_part_fits, m.group().split(".")))
    ]
    for m in _CARD.finditer(text):
        digits = only_digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(only_digits(m.group())) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return spans


def shape(token: str) -> str:
    """Class of a token, the observation of its node factor; '' for tokens that are no node."""
    if "@" in token:
        left, _, right = token.partition("@")
        return ("address" if "." in right else "handle") if left and right else ""
    digits = only_digits(token)
    rest = set(token) - set("0123456789 ().+-")
    if rest or len(digits) < DIGITS[0]:
        return ""
    parts = token.split(".")
    if len(parts) >= 4 and all(p.isascii() and p.isdigit() for p in parts):
        return "quad" if len(parts) == 4 and all(map(_part_fits, parts)) else "dotted"
    if 16 <= len(digits) <= 19:
        return "checked" if luhn(digits) else "unchecked"
    if len(digits) > 19:
        return "long"
    if token.startswith("+") and 8 <= len(digits) <= 15:
        return "plus"
    return "spaced" if len(digits) < len(token) else "number"


def keys(token: str) -> list[tuple[str, str]]:
    """What makes a string a repetition of another, or like it."""
    if "@" in token:
        return [("local", token.partition("@")[0].lower())]
    parts = token.split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        return [("quad", ".".join(p.lstrip("0") or "0" for p in parts))]
    digits = only_digits(token)
    return [("digits", digits), *[(f"last {n}", digits[-n:]) for n in TAILS if len(digits) >= n]]


@dataclass(frozen=True)
class Node:
    start: int
    end: int
    shape: str
    label: int  # of the base patterns; 0 for none
    keys: tuple[tuple[str, str], ...]


def _free(start: int, end: int, starts: list[int], reach: list[int]) -> bool:
    """Whether a stretch meets none of those that begin at ``starts`` and, so far, reach to ``reach``."""
    before = bisect_left(starts, end)
    return not before or reach[before - 1] <= start


def nodes(text: str, spans: list[tuple[str, int, int]]) -> list[Node]:
    """Base matches and the other candidates of ``text``, by start; candidates overlap nothing.

    A run of two to eight digit groups with 7 to 19 digits is one candidate, other tokens are each one.
    """
    found = [
        Node(s, e, shape(text[s:e]) or kind, LABELS.index(kind), tuple(keys(text[s:e]))) for kind, s, e in spans
    ]
    if not _MARK.search(text):
        return found

    def add(start: int, end: int) -> bool:
        token = text[start:end]
        if kind := shape(token):
            found.append(Node(start, end, kind, 0, tuple(keys(token))))
        return bool(kind)

    taken = sorted((s, e) for _, s, e in spans)
    gaps, at = [], 0
    for start, end in taken:
        if start > at:
            gaps.append((at, start))
        at = max(at, end)
    groups = []
    for low, high in [*gaps, (at, len(text))]:
        for m in _GROUPS.finditer(text, low, high):
            if DIGITS[0] <= len(only_digits(m.group())) <= DIGITS[1] and add(m.start(), m.end()):
                groups.append(m.span())
    taken = sorted([*taken, *groups])
    starts = [s for s, _ in taken]
    reach = np.maximum.accumulate([e for _, e in taken]).tolist() if taken else []
    for m in _TOKEN.finditer(text):
        token = m.group()
        start = m.start() + len(token) - len(token.lstrip(_EDGE))
        end = start + len(token.strip(_EDGE))
        if start < end and _free(start, end, starts, reach):
            add(start, end)
    return sorted(found, key=lambda n: (n.start, n.end, n.label))


def edges(found: list[Node]) -> list[tuple[int, int, int]]:
    """(i, j, 0) for neighbours and (i, j, 1) for consecutive tokens that share a key: both linear."""
    out = [(i, i + 1, 0) for i in range(len(found) - 1)]
    last: dict[tuple[str, str], int] = {}
    linked = set()
    for j, node in enumerate(found):
        for key in node.keys:
            if key in last and (last[key], j) not in linked:
                linked.add((last[key], j))
                out.append((last[key], j, 1))
            last[key] = j
    return out


@dataclass(frozen=True)
class Model:
    """Log factors: label by shape, and label pairs over chain and over skip edges."""

    unary: dict[str, np.ndarray]
    pair: np.ndarray


def count_factors(text: str | None) -> Counter:
    """Counts of (factor, observation, label, label) in one text, labelled by the base patterns.

    u: nodes of a shape; c: neighbours; k: skip edges between matches of one kind; s: matches that could have
    had one, those of a kind after the first; m: the loosest key of a match, once for each text.
    """
    text = text or ""
    found = nodes(text, base_spans(text))
    counts = Counter(("u", n.shape, n.label, 0) for n in found)
    for i, j, skip in edges(found):
        a, b = found[i].label, found[j].label
        if not skip:
            counts["c", "", a, b] += 1
        elif a and a == b:
            counts["k", "", 0, 0] += 1
    of = Counter(n.label for n in found if n.label)
    if more := sum(n - 1 for n in of.values()):
        counts["s", "", 0, 0] = more
    for key in {n.keys[min(1, len(n.keys) - 1)] for n in found if n.label}:
        counts["m", hashlib.blake2b(repr(key).encode(), digest_size=8).hexdigest(), 0, 0] = 1
    return counts


def summed(counts: Mapping[tuple[str, str, int, int], int]) -> list[tuple[str, str, int, int, int]]:
    """Rows for ``model_of``: all counts but those of keys, and of these their sum (m) and the pairs of
    texts that share one (p)."""
    rows = [(*k, n) for k, n in counts.items() if k[0] != "m"]
    shared = [n for k, n in counts.items() if k[0] == "m"]
    return [*rows, ("m", "", 0, 0, sum(shared)), ("p", "", 0, 0, sum(n * (n - 1) // 2 for n in shared))]


def model_of(counts: Iterable[tuple[str, str, int, int, int]]) -> Model:
    """Factors from summed counts.

    A shape's node factor is its labels' distribution, drawn towards that of all nodes by PRIOR nodes; that
    of ``""``, for shapes never seen, is all nodes'. A chain factor is what a pair of neighbouring labels has
    beyond chance, drawn towards chance alike. The skip factor is the logarithm of the rate at which
    matches of one kind share a key within a text to the rate at which matches of any two texts
    do: each side's label is known by its own pattern, so either could be hidden and told from the other.
    It rewards agreement on a kind only; two rejected strings are no evidence for each other.
    """
    size = len(LABELS)
    seen: dict[str, np.ndarray] = {}
    chain = np.full((size, size), SMOOTHING)
    totals: Counter = Counter()
    for factor, name, a, b, n in counts:
        if factor == "u":
            seen.setdefault(name, np.zeros(size))[a] += n
        elif factor == "c":
            chain[a, b] += n
            chain[b, a] += n
        else:
            totals[factor] += n
    every = sum(seen.values(), np.full(size, SMOOTHING))
    every = every / every.sum()
    unary = {name: np.log((v + PRIOR * every) / (v.sum() + PRIOR)) for name, v in seen.items()}
    unary[""] = np.log(every)
    single = chain.sum(axis=1) / chain.sum()
    expected = np.outer(single, single)
    pair = np.zeros((2, size, size))
    pair[0] = np.log((chain + PRIOR * expected) / ((chain.sum() + PRIOR) * expected))
    within = (totals["k"] + SMOOTHING) / (max(totals["s"], totals["k"]) + 2 * SMOOTHING)
    across = (totals["p"] + SMOOTHING) / (totals["m"] * (totals["m"] - 1) / 2 + 2 * SMOOTHING)
    pair[1] = np.eye(size) * max(0.0, math.log(within / across))
    pair[1][0, 0] = 0.0
    return Model(unary, pair)


def fit(docs: DataFrame) -> Model:
    """Factors counted over all rows of ``docs`` (doc_id, text). Counts are summed in Spark, those of keys
    twice, by key and over all keys; a few dozen numbers reach the driver."""

    def make():
        def count(text: str | None) -> tuple[str]:
            return (";".join(f"{f},{o},{a},{b},{n}" for (f, o, a, b), n in count_factors(text).items()),)

        return count

    parts = F.split("c", ",")
    counted = (
        append_by_text(docs, make, [("counts", "string")], keep=[])
        .select(F.explode(F.split("counts", ";")).alias("c"))
        .where("c <> ''")
        .select(parts[0].alias("f"), parts[1].alias("o"), parts[2].cast("int").alias("a"), parts[3].cast("int").alias("b"), parts[4].cast("bigint").alias("n"))
        .groupBy("f", "o", "a", "b")
        .agg(F.sum("n").alias("n"))
    )
    is_key = F.col("f") == "m"
    rows = counted.groupBy("f", F.when(~is_key, F.col("o")).otherwise("").alias("o"), "a", "b").agg(
        F.sum("n").alias("n"), F.sum(F.when(is_key, F.col("n") * (F.col("n") - 1) / 2)).cast("bigint").alias("pairs")
    )
    summed_rows = []
    for f, o, a, b, n, pairs in rows.collect():
        summed_rows.append((f, o, a, b, n))
        if f == "m":
            summed_rows.append(("p", "", 0, 0, pairs))
    return model_of(summed_rows)


def marginals(found: list[Node], links: list[tuple[int, int, int]], model: Model) -> np.ndarray:
    """Label probabilities of each node by damped loopy belief propagation; base matches are given."""
    size = len(LABELS)
    local = np.array([model.unary.get(n.shape, model.unary[""]) for n in found])
    for i, node in enumerate(found):
        if node.label:
            local[i] = -30.0
            local[i, node.label] = 0.0
    if not links:
        scores = local
    else:
        a, b, kind = (np.array(x) for x in zip(*links, strict=True))
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        potential = np.concatenate([model.pair[kind], model.pair[kind].transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        message = np.zeros((len(source), size))
        for _ in range(ROUNDS):
            belief = local.copy()
            np.add.at(belief, target, message)
            outgoing = belief[source] - message[back]
            new = np.logaddexp.reduce(outgoing[:, :, None] + potential, axis=1)
            new -= np.logaddexp.reduce(new, axis=1, keepdims=True)
            moved = np.abs(new - message).max()
            message = DAMPING * message + (1 - DAMPING) * new
            if moved < 1e-4:
                break
        scores = local.copy()
        np.add.at(scores, target, message)
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def all_spans(text: str, model: Model) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans of ``text`` and the spans that the field adds, each by kind, then start."""
    base = base_spans(text)
    found = nodes(text, base)
    added = []
    if any(not n.label for n in found):
        chances = marginals(found, edges(found), model)
        for node, chance in zip(found, chances, strict=True):
            label = int(chance[1:].argmax()) + 1
            if not node.label and chance[label] >= CERTAIN:
                added.append((LABELS[label], node.start, node.end))
    order = KINDS.index
    return base, sorted(added, key=lambda s: (order(s[0]), *s[1:]))


def join_spans(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end, comma-joined, by kind as listed, then start."""
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), *x[1:])))


FIELDS = [(f"n_{kind}", "bigint") for kind in KINDS] + [("base", "string"), ("spans", "string"), ("n_added", "bigint")]


def find_personal_data(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans, n_added) for every row of ``docs``.

    The counts and ``base`` are of the base patterns; ``spans`` are these and the added ones. Both
    list kind:start:end in code points of the whole text. Null texts are empty. Rows come back one
    for one; other columns are ignored.
    """

    def make():
        def find(text: str | None) -> tuple:
            base, added = all_spans(text or "", model)
            count = Counter(kind for kind, _, _ in base)
            return (*(count[k] for k in KINDS), join_spans(base), join_spans(base + added), len(added))

        return find

    return append_by_text(docs, make, FIELDS, keep=["doc_id"])
