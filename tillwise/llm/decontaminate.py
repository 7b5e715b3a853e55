"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters has an error budget of k edits. Cut into k+1 pieces, any occurrence
within the budget leaves at least one piece untouched: exact hits of pieces propose windows, and
Myers' bit-parallel distance verifies them. Pieces are found by the hashes of their first characters
in sorted arrays, a few bytes a piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import SLICE_ROWS, land

#: Characters of an item for each edit that is allowed.
CHARS_PER_EDIT = 12
#: Characters of items searched for in one pass over the documents; more items take more passes.
BLOCK_CHARS = 4_000_000

#: Length of the q-grams of which a window must hold as many of an item's as the budget leaves.
GRAM = 4
#: Lengths of the prefixes that pieces are hashed by: the longest that a piece has.
PREFIXES = (1, 2, 4, 8)
#: Characters of a text that are hashed at a time.
STRETCH = 1 << 20
#: Automata of items that a task keeps.
PATTERNS = 2048


def normalise(text: str | None) -> str:
    """Lower case, runs of white space as one space, none at the ends."""
    return " ".join((text or "").lower().split())


def budget(length: int, chars_per_edit: int = CHARS_PER_EDIT) -> int:
    """Edits allowed for an item of ``length`` characters."""
    return length // chars_per_edit


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """``item`` as edits+1 (offset, piece), lengths differing by one at most."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """Myers' automaton of one item: one bit per character, in Python's whole numbers."""

    def __init__(self, item: str) -> None:
        self.item, self.length = item, len(item)
        self.masks: dict[str, int] = {}
        for i, char in enumerate(item):
            self.masks[char] = self.masks.get(char, 0) | 1 << i

    def may_hold(self, text: str, edits: int) -> bool:
        """False only if no substring of ``text`` is within ``edits``: an edit spoils at most GRAM of
        the item's q-grams, all others are in the text."""
        grams = [self.item[i : i + GRAM] for i in range(self.length - GRAM + 1)]
        needed = len(grams) - GRAM * edits
        if needed <= 0:
            return True
        there = {text[i : i + GRAM] for i in range(len(text) - GRAM + 1)}
        return sum(map(there.__contains__, grams)) >= needed

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end) of the substring of ``text`` nearest to the item, the first of equals."""
        full, top = (1 << self.length) - 1, 1 << self.length - 1
        plus, minus, distance = full, 0, self.length
        found = (distance, 0)
        for end, char in enumerate(text, 1):
            eq = self.masks.get(char, 0)
            d0 = ((((eq & plus) + plus) ^ plus) | eq | minus) & full
            up = minus | ~(d0 | plus) & full
            down = d0 & plus
            distance += bool(up & top) - bool(down & top)
            up, down = up << 1 & full, down << 1 & full
            plus = (down | ~(d0 | up)) & full
            minus = d0 & up
            if distance < found[0]:
                found = (distance, end)
        return found


def _prefix_hashes(text: str) -> dict[int, np.ndarray]:
    """Hashes of the prefixes of every length in PREFIXES at every place of ``text``."""
    h = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    found = {1: h}
    for length, factor in zip(PREFIXES[1:], (2654435761, 2246822519, 3266489917), strict=True):
        half = length // 2
        h = h[:-half] * np.uint32(factor) + h[half:] if len(h) > half else h[:0]
        found[length] = h
    return found


class PieceIndex:
    """The pieces of a block of items, by the hash of their prefix."""

    def __init__(self, items: list[str], edits: list[int]) -> None:
        self.items = items
        by_length: dict[int, list[tuple[str, int, int, int]]] = {}
        for at, (item, k) in enumerate(zip(items, edits, strict=True)):
            for offset, piece in pieces(item, k):
                length = max(q for q in PREFIXES if q <= len(piece))
                by_length.setdefault(length, []).append((piece[:length], at, offset, len(piece)))
        self.tables = []
        for length, entries in by_length.items():
            keys = _prefix_hashes("".join(e[0] for e in entries))[length][::length]
            order = np.argsort(keys, kind="stable")
            place = np.array([e[1:] for e in entries], dtype=np.int64)[order]
            bits = max(10, min(24, int(np.ceil(np.log2(64 * len(entries))))))
            seen = np.zeros(1 << bits, dtype=bool)
            seen[self._slot(keys, bits)] = True
            self.tables.append((length, bits, seen, keys[order], place))

    @staticmethod
    def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
        return (keys * np.uint32(2654435761)) >> np.uint32(32 - bits)

    def hits(self, text: str) -> Iterator[tuple[int, int]]:
        """(item, place where the item would begin) for every piece at every place of ``text``."""
        for begin in range(0, len(text), STRETCH):
            stretch = text[begin : begin + STRETCH + PREFIXES[-1] - 1]
            hashes = _prefix_hashes(stretch)
            for length, bits, seen, keys, place in self.tables:
                h = hashes[length][:STRETCH]
                at = np.flatnonzero(seen[self._slot(h, bits)])
                low, high = np.searchsorted(keys, h[at], "left"), np.searchsorted(keys, h[at], "right")
                for i in np.flatnonzero(low < high).tolist():
                    where = begin + int(at[i])
                    for item, offset, n in place[low[i] : high[i]].tolist():
                        if text.startswith(self.items[item][offset : offset + n], where):
                            yield item, where - offset


def matcher(items: list[tuple[int, str]], chars_per_edit: int = CHARS_PER_EDIT):
    """The function from a text to its (item_id, distance, start, end), one per item found.

    An item that allows no edit, being shorter than ``chars_per_edit``, is no passage that could mark a
    longer text: it is found only where it is the whole text.
    """
    whole: dict[str, list[int]] = {}
    for item_id, item in items:
        if not budget(len(item), chars_per_edit):
            whole.setdefault(item, []).append(item_id)
    items = [x for x in items if budget(len(x[1]), chars_per_edit)]
    edits = [budget(len(item), chars_per_edit) for _, item in items]
    index = PieceIndex([item for _, item in items], edits)

    @lru_cache(PATTERNS)
    def forward_of(at: int) -> Pattern:
        return Pattern(items[at][1])

    @lru_cache(PATTERNS)
    def backward_of(at: int) -> Pattern:
        return Pattern(items[at][1][::-1])

    def match(text: str | None) -> list[tuple[int, int, int, int]]:
        text = normalise(text)
        starts: dict[int, set[int]] = {}
        for at, begin in index.hits(text):
            starts.setdefault(at, set()).add(begin)
        found = [hit for at, begins in starts.items() if (hit := _verify(at, sorted(begins), text))]
        return found + [(item_id, 0, 0, len(text)) for item_id in whole.get(text, ())]

    def _verify(at: int, begins: list[int], text: str) -> tuple[int, int, int, int] | None:
        forward = forward_of(at)
        k, n = edits[at], forward.length
        best = None
        window: list[int] = []
        for begin in [*begins, None]:
            if begin is not None and (not window or begin <= window[1]):
                window = [window[0] if window else begin - k, begin + n + k]
                continue
            low = max(0, window[0])
            near = text[low : window[1]]
            distance, end = forward.best(near) if forward.may_hold(near, k) else (k + 1, 0)
            if distance <= k and (best is None or distance < best[0]):
                best = (distance, low + end)
                if not distance:
                    break
            if begin is not None:
                window = [begin - k, begin + n + k]
        if best is None:
            return None
        distance, end = best
        back = text[max(0, end - n - k) : end][::-1]
        start = end - backward_of(at).best(back)[1] if distance else end - n
        return items[at][0], distance, start, end

    return match


def item_blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Normalised items in blocks of about ``chars`` characters, one block at a time.

    Spark deals the items into blocks and lands them; a block is read when it is asked for, so the
    driver holds one. Null and blank items match nothing and are left out.
    """
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // chars)
    numbered = benchmark.select("item_id", "text").withColumn("_n", F.monotonically_increasing_id())
    dealt = numbered.withColumn("_block", F.pmod(F.xxhash64("_n"), F.lit(max(blocks, 1)))).drop("_n")
    if blocks > 1:
        dealt = land(dealt)
    for number in range(blocks):
        rows = dealt.where(F.col("_block") == number).select("item_id", "text").collect()  # about ``chars`` characters
        if block := [(item_id, item) for item_id, text in rows if (item := normalise(text))]:
            yield block


def contaminations(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, start, end), one row per row of ``docs`` and item its text contains.

    An item of n characters (lower-cased, white space collapsed) is contained if some substring of
    the text, treated alike, is at most n // 12 edits away; the row has the least distance and the
    place of that substring in the treated text. Items of fewer than 12 characters, which allow no edit,
    are contained only in a text that equals them. Null and empty texts contain nothing; repeated
    rows and repeated items give their rows again; an empty benchmark or table gives none. Other
    columns are ignored. All items are searched for, ``block_chars`` characters of them per pass;
    with more than one pass each is landed before the next, so driver, plan and tasks hold one block
    whatever the size of the benchmark.
    """
    schema = "doc_id bigint, item_id bigint, distance int, start int, end int"
    texts = docs.select("doc_id", "text")
    passes: list[DataFrame] = []
    for items in item_blocks(benchmark, block_chars):
        if passes:
            passes[-1] = land(passes[-1])
        passes.append(texts.mapInArrow(_finder(items), schema))
    return reduce(DataFrame.unionAll, passes) if passes else docs.sparkSession.createDataFrame([], schema)


def _finder(items: list[tuple[int, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = matcher(items)
        names = ["doc_id", "item_id", "distance", "start", "end"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE_ROWS):
                ids, texts = (c.to_pylist() for c in batch.slice(begin, SLICE_ROWS).columns)
                rows = [(i, *hit) for i, text in zip(ids, texts, strict=True) for hit in match(text)]
                if rows:
                    columns = [pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item (see ``contaminations``), all columns.

    Rows with a null or empty text stay, repeated rows stay or go together.
    """
    clean = docs
    for number, items in enumerate(item_blocks(benchmark, block_chars)):
        clean = (land(clean) if number else clean).mapInArrow(_cleaner(items), docs.schema)
    return clean


def _cleaner(items: list[tuple[int, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = matcher(items)
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(begin, SLICE_ROWS)
                clean = [not match(text) for text in part.column("text").to_pylist()]
                yield part.filter(pa.array(clean, type=pa.bool_()))

    return run
