"""Packing token pieces into sequences of a fixed size by best fit and a swap-based local search.

Documents are cut into pieces no longer than a sequence. Pieces are dealt into groups of a bounded size;
in each group a best fit by falling length comes first, then documents are moved or exchanged, one for
one, two for one or one for two, between underfull bins. Every step raises the sum of the squared fills,
so nearly empty bins run dry and go. The bins still underfull in all groups are opened and packed again
in fewer groups, until one group is left.
"""

from __future__ import annotations

import base64
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import combinations
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tillwise.llm.common import SLICE_ROWS, land

TOKENIZER = "byte_bpe_50k.json"
#: The vocabulary of TOKENIZER once more, as ranks.
RANKS = "byte_bpe_50k.tiktoken"
END = 2
SIZE = 1024
#: Pieces packed by one task.
GROUP = 65_536
#: The rank encoder overflows its stack on much longer runs of white space; these go to the library.
LONGEST_BLANK = 10_000


def document_encoder(path: str | None = None) -> Callable[[], Callable[[str], list[int]]]:
    """Per-task factory of the function from a text to its ids, those of the tokenizers library with
    ``add_special_tokens=False``.

    For the default vocabulary an encoder of the same ranks does the work, at a sixth of the time. It
    gives the same ids for every code point (tested); the texts it can't take are left to the library:
    those with the string of an added token, and those with very long runs of white space.
    """

    def make():
        library = Tokenizer.from_file(path or public_tokenizers.path(TOKENIZER))

        def slow(text: str) -> list[int]:
            return library.encode(text, add_special_tokens=False).ids

        if path is not None:
            return slow
        with open(public_tokenizers.path(RANKS), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        added = [t.content for t in library.get_added_tokens_decoder().values()]

        def encode(text: str) -> list[int]:
            blank = len(text) > LONGEST_BLANK and max(map(len, re.findall(r"\s{64,}", text)), default=0)
            return slow(text) if blank > LONGEST_BLANK or any(t in text for t in added) else fast(text)

        return encode

    return make


def cut(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: all of ``size``, but the first may be shorter."""
    first = n % size or size
    return [(0, first), *((start, size) for start in range(first, n, size))] if n else []


def token_pieces(
    docs: DataFrame, size: int = SIZE, end: int | None = END, path: str | None = None, with_ids: bool = False
) -> DataFrame:
    """(doc_id, piece int, start, length, ids_crc32 bigint) of the pieces of every row of ``docs`` (doc_id, text).

    A row's tokens are those of its whole text (null: empty), then ``end``. ``ids_crc32`` is of the ids as
    little-endian unsigned 32-bit integers; ``with_ids`` adds them as ``ids`` binary, the form in which
    shards are written. Repeated rows give their pieces each; without ``end`` an empty text gives none.
    """
    make = document_encoder(path)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make()
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(begin, SLICE_ROWS)
                owners, rows = [], []
                for at, text in enumerate(part.column("text").to_pylist()):
                    ids = encode(text or "")
                    packed = np.array(ids if end is None else [*ids, end], "<u4").tobytes()
                    for k, (start, length) in enumerate(cut(len(packed) // 4, size)):
                        own = packed[4 * start : 4 * (start + length)]
                        owners.append(at)
                        rows.append((k, start, length, crc32(own), *[own] * with_ids))
                if rows:
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(owners, pa.int64()))]
                        + [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=False)],
                        names=names,
                    )

    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Bins of item numbers: by falling length, each item into the fullest bin that takes it.

    Bins are kept by their room; a bit mask of the rooms in use gives the smallest that is enough.
    """
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms = 0
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        need = lengths[item]
        enough = rooms >> need
        if enough:
            room = need + (enough & -enough).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, at = size, len(bins)
            bins.append([])
        bins[at].append(item)
        if room > need:
            by_room[room - need].append(at)
            rooms |= 1 << (room - need)
    return bins


class Exchange:
    """Local search between the underfull bins of a packing."""

    def __init__(self, lengths: list[int], bins: list[list[int]], size: int):
        self.lengths, self.bins, self.size = lengths, bins, size
        self.fill = [sum(lengths[i] for i in b) for b in bins]
        #: room -> mask of what a bin with that room can give back: the lengths of no, one or two of its items
        self.offers: dict[int, list[int]] = {}
        #: (room, number of items given, their length) -> bins, some of which may have changed since
        self.where: dict[tuple[int, int, int], list[int]] = defaultdict(list)
        for at in range(len(bins)):
            self.offer(at)

    def gifts(self, at: int) -> Iterator[tuple[int, int]]:
        """(number of items, their length) of what a bin can give; equal lengths count once."""
        own = sorted(self.lengths[i] for i in self.bins[at])
        yield from ((1, x) for x in set(own))
        twice = {x for x, y in zip(own, own[1:], strict=False) if x == y}
        yield from ((2, x) for x in {x + y for x, y in combinations(sorted(set(own)), 2)} | {2 * x for x in twice})

    def offer(self, at: int) -> None:
        room = self.size - self.fill[at]
        if not room or not self.bins[at]:
            return
        masks = self.offers.setdefault(room, [0, 0, 0])
        for count, length in [(0, 0), *self.gifts(at)]:
            masks[count] |= 1 << length
            self.where[room, count, length].append(at)

    def taker(self, room: int, count: int, length: int, giver: int) -> int | None:
        """An underfull bin other than ``giver`` that still makes the offer."""
        bins = self.where[room, count, length]
        own = False
        while bins:
            at = bins[-1]
            if at == giver:
                own = True
            elif self.size - self.fill[at] == room and self.bins[at] and self.pick(at, count, length) is not None:
                break
            bins.pop()
        found = bins[-1] if bins else None
        if own:
            bins.insert(0, giver)
        elif not bins:
            self.offers[room][count] &= ~(1 << length)
            if not any(self.offers[room]):
                del self.offers[room]
        return found

    def pick(self, at: int, count: int, length: int) -> list[int] | None:
        """``count`` items of a bin with that length in all."""
        if count == 0:
            return []
        if count == 1:
            return next(([i] for i in self.bins[at] if self.lengths[i] == length), None)
        seen: dict[int, int] = {}
        for i in self.bins[at]:
            if (j := seen.get(length - self.lengths[i])) is not None:
                return [j, i]
            seen[self.lengths[i]] = i
        return None

    def best_step(self, giver: int) -> tuple | None:
        """The exchange that raises the squared fills most by passing length on from ``giver``."""
        best, chosen = 0, None
        given = self.fill[giver]
        for count, y in list(self.gifts(giver)):
            for room in list(self.offers):
                fill = self.size - room
                for back in (0, 1, 2) if count == 1 else (1,):
                    masks = self.offers.get(room)
                    if masks is None:
                        break
                    # the least that the taker can give back: at least y - room, less than y
                    least = max(0, y - room)
                    while fitting := (masks[back] >> least) & ((1 << (y - least)) - 1):
                        x = least + (fitting & -fitting).bit_length() - 1
                        gain = 2 * (y - x) * (fill - given + y - x)
                        if gain <= best:
                            break
                        taker = self.taker(room, back, x, giver)
                        if taker is not None:
                            best, chosen = gain, (taker, count, y, back, x)
                            break
                        if room not in self.offers:
                            break
                        least = x + 1
        return chosen

    def apply(self, giver: int, step: tuple) -> None:
        taker, count, y, back, x = step
        there, here = self.pick(giver, count, y), self.pick(taker, back, x)
        for at, gone, new in ((giver, there, here), (taker, here, there)):
            self.bins[at] = [i for i in self.bins[at] if i not in gone] + new
            self.fill[at] = sum(self.lengths[i] for i in self.bins[at])
            self.offer(at)

    def run(self) -> list[list[int]]:
        """Empties bins, the emptiest first, until none can pass anything on or no bin can be spared."""
        changed = True
        while changed:
            changed = False
            underfull = [at for at, f in enumerate(self.fill) if 0 < f < self.size]
            needed = -(-sum(self.fill[at] for at in underfull) // self.size)
            left = len(underfull)
            for giver in sorted(underfull, key=lambda at: (self.fill[at], at)):
                if left <= needed:
                    return [b for b in self.bins if b]
                # a bin that others have filled meanwhile stays
                while 0 < self.fill[giver] < self.size and (step := self.best_step(giver)):
                    self.apply(giver, step)
                    changed = True
                # full bins count on both sides
                left -= not self.fill[giver]
        return [b for b in self.bins if b]


def pack_group(lengths: list[int], size: int = SIZE) -> list[list[int]]:
    """Bins of item numbers for items of 1 to ``size`` tokens."""
    return Exchange(lengths, best_fit(lengths, size), size).run()


def _packed_groups(pieces: DataFrame, size: int, group: int, n: int, spread: int) -> DataFrame:
    """``pieces`` with sequence_id and offset, packed in groups of about ``group`` pieces, and whether full."""
    groups = -(-n // group)
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("_id", F.lit(spread)), F.lit(groups)))
    added = [("sequence_id", T.LongType()), ("offset", T.LongType()), ("_full", T.BooleanType())]
    out = T.StructType([*pieces.schema.fields, *[T.StructField(*field) for field in added]])

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("_id").drop_columns(["_group"])
        lengths, ids = table.column("length").to_pylist(), table.column("_id").to_pylist()
        sequence, offset, full = [0] * len(ids), [0] * len(ids), [False] * len(ids)
        for items in pack_group(lengths, size):
            items.sort()
            at = 0
            for i in items:
                sequence[i], offset[i] = ids[items[0]], at
                at += lengths[i]
            for i in items:
                full[i] = at == size
        table = table.append_column("sequence_id", pa.array(sequence, pa.int64()))
        table = table.append_column("offset", pa.array(offset, pa.int64()))
        return table.append_column("_full", pa.array(full, pa.bool_()))

    return dealt.groupBy("_group").applyInArrow(pack, out)


def pack_pieces(pieces: DataFrame, size: int = SIZE, group: int = GROUP) -> DataFrame:
    """``pieces`` with sequence_id and offset (bigint): its place in one of as few sequences as can be found.

    ``length`` must be 1 to ``size``; all other columns are passed on, whatever their names, but for
    sequence_id, offset, _id, _group and _full, which are replaced. Offsets in a sequence are gapless
    from 0. A sequence is numbered by the first of its pieces; the numbers have gaps. Equal lengths and
    repeated rows are packed each on its own; no pieces give no rows.

    Pieces of the full size are sequences of their own. The others are dealt at random into groups of
    about ``group``, so that pieces of any one length, however many, spread over all tasks. What is not
    in a full sequence is dealt again into fewer groups, while that makes it less by a quarter or more;
    the last underfull bins of a single group stay. Every round is landed.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset", "_id", "_group", "_full")]
    rows = land(pieces.select(*[F.col(f"`{c}`") for c in names]).withColumn("_id", F.monotonically_increasing_id()))
    alone = F.col("length") >= size
    done = [
        rows.where(alone).select(*rows.columns, F.col("_id").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    ]
    rest = rows.where(~alone)
    n = rest.count()
    spread = 0
    while n:
        packed = land(_packed_groups(rest, size, group, n, spread))
        left = 0 if n <= group else packed.where(~F.col("_full")).count()
        again = 0 < left <= 0.75 * n
        done.append(packed.where("_full" if again else "true").drop("_full"))
        rest, n, spread = packed.where(~F.col("_full")).select(*rows.columns), left if again else 0, spread + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.drop("_id")


def pack_documents(docs: DataFrame, size: int = SIZE, end: int | None = END, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of the pieces of every row of ``docs``."""
    return pack_pieces(token_pieces(docs, size, end, path), size)
