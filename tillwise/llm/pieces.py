"""SentencePiece encoding and decoding by a table of distinct chunks.

No piece of the model has a whitespace marker after another character, so no merge crosses the
start of a marked word: a chunk is a run of spaces with the word after it, and the ids of a text
are those of its chunks in order. Each task keeps a table from chunk to packed ids and segments a
chunk once, when it first meets it.
"""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame

from tillwise.llm.common import append_by_text

MODEL = "piece_bpe_32k.model"
#: Bytes after which a task starts its table anew, by estimate; bounds memory, not results.
TABLE_BYTES = 64 << 20
#: What an entry takes beside its characters and ids.
ENTRY_BYTES = 200
MARK = "▁"


def model_path() -> str:
    """Default model: the public vocabulary file, never copied."""
    return public_tokenizers.path(MODEL)


def crossing_pieces(path: str) -> list[str]:
    """Pieces that would break the chunk table: a marker after another character, or several
    markers before one. Must be empty for the model in use."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return [p for p in pieces if p.strip(MARK) and (MARK in p.lstrip(MARK) or p.startswith(MARK * 2))]


def piece_maker(path: str | None = None, table_bytes: int = TABLE_BYTES):
    """Returns the per-task factory of the function from a text to (n_tokens, ids, decoded).

    A model with pieces that would break the chunk table is an error.
    """
    path = path or model_path()
    if crossing := crossing_pieces(path):
        raise ValueError(f"pieces that cross a whitespace marker: {crossing[:5]}")

    def make():
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        begin, end = (np.array([i], "<u4").tobytes() for i in (model.bos_id(), model.eos_id()))
        blank = {"": np.array([model.piece_to_id(MARK)], "<u4").tobytes()}
        ids_of, held = dict(blank), 0

        def encode(text: str | None) -> tuple[int, bytes, str]:
            nonlocal ids_of, held
            text = (text or "").replace(MARK, " ")
            # The library puts one marker before a text: a chunk without its first space is a text.
            if not text:
                chunks = []
            elif "  " in text or text[0] == " " or text[-1] == " ":
                chunks = [c[1:] for c in re.findall(" +[^ ]*", " " + text)]
            else:
                chunks = text.split(" ")
            if held > table_bytes:
                ids_of, held = dict(blank), 0
            new = [c for c in set(chunks) if c not in ids_of]
            if new:
                for chunk, ids in zip(new, model.encode(new, num_threads=1), strict=True):
                    ids_of[chunk] = np.array(ids, "<u4").tobytes()
                    held += 4 * (len(chunk) + len(ids)) + ENTRY_BYTES
            packed = begin + b"".join(map(ids_of.__getitem__, chunks)) + end
            return len(packed) // 4, packed, model.decode(np.frombuffer(packed, "<u4").tolist())

        return encode

    return make


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens bigint, ids binary, decoded string) for every row of ``docs``.

    ids are the library's, begin and end ids included, as little-endian unsigned 32-bit integers,
    the form in which token shards are stored. Null and empty texts are the two end marks and
    decode to ''. Rows come back one for one; other columns are ignored.
    """
    fields = [("n_tokens", "bigint"), ("ids", "binary"), ("decoded", "string")]
    return append_by_text(docs, piece_maker(path), fields, keep=["doc_id"])
