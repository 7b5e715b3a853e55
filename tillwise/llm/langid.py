"""Language identification by error-correcting output codes.

Each language gets a codeword; one binary classifier per bit of the code sees hashed byte n-grams.
A text goes to the codeword with the least loss over all bits, each weighted by the logistic loss
of its margin; a small lead over the second codeword marks the text as ambiguous.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import append_by_text, hashed_sample

UNKNOWN = "und"
#: Labelled rows per language that the bit classifiers are fitted on (whole texts, chosen by the
#: hash of their id); the only bound of the operator.
SAMPLE_PER_LANGUAGE = 1000
BUCKETS = 1 << 16
SMOOTHING = 0.5
#: Mean log-odds per n-gram are multiplied by this before the loss.
SHARPNESS = 20.0
#: Texts whose probability is below this have no clear nearest codeword.
AMBIGUOUS = 0.4


@dataclass(frozen=True)
class Model:
    """Languages in order, their codewords (one row of +-1 each) and the weights of the bits."""

    languages: tuple[str, ...]
    code: np.ndarray
    weights: np.ndarray


def codewords(languages: int) -> np.ndarray:
    """One row of +-1 per language; no column is constant, repeated or the opposite of another.

    Up to seven languages: the exhaustive code of 2^(k-1)-1 bits, whose rows differ in 2^(k-2).
    More: the widest of 64 fixed pseudo-random codes of at most 10 log2 k bits.
    """
    if languages < 2:
        return np.ones((languages, 0), dtype=np.int8)
    if languages <= 7:
        bits = np.arange(1, 2 ** (languages - 1))
        rows = [np.ones(len(bits), dtype=int)]
        rows += [1 - 2 * ((bits >> k) & 1) for k in range(languages - 1)]
        return np.array(rows, dtype=np.int8)
    width = int(np.ceil(10 * np.log2(languages)))

    def draw(seed: int) -> np.ndarray:
        code = np.random.default_rng(seed).choice([-1, 1], size=(languages, width))
        # a column and its opposite are the same question: the first row of all is +1
        code = np.unique(code * code[0], axis=1)
        return code[:, code.sum(axis=0) < languages]

    def gap(code: np.ndarray) -> int:
        same = code @ code.T
        return code.shape[1] - int(same[~np.eye(languages, dtype=bool)].max())

    return max(map(draw, range(64)), key=gap).astype(np.int8)


def ngrams(text: str) -> np.ndarray:
    """Buckets of the byte pairs (exact) and byte 4-grams (hashed) of the lower-cased text."""
    b = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
    pairs = b[:-1] | b[1:] << 8
    if len(b) < 4:
        return pairs
    fours = pairs[:-2] | pairs[2:] << 16
    return np.concatenate([pairs, BUCKETS + ((fours * np.uint32(2654435761)) >> np.uint32(16))])


def fit(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """The model of ``labelled`` (doc_id, text, lang); null languages and texts are left out.

    ``per_language`` rows of each language are used at most; no labelled rows give a model without
    languages. The sample's n-gram counts are taken in tasks; their sums, at most 2 * BUCKETS numbers
    per language, reach the driver. Every distinct value of ``lang`` is a language: labels are meant to
    be a list of some hundred languages at most, not free text.
    """
    rows = labelled.where("lang is not null and text is not null")
    chosen = hashed_sample(rows, "lang", per_language)
    sample = rows.select("doc_id", "lang", "text").join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")

    def count(batches):
        import pyarrow as pa

        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                total = sums.setdefault(lang, np.zeros(2 * BUCKETS, dtype=np.int64))
                total += np.bincount(ngrams(text), minlength=2 * BUCKETS)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at, type=pa.int32()), pa.array(total[at])],
                names=["lang", "bucket", "n"],
            )

    counted = (
        sample.select("lang", "text")
        .mapInArrow(count, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .groupBy("lang")
        .agg(F.collect_list(F.struct("bucket", "n")).alias("counts"))
    )
    by_language = {}
    for lang, counts in counted.collect():  # one row of at most 2 * BUCKETS numbers per language
        total = by_language.setdefault(lang, np.zeros(2 * BUCKETS))
        total[[b for b, _ in counts]] = [n for _, n in counts]
    languages = tuple(sorted(by_language))
    code = codewords(len(languages))
    weights = np.zeros((2 * BUCKETS, code.shape[1]), dtype=np.float32)
    if languages:
        rates = np.array([by_language[x] / max(1.0, by_language[x].sum()) for x in languages])
        for bit in range(code.shape[1]):
            sides = []
            for sign in (1, -1):
                rate = rates[code[:, bit] == sign].mean(axis=0) + SMOOTHING / (2 * BUCKETS)
                sides.append(np.log(rate / rate.sum()))
            weights[:, bit] = sides[0] - sides[1]
    return Model(languages, code, weights)


def predictor(model: Model, sharpness: float = SHARPNESS):
    """The per-task factory of the function from a text to (language, score, ambiguous)."""

    def make():
        weights, code = model.weights, model.code.astype(np.float64)

        def predict(text: str | None) -> tuple[str, float, bool]:
            if not model.languages or not text or not any(map(str.isalpha, text)):
                return UNKNOWN, 0.0, True
            if len(model.languages) == 1:
                return model.languages[0], 1.0, False
            grams = ngrams(text)
            margin = np.zeros(code.shape[1])
            for at in range(0, len(grams), 65536):
                margin += weights[grams[at : at + 65536]].sum(axis=0, dtype=np.float64)
            loss = np.logaddexp(0.0, -code * (margin * sharpness / len(grams))).sum(axis=1)
            share = np.exp(loss.min() - loss)
            score = float(1.0 / share.sum())
            return model.languages[int(loss.argmin())], score, score < AMBIGUOUS

        return predict

    return make


FIELDS = [("lang_pred", "string"), ("score", "double"), ("ambiguous", "boolean")]


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default all) of ``docs`` with lang_pred, score and ambiguous.

    Only the text decides. Null texts and texts without a letter (a character of a Unicode letter
    category; numerals and circled numbers are none) are ``und`` with score 0 and ambiguous; so is every text if nothing was learned. A tie goes to the first language in
    alphabetical order. Rows come back one for one.
    """
    return append_by_text(docs, predictor(model), FIELDS, keep=keep)


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose language is clear, with their own columns only."""
    flag = "_ambiguous"
    while flag in docs.columns:
        flag = f"_{flag}"

    def make():
        predict = predictor(model)()
        return lambda text: (predict(text)[2],)

    return append_by_text(docs, make, [(flag, "boolean")]).where(~F.col(flag)).drop(flag)
