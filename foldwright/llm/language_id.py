"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per language in numpy, sums them by Spark, and leaves one small matrix of log
probabilities (languages x buckets), whose size does not depend on the corpus. Scoring reads every
text once: the n-grams of a batch become a sparse (document, bucket) table of counts that is
multiplied with the matrix. Texts are lower-cased; all that is not a letter counts as a space.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.staging import stage

BUCKET_BITS = 14
ORDERS = (2, 3)
TRAINING_ROWS = 20_000
#: Of each language, as far as it has them.
LEAST_ROWS = 500
TRAINING_PARTS = 32
UNDETERMINED = "und"

_PIECE = 1 << 19
_SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Which code points are letters, built once per worker."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in one array, two spaces after each, and where each text ends."""
    lowered = [t.lower() + "  " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return codes, np.cumsum([len(t) for t in lowered])


def buckets_of(codes: np.ndarray, left: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: the bucket of every n-gram, and which of them hold a letter and end within their text.

    ``left`` is how many signs a text still has at each place.
    """
    letter = _letters()[codes]
    signs = np.where(letter, codes, np.uint32(_SPACE)).astype(np.uint64)
    for n in ORDERS:
        size = max(0, len(signs) - n + 1)
        mixed = np.full(size, n, dtype=np.uint64)
        some = np.zeros(size, dtype=bool)
        for k in range(n):
            mixed = (mixed ^ signs[k : k + size]) * np.uint64(0x9E3779B97F4A7C15)
            some |= letter[k : k + size]
        some &= left[:size] >= n
        yield (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), some


def sparse_counts(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first document, document, bucket, count)`` for consecutive groups of the texts.

    A group holds about half a million signs, or one longer text; so memory does not grow with a batch.
    """
    width = 1 << BUCKET_BITS
    first = 0
    while first < len(texts):
        last, signs = first, 0
        while last < len(texts) and (last == first or signs + len(texts[last]) <= _PIECE) and last - first < 64:
            signs += len(texts[last])
            last += 1
        codes, ends = codes_of(texts[first:last])
        flat = np.zeros((last - first) * width, dtype=np.int64)
        lengths = np.diff(ends, prepend=0)
        owner = np.repeat(np.arange(last - first), lengths) * width
        left = np.repeat(ends, lengths) - np.arange(len(codes))
        for bucket, some in buckets_of(codes, left):
            flat += np.bincount((owner[: len(bucket)] + bucket)[some], minlength=len(flat))
        cells = np.flatnonzero(flat)
        yield first, cells // width, cells % width, flat[cells]
        first = last


@dataclass
class LanguageModel:
    """Languages and their log probabilities, one row of ``weights`` per bucket."""

    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and posterior of each text; ``und`` and 0 for a text without letters."""
        scores = np.tile(self.prior, (len(texts), 1))
        seen = np.zeros(len(texts), dtype=bool)
        for first, doc, bucket, count in sparse_counts(texts):
            if len(doc):
                starts = np.flatnonzero(np.diff(doc, prepend=-1))
                gained = self.weights[bucket] * count[:, None]
                rows = doc[starts] + first
                scores[rows] += np.add.reduceat(gained, starts, axis=0)
                seen[rows] = True
        if not self.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        best = scores.argmax(axis=1)
        odds = np.exp(scores - scores.max(axis=1, keepdims=True))
        posterior = 1.0 / odds.sum(axis=1)
        return [(self.languages[b], float(p)) if s else (UNDETERMINED, 0.0) for b, p, s in zip(best, posterior, seen, strict=True)]


def _part_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        for language, group in batch.groupby("lang"):
            total = totals.setdefault(language, np.zeros(1 << BUCKET_BITS, dtype=np.int64))
            rows[language] = rows.get(language, 0) + len(group)
            for _, _, bucket, count in sparse_counts(group["text"].tolist()):
                np.add.at(total, bucket, count)
    if totals:
        names = list(totals)
        yield pd.DataFrame({"lang": names, "n": [rows[x] for x in names], "counts": [totals[x].tobytes() for x in names]})


def _summed(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, dtype=np.int64) for c in group["counts"])
    return pd.DataFrame({"lang": [key[0]], "n": [int(group["n"].sum())], "counts": [total.tobytes()]})


def drawn_rows(usable: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` rows of ``(key, lang, text)`` in all, and of every language ``LEAST_ROWS`` or what it has.

    Each row is drawn by a hash of its key, text and language, so copies under other keys are drawn one
    by one, and each language by a rate of its own. There is one rate for each language, as in the model.
    """
    sizes = stage(usable.groupBy("lang").agg(F.count("*").alias("n")), "language-sizes")
    most = F.col("n") * rows / F.greatest(sizes.agg(F.sum("n")).scalar(), F.lit(1))
    rates = sizes.select("lang", (F.greatest(most, F.lit(LEAST_ROWS)) / F.col("n")).alias("rate"))
    draw = F.pmod(F.xxhash64("key", "text", "lang"), F.lit(1 << 30)) / (1 << 30)
    return usable.join(F.broadcast(rates), "lang").filter(draw < F.col("rate")).select("lang", "text")


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", rows: int = TRAINING_ROWS, key: str | None = None) -> LanguageModel:
    """Fit on about ``rows`` rows (a documented bound), chosen by a hash of the row, and on some of every language.

    Rows without a text or language are left out. ``key`` names a row; without one, equal texts are drawn
    together. The sample is dealt to a fixed number of parts, so what is summed and sent to the driver is
    (parts or 1) x languages x buckets, whatever the corpus.
    """
    name = F.col(key).cast("string") if key else F.lit(None).cast("string")
    usable = labelled.select(name.alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    usable = drawn_rows(usable.filter("lang is not null and text is not null"), rows)
    schema = "lang string, n bigint, counts binary"
    parts = usable.repartition(TRAINING_PARTS).mapInPandas(_part_counts, schema)
    summed = sorted(parts.groupBy("lang").applyInPandas(_summed, schema).collect())
    counts = np.array([np.frombuffer(row["counts"], dtype=np.int64) for row in summed], dtype=np.float64).reshape(
        len(summed), 1 << BUCKET_BITS
    )
    smoothed = np.log((counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True))
    prior = np.log(np.array([row["n"] for row in summed], dtype=np.float64) / max(1, sum(row["n"] for row in summed)))
    return LanguageModel([row["lang"] for row in summed], prior, np.ascontiguousarray(smoothed.T))


def predict_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """``struct(lang_pred, score)`` of each whole text; ``und`` and 0 for null texts and texts without letters.

    The model is broadcast: 2**14 buckets x 8 bytes per language. An empty model predicts ``und``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            known = [t if isinstance(t, str) else "" for t in texts]
            yield pd.DataFrame(shared.value.predict(known), columns=["lang_pred", "score"])

    return predict(F.col(text))


def identify_languages(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The documents with ``lang_pred`` and ``score``, which replace input columns of the same names."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    found = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), predict_language(docs, model, text).alias("found"))
    return found.select("row.*", "found.*")
