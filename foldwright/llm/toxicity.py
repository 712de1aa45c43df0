"""Toxicity: a support vector machine over a gap-tolerant subsequence kernel with Nyström landmarks.

The kernel compares two words by their common subsequences of four letters; each occurrence counts
``DECAY`` for every letter that it skips, so letters that are inserted or left out cost little.
Words are what stands between blanks, with the signs inside deleted, and the pieces between such signs.
Two or three neighbouring pieces put together count where they give a telling landmark letter by letter.
Landmarks are words that mark toxic training sentences. A word is described by its normalised kernel
values with them, a sentence by the largest value of any of its words per landmark. Two kernels are used
side by side, both powers of these values: a low one that sees words with inserted letters and a high one
that sees little but the word itself. The Nyström maps (the inverse square roots of the landmarks' own
kernel matrices) turn them into features of a linear machine, fitted on the most suspicious sentence of
each labelled text; where that holds a landmark, it is learned from again with letters inserted in it. A text scores as its worst sentence does, and a
logistic curve fitted on the training margins makes that a probability.

A word's kernel values are taken as 0 below ``LEAST``; an upper bound on them, computed for all words of
a batch at once, leaves few words for the full computation.
"""

from __future__ import annotations

import random
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain, combinations, groupby, pairwise
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwright.llm.common import mixed
from foldwright.staging import stage

ORDER, DECAY, SPAN = 4, 0.9, 9
#: Kernel values below this count as 0: two letters inserted anywhere in a word of four leave more. The
#: others are raised to a power, which is a kernel again, and that to another one by squaring.
LEAST, POWER, SQUARINGS = 0.3, 2, 4
#: So many letters are inserted in the landmarks of training sentences, one copy for each number.
INSERTED = (1, 2, 2)
#: Of a copy in the logistic curve. Copies are no texts, so they weigh less than the sampled ones do.
COPY_WEIGHT = 0.7
#: A copy is lost if it is no further from an empty text than this share of the toxic texts' median.
LOST = 0.1
#: Of a row's error in the machine, and of all rows' together at least.
COST, COST_OF_ALL = 0.05, 25.0
TRAINING_ROWS = 20_000
LANDMARKS, CONTRASTS = 96, 160
PREDICT_FROM = 0.7

#: Both ends of a word are signs of their own, beyond all letters; a word of two letters has a subsequence.
_START, _END = 0x110000, 0x110001
_FEWEST = ORDER - 2
#: Of the numbers of subsequences, and of the table that bounds a word's values.
_WIDE, _ROUGH, _ROUGH_BITS = np.uint64(0x9E3779B97F4A7C15), np.uint32(0x9E3779B1), 18
_LONGEST = 48
_KEPT_WORDS = 300_000
#: Words of the training sample, the most frequent first, of which it is remembered that they resemble no landmark.
PLAIN_WORDS = 300_000
#: Signs of the sentences, and numbers of subsequences, that are looked at together; they bound a worker's memory.
_PIECE, _CELLS = 1 << 20, 1 << 17
_SENTENCE = re.compile(r"[.!?]+(?=\s|$)|\n")
#: Letters that stand alone one after another: "i d i o t".
_LETTERS = re.compile(r"[^\W\d_]+")
_SPELLED = re.compile(r"(?<!\S)\S(?:[ \t]\S){3,}(?!\S)")


def letters_of(word: str) -> str:
    """The letters of a word, lower-cased; signs and digits put between them are dropped."""
    return word if word.isalpha() else "".join(filter(str.isalpha, word))


def token_words(token: str) -> set[str]:
    """What stands between blanks, as it is or without signs, and the pieces between signs."""
    return {token} if token.isalpha() else {*_LETTERS.findall(token), letters_of(token)}


def spelled_words(sentence: str) -> set[str]:
    """Runs of letters that stand alone put together."""
    return {letters_of(m.group()) for m in _SPELLED.finditer(sentence)}


def sentence_words(sentence: str) -> set[str]:
    """Distinct words of a sentence."""
    return set().union(spelled_words(sentence), *map(token_words, set(sentence.split())))


@lru_cache(maxsize=64)
def _places(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rising places of ORDER letters within SPAN of each other in a word of ``size`` letters.

    They are given as all but the last place, each once, then the number of these and the last place for
    every subsequence, and its weight.
    """
    found = [
        (first, *(first + x for x in rest))
        for first in range(size)
        for rest in combinations(range(1, min(SPAN, size - first)), ORDER - 1)
    ]
    places = np.array(found, dtype=np.int64).reshape(-1, ORDER)
    gaps = places[:, -1] - places[:, 0] - (ORDER - 1)
    heads, head = np.unique(places[:, :-1], axis=0, return_inverse=True)
    return heads, head.reshape(-1), places[:, -1], (DECAY**gaps).astype(np.float32)


def _codes(words: list[str]) -> np.ndarray:
    """Code points of equally long words, one column each, with start and end."""
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).reshape(len(words), -1)
    return np.pad(points.T, ((1, 1), (0, 0)), constant_values=((_START, _END), (0, 0)))


def _subsequences(codes: np.ndarray, factor: np.unsignedinteger) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the subsequences of words given by their codes (one column each), and their weights.

    A number mixes the letters with a factor and has as many bits as that; in 64 bits it stands for them.
    """
    heads, head, last, weights = _places(len(codes))
    codes = codes.astype(factor.dtype)
    total = codes[heads[:, 0]]
    for k in range(1, ORDER - 1):
        total = total * factor + codes[heads[:, k]]
    return (total * factor)[head] + codes[last] * (factor >> 7 | 1), weights


def _hashes(codes: np.ndarray) -> np.ndarray:
    """64 bits for each whole word."""
    total = np.zeros(codes.shape[1], dtype=np.uint64)
    for row in codes.astype(np.uint64):
        total = mixed(total * _WIDE + row)
    return total


def _vector(word: str) -> dict[int, float]:
    """The explicit feature vector of one word, of length one."""
    subs, weights = _subsequences(_codes([word]), _WIDE)
    values: dict[int, float] = {}
    for s, w in zip(subs[:, 0].tolist(), weights.tolist(), strict=True):
        values[s] = values.get(s, 0.0) + w
    norm = sum(v * v for v in values.values()) ** 0.5
    return {s: v / norm for s, v in values.items()}


#: Numbers of landmarks, and the values with them that are not 0.
Sparse = tuple[np.ndarray, np.ndarray]


@dataclass
class Landmarks:
    """Words whose kernel values describe other words.

    The first ``telling`` mark toxic texts, the rest are harmless words that resemble those. A word
    counts only if it resembles a telling one. ``plain`` are hashes of words that are known to resemble
    none; they are passed over.
    """

    words: list[str]
    telling: int
    plain: np.ndarray = field(repr=False, default_factory=lambda: np.zeros(0, dtype=np.uint64))
    subs: np.ndarray = field(repr=False, init=False)
    table: np.ndarray = field(repr=False, init=False)
    most: np.ndarray = field(repr=False, init=False)

    def __post_init__(self) -> None:
        vectors = [_vector(w) for w in self.words]
        self._insults = set(self.words[: self.telling])
        self._begun = {w[:i] for w in self._insults for i in range(1, len(w))}
        self.subs = np.array(sorted({s for v in vectors for s in v}), dtype=np.uint64)
        self.table = np.zeros((len(self.subs), len(self.words)), dtype=np.float32)
        # Subsequences that share a place here can only raise a bound.
        self.most = np.zeros(1 << _ROUGH_BITS, dtype=np.float32)
        self._some = np.zeros(1 << _ROUGH_BITS, dtype=bool)
        for i, v in enumerate(vectors):
            self.table[np.searchsorted(self.subs, np.array(list(v), dtype=np.uint64)), i] = list(v.values())
            codes = _codes([self.words[i]])
            rough = self._rough(codes)[0][:, 0]
            self._some[rough] = True
            if i < self.telling:
                exact = [v[s] for s in _subsequences(codes, _WIDE)[0][:, 0].tolist()]
                np.maximum.at(self.most, rough, exact)
        # Few landmarks share a subsequence, so the table is read by its entries.
        owner, self._owner = np.nonzero(self.table)
        self._entries = self.table[owner, self._owner]
        self._heads = np.searchsorted(owner, np.arange(len(self.subs) + 1))
        self._known: dict[str, Sparse | None] = {}

    @staticmethod
    def _rough(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        numbers, weights = _subsequences(codes, _ROUGH)
        return numbers >> (32 - _ROUGH_BITS), weights

    def __getstate__(self) -> dict:
        return {"words": self.words, "telling": self.telling, "plain": self.plain}

    def __setstate__(self, state: dict) -> None:
        self.words, self.telling, self.plain = state["words"], state["telling"], state["plain"]
        self.__post_init__()

    def beginnings(self, tokens: list[str], pieces: dict[str, list[str]]) -> set[str]:
        """The tokens, by their pieces if they have any, with which a telling landmark may begin."""
        return self._begun.intersection(tokens).union(t for t, own in pieces.items() if not self._begun.isdisjoint(own))

    def goes_on(self, start: str) -> bool:
        """Whether a telling landmark is, or begins with, these letters."""
        return start in self._begun or start in self._insults

    def joined(self, pieces: list[str]) -> set[str]:
        """Telling landmarks that two or three neighbouring pieces give, letter by letter."""
        found = set()
        for i, piece in enumerate(pieces[:-1]):
            if piece in self._begun:
                two = piece + pieces[i + 1]
                if two in self._insults:
                    found.add(two)
                if two in self._begun and i + 2 < len(pieces) and two + pieces[i + 2] in self._insults:
                    found.add(two + pieces[i + 2])
        return found

    def forget(self) -> None:
        self._known.clear()

    def similar(self, words: set[str]) -> dict[str, Sparse | None]:
        """Kernel values with the landmarks, or None if no telling one reaches ``LEAST``; kept for later calls.

        A long word is measured in pieces; where several of them have a landmark, the largest value counts.
        """
        if len(self._known) > _KEPT_WORDS:
            self._known.clear()
        known = self._known
        by_size: dict[int, list[tuple[str, str]]] = {}
        for word in words.difference(known):
            known[word] = None
            bare = letters_of(word)
            if _FEWEST <= len(bare) <= _LONGEST // 2:
                by_size.setdefault(len(bare), []).append((word, bare))
                continue
            for start in range(0, max(1, len(bare) - _LONGEST // 2), _LONGEST // 2):
                piece = bare[start : start + _LONGEST]
                if len(piece) >= _FEWEST:
                    by_size.setdefault(len(piece), []).append((word, piece))
        for size, pairs in by_size.items():
            stretch = max(1, min(1024, _CELLS // len(_places(size + 2)[2])))
            for start in range(0, len(pairs), stretch):
                self._measure(pairs[start : start + stretch])
        return known

    def _measure(self, pairs: list[tuple[str, str]]) -> None:
        codes = _codes([piece for _, piece in pairs])
        if len(self.plain):
            hashes = _hashes(codes)
            place = np.minimum(np.searchsorted(self.plain, hashes), len(self.plain) - 1)
            left = np.flatnonzero(self.plain[place] != hashes)
            if not len(left):
                return
            codes, pairs = codes[:, left], [pairs[i] for i in left.tolist()]
        rough, weights = self._rough(codes)
        length = np.sqrt((weights**2).sum())  # of a word that repeats no subsequence; others are longer
        near = np.flatnonzero(weights @ self.most[rough] >= LEAST * length)
        # Only subsequences that a landmark may have are looked up.
        place, word = np.nonzero(self._some[rough[:, near]])
        if not len(word):
            return
        subs = _subsequences(codes[:, near], _WIDE)[0]
        looked = subs[place, word]
        row = np.minimum(np.searchsorted(self.subs, looked), len(self.subs) - 1)
        met = self.subs[row] == looked
        word, row, gain = word[met], row[met], weights[place[met]]
        entry, count = _expanded(self._heads, row)
        cell = np.repeat(word * len(self.words), count) + self._owner[entry]
        summed = np.bincount(cell, np.repeat(gain, count) * self._entries[entry], len(near) * len(self.words))
        values = summed.reshape(len(near), len(self.words))
        chosen = np.flatnonzero(values[:, : self.telling].max(axis=1) >= LEAST * length)
        if not len(chosen):
            return
        values = values[chosen] / _lengths(subs[:, chosen], weights)[:, None]
        values = np.where(values < LEAST, 0, values**POWER).astype(np.float32)
        telling = values[:, : self.telling].any(axis=1)
        row, column = np.nonzero(values[telling])
        heads = np.searchsorted(row, np.arange(telling.sum() + 1)).tolist()
        held = values[telling][row, column]
        for i, first, last in zip(near[chosen[telling]].tolist(), heads, heads[1:], strict=False):
            name = pairs[i][0]
            found = column[first:last], held[first:last]
            before = self._known[name]
            self._known[name] = found if before is None else tuple(map(np.concatenate, zip(before, found, strict=True)))

    def dense(self, values: Sparse) -> np.ndarray:
        row = np.zeros(len(self.words))
        np.maximum.at(row, *values)
        return row


def _lengths(subs: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Lengths of the vectors of words, one column each; a subsequence that occurs again adds to its weight."""
    order = np.argsort(subs, axis=0, kind="stable")
    ordered = np.take_along_axis(subs, order, axis=0).T
    new = np.ones(ordered.shape, dtype=bool)
    new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
    heads = np.flatnonzero(new)
    squares = np.add.reduceat(weights[order].T.ravel(), heads) ** 2
    return np.sqrt(np.bincount(heads // ordered.shape[1], squares))


def _expanded(heads: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of a table by entries: the numbers of all their entries, and how many each row has."""
    count = heads[rows + 1] - heads[rows]
    return np.arange(count.sum()) + np.repeat(heads[rows] - np.cumsum(count) + count, count), count


def _sentence_values(landmarks: Landmarks, sentences: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of the sentences that are not 0: numbers of sentence and landmark, in order, and the largest value of any word.

    Each distinct word is measured once.
    """
    split = list(map(str.split, sentences))
    flat = list(chain.from_iterable(split))
    encoded = pa.array(flat, pa.large_string()).dictionary_encode()
    tokens, codes = encoded.dictionary.to_pylist(), encoded.indices.to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(sentences)), np.fromiter(map(len, split), dtype=np.int64, count=len(split)))
    odd = {t: _LETTERS.findall(t) for t in tokens if not t.isalpha()}

    found: list[tuple[int, str]] = []
    single = np.fromiter((len(t) == 1 for t in tokens), dtype=bool, count=len(tokens))
    for i in np.flatnonzero(np.bincount(owner[single[codes]], minlength=len(sentences)) > 3).tolist():
        found += [(i, word) for word in spelled_words(sentences[i])]
    # Landmarks put together from the pieces of neighbouring tokens, from each token with which one may begin.
    lettered = np.fromiter((t not in odd or bool(odd[t]) for t in tokens), dtype=bool, count=len(tokens))
    begins = np.fromiter(map(landmarks.beginnings(tokens, odd).__contains__, tokens), dtype=bool, count=len(tokens))
    order = np.flatnonzero(lettered[codes])
    line, sentence_of = [flat[i] for i in order.tolist()], owner[order].tolist()
    for at in np.flatnonzero(begins[codes[order]]).tolist():
        own = line[at : at + 3]
        while own and sentence_of[at + len(own) - 1] != sentence_of[at]:
            own.pop()
        if len(own) > 1 and (own[0] in odd or own[1] in odd or landmarks.goes_on(own[0] + own[1])):
            found += [(sentence_of[at], word) for word in landmarks.joined([p for t in own for p in odd.get(t, (t,))])]

    words = {t: {*own, letters_of(t), *landmarks.joined(own)} for t, own in odd.items()}
    known = landmarks.similar(set(tokens).difference(odd).union((word for _, word in found), *words.values()))
    sizes, held = np.zeros(len(tokens) + len(found) + 1, dtype=np.int64), []
    for i, token in enumerate(chain(tokens, (word for _, word in found)), start=1):
        for word in words.get(token, (token,)):
            if values := known[word]:
                sizes[i] += len(values[0])
                held.append(values)
    heads = np.cumsum(sizes)
    columns = np.concatenate([np.zeros(0, dtype=np.int64), *(v[0] for v in held)])
    values = np.concatenate([np.zeros(0, dtype=np.float32), *(v[1] for v in held)])

    rows = np.concatenate([codes, len(tokens) + np.arange(len(found))])
    owner = np.concatenate([owner, np.array([i for i, _ in found], dtype=np.int64)])
    met = heads[rows + 1] > heads[rows]
    entry, count = _expanded(heads, rows[met])
    cell = np.repeat(owner[met], count) * len(landmarks.words) + columns[entry]
    order = np.argsort(cell, kind="stable")
    first = np.flatnonzero(np.diff(cell[order], prepend=-1))
    largest = np.maximum.reduceat(values[entry][order], first) if len(first) else values[:0]
    sentence, landmark = np.divmod(cell[order][first], len(landmarks.words))
    return sentence, landmark, largest


def _pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """The sentences of about a million signs, or one longer sentence, and the numbers of the texts they are from."""
    owners: list[int] = []
    waiting: list[str] = []
    signs = 0
    for i, text in enumerate(texts):
        for sentence in _SENTENCE.split(text.lower()):
            waiting.append(sentence)
            owners.append(i)
            signs += len(sentence) + 1
            if signs > _PIECE:
                yield np.array(owners), waiting
                owners, waiting, signs = [], [], 0
    if waiting:
        yield np.array(owners), waiting


def _suspicious(landmarks: Landmarks, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """The values of each sentence in which a word resembles a landmark, after the number of its text, in order."""
    for owners, sentences in _pieces(texts):
        sentence, landmark, values = _sentence_values(landmarks, sentences)
        for first, last in pairwise([*np.flatnonzero(np.diff(sentence, prepend=-1)).tolist(), len(sentence)]):
            yield int(owners[sentence[first]]), landmarks.dense((landmark[first:last], values[first:last]))


def measured(landmarks: Landmarks, texts: list[str]) -> Iterator[np.ndarray]:
    """For each text one row of values for each sentence in which a word resembles a landmark."""
    rows = groupby(_suspicious(landmarks, texts), key=itemgetter(0))
    owner, found = next(rows, (None, ()))
    for i in range(len(texts)):
        own = []
        if owner == i:
            own = [row for _, row in found]
            owner, found = next(rows, (None, ()))
        yield np.array(own, dtype=np.float64).reshape(-1, len(landmarks.words))


def worst_rows(landmarks: Landmarks, texts: list[str]) -> list[np.ndarray | None]:
    """For each text the row of the sentence that resembles telling landmarks most, or None if none resembles any.

    One row for each text is kept, however many sentences it has.
    """
    worst: list[np.ndarray | None] = [None] * len(texts)
    most = [-1.0] * len(texts)
    for i, row in _suspicious(landmarks, texts):
        if (total := row[: landmarks.telling].sum()) > most[i]:
            worst[i], most[i] = row, total
    return worst


@dataclass
class ToxicityModel:
    landmarks: Landmarks
    nystroem: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def scores(self, texts: list[str]) -> list[float]:
        """Probability of the worst sentence of each; a text without a suspicious one scores as an empty text."""
        margins = np.full(len(texts), self.bias)
        size, slope = len(self.landmarks.words), self.nystroem @ self.weights
        low, high = slope[:size], np.append(slope[size:], np.zeros(size - self.landmarks.telling))
        for owners, sentences in _pieces(texts) if size else ():
            sentence, landmark, values = _sentence_values(self.landmarks, sentences)
            values = values.astype(np.float64)
            gain = values * low[landmark] + _sharp(values) * high[landmark]
            found = np.bincount(sentence, gain, minlength=len(sentences))
            np.maximum.at(margins, owners, found + self.bias)
        return (1 / (1 + np.exp(-np.clip(self.slope * margins + self.offset, -40, 40)))).tolist()


# -- training -----------------------------------------------------------------------------------


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``text, label`` of about ``rows`` labelled texts (a documented bound), chosen by a hash of the id.

    Only ids and labels are counted; an id with several labels is toxic if one says so. The chosen ids
    are broadcast: there are at most about ``rows`` of them, and no text is shuffled.
    """
    named = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("label"))
    known = named.count()
    if known > rows:
        named = named.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int((1 << 30) * rows / known))
    texts = docs.select(F.col(key), F.col(text).alias("text")).filter("text is not null")
    return texts.join(F.broadcast(named), key).select("text", "label")


def _word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    toxic, all_texts = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"], strict=True):
            words = {letters_of(w) for w in sentence_words(text.lower())}
            words = [w for w in words if _FEWEST <= len(w) <= _LONGEST // 2]
            all_texts.update(words)
            if label:
                toxic.update(words)
    if all_texts:
        names = list(all_texts)
        yield pd.DataFrame({"word": names, "bad": [toxic[w] for w in names], "n": list(all_texts.values())})


def _plain(landmarks: Landmarks):
    """Hashes of the words of a table that resemble no landmark."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = landmarks.similar(set(batch["word"]))
            by_size: dict[int, list[str]] = {}
            for word in batch["word"]:
                if known.get(word) is None:
                    by_size.setdefault(len(word), []).append(word)
            hashes = [_hashes(_codes(words)).view(np.int64) for words in by_size.values()]
            yield pd.DataFrame({"hash": np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.int64)})

    return find


def _resembling(landmarks: Landmarks):
    """Words of a table that resemble a landmark, with the largest kernel value."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = landmarks.similar(set(batch["word"]))
            near = [float(v[1].max()) if (v := known.get(w)) else 0.0 for w in batch["word"]]
            yield batch.assign(near=near)[["word", "n", "near"]]

    return find


def choose_landmarks(sample: DataFrame, most: int = LANDMARKS, contrasts: int = CONTRASTS) -> Landmarks:
    """Words that occur far more often in toxic texts, the most telling first, none twice in near form.

    Texts that repeat count once. To them come harmless words that resemble them, the most frequent
    first, so that the machine can tell the two apart.
    """
    sample = sample.groupBy("text").agg(F.max("label").alias("label"))
    bad, n = (int(x or 0) for x in sample.agg(F.sum("label"), F.count("*")).first())
    if not bad or bad == n:
        return Landmarks([], 0)
    counts = sample.mapInPandas(_word_counts, "word string, bad bigint, n bigint").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    counts = stage(counts, "word-counts")
    lift = ((F.col("bad") + 0.5) / (bad + 1)) / ((F.col("n") - F.col("bad") + 0.5) / (n - bad + 1))
    told = counts.withColumn("lift", lift).filter((F.col("bad") >= 3) & (F.col("lift") >= 8))
    ranked = told.orderBy((F.col("bad") * F.log("lift")).desc(), "word").limit(4 * most).collect()
    chosen: list[str] = []
    vectors: list[dict[int, float]] = []
    for row in ranked:
        vector = _vector(row["word"])
        if all(sum(v * other.get(s, 0.0) for s, v in vector.items()) < 0.9 for other in vectors):
            chosen.append(row["word"])
            vectors.append(vector)
        if len(chosen) == most:
            break
    telling = len(chosen)
    if chosen:
        harmless = counts.filter((F.col("n") >= 3) & (F.col("bad") * 2 * n <= F.col("n") * 3 * bad))
        near = harmless.mapInPandas(_resembling(Landmarks(chosen, telling)), "word string, n bigint, near double").filter("near > 0")
        chosen += [r["word"] for r in near.orderBy((F.col("n") * F.col("near")).desc(), "word").limit(contrasts).collect()]
        # A bounded memory of results: what is not in it is measured.
        sizes = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.col("n").desc()).toLocalIterator()
        least, held = 1 << 62, 0
        for row in sizes:
            held += row["words"]
            if held > PLAIN_WORDS:
                break
            least = row["n"]
        frequent = counts.filter(F.col("n") >= least).select("word").repartition(16)
        plain = frequent.mapInPandas(_plain(Landmarks(chosen, telling)), "hash bigint").toArrow().column(0).to_numpy()
        return Landmarks(chosen, telling, np.sort(plain.view(np.uint64)))
    return Landmarks(chosen, telling)


def _sharp(values: np.ndarray) -> np.ndarray:
    for _ in range(SQUARINGS):
        values = values * values
    return values


def both_kernels(values: np.ndarray, telling: int) -> np.ndarray:
    """Values of the low kernel with all landmarks, and of the high one with the telling ones."""
    return np.hstack([values, _sharp(values[:, :telling])])


def _nystroem(landmarks: Landmarks) -> np.ndarray:
    """The maps of both kernels, side by side."""
    low = (landmarks.table.T @ landmarks.table).astype(np.float64) ** POWER
    size, telling = len(low), landmarks.telling
    mapped = np.zeros((size + telling, size + telling))
    for kernel, at in ((low, slice(0, size)), (_sharp(low[:telling, :telling]), slice(size, None))):
        values, vectors = np.linalg.eigh(kernel)
        mapped[at, at] = vectors / np.sqrt(np.maximum(values, 1e-2)) @ vectors.T
    return mapped


def with_inserted(landmarks: Landmarks, z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows, and a copy of each that holds a landmark itself for every number of ``INSERTED`` letters.

    In a copy, values of the landmark that stands in the sentence become those of the word with letters
    inserted at chance places; harmless sentences are copied as toxic ones are.
    """
    chance = random.Random(0)
    rows, labels = [z], [y]
    own = z[:, : landmarks.telling]
    for i in np.flatnonzero(own.max(axis=1) >= 0.9).tolist():
        for inserted in INSERTED:
            copy = np.zeros(z.shape[1])
            for j in np.flatnonzero(own[i] >= 0.9).tolist():
                letters = list(landmarks.words[j])
                for _ in range(inserted):
                    letters.insert(chance.randint(1, len(letters) - 1), chance.choice(string.ascii_lowercase))
                word = "".join(letters)
                if values := landmarks.similar({word})[word]:
                    copy = np.maximum(copy, landmarks.dense(values))
            if copy.any():  # else the letters left nothing of the word, and the copy is like any other text
                rows.append(copy[None])
                labels.append(y[i : i + 1])
    landmarks.forget()
    return np.vstack(rows), np.concatenate(labels)


def fit_machine(x: np.ndarray, y: np.ndarray, cost: float = COST, rounds: int = 50) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, classes weighted evenly, by Newton steps over stretches of rows."""
    signs = np.where(y > 0, 1.0, -1.0)
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) * max(COST_OF_ALL, len(y) * cost)
    ridge = np.ones(x.shape[1] + 1)
    ridge[-1] = 1e-3
    w = np.zeros(len(ridge))
    for _ in range(rounds):
        gradient, curve = ridge * w, np.diag(ridge)
        for start in range(0, len(x), 4096):
            here = slice(start, start + 4096)
            rows = np.hstack([x[here], np.ones((len(x[here]), 1))])
            slack = 1 - signs[here] * (rows @ w)
            pull = np.where(slack > 0, share[here], 0.0)
            gradient = gradient - rows.T @ (pull * signs[here] * slack)
            curve = curve + (rows * pull[:, None]).T @ rows
        step = np.linalg.solve(curve, gradient)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1], float(w[-1])


def fit_curve(margins: np.ndarray, y: np.ndarray, share: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of a logistic curve over weighted margins; slope at least 0.01, so order is kept."""
    full = np.stack([margins, np.ones_like(margins)], axis=1)
    goal = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y <= 0).sum() + 2))
    w = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(full @ w, -40, 40)))
        gradient = full.T @ ((p - goal) * share) + 1e-3 * w
        step = np.linalg.solve((full * (p * (1 - p) * share)[:, None]).T @ full + 1e-3 * np.eye(2), gradient)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(0.01, float(w[0])), float(w[1])


def _worst_sentences(landmarks: Landmarks):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            worst = worst_rows(landmarks, batch["text"].tolist())
            values = [b"" if row is None else row.astype(np.float32).tobytes() for row in worst]
            yield pd.DataFrame({"label": batch["label"].array, "values": values})

    return find


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Fit on a bounded sample of labelled texts; what reaches the driver is one short row per sampled text.

    Without labels of both kinds, or without a word that tells them apart, every text scores the share
    of toxic labels (0.5 / (n + 1) without any label at all).
    """
    sample = stage(training_sample(docs, labels, rows, key, text, label), "toxic-sample")
    landmarks = choose_landmarks(sample)
    if not landmarks.words:
        bad, n = (int(x or 0) for x in sample.agg(F.sum("label"), F.count("*")).first())
        share = (bad + 0.5) / (n + 1) if bad else 0.5 / (n + 1)
        return ToxicityModel(landmarks, np.zeros((0, 0)), np.zeros(0), 0.0, 1.0, float(np.log(share / (1 - share))))
    found = sample.mapInPandas(_worst_sentences(landmarks), "label int, values binary").toArrow()
    z = np.zeros((len(found), len(landmarks.words)))
    for i, values in enumerate(found.column("values")):
        if len(row := np.frombuffer(values.as_py(), dtype=np.float32)):
            z[i] = row
    y = found.column("label").to_numpy()
    sampled = len(y)
    z, y = with_inserted(landmarks, z, y)
    mapped = both_kernels(z, landmarks.telling) @ (nystroem := _nystroem(landmarks))
    weights, bias = fit_machine(mapped, y)
    margins = np.maximum(mapped @ weights + bias, bias)
    # A copy hardly more suspicious than an empty text says nothing of such texts.
    real, found = np.arange(len(y)) < sampled, margins > bias
    lost = bias + LOST * (np.median(margins[real & found & (y > 0)]) - bias) if (real & found & (y > 0)).any() else bias
    share = np.where(real, 1.0, np.where(margins > lost, COPY_WEIGHT, 0.0))
    slope, offset = fit_curve(margins, y, share)
    return ToxicityModel(landmarks, nystroem, weights, bias, slope, offset)


def toxicity_score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> Column:
    """Probability between 0 and 1 for each whole text; null and empty texts get that of no suspicion.

    The model is broadcast: the landmarks and one number for each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for texts in batches:
            yield pd.Series(own.scores([t if isinstance(t, str) else "" for t in texts]), dtype="float64")
        own.landmarks.forget()  # the worker lives on after the task

    return score(F.col(text))
