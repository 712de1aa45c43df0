"""Byte-level BPE by a tree of joins: encode halves, mend the boundary, concatenate up the tree.

A text is cut in halves down to short leaves, and a leaf is encoded on its own. Where two halves
meet, a window around the cut is encoded again; it grows until what lies outside is proven not to
change. Two facts prove that:

* Splitting is memoryless. A match of the pattern depends only on the text from its start on, and no
  match holds a letter followed by a non-letter, a number followed by a non-number, or a visible sign
  followed by a space. Such a place (an anchor) is therefore always a boundary, whatever surrounds it.
* Inside one match, tokens t1..tn are its encoding exactly if every neighbouring pair encodes to
  itself. So two halves of a long run join as soon as the window's first and last token form such
  pairs with the tokens outside.

Long runs without an anchor (one letter repeated a million times, say) take the second way, with the
same halving over bytes. Memory is bounded by one text and its tokens.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LEAF, REACH, WIDEST, RUN_LEAF = 8192, 24, 1536, 512


class TreeCodec:
    """Encoder and decoder for one vocabulary of ranks and its splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF, run_leaf: int = RUN_LEAF) -> None:
        import regex
        import tiktoken

        self.leaf, self.run_leaf = max(2, leaf), max(2, run_leaf)
        self._unit = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self._bytes[rank] = token
        self._matches = regex.compile(pattern)
        self._anchor = regex.compile(r"\p{L}(?!\p{L})(?=.)|\p{N}(?!\p{N})(?=.)|\S(?=\s)", regex.DOTALL)
        self._stable: dict[tuple[int, int], bool] = {}

    # -- encoding -------------------------------------------------------------------------------

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def _flat(self, text: str) -> list[int]:
        return self._unit.encode_ordinary(text) if text else []

    def _encode(self, text: str, low: int, high: int) -> list[int]:
        if high - low <= self.leaf:
            return self._flat(text[low:high])
        middle = (low + high) // 2
        reach = REACH
        while True:
            first, last = self._anchor_before(text, low, middle, reach), self._anchor_after(text, middle, high, reach)
            if first is not None and last is not None:
                return self._joined(text, low, first, middle, last, high)
            if reach >= WIDEST:
                break
            reach *= 4
        # A run without an anchor near the cut: its ends are anchors, so the three parts concatenate.
        first, last = self._anchor_before(text, low, middle, middle - low), self._anchor_after(text, middle, high, high - middle)
        first, last = low if first is None else first, high if last is None else last
        tokens = self._encode(text, low, first) if first > low else []
        for match in self._matches.finditer(text[first:last]):
            tokens += self._run(match.group().encode())
        return tokens + (self._encode(text, last, high) if last < high else [])

    def _joined(self, text: str, low: int, first: int, middle: int, last: int, high: int) -> list[int]:
        left, right = self._encode(text, low, middle), self._encode(text, middle, high)
        dropped, skipped = len(self._flat(text[first:middle])), len(self._flat(text[middle:last]))
        return left[: len(left) - dropped] + self._flat(text[first:last]) + right[skipped:]

    def _anchor_before(self, text: str, low: int, middle: int, reach: int) -> int | None:
        """The last anchor at most ``reach`` signs before the cut; the start of the node is one."""
        start = max(low, middle - reach)
        found = None
        for match in self._anchor.finditer(text, start, middle):
            found = match.end()
        return low if found is None and start == low else found

    def _anchor_after(self, text: str, middle: int, high: int, reach: int) -> int | None:
        end = min(high, middle + reach)
        match = self._anchor.search(text, middle, end)
        if match:
            return match.end()
        return high if end == high else None

    # -- one long match ---------------------------------------------------------------------------

    def _run(self, data: bytes) -> list[int]:
        if len(data) <= self.run_leaf:
            return list(self._unit._core_bpe.encode_single_piece(data))
        left, right = self._run(data[: len(data) // 2]), self._run(data[len(data) // 2 :])
        i = j = 2
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = b"".join(self._bytes[t] for t in left[len(left) - i :] + right[:j])
            tokens = list(self._unit._core_bpe.encode_single_piece(window))
            kept = i == len(left) or self._pair(left[-i - 1], tokens[0])
            also = j == len(right) or self._pair(tokens[-1], right[j])
            if kept and also:
                return left[: len(left) - i] + tokens + right[j:]
            i, j = i if kept else 2 * i, j if also else 2 * j

    def _pair(self, a: int, b: int) -> bool:
        known = self._stable.get((a, b))
        if known is None:
            known = list(self._unit._core_bpe.encode_single_piece(self._bytes[a] + self._bytes[b])) == [a, b]
            if len(self._stable) < 1_000_000:
                self._stable[a, b] = known
        return known

    # -- decoding ---------------------------------------------------------------------------------

    def decode(self, tokens: list[int]) -> bytes:
        """The bytes of the tokens, concatenated up the same kind of tree."""
        if len(tokens) <= self.leaf:
            return b"".join(map(self._bytes.__getitem__, tokens))
        middle = len(tokens) // 2
        return self.decode(tokens[:middle]) + self.decode(tokens[middle:])


@lru_cache(maxsize=4)
def codec(path: str, pattern: str, leaf: int = LEAF, run_leaf: int = RUN_LEAF) -> TreeCodec:
    """The codec of a rank file (base64 token, space, rank on each line), read once per worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return TreeCodec(ranks, pattern, leaf, run_leaf)


def encode_text(text: Column, path: str, pattern: str) -> Column:
    """The token ids of each text as an array; a null or empty text has none.

    ``path`` must be readable on every worker; the vocabulary is a file of the installation.
    """

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for texts in batches:
            yield pd.Series([own.encode(t) if t else [] for t in texts], dtype=object)

    return encode(text)


def decode_tokens(tokens: Column, path: str, pattern: str) -> Column:
    """The bytes of each array of ids; null and empty arrays give no bytes."""

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path, pattern)
        for arrays in batches:
            yield pd.Series([own.decode(a.tolist()) if a is not None else b"" for a in arrays], dtype=object)

    return decode(tokens)


def token_digest(text: Column, path: str, pattern: str) -> Column:
    """Encode and decode in one pass: ``n_tokens``, and sha256 of the ids and of the decoded bytes.

    Only the digests leave the worker, so neither ids nor bytes are moved.
    """

    @F.pandas_udf("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(path, pattern)

        def row(text) -> tuple[int, str, str]:
            tokens = own.encode(text) if text else []
            ids = " ".join(map(str, tokens)).encode()
            return len(tokens), hashlib.sha256(ids).hexdigest(), hashlib.sha256(own.decode(tokens)).hexdigest()

        for texts in batches:
            yield pd.DataFrame([row(t) for t in texts], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return digest(text)
