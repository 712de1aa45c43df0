"""Periodic runs against a search of all periods, with tiles solved here and dealt out; odd rows; the registered query."""

import hashlib
import random
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from foldwright.llm import periodic, queries  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(words, least=24):
    """All periods, one after the other; a stretch with several periods has its smallest."""
    names = {}
    codes = np.array([names.setdefault(w, len(names)) for w in words], dtype=np.int64)
    found = {}
    for q in range(1, len(words) // 3 + 1):
        edges = np.diff(np.concatenate([[0], (codes[:-q] == codes[q:]).astype(int), [0]]))
        for start, end in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
            if end - start + q >= max(least, 3 * q):
                found.setdefault((start, end + q), q)
    return sorted((start, q, end - start) for (start, end), q in found.items())


def plain_kept(words, runs):
    dropped = {i for start, q, length in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in dropped]


def texts(seed):
    """Texts with planted runs of many periods, next to each other, inside each other, and cut short."""
    draw = random.Random(seed)

    def some(n, kinds):
        return [f"w{draw.randrange(kinds)}" for _ in range(n)]

    found = []
    for _ in range(40):
        words = []
        for _ in range(draw.randrange(6)):
            words += some(draw.randrange(30), draw.choice([2, 5, 1000]))
            unit = some(draw.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 60]), draw.choice([1, 2, 1000]))
            words += (unit * 12)[: draw.randrange(len(unit), 9 * len(unit) + 2)]
        found.append(" ".join(words))
    return found


def table(spark, rows):
    return spark.createDataFrame([(k, t, "own", 1) for k, t in rows], "doc_id bigint, text string, runs string, n_words int").repartition(3)


def got(df):
    return sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in df.collect()), key=repr)


def plain(rows, least=24):
    found = []
    for k, text in rows:
        words = WORD.findall(text or "")
        runs = plain_runs(words, least)
        found.append((k, len(words), runs, " ".join(plain_kept(words, runs))))
    return sorted(found, key=repr)


@pytest.mark.parametrize("least", [24, 1, 9, 100])
def test_all_runs_are_found(spark, least):
    rows = list(enumerate(texts(least)))
    docs = table(spark, rows)
    expected = plain(rows, least)
    assert sum(len(r[2]) for r in expected) > 20
    assert got(periodic.periodic_runs(docs, least)) == expected
    # The same when every tile is dealt out.
    assert got(periodic.periodic_runs(docs, least, spread=0)) == expected


def test_long_documents_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(periodic, "TILE_BOUNDARIES", 4)
    draw = random.Random(5)
    unit = [f"u{draw.randrange(900)}" for _ in range(700)]
    rows = [
        (1, " ".join(unit * 5 + unit[:100])),
        (2, "same " * 9000),
        (3, " ".join(f"x{draw.randrange(10**6)}" for _ in range(5000)) + " a b c" * 900),
        (4, "a b " * 3000 + "c " + "a b " * 3000),
    ]
    docs = table(spark, rows)
    assert got(periodic.periodic_runs(docs, spread=100)) == plain(rows)


def test_odd_rows(spark):
    run = "a b c " * 9
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, run), (None, run), (4, run), (4, run), (4, "x " + run), (5, run * 700), (6, "y" * 200_000)]
    docs = table(spark, rows)
    assert got(periodic.periodic_runs(docs)) == plain(rows)
    assert got(periodic.periodic_runs(docs.limit(0))) == []
    # Other spaces are letters of a word.
    assert got(periodic.periodic_runs(table(spark, [(1, "a b " * 30)])))[0][2] == [(0, 1, 30)]


def test_copies_side_by_side_make_no_run(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(i, text) for i in range(50)]
    assert got(periodic.periodic_runs(table(spark, rows).coalesce(1))) == plain(rows)


def test_z_function():
    draw = random.Random(3)
    for _ in range(200):
        s = [draw.randrange(2) for _ in range(draw.randrange(20))]
        reach = periodic.z_function(s)
        for i in range(1, len(s)):
            assert reach[i] == next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i)


def test_registered_query(spark, sf_dir):
    rows = queries.op11_periodic_runs(spark, sf_dir).collect()
    known = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(known)
    for r in rows:
        words = WORD.findall(known[r["doc_id"]] or "")
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = max(runs, key=lambda x: (x[2] / x[1], -x[0], -x[1]), default=None)
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["period"], r["length"]) == (best or (None, None, None))
        assert r["exponent_milli"] == (1000 * best[2] // best[1] if best else None)
        lines = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
        assert r["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(plain_kept(words, runs)).encode()).hexdigest()


def test_replayed_odd_texts(spark):
    """The derived texts, where the original has no words, one word or none at all."""
    chosen = [k for k in range(2000) if zlib.crc32(str(k).encode()) % 10 == 0]
    source = [None, "", " \n", "one", " a  b\tc ", "p q r s t u v w x y z"]
    rows = [(k, source[i % len(source)]) for i, k in enumerate(chosen)]
    for r in queries.replayed(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        words = WORD.findall(dict(rows)[r["doc_id"]] or "")
        n, g = len(words), zlib.crc32(str(r["doc_id"]).encode()) // 10
        if n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert WORD.findall(r["text"] or "") == words
