"""Source divergence against plain arithmetic on whole numbers: odd rows, ties, large counts, cut pairs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from foldwright.llm import divergence as dv

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def plain(rows, min_df=3, most=200):
    docs = [(lang or "", source or "", Counter(t.translate(LOWER) for t in TERM.findall(text or ""))) for lang, source, text in rows]
    found = []
    for lang in {d[0] for d in docs}:
        here = [d for d in docs if d[0] == lang]
        df, all_counts, groups = Counter(), Counter(), defaultdict(Counter)
        for _, source, c in here:
            df.update(c.keys())
            all_counts.update(c)
            groups[source].update(c)
        kept = [t for t in df if df[t] >= min_df]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        p = {source: shares(c) for source, c in groups.items()}
        q = shares(all_counts)
        for a in groups:
            pairs = [(b, sum((p[a][t] - p[b][t]) ** 2 // p[b][t] for t in kept)) for b in groups if b != a]
            terms = [(t, (p[a][t] - q[t]) ** 2 // q[t]) for t in kept if groups[a][t] and p[a][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, most)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                found += [(lang, a, part, item, value, i + 1) for i, (item, value) in enumerate(items[:limit])]
    return sorted(found)


def run(spark, rows, **settings):
    docs = spark.createDataFrame([(lang, s, t, "own", 1) for lang, s, t in rows], "lang string, source string, text string, value string, rank int")
    out = dv.source_divergence(docs.repartition(3), **settings)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert dict(out.dtypes)["value"] == "bigint" and dict(out.dtypes)["rank"] == "int"
    return sorted(map(tuple, out.collect()))


def some(seed, n=150):
    draw = random.Random(seed)
    words = ["Ärger", "a", "A", "b", "größe", "of", "日本", "É", "é", "naïve", *(f"{x}{y}" for x in "klmnop" for y in "qrstuv")]
    langs, sources = ["en", "de", None, ""], [None, "", "s1", "s2", "s3", "Z", "é"]
    rows = []
    for _ in range(n):
        text = " ".join(draw.choice(words[: draw.choice([4, 12, 46])]) + draw.choice(["", ",", "-x", "9", "_"]) for _ in range(draw.randrange(30)))
        rows.append((draw.choice(langs), draw.choice(sources), draw.choice([text, text, text, text, None, "", "12 !"])))
    return rows


@pytest.mark.parametrize("min_df,most", [(3, 200), (1, 2), (8, 0), (1000, 5)])
def test_equals_plain_arithmetic(spark, min_df, most):
    rows = some(min_df)
    assert run(spark, rows, min_df=min_df, most_terms=most) == plain(rows, min_df, most)


def test_buffers_and_blocks(spark, monkeypatch):
    # Small bounds: blocks of few entries. (Task-side bounds are module constants that workers read anew.)
    monkeypatch.setattr(dv, "BLOCK_ENTRIES", 7)
    monkeypatch.setattr(dv, "small_side", lambda table, _: table)
    rows = some(9)
    assert run(spark, rows) == plain(rows)


def test_no_rows_one_group_repeated_rows_long_text(spark):
    assert run(spark, []) == []
    assert run(spark, [("en", "a", None)]) == []
    one = [("en", "a", "x y z")] * 5
    assert run(spark, one) == plain(one) == []
    two = one + [("en", "b", "x " * 100_000)] * 2
    assert run(spark, two) == plain(two)


def test_partial_sums_are_handed_on(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(dv, "BUFFER_TERMS", 2)
    rows = [("en", "a", b"x y X"), ("en", "a", b"x z"), ("de", "a", None)] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["lang", "source", "text"])
    total = Counter()
    for part in dv._summed([batch]):
        for r in part.to_pylist():
            total[r["lang"], r["source"], r["term"]] += 1000 * r["n"] + r["docs"]
    assert total == {("en", "a", b"x"): 9006, ("en", "a", b"y"): 3003, ("en", "a", b"z"): 3003}


def test_pairs_that_are_cut(monkeypatch):
    draw = np.random.default_rng(2)
    term = np.sort(draw.integers(0, 20, 300))
    group = np.concatenate([draw.permutation(400)[: (term == t).sum()] for t in range(20)]).astype(np.int64)
    share, lacking = draw.integers(1, 10**9, 300), draw.integers(1, 10**6, 300)
    whole = dv.pair_corrections(term, group, share, lacking)
    expected = Counter()
    for i in range(300):
        for j in range(300):
            if term[i] == term[j] and group[i] != group[j]:
                p, q, x, y = (int(v) for v in (share[i], share[j], lacking[i], lacking[j]))
                expected[int(group[i]), int(group[j])] += (p - q) ** 2 // q - (p - y) ** 2 // y - (x - q) ** 2 // q + (x - y) ** 2 // y
    assert whole == dict(expected)
    monkeypatch.setattr(dv, "_PAIRS", 10)
    assert dv.pair_corrections(term, group, share, lacking) == whole


def test_shares_of_large_counts(spark):
    big = 10**17
    row = spark.createDataFrame([(big, 3 * big, 7)], "n bigint, total bigint, size bigint")
    assert row.select(dv._share(row.n, row.total, row.size)).first()[0] == 1 + 10**9 * (big + 1) // (3 * big + 7)
