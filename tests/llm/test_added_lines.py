"""Line dedup: plain counts, both ways of cleaning, insertions and deletions, the filter itself, odd rows."""

from collections import Counter

import numpy as np
import pytest

from foldwright.llm import line_dedup as ld

WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
ODD = [
    (1, None),
    (2, ""),
    (3, "same\n SAME \t\nown"),
    (None, "same\r\nother"),
    (None, "same"),
    (4, "Ü same\nÜ"),
    (4, "Ü same\nÜ"),
    (5, "ü\n\n\nsame\n"),
    (6, "x" * 300_000 + "\nsame"),
]


def table(spark, rows):
    return spark.createDataFrame([(k, t, "own", 1) for k, t in rows], "doc_id bigint, text string, kept string, n_lines int").repartition(3)


def key(line):
    return line.strip(WHITE).translate(LOWER)


def plain(indexed, rows, least, chars=1):
    counts = Counter(k for _, t in indexed for k in {key(x) for x in (t or "").split("\n")} if len(k) >= chars)
    found = []
    for k, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if counts[key(x)] < least]
        found.append((k, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(found, key=repr)


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("least,chars", [(1, 1), (2, 1), (2, 4), (5, 1), (6, 1)])
def test_odd_rows(spark, least, chars):
    docs = table(spark, ODD)
    index = ld.build_index(docs, least, chars)
    expected = plain(ODD, ODD, least, chars)
    assert got(ld.clean_documents(index, docs)) == expected
    assert got(ld.clean_by_join(index, docs)) == expected


def test_empty_table(spark):
    docs = table(spark, []).limit(0)
    index = ld.build_index(docs)
    assert got(ld.clean_documents(index, docs)) == []
    added = ld.insert_documents(index, table(spark, ODD))
    assert got(ld.clean_documents(added, table(spark, ODD))) == plain(ODD, ODD, 10)


def test_large_filters_join_instead(spark, monkeypatch):
    docs = table(spark, ODD)
    index = ld.build_index(docs, 2)
    monkeypatch.setattr(ld, "BROADCAST_BYTES", 0)
    assert got(ld.clean_documents(index, docs)) == plain(ODD, ODD, 2)


def counts(index):
    return {(bytes(r["key"]), r["refs"]) for r in ld.references(index).collect()}


def test_deletion_undoes_insertion(spark, monkeypatch):
    monkeypatch.setattr(ld, "MOST_RUNS", 3)
    first = [(i, f"head\nline {i % 7}\nline {i % 11}\nown {i}") for i in range(60)]
    second = [(100 + i, f"HEAD \nline {i % 13}\nown {i}") for i in range(60)]
    a, b = table(spark, first), table(spark, second)
    alone = ld.build_index(a, 8)
    both = ld.insert_documents(alone, b)
    assert got(ld.clean_documents(both, b)) == plain(first + second, second, 8)
    back = ld.delete_documents(both, b)
    assert counts(back) == counts(alone)
    assert got(ld.clean_documents(back, a)) == plain(first, first, 8)
    # The given states stay as they were, and the filters hold the frequent keys alone.
    assert got(ld.clean_documents(both, a)) == plain(first + second, first, 8)
    marks = sum(int((ld.CuckooFilter.from_bytes(bytes(r["filter"])).slots > 0).sum()) for r in back.filters.collect())
    assert marks == sum(n >= 8 for _, n in counts(back))
    # Runs are merged on the way.
    again = ld.delete_documents(ld.insert_documents(back, b), b)
    assert len(again.runs) < 5 and counts(again) == counts(alone)


def test_deleting_what_is_not_there(spark):
    index = ld.build_index(table(spark, [(1, "a")]), 2)
    with pytest.raises(ValueError):
        ld.delete_documents(index, table(spark, [(1, "b")]))


def test_a_full_filter_is_built_again(spark):
    index = ld.build_index(table(spark, [(1, "a"), (2, "a")]), 1)
    many = [(i, "\n".join(f"row {i} {j}" for j in range(50))) for i in range(20)]
    grown = ld.insert_documents(index, table(spark, many))
    assert got(ld.clean_documents(grown, table(spark, many))) == plain(many, many, 1)


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(ld, "SHARD_KEYS", 16)
    rows = [(i, "\n".join(f"shared {j}" for j in range(i % 97, 97)) + f"\nown {i}") for i in range(40)]
    docs = table(spark, rows)
    index = ld.build_index(docs, 5)
    assert index.shard_bits == 3 and index.filters.count() > 4
    assert got(ld.clean_documents(index, docs)) == plain(rows, rows, 5)
    more = [(100 + i, f"own {i % 3}") for i in range(30)]
    assert got(ld.clean_documents(ld.insert_documents(index, table(spark, more)), docs)) == plain(rows + more, rows, 5)


def test_false_hits_are_spared(spark, monkeypatch):
    # With fingerprints of few bits many keys are hit falsely; the counts tell them apart.
    places = ld.CuckooFilter._places
    monkeypatch.setattr(ld.CuckooFilter, "_places", lambda self, keys: places(self, keys & np.uint32(3)))
    frequent = [ld.line_key(b"often", 1)]
    rare = [ld.line_key(f"rare {i}".encode(), 1) for i in range(400)]
    small = ld.filter_of(ld._numbers(frequent))
    hit = small.contains(ld._numbers(rare))
    assert 0 < hit.sum() < 400
    filters = type("Sent", (), {"value": {0: small.to_bytes()}})()
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(rare, pa.binary())], names=["key"])
    spared = [k for b in ld._false_hits(filters, 0)([batch]) for k in b.column(0).to_pylist()]
    assert spared == [k for k, h in zip(rare, hit) if h]
    exceptions = type("Sent", (), {"value": set(spared)})()
    texts = pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array([b"\n".join([b"Often", *(f"rare {i}".encode() for i in range(400))])])], names=["k", "t"]
    )
    schema = pa.schema([(n, pa.null()) for n in ("k", "n_lines", "n_dropped", "kept")])
    done = next(ld._cleaned(filters, exceptions, 0, 1, schema)([texts])).to_pylist()[0]
    assert (done["n_lines"], done["n_dropped"]) == (401, 1)


def test_the_filter():
    draw = np.random.default_rng(1)
    keys = draw.integers(0, 1 << 32, size=(20_000, 4), dtype=np.uint32)
    built = ld.filter_of(keys)
    assert built.contains(keys).all()
    others = draw.integers(0, 1 << 32, size=(100_000, 4), dtype=np.uint32)
    assert built.contains(others).sum() < 3
    built.remove(keys[:10_000])
    assert built.contains(keys[10_000:]).all() and not built.contains(keys[:10_000]).any()
    assert (ld.CuckooFilter.from_bytes(built.to_bytes()).slots == built.slots).all()
    with pytest.raises(ld.FilterFull):
        ld.CuckooFilter.sized(10).add(keys[:100])
