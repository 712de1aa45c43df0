"""The registered queries: against SQL where there is some, else against plain versions on the whole table."""

import hashlib
import sys
import zlib
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from foldwright.llm import queries as q  # noqa: E402

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/sf0.001/{name}.parquet'")
    return connection


@pytest.fixture()
def texts(duck):
    return dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", sorted(q.statements()))
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = q.registered()[name](spark, sf_dir)
    expected = duck.execute(q.statements()[name])
    names = sorted(c[0] for c in expected.description)
    assert {c[0]: str(c[1]) for c in expected.description} == {c: TYPES[t] for c, t in result.dtypes}
    places = [[c[0] for c in expected.description].index(n) for n in names]
    assert sorted((tuple(r[n] for n in names) for r in result.collect()), key=repr) == sorted(
        (tuple(r[i] for i in places) for r in expected.fetchall()), key=repr
    )


def test_all_ten_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in q.registered()) == list(range(1, 11))


def test_shards(spark, sf_dir, texts):
    rows = q.registered()["op2_byte_shards"](spark, sf_dir).orderBy("doc_id").collect()
    assert [r["doc_id"] for r in rows] == sorted(texts)
    data = {k: t.encode() for k, t in texts.items()}
    total, before, slots = sum(len(b) + 8 for b in data.values()), 0, {}
    for r in rows:
        size = len(data[r["doc_id"]]) + 8
        shard = (2 * before + size) * 24 // (2 * total)
        slot = slots.get(shard, 0)
        assert (r["size"], r["text_crc32"], r["shard"], r["slot"]) == (size, zlib.crc32(data[r["doc_id"]]), shard, slot)
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
        before, slots[shard] = before + size, slot + 1


def test_toxicity_on_the_held_out_fold(spark, duck):
    folder = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in q.registered()["op3_toxicity"](spark, folder).collect()}
    labels = duck.execute(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall()
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    held = [(rows[k]["score"], toxic) for k, toxic in labels if rows[k]["held_out"]]
    bad, good = [s for s, t in held if t], [s for s, t in held if not t]
    auc = sum((b > g) + (b == g) / 2 for b in bad for g in good) / (len(bad) * len(good))
    assert auc > 0.93
    assert sum(g >= 0.7 for g in good) / len(good) < 0.01


def test_language_on_the_held_out_fold(spark, duck):
    folder = "/root/testdata/sf0.01"
    known = dict(duck.execute(f"SELECT doc_id, lang FROM '{folder}/documents.parquet'").fetchall())
    rows = q.registered()["op8_language_id"](spark, folder).collect()
    assert len(rows) == len(known)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang_pred"] == known[r["doc_id"]] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_tokens_equal_the_library(spark, sf_dir, texts):
    import base64

    import tiktoken

    path, pattern = q.tokenizer()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    rows = q.registered()["op9_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        ids = plain.encode_ordinary(text)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), digest)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", ["op4_tool_calls", "op6_mix_sources"])
def test_native_queries_plan_no_python(spark, sf_dir, name):
    plan = q.registered()[name](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
