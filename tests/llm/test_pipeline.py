"""The pipeline: each stage against a plain version on its own input, and the whole run."""

import hashlib
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as pipeline  # noqa: E402

from foldwright.llm import mixing, toxicity  # noqa: E402
from foldwright.llm.common import id_crc  # noqa: E402
from foldwright.llm.language_id import identify_languages  # noqa: E402
from foldwright.llm.queries import language_model, table  # noqa: E402
from foldwright.staging import stage  # noqa: E402

from test_edges import plain_components  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_in_order(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = stage(pipeline.STAGES[0][1](spark, docs, sf_dir), "first")
    sure = {r["doc_id"] for r in identify_languages(docs, language_model(docs)).collect() if r["lang_pred"] != "und" and r["score"] >= pipeline.SURE}
    assert kept.columns == COLUMNS and {r["doc_id"] for r in kept.collect()} == sure

    calm = stage(pipeline.STAGES[1][1](spark, kept, sf_dir), "second")
    model = toxicity.train(kept, table(spark, sf_dir, "labels").filter(id_crc("doc_id") % 3 != 1))
    rows = kept.collect()
    plain = {r["doc_id"] for r, s in zip(rows, model.scores([r["text"] for r in rows])) if s < toxicity.PREDICT_FROM}
    assert calm.columns == COLUMNS and {r["doc_id"] for r in calm.collect()} == plain

    single = stage(pipeline.STAGES[2][1](spark, calm, sf_dir), "third")
    groups = plain_components([(r["doc_id"], r["text"]) for r in calm.collect()], pipeline.NEAR_WORDS, pipeline.NEAR_PERCENT)
    assert single.columns == COLUMNS and {r["doc_id"] for r in single.collect()} == {k for k, _, c in groups if k == c}

    mixed = stage(pipeline.STAGES[3][1](spark, single, sf_dir), "fourth")
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(single).collect()}
    assert mixed.columns == COLUMNS
    assert rows_of(mixed) == sorted((r for row in single.collect() for r in [tuple(row)] * copies[row["doc_id"]]), key=repr)

    last = pipeline.STAGES[4][1](spark, mixed, sf_dir)
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert last.count() == mixed.count()
    assert all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in last.collect())


def test_run_is_all_stages(spark, sf_dir):
    result = pipeline.run(spark, sf_dir)
    assert result.columns == ["doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert result.count() > 100
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "toxicity", "near_copies", "mix_sources", "byte_bpe"]


def test_stages_take_odd_documents(spark, sf_dir, documents):
    odd = [(1, None, None, None), (2, "", "en", None), (None, "the id is not there", "en", "a"), (3, "one two three four five six", None, "a")]
    docs = documents(odd + [(3, "one two three four five six", None, "a")] * 2 + [(4, "x " * 50_000, "en", "b"), (5, "123", "en", "b")], extra=("_row", "score"))
    for rows in (docs, docs.limit(0)):
        for _, step in pipeline.STAGES[:-1]:
            assert step(spark, rows, sf_dir).columns == docs.columns
            assert step(spark, rows, sf_dir).count() <= 2 * rows.count()
        assert pipeline.STAGES[-1][1](spark, rows, sf_dir).count() == rows.count()


def test_one_of_repeated_rows_stays(spark, sf_dir, documents):
    docs = documents([(3, "one two three four five six")] * 4 + [(9, "one two three four five six"), (7, "other words stand here alone today")])
    kept = pipeline.drop_near_copies(spark, docs, sf_dir)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 7]


def test_copies_without_an_id_go(spark, sf_dir, documents):
    text, other = "one two three four five six", "seven eight nine ten eleven twelve"
    docs = documents([(None, text)] * 3 + [(None, other), (None, None), (None, ""), (3, text), (4, other + " x" * 40)])
    kept = pipeline.drop_near_copies(spark, docs, sf_dir).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=repr) == sorted(
        [(3, text), (None, other), (None, None), (None, ""), (4, other + " x" * 40)], key=repr
    )
    alone = pipeline.drop_near_copies(spark, documents([(None, text)] * 3), sf_dir).collect()
    assert [(r["doc_id"], r["text"]) for r in alone] == [(None, text)]


def test_texts_that_share_an_id(spark, sf_dir, documents):
    """Two components with the same smallest id both keep a row; a component with two texts under it keeps one."""
    a = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen"
    b = " ".join(f"w{i}" for i in range(30))
    docs = documents([(3, a), (3, b), (5, a), (6, b), (3, b + " w30")])
    kept = pipeline.drop_near_copies(spark, docs, sf_dir).collect()
    assert [r["doc_id"] for r in kept] == [3, 3]
    assert sorted(r["text"].split()[0] for r in kept) == ["one", "w0"]


def test_names_of_the_input_stay(spark, sf_dir, documents):
    """Columns named like those of a stage come back as they were."""
    names = ("_found", "_score", "_hash", "_id", "_text", "row", "found", "score", "key", "text_hash", "group_id", "component_id")
    docs = documents([(i, f"the text number {i} is one of a few in here") for i in range(6)], extra=names)
    for _, step in pipeline.STAGES[:-1]:
        out = step(spark, docs, sf_dir)
        assert out.columns == docs.columns
        before = {r["doc_id"]: tuple(r) for r in docs.collect()}
        assert all(tuple(r) == before[r["doc_id"]] for r in out.collect())
