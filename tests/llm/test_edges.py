"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for every operator."""

import json
import math
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from foldwright.llm import (
    block_search,
    cover_search,
    language_id,
    mixing,
    sharding,
    tool_calls,
    toxicity,
    trie_join,
    url_filter,
)
from foldwright.llm.bpe import codec, decode_tokens, encode_text, token_digest
from foldwright.llm.components import connected_components
from foldwright.llm.queries import ANSWER_SCHEMA, URL_RULES, tokenizer

LONG = "long words stand here " * 20_000
ODD = [(1, None), (2, ""), (3, " \n\t"), (None, "no id"), (4, LONG), (5, "twice"), (5, "twice"), (5, "other"), (6, "x" * 200_000)]


# -- vectors ------------------------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, score string, rank string"


def vectors(spark, rows):
    return spark.createDataFrame([(k, v, "own", "own") for k, v in rows], VECTORS).repartition(4)


def plain_best(rows, every, k, form):
    """Brute force over one usable vector per id: the smallest of those that share an id."""
    usable = {}
    for key, v in rows:
        sound = key is not None and v and all(x is not None and math.isfinite(x) for x in v)
        if sound and (form is not None or any(v)):
            value = [float(np.float32(x)) for x in v]
            value = [math.floor(256 * x) for x in value] if form else value
            usable[key] = min(usable.get(key, value), value)
    found = []
    for a, v in usable.items():
        if a % every == 0:
            scores = []
            for b, w in usable.items():
                if b != a and len(w) == len(v):
                    total = 0 if form else 0.0
                    for x, y in zip(v, w):
                        total += x * y
                    scores.append((-total, b))
            found += [(a, i + 1, b, -s) for i, (s, b) in enumerate(sorted(scores)[:k])]
    return sorted(found)


def odd_vectors(count, seed, dim=6):
    rnd = random.Random(seed)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(dim)]) for i in range(count)]
    common = [0.5] * dim
    rows += [(count + i, common) for i in range(count // 2)]  # a very common vector: ties
    rows += [(10_000, None), (10_001, [None] * dim), (10_050, [float("nan")] * dim), (10_100, [float("inf")] * dim)]
    rows += [(10_150, []), (10_200, [0.0] * dim), (None, common), (0, rows[0][1]), (20, [0.25] * dim), (10_250, [1.0, 2.0])]
    return rows


def test_cover_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(cover_search, "BLOCK_ROWS", 40)
    monkeypatch.setattr(cover_search, "LEAST_ROWS", 8)
    monkeypatch.setattr(cover_search, "LEAF_ROWS", 4)
    monkeypatch.setattr(cover_search, "SAMPLE_ROWS", 32)
    monkeypatch.setattr(cover_search, "ROWS_PER_CENTER", 2)
    rows = odd_vectors(150, 1)
    found = cover_search.top_products(vectors(spark, rows), F.col("id") % 10 == 0, k=5)
    assert sorted(map(tuple, found.collect())) == plain_best(rows, 10, 5, True)


def test_block_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(block_search, "LEAST_ROWS", 16)
    rows = odd_vectors(150, 2)
    found = block_search.nearest_by_product(vectors(spark, rows), F.col("id") % 10 == 0, k=7, most_rows=9)
    assert sorted(map(tuple, found.collect())) == plain_best(rows, 10, 7, None)


def test_wide_vectors_keep_exact_products():
    rnd = np.random.default_rng(3)
    a, b = (rnd.integers(-127, 128, (3, 2500)).astype(np.int8) for _ in range(2))
    assert (block_search._products(a, b) == a.astype(np.int64) @ b.T.astype(np.int64)).all()


@pytest.mark.parametrize("search", [cover_search.top_products, block_search.nearest_by_product])
def test_searches_with_few_or_no_rows(spark, search):
    assert search(vectors(spark, []), F.col("id") % 10 == 0).count() == 0
    assert search(vectors(spark, [(0, [1.0])]), F.col("id") % 10 == 0).count() == 0
    two = search(vectors(spark, [(0, [1.0]), (1, [1.0])]), F.col("id") % 10 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in two] == [(0, 1, 1)]


# -- shards and mixture -------------------------------------------------------------------------


def test_shards_of_odd_rows(spark, documents):
    rows = sharding.shard_by_bytes(documents(ODD + [(7, "same")] * 300), 4).collect()
    assert len(rows) == len(ODD) + 300
    assert sorted(r["size"] for r in rows if r["doc_id"] in (1, 2)) == [8, 8]
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    for shard in range(4):
        inside = [r for r in rows if r["shard"] == shard]
        assert sorted(r["slot"] for r in inside) == list(range(len(inside)))
        assert abs(sum(r["size"] for r in inside) - total / 4) <= largest
    assert sharding.shard_by_bytes(documents([]), 4).count() == 0


def test_shards_of_one_repeated_row_are_even(spark, documents, many_ranges):
    rows = sharding.shard_by_bytes(documents([(1, "same")] * 480, parts=7), 24).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in rows) == [20] * 24


def test_written_shards_hold_the_texts(spark, documents, tmp_path):
    docs = documents([(i, f"text {i}") for i in range(40)])
    sharding.write_shards(docs, sharding.shard_by_bytes(docs, 4), str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted((r["doc_id"], r["text"]) for r in back.collect()) == [(i, f"text {i}") for i in range(40)]


def filled(sizes, weights, share=1.5, most=2.0):
    """Targets by sharing out again and again, as the contract tells it."""
    left, open_, target = share * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        level = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if level * weights[i] > most * sizes[i]}
        if not over:
            for i in open_:
                target[i] = level * weights[i]
            break
        for i in over:
            target[i] = most * sizes[i]
            left -= target[i]
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 1], [1, 1000, 5, 0, 7], [5], [0, 0]])
def test_targets_share_out_the_excess(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes) - 1)] + [None]
    table = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
    wanted = filled(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))])
    assert [got[n] for n in names] == pytest.approx(wanted)


def test_mixture_of_odd_rows(spark, documents):
    rnd = random.Random(4)
    rows = [(i, "w " * rnd.randint(0, 30), None, rnd.choice(["a", "b", "hot", "hot", "hot", None])) for i in range(3000)]
    rows += [(k, t, None, "odd") for k, t in ODD] + [(9000, None, None, "silent")]
    docs = documents(rows)
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows)
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in got)
    for source in ("a", "b", "hot", None):
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
        assert sum(r["size"] for r in own) == own[0]["source_size"]
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix_sources(docs.repartition(11)).collect()), key=repr)
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mixed_documents(docs).count() == sum(r["copies"] for r in got)
    assert mixing.mix_sources(documents([])).count() == 0


def test_a_larger_budget_contains_the_smaller(spark, documents):
    docs = documents([(i, "w " * (i % 7 + 1), None, "s") for i in range(500)])
    small, large = ({r["doc_id"] for r in mixing.mix_sources(docs, share=s).collect() if r["copies"]} for s in (0.3, 0.6))
    assert small < large


# -- texts --------------------------------------------------------------------------------------


def plain_components(rows, width, percent):
    import re

    lower = {c: c + 32 for c in range(65, 91)}
    words = [re.findall(r"[^\x20\x09-\x0d]+", (t or "").translate(lower)) for _, t in rows]
    sets = [
        {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set() for w in words
    ]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in ((i, j) for i in range(len(rows)) for j in range(i)):
        if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j]:
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(least.get(find(i), key), key)
    return sorted(
        ((k, len(s), None if k is None else least[find(i)] if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=repr
    )


@pytest.mark.parametrize(("width", "percent", "block"), [(4, 85, 512), (4, 85, 6), (5, 80, 6), (1, 60, 4), (4, 100, 6)])
def test_components_equal_brute_force(spark, documents, monkeypatch, width, percent, block):
    """Near copies, shared passages and repeated ids; small blocks force the comparison across blocks."""
    monkeypatch.setattr(trie_join, "BLOCK", block)
    rnd = random.Random(percent * block + width)
    names = [f"w{i}" for i in range(50)]
    base = [[rnd.choice(names) for _ in range(rnd.randint(1, 80))] for _ in range(9)]
    passage = [rnd.choice(names) for _ in range(25)]
    rows = list(ODD)
    for i in range(170):
        text = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 4])):
            text[rnd.randrange(len(text))] = rnd.choice(names)
        rows.append((rnd.choice([100 + i, 100 + i, 100 + i, 107]), " ".join(text + passage * (rnd.random() < 0.3))))
    got = trie_join.similar_components(documents(rows, parts=5), width, percent)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=repr) == plain_components(rows, width, percent)


def test_no_documents_have_no_components(spark, documents):
    assert trie_join.similar_components(documents([])).count() == 0
    assert trie_join.similar_components(documents([(1, None), (2, "")])).count() == 2


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000 + i, 100) for i in range(200)] + [(5, 5), (7, None)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert got == {i: 0 for i in range(1, 61)} | {1000 + i: 100 for i in range(200)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_language_of_odd_rows(spark, documents):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("der Hund und die Katze", "de")] * 20)]
    rows += [(100, None, "en"), (101, "the dog", None), (102, "123 !?", "en"), (103, "", None), (104, LONG, None), (105, "ῳ" * 9, None)]
    docs = documents(rows)
    model = language_id.train(docs)
    assert model.languages == ["de", "en"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify_languages(docs, model).collect()}
    assert [got[i] for i in (100, 102, 103)] == [("und", 0.0)] * 3
    assert all(got[i][0] == rows[i][2] for i in range(40)) and got[101][0] == "en" and got[105][0] in ("de", "en")
    bounded = language_id.train(docs, rows=10)
    assert bounded.languages == ["de", "en"]
    clash = documents(rows[:3]).selectExpr("*", "1 as _found", "2 as found", "3 as row")
    others = [c for c in clash.columns if c != "score"]
    assert language_id.identify_languages(clash, model).columns == [*others, "lang_pred", "score"]
    empty = language_id.train(documents([]))
    assert {r["lang_pred"] for r in language_id.identify_languages(docs, empty).collect()} == {"und"}
    assert language_id.identify_languages(documents([]), model).count() == 0


def test_naive_bayes_equals_a_plain_count():
    """Posteriors against counts in dictionaries."""
    texts = {"a": "abba babb a", "b": "cabcab, bca"}
    counts = {k: np.zeros(1 << language_id.BUCKET_BITS) for k in texts}
    for k, t in texts.items():
        for _, _, bucket, count in language_id.sparse_counts([t]):
            np.add.at(counts[k], bucket, count)
        n = sum(any(c.isalpha() for c in g) for order in language_id.ORDERS for g in grams(t, order))
        assert counts[k].sum() == n
    weights = np.array([np.log((c + 0.5) / (c + 0.5).sum()) for c in counts.values()])
    model = language_id.LanguageModel(["a", "b"], np.log([0.5, 0.5]), weights.T.copy())
    for text in ("abb", "bcab"):
        own = np.log([0.5, 0.5])
        for _, _, bucket, count in language_id.sparse_counts([text]):
            own = own + (weights[:, bucket] * count).sum(axis=1)
        wanted = np.exp(own - own.max()) / np.exp(own - own.max()).sum()
        assert model.predict([text])[0][1] == pytest.approx(wanted.max())


def grams(text, order):
    padded = text + "  "
    return [padded[i : i + order] for i in range(len(padded) - order + 1)]


def test_toxicity_tolerates_gaps(spark, documents):
    rnd = random.Random(6)
    plain = ["house", "garden", "river", "window", "letter", "market", "summer", "teacher", "village", "morning"]
    rows, labels = [], []
    for i in range(240):
        words = [rnd.choice(plain) for _ in range(12)]
        if i % 3 == 0:
            words[rnd.randrange(12)] = rnd.choice(["blockhead", "numbskull"])
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(i % 3 == 0), 1))
    labels += [(None, 1, 1), (5000, 1, 1), (3, None, 1)]
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int")
    docs = documents(rows + [(900, None), (901, ""), (None, "x"), (902, LONG)])
    model = toxicity.train(docs, table)
    probes = {
        "plain": "the river in summer", "bad": "you blockhead", "gapped": "you b.l.o.c.k.h.e.a.d", "inserted": "you blockxhead there",
        "spelled": "you n u m b s k u l l", "empty": "", "marks": "numb*skull!",
    }
    scores = dict(zip(probes, model.scores(list(probes.values()))))
    assert all(scores[k] >= 0.7 for k in ("bad", "gapped", "spelled", "marks")), scores
    # A letter more lowers the kernel value, and the score with it, but not to that of a harmless text.
    assert scores["inserted"] > 3 * scores["plain"]
    assert scores["plain"] < 0.3 and scores["empty"] < 0.3
    got = docs.select("doc_id", toxicity.toxicity_score(docs, model).alias("s")).collect()
    assert len(got) == 244 and all(0 <= r["s"] <= 1 for r in got)
    assert {r["s"] for r in got if r["doc_id"] in (900, 901)} == {scores["empty"]}


def test_short_insults_with_inserted_letters(spark, documents):
    """Every place of one and two more letters keeps a kernel value; one letter more still reaches the threshold."""
    from itertools import combinations_with_replacement

    insults = ["scum", "idiot", "moron", "stupid"]
    marks = toxicity.Landmarks(insults, len(insults))
    for i, word in enumerate(insults):
        for count in (1, 2):
            for places in combinations_with_replacement(range(1, len(word)), count):
                probe = word
                for place in reversed(places):
                    probe = probe[:place] + "x" + probe[place:]
                values = marks.similar({probe})[probe]
                assert values is not None and marks.dense(values)[i] > 0, probe

    rnd = random.Random(8)
    plain = ["house", "garden", "river", "window", "letter", "market", "summer", "teacher", "village", "morning"]
    rows = [[rnd.choice(plain) for _ in range(12)] for _ in range(360)]
    for i in range(0, 360, 3):
        rows[i][rnd.randrange(12)] = insults[i // 3 % len(insults)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(360)], "doc_id bigint, toxic int")
    model = toxicity.train(documents([(i, " ".join(r)) for i, r in enumerate(rows)]), labels)
    one = ["scxum", "idxiot", "ixdiot", "mozron", "stuqpid"]
    two = ["scxzum", "ixdxiot", "moqzron", "stuxpzid"]
    scores = dict(zip(one + two + [""], model.scores([f"the {w} in summer" for w in one + two] + [""])))
    assert all(scores[w] >= toxicity.PREDICT_FROM for w in one), scores
    assert all(scores[w] > 2 * scores[""] for w in two), scores
    assert model.scores([" ".join(plain)])[0] < 0.3


def test_insults_between_signs_and_blanks(spark, documents):
    """Insults that signs join to other words or blanks split, short ones and ones in other scripts."""
    rnd = random.Random(9)
    plain = ["house", "garden", "river", "window", "letter", "market", "summer", "teacher", "village", "morning", "улица"]
    insults = ["idiot", "scum", "oaf", "git", "дурак"]
    rows = [[rnd.choice(plain) for _ in range(12)] for _ in range(360)]
    for i in range(0, 360, 3):
        rows[i][rnd.randrange(12)] = insults[i // 3 % len(insults)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(360)], "doc_id bigint, toxic int")
    model = toxicity.train(documents([(i, " ".join(r)) for i, r in enumerate(rows)]), labels)
    probes = ["you...idiot", "idiot/summer", "you-scum", "you,idiot", "<b>idiot</b>you", "you—scum", "id iot", "i d iot", "s cum"]
    probes += ["an oaf", "this git", "дурак", "ты/дурак", "ду рак"]
    scores = dict(zip(probes, model.scores([f"the {p} in summer" for p in probes])))
    assert all(s >= toxicity.PREDICT_FROM for s in scores.values()), scores
    assert model.scores([" ".join(plain)])[0] < 0.3
    # Letters outside a-z are told apart: these were all the same before.
    marks = toxicity.Landmarks(["дурак"], 1)
    swapped = "".join(chr(ord(c) + 4) for c in "дурак")
    assert marks.similar({swapped})[swapped] is None


def test_toxicity_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.train(documents([(1, "a text")]), none)
    assert model.scores(["a text", ""])[0] == pytest.approx(0.5)
    assert toxicity.train(documents([]), none).scores([""]) == pytest.approx([0.5])


def test_kernel_equals_its_definition():
    """The vectorised values against sums over pairs of subsequences."""
    from itertools import combinations

    def vector(word):
        signs = [f"^{word}$"[i] for i in range(len(word) + 2)]
        found = {}
        for places in combinations(range(len(signs)), toxicity.ORDER):
            span = places[-1] - places[0] + 1
            if span <= toxicity.SPAN:
                key = "".join(signs[p] for p in places)
                found[key] = found.get(key, 0) + toxicity.DECAY ** (span - toxicity.ORDER)
        return found

    def kernel(a, b):
        dot = lambda x, y: sum(v * y.get(k, 0) for k, v in x.items())
        va, vb = vector(a), vector(b)
        return dot(va, vb) / math.sqrt(dot(va, va) * dot(vb, vb))

    words = ["blockhead", "numbskull"]
    marks = toxicity.Landmarks(words, 2)
    for probe in ["blockhead", "blokhead", "blxockhead", "numbskulls", "garden", "blockblock"]:
        wanted = [k**toxicity.POWER if (k := kernel(probe, w)) >= toxicity.LEAST else 0 for w in words]
        values = marks.similar({probe})[probe]
        assert ([0, 0] if values is None else marks.dense(values).tolist()) == pytest.approx(wanted, abs=1e-4)
        # A word that is known to resemble none is passed over, others are not.
        plain = np.sort(toxicity._hashes(toxicity._codes(["garden"])))
        again = toxicity.Landmarks(words, 2, plain).similar({probe})[probe]
        assert (again is None) == (values is None)


def test_values_of_sentences_are_the_largest_of_their_words():
    """Sentences measured together against each word measured alone."""
    marks = toxicity.Landmarks(["blockhead", "numbskull", "garden"], 2)
    texts = [
        "A blockhead, a blokhead! The garden. num bskull in the gar den",
        "b l o c k h e a d and n.u.m.b.s.k.u.l.l\n(block-head) block - head",
        "",
        "nothing here",
        "blockheadblockheadblockheadblockheadblockheadblockhead x" * 3,
    ]

    def alone(sentence):
        pieces = [p for t in sentence.split() for p in toxicity._LETTERS.findall(t)]
        words = toxicity.sentence_words(sentence) | marks.joined(pieces)
        found = [marks.dense(v) for w in words if (v := marks.similar({w})[w])]
        return np.max(found, axis=0) if found else None

    wanted = [[v for s in toxicity._SENTENCE.split(t.lower()) if (v := alone(s)) is not None] for t in texts]
    for text, rows, expected in zip(texts, toxicity.measured(marks, texts), wanted, strict=True):
        assert np.allclose(rows, np.array(expected).reshape(-1, 3)) and len(rows) == len(expected), text


def _peak_mb(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_toxicity_does_not_grow_with_a_batch():
    """Long words, and many sentences that resemble a landmark, in one batch."""
    letters = [chr(97 + i) for i in range(26)]
    marks = toxicity.Landmarks(["blockhead", "numbskull", *(f"garden{a}{b}" for a in letters for b in letters[:8])], 2)
    chance = random.Random(0)
    words = {"blockhead" + "".join(chance.choices(letters, k=15)) for _ in range(2000)}
    assert _peak_mb(lambda: marks.similar(words)) < 16
    batch = pd.DataFrame({"text": ["You blockhead went home. A numbskull stays here. " * 100] * 100, "label": 1})
    found = []
    assert _peak_mb(lambda: found.extend(toxicity._worst_sentences(marks)(iter([batch])))) < 24
    assert len(found[0]) == 100 and found[0]["values"].str.len().eq(4 * len(marks.words)).all()


def test_worst_sentence_of_each_text(monkeypatch):
    """However a batch is cut, the first of the worst sentences counts; batches without a suspicious one give no values."""
    marks = toxicity.Landmarks(["blockhead", "numbskull", "garden"], 2)
    texts = ["A garden. A blockhead! A blokhead. A numbskull", "nothing", "", "blockhead blockhead\nnumbskull blockhead"]
    for signs in (1, 12, 1 << 22):
        monkeypatch.setattr(toxicity, "_PIECE", signs)
        rows = toxicity.worst_rows(marks, texts)
        for row, found in zip(rows, toxicity.measured(marks, texts), strict=True):
            assert (row is None) == (len(found) == 0)
            if row is not None:
                assert row.tolist() == found[found[:, :2].sum(axis=1).argmax()].tolist()
        assert rows[0][0] == pytest.approx(1) and rows[3][1] == pytest.approx(1)
    batch = pd.DataFrame({"text": ["nothing here", ""], "label": [0, 1]})
    (made,) = toxicity._worst_sentences(marks)(iter([batch]))
    assert made["label"].tolist() == [0, 1] and made["values"].tolist() == [b"", b""]


def test_every_language_is_drawn(spark):
    """A rare language and one of copies beside a large one, under a small bound."""
    rows = [(i, f"the words of text {i} and more", "en") for i in range(3000)]
    rows += [(i, "der gleiche Text und noch einer", "de") for i in range(3000, 5000)]
    rows += [(i, f"la phrase du texte {i}", "fr") for i in range(5000, 5003)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    model = language_id.train(docs, rows=300, key="doc_id")
    assert model.languages == ["de", "en", "fr"]
    usable = docs.selectExpr("cast(doc_id as string) as key", "lang", "text")
    drawn = {r["lang"]: r["count"] for r in language_id.drawn_rows(usable, 300).groupBy("lang").count().collect()}
    assert drawn["fr"] == 3 and 350 < drawn["en"] < 650 and 350 < drawn["de"] < 650


# -- tokens -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def plain_encoding():
    import base64

    import tiktoken

    path, pattern = tokenizer()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def test_small_trees_equal_the_library(plain_encoding):
    """Leaves of a few signs, so that almost every place is once a boundary."""
    tree = codec(*tokenizer(), leaf=4, run_leaf=3)
    rnd = random.Random(7)
    signs = ["a", "b", "the", "ing", "'", "'s", "'re", "'l", "l", " ", "  ", "\n", "\t", "1", "23", "!", "é", "中", "　", "😀", "²", "́", "\x00"]
    for _ in range(3000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 40)))
        assert tree.encode(text) == plain_encoding.encode_ordinary(text)
        assert tree.decode(tree.encode(text)) == text.encode()
    for sign in ["a", "ab", " ", "' ", "12", "=-", "中文", "théing", " \n"]:
        for _ in range(30):
            text = "x'" + "".join(rnd.choice(sign) for _ in range(rnd.randint(1, 500))) + rnd.choice(["", " x", "s"])
            assert tree.encode(text) == plain_encoding.encode_ordinary(text)


def test_long_runs_equal_the_library(plain_encoding):
    tree = codec(*tokenizer())
    for text in ["a" * 100_000, " " * 100_000 + "x", "ab" * 60_000 + "'s", "中" * 50_000, LONG, "é\n" * 30_000]:
        assert tree.encode(text) == plain_encoding.encode_ordinary(text)


def test_every_token_encodes_to_itself(plain_encoding):
    """The pair rule of the joins rests on this."""
    core = plain_encoding._core_bpe
    assert all(list(core.encode_single_piece(plain_encoding.decode_single_token_bytes(i))) == [i] for i in range(plain_encoding.n_vocab))


def test_tokens_of_odd_rows(spark, documents, plain_encoding):
    docs = documents(ODD)
    ids = encode_text(F.col("text"), *tokenizer())
    back = docs.select("text", ids.alias("ids")).select("text", "ids", decode_tokens(F.col("ids"), *tokenizer()).alias("bytes"))
    for r in back.collect():
        assert r["ids"] == plain_encoding.encode_ordinary(r["text"] or "") and bytes(r["bytes"]) == (r["text"] or "").encode()
    digests = docs.select("text", token_digest(F.col("text"), *tokenizer()).alias("d")).select("text", "d.*").collect()
    assert {r["n_tokens"] for r in digests if not r["text"]} == {0}
    assert documents([]).select(token_digest(F.col("text"), *tokenizer())).count() == 0


# -- urls and tool calls ------------------------------------------------------------------------


def test_urls(spark):
    cases = {
        None: ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "http://": ("", "", None, "allow"),
        "http://WWW.Example.ORG/es/1?q#f": ("www.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/17": ("example.org", "/en/17", "example.org/en/1", "block"),
        "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "http://notexample.org/es/1": ("notexample.org", "/es/1", "org/", "allow"),
        "http://a.com/de/x": ("a.com", "/de/x", "com/de/", "block"),
        "http://com/fr/casino": ("com", "/fr/casino", "com/fr/", "allow"),
        "http://x.net?u=http://y": ("x.net", "", None, "allow"),
        "http://casino.net/": ("casino.net", "/", None, "block"),
        "http://occasinos.net/": ("occasinos.net", "/", None, "allow"),
        "http://cheap.net/free": ("cheap.net", "/free", None, "block"),
        "http://cheap.net/cheap": ("cheap.net", "/cheap", None, "allow"),
        "http://" + "a" * 100_000 + ".net/x": ("a" * 100_000 + ".net", "/x", None, "allow"),
        "http://é.NET/Ünï\ncode": ("é.net", "/Ünï\ncode", None, "allow"),
    }
    rows = [(i, u, "own", "own") for i, u in enumerate(cases)] * 2
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, verdict string")
    got = url_filter.filter_urls(pages, URL_RULES).collect()
    assert len(got) == 2 * len(cases)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == cases[r["url"]], r["url"]
    assert url_filter.filter_urls(pages.limit(0), URL_RULES).count() == 0
    assert url_filter.filter_urls(pages, strict=(), soft=()).filter("verdict = 'block'").count() == 0


def call(name, after=None, arguments=None, tool="answer"):
    return {"id": name, "name": tool, "arguments": arguments or {"words": 1, "topic": "t"}, "after": after or []}


def test_tool_calls(spark):
    say = lambda *calls: json.dumps({"tool_calls": list(calls)})
    rows = [
        (1, 0, "assistant", say(call("c", ["b"]), call("a"), call("b", ["a", "elsewhere"]))),
        (1, 1, "tool", json.dumps({"tool_call_id": "a", "content": {"z": 1, "b": [2, {"y": None, "x": 1.5}]}})),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "late"})),
        (1, 3, "tool", json.dumps({"tool_call_id": "nobody", "content": 1})),
        (2, 0, "assistant", say(call("x", ["y"]), call("y", ["x"]), call("behind", ["x"]), call("free"))),
        (3, 0, "assistant", say(call("m", None, {"topic": 5, "note": "n", "more": 1}), call("u", tool="other"))),
        (None, 0, "assistant", say(call("n"))),
        (4, 0, "user", None),
        (4, 1, "tool", "no json"),
        (4, 2, "assistant", ""),
        (4, 3, "assistant", say({"name": "answer"})),
        (None, None, None, None),
    ]
    messages = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    got = {(r["conv_id"], r["call_id"]): r for r in tool_calls.link_tool_calls(messages, ANSWER_SCHEMA).collect()}
    assert {k: r["level"] for k, r in got.items()} == {
        (1, "a"): 0, (1, "b"): 1, (1, "c"): 2, (2, "x"): None, (2, "y"): None, (2, "behind"): None, (2, "free"): 0,
        (3, "m"): 0, (3, "u"): 0, (None, "n"): 0,
    }
    first = got[1, "a"]
    assert (first["result_turn"], first["n_results"], first["valid"], first["problems"]) == (1, 2, True, "")
    assert first["json"] == '{"arguments":{"topic":"t","words":1},"id":"a","name":"answer","result":{"b":[2,{"x":1.5,"y":null}],"z":1}}'
    assert got[1, "b"]["result_turn"] is None and got[1, "b"]["n_results"] == 0 and got[1, "b"]["json"].endswith('"result":null}')
    assert got[3, "m"]["problems"] == "type of note; type of topic; missing words; unknown more" or sorted(
        got[3, "m"]["problems"].split("; ")
    ) == ["missing words", "type of note", "type of topic", "unknown more"]
    assert got[3, "u"]["problems"] == "unknown tool" and not got[2, "x"]["valid"] and got[2, "free"]["valid"]
    assert tool_calls.link_tool_calls(messages.limit(0), ANSWER_SCHEMA).count() == 0


def test_repeated_call_rows_stay(spark):
    text = json.dumps({"tool_calls": [call("a")]})
    messages = spark.createDataFrame([(1, 0, "assistant", text)] * 3, "conv_id bigint, turn bigint, role string, text string")
    assert tool_calls.link_tool_calls(messages, ANSWER_SCHEMA).count() == 3
