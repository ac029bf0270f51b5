"""Joins and models: components, blocks, n-gram join, vectors, lines, toxicity, pipeline."""

import math
import random

import numpy as np
import pytest

import corpus_pipeline
from loanrisk.llm import blocks, line_dedup, ngram_join, toxicity, vector_dedup
from loanrisk.llm.components import connected_components
from loanrisk.llm.queries import QUERIES
from tests.llm.helpers import components, documents


def test_components(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(100, 140)] + [(rng.randrange(99), rng.randrange(99)) for _ in range(60)]
    links += [(500, k) for k in range(501, 560)] + [(7, 7), (3, None), (None, None)]
    edges = spark.createDataFrame(links, "a long, b long")
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    want = components({n for pair in real for n in pair}, real)
    assert {r.node: r.component for r in connected_components(edges).collect()} == want
    assert connected_components(edges.limit(0)).count() == 0


def test_blocks_compare_every_pair_of_a_key_once(spark):
    rows = [(k, 0 if k < 60 else k % 7 + 1) for k in range(200)]
    dealt = blocks.paired_blocks(spark.createDataFrame(rows, "id long, key long"), ["key"], "id", most=10)

    def compare(table, starts):
        import pyarrow as pa

        ids, block, other = (table.column(c).to_numpy() for c in ("id", "block", "other"))
        for i, j in blocks.pairs_in_groups(starts, block, other):
            yield pa.RecordBatch.from_pydict({"a": ids[i], "b": ids[j]})

    pairs = blocks.map_groups(dealt, ["key"], compare, "a long, b long").collect()
    got = sorted((min(p), max(p)) for p in pairs)
    assert got == sorted((a, b) for a, ka in rows for b, kb in rows if a < b and ka == kb)


# ---- n-gram join


def near_texts(rng, n):
    words = [f"w{k}" for k in range(400)]
    base = [[rng.choice(words) for _ in range(rng.randrange(1, 120))] for _ in range(n // 6)]
    texts = []
    for _ in range(n):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            text[rng.randrange(len(text))] = rng.choice(words)
        texts.append(" ".join(text).upper() if rng.random() < 0.2 else "\n".join(text))
    return texts


@pytest.mark.parametrize("n, percent", [(3, 90), (5, 80)])
def test_near_copies_by_brute_force(spark, n, percent):
    rows = list(enumerate(near_texts(random.Random(n), 240), 10))
    rows += [(1, None), (2, ""), (3, " \t\n"), (None, rows[0][1]), (4, "One  word"), (5, "one word"), (6, "word"), (rows[3][0], rows[3][1])]
    sets = {}
    for i, t in rows:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    ids = [i for i in sets if i is not None]
    close = lambda a, b: a and 100 * len(a & b) >= percent * len(a | b)
    links = [(a, b) for a in ids for b in ids if a < b and close(sets[a], sets[b])]
    top = components(ids, links)
    out = ngram_join.near_copies(documents(spark, rows), n, percent).collect()
    want = [(i, len(sets[i]), top.get(i)) for i, _ in rows]
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == sorted(want, key=str)
    assert len(links) > 100


def test_no_near_copies_of_nothing(spark):
    docs = documents(spark, [(1, None)])
    assert ngram_join.near_copies(docs.limit(0)).count() == 0
    assert [r.component_id for r in ngram_join.near_copies(docs).collect()] == [1]


# ---- vectors


def test_vectors_by_brute_force(spark):
    rng = np.random.Generator(np.random.PCG64(3))
    centres = rng.standard_normal((25, 16))
    vectors = [(centres[k % 25] + 0.09 * rng.standard_normal(16)).tolist() for k in range(200)]
    rows = list(enumerate(vectors, 5)) + [(900 + k, vectors[0]) for k in range(6)] + [(901, vectors[0])]
    bad = [None, [0.0] * 16, [math.nan] * 16, [math.inf] + [1.0] * 15, [None] + [1.0] * 15, []]
    rows += list(enumerate(bad, 700)) + [(None, vectors[0])]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, links int, bucket int")
    out = vector_dedup.near_vectors(frame, recall=0.999999).collect()
    good = [(k, i, np.array(v) / np.linalg.norm(v)) for k, (i, v) in enumerate(rows) if i is not None and not 700 <= i < 706]
    count, links = {}, []
    for k, i, v in good:
        near = [j for m, j, w in good if m != k and v @ w >= 0.95]
        count[i] = len(near)
        links += [(i, j) for j in near]
    top = components({i for i, _ in rows if i is not None}, links)
    want = [(i, count.get(i, 0), top.get(i), top.get(i) == i) for i, _ in rows]
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out if r.vec_id is not None), key=str) == sorted(
        (w for w in want if w[0] is not None), key=str
    )
    assert [(r.n_links, r.component_id, r.kept) for r in out if r.vec_id is None] == [(0, None, True)]
    assert vector_dedup.near_vectors(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="components"):
        vector_dedup.near_vectors(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>"))


def test_different_vectors_under_one_id_are_counted_apart(spark):
    near = [1.0, 0.01, 0.0, 0.0]
    rows = [(1, [1.0, 0.0, 0.0, 0.0]), (1, [0.0, 0.0, 0.0, 1.0]), (2, near), (7, [1e200, 0.0, 0.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in vector_dedup.near_vectors(frame).collect())
    assert got == [(1, 0, 1), (1, 2, 1), (2, 2, 1), (7, 2, 1)]


def test_more_near_vectors_than_a_block_under_one_id(spark):
    rng = np.random.Generator(np.random.PCG64(8))
    vectors = (np.array([1.0] + [0.0] * 7) + 0.003 * rng.standard_normal((4_500, 8))).tolist()
    frame = spark.createDataFrame([(3, v) for v in vectors], "vec_id long, embedding array<float>")
    out = vector_dedup.near_vectors(frame).groupBy("n_links", "component_id").count().collect()
    assert [tuple(r) for r in out] == [(4_499, 3, 4_500)]


def test_more_vectors_need_longer_hashes():
    for vectors in (10, 1_000, 10**6, 10**10):
        k, tables = vector_dedup.tables_for(vectors, 0.95)
        same = (1 - math.acos(0.95) / math.pi) ** k
        assert 1 - (1 - same) ** tables >= 0.999


# ---- lines


def without_repeats(rows, least):
    """Delete every run of lines with enough words that occurs at an earlier place."""
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda d: (d[0] is not None, d[0] or 0))
    lines = []
    for d, (_, text) in enumerate(docs):
        lines += [(d, k, x.strip(), len(x.split())) for k, x in enumerate(text.split("\n")) if x.split()]
    first, gone = {}, set()
    for a in range(len(lines)):
        content, words = [], 0
        for b in range(a, len(lines)):
            if lines[b][0] != lines[a][0]:
                break
            content.append(lines[b][2])
            words += lines[b][3]
            if first.setdefault(tuple(content), a) < a and words >= least:
                gone.update(range(a, b + 1))
    dropped = {lines[k][:2] for k in gone}
    return {
        docs[d]: "\n".join(x for k, x in enumerate(docs[d][1].split("\n")) if (d, k) not in dropped)
        for d in range(len(docs))
    }


@pytest.mark.parametrize("least", [1, 5, 9])
def test_lines_by_brute_force(spark, least):
    rng = random.Random(least)
    lines = ["a b c", "d", "e f", "g h i j", "", "  a b c ", "k l m n o p q r s t"]
    rows = [(k, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 12)))) for k in range(25)]
    rows += [(30, rows[3][1]), (31, None), (32, ""), (None, rows[4][1]), (33, "\n\n"), (34, "x " * 3000), (35, "x " * 3000), (7, rows[7][1])]
    out = line_dedup.drop_repeated_lines(documents(spark, rows), min_words=least).collect()
    want = without_repeats(rows, least)
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(((i, want[(i, t or "")]) for i, t in rows), key=str)
    for r in out:
        assert r.n_removed <= r.n_lines
    assert line_dedup.drop_repeated_lines(documents(spark, rows).limit(0)).count() == 0


# ---- toxicity


def test_label_model_finds_good_bad_and_copied_voters():
    rng = np.random.Generator(np.random.PCG64(1))
    truth = rng.random(4000) < 0.2
    good, other = ((truth & (rng.random(4000) < 0.8)) | (rng.random(4000) < 0.02) for _ in range(2))
    noise = rng.random(4000) < 0.3
    given = np.where(rng.random(4000) < 0.97, truth, ~truth)
    votes = np.column_stack([good, good, other, noise]).astype(float)
    posterior, voters = toxicity.label_model(votes, given.astype(float))
    assert ((posterior > 0.5) == truth).mean() > 0.96
    assert voters.share[0] < 0.7 < voters.share[2]
    assert abs(voters.hit[3] - voters.miss[3]) < 0.1 and voters.hit[0] > 0.7


def test_toxic_documents_are_found(spark):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("ano", "ira", "ulo", "esto", "anda")]
    rows, labels = [], []
    for k in range(600):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            text += rng.sample(["zorblin", "kwerta", "gruxo" + rng.choice(["an", "el", "is", "ot"])], 2)
        rng.shuffle(text)
        rows.append((k, " ".join(text)))
        labels.append((k, int(toxic)))
    rows += [(700, None), (701, ""), (None, "zorblin kwerta"), (702, "word " * 200_000)]
    labels += [(700, None), (None, 1), (999, 1)]
    docs = documents(spark, rows)
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = toxicity.score_documents(docs, given).toPandas()
    truth = dict(labels[:600])
    tested = out[out.held_out & out.doc_id.isin(truth)]
    assert len(out) == len(rows) and len(tested) > 100
    right = [p == truth[int(i)] for i, p in zip(tested.doc_id, tested.predicted)]
    assert sum(right) >= 0.98 * len(right)
    assert out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.3)).all()
    left = toxicity.drop_toxic(docs, given)
    assert left.columns == docs.columns
    assert 470 <= left.where("doc_id < 600").count() <= 500


def test_toxicity_without_labels_or_documents(spark):
    docs = documents(spark, [(1, "You are an idiot"), (2, "a fine day"), (3, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    found = {r.doc_id: r.predicted for r in toxicity.score_documents(docs, none).collect()}
    assert found == {1: 1, 2: 0, 3: 0}
    assert toxicity.score_documents(docs.limit(0), none).count() == 0


INSULTS = "zorblin kwerta gruxoan plimfet vuskand yabroth quendle hixmar jolvent wumpish drekkol snarvit".split()


def labelled_texts(rng, n, insults):
    """Texts of harmless words, a fifth of them toxic by one insult; and their labels."""
    words = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("ano", "ira", "ulo", "esto", "anda")]
    rows, labels = [], []
    for k in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(5, 40))]
        if k % 5 == 0:
            text.append(insults[k // 5 % len(insults)])
        rows.append((k, " ".join(text)))
        labels.append((k, int(k % 5 == 0)))
    return rows, labels


def test_rare_insults_are_learned_beside_a_text_of_many_words(spark):
    rows, labels = labelled_texts(random.Random(9), 1000, INSULTS)
    letters = "abcdefghij"
    many = " ".join("".join(letters[int(d)] for d in f"{k:07d}") for k in range(0, 9_000_000, 11))
    rows, labels = [*rows, (5000, many)], [*labels, (5000, 1)]
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = toxicity.score_documents(documents(spark, rows), given).toPandas()
    truth = dict(labels[:1000])
    tested = out[out.held_out & out.doc_id.isin(truth)]
    right = [p == truth[int(i)] for i, p in zip(tested.doc_id, tested.predicted)]
    assert len(right) > 150 and sum(right) >= 0.98 * len(right)


@pytest.mark.parametrize("copies", [1, 3])
def test_the_sample_is_taken_from_labels_with_documents(spark, monkeypatch, copies):
    rows, labels = labelled_texts(random.Random(11), 300, INSULTS[:2])
    labels += [(k, 0) for k in range(10_000, 18_000)]
    sizes, model = [], toxicity.label_model
    monkeypatch.setattr(toxicity, "label_model", lambda votes, given: sizes.append(len(given)) or model(votes, given))
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = documents(spark, rows * copies)
    toxicity.fit(docs, given, sample=250)
    toxicity.fit(docs, given, sample=2000)
    assert sizes == [250, 300 * copies]


def test_terms_in_several_parts_give_the_same_scores(spark, monkeypatch):
    rows, labels = labelled_texts(random.Random(10), 400, ["zorblin", "kwerta", "gruxoan", "gruxoel", "gruxois"])
    docs = documents(spark, [*rows, (None, "zorblin kwerta IDIOT"), (700, None), (701, "")])
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    one = toxicity.score_documents(docs, given).toPandas()
    monkeypatch.setattr(toxicity, "MOST_TERMS", 2)
    model = toxicity.fit(docs, given)
    assert model.terms.parts > 2
    parts = toxicity.score_documents(docs, given).toPandas()
    order = ["doc_id", "score"]
    one, parts = one.sort_values(order), parts.sort_values(order)
    assert one.predicted.sum() > 40 and parts.predicted.tolist() == one.predicted.tolist()
    assert np.allclose(parts.score, one.score)
    assert toxicity.drop_toxic(docs, given).columns == docs.columns


# ---- pipeline and registration


def test_registered_queries():
    assert sorted(QUERIES) == sorted(
        ["op1_url_filter", "op2_toxicity", "op3_vector_dedup", "op4_byte_bpe", "op5_ngram_join", "op6_best_fit_packing",
         "op7_token_files", "op8_line_dedup", "op9_secret_scan", "op10_exact_dedup", "op11_lexical_search",
         "op12_cutting_stock", "op13_importance_resampling"]
    )


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(6)
    rows = list(enumerate(near_texts(rng, 60), 10))
    rows += [(k, t) for k, (_, t) in enumerate(rows[:10], 200)]
    rows += [(1, None), (2, ""), (3, "token = abcdefghijklmnop and more"), (4, "you are an idiot and a moron")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i, _ in rows if i != 4] + [(4, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, dict(rows)


def test_pipeline(spark, corpus):
    folder, texts = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept[-1], folder)
        assert out.schema.names == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        path = f"{folder}/{name}.parquet"
        out.write.parquet(path)
        kept.append(spark.read.parquet(path))
    clean, unique, distinct, masked = ({r.doc_id: r.text for r in k.collect()} for k in kept[1:])
    assert 4 in texts and set(clean) >= set(texts) - {4}
    assert set(unique) == {max(i for i in clean if (clean[i] or "") == (t or "")) for t in clean.values()}
    shingles = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for i, t in unique.items()}
    links = [(a, b) for a in unique for b in unique if a < b and shingles[a] and 100 * len(shingles[a] & shingles[b]) >= 80 * len(shingles[a] | shingles[b])]
    assert set(distinct) == set(components(unique, links).values())
    assert set(masked) == set(distinct) and masked[3] == "<SECRET> and more"
    assert all(masked[i] == distinct[i] for i in masked if i != 3)
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in pieces} == set(masked)
    assert sum(r.length for r in pieces) <= 4096 * len({r.sequence_id for r in pieces})


def test_stages_take_empty_tables(spark, corpus):
    folder, _ = corpus
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
