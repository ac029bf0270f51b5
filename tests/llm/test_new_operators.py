"""Lexical search, cutting-stock packing and importance resampling; outputs of the registered queries."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loanrisk.llm import cutting_stock, importance_resampling, lexical_search
from loanrisk.llm.ascii_words import words
from loanrisk.llm.oracle import ORACLES
from loanrisk.llm.queries import QUERIES
from tests.llm.helpers import documents

SMALL = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, " \n "), (4, "x"), (4, "x"), (None, "one two two"), (5, "A-b_c É1 ÉÈ \U0001f600!")]


def texts(rng, n, most=60):
    vocabulary = [f"w{k}" for k in range(30)] + ["É", "the", "THE", "a"]
    return [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(most))) for _ in range(n)]


def test_words():
    text = "Ab c3-Éİx  !\x00z\U0001f600　"
    folded = "".join(c.lower() if c.isascii() else c for c in text)
    want = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
    assert [w.decode() for w in words(text.encode())] == want


# ---- lexical search


def ranked_by_brute_force(docs, queries, k):
    bags = [Counter(words((t or "").encode())) for _, t in docs]
    n_docs, n_words = sum(bool(b) for b in bags), sum(b.total() for b in bags)
    df = Counter(t for b in bags for t in b)
    out = []
    for item, text in queries:
        found = []
        for (doc_id, _), bag in zip(docs, bags):
            score = 0
            for term in set(words((text or "").encode())) & set(bag):
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                m = 50 + (50 * bag.total() * n_docs) // n_words
                score += weight * (1_000_000_000 * bag[term] // (1000 * bag[term] + 20 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if none else doc_id, -score))
    return sorted(out, key=str)


@pytest.mark.parametrize("k, size", [(5, 8_000_000), (50, 200)])
def test_search_by_brute_force(spark, monkeypatch, k, size):
    """Ties, repeated rows and ids, nulls, a block per task, and queries in several groups."""
    monkeypatch.setattr(lexical_search, "QUERY_BYTES", size)
    rng = random.Random(1)
    rows = [*ODD, *enumerate(texts(rng, 250), 10)] + [(7, "w1 w2")] * 5 + [(8, "w3 " * 500)]
    queries = [*enumerate(texts(rng, 25, 12)), (90, None), (91, ""), (92, "unknown"), (3, "w1 w1 w2"), (94, "É1 x")]
    asked = spark.createDataFrame([(*q, 1) for q in queries], "item_id int, text string, rank int")
    out = lexical_search.best_documents(documents(spark, rows), asked, k=k)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, out.collect()), key=str) == ranked_by_brute_force(rows, queries, k)
    assert lexical_search.best_documents(documents(spark, rows).limit(0), asked).count() == 0
    assert lexical_search.best_documents(documents(spark, rows), asked.limit(0)).count() == 0


@pytest.mark.parametrize("wave", [1, 5, 256])
def test_intervals_give_the_best_and_leave_documents_unread(monkeypatch, wave):
    monkeypatch.setattr(lexical_search, "WAVE", wave)
    rng = np.random.default_rng(3)
    n_docs, n_terms = 4000, 12
    places = [np.sort(rng.choice(n_docs, rng.integers(1, 1500), replace=False)) for _ in range(n_terms)]
    held = np.array([len(p) for p in places])
    impacts = np.floor(rng.pareto(1.2, held.sum()) * 100).astype(np.int64)
    block = lexical_search.Block(np.arange(n_terms) * 3, held, np.concatenate(places), impacts)
    top = lexical_search.Top(10)
    asked = np.array([0, 3, 4, 9, 30])
    scored = block.search(asked, top, np.arange(n_docs), np.ones(n_docs, dtype=bool))
    scores = np.zeros(n_docs, dtype=np.int64)
    for k in (0, 1, 3, 10):
        np.add.at(scores, places[k], impacts[held[:k].sum() : held[: k + 1].sum()])
    best = np.lexsort((np.arange(n_docs), -scores))[:10]
    assert top.docs.tolist() == best.tolist() and top.scores.tolist() == scores[best].tolist()
    assert scored < n_docs / 2


def test_a_term_missing_from_a_block_does_not_count_another_twice(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 2)
    rows = [(k, t) for k, t in enumerate(["b b c", "b", "a d", "a c", "", "d a", "c", "b x y"], 1)]
    queries = [(1, "a b"), (2, "c a b d"), (3, "x d c")]
    asked = spark.createDataFrame(queries, "item_id int, text string")
    out = lexical_search.best_documents(documents(spark, rows).coalesce(1), asked)
    assert sorted(map(tuple, out.collect()), key=str) == ranked_by_brute_force(rows, queries, 50)
    block = lexical_search.Block(np.array([2, 5]), np.array([1, 1]), np.array([0, 1]), np.array([7, 4]))
    top = lexical_search.Top(10)
    block.search(np.array([1, 2, 4, 5, 9]), top, np.arange(2), np.ones(2, dtype=bool))
    assert top.docs.tolist() == [0, 1] and top.scores.tolist() == [7, 4]


# ---- cutting-stock packing


@pytest.mark.parametrize("capacity, seed", [(64, 1), (1024, 2), (10, 3), (1, 4), (7, 5)])
def test_plan_places_every_token_once_without_padding(capacity, seed):
    rng = np.random.default_rng(seed)
    sizes = np.maximum(1, rng.lognormal(np.log(capacity) - 0.3, 0.8, 3000)).astype(int)
    counts = np.bincount(sizes % capacity, minlength=capacity + 1)
    counts[0], counts[capacity] = 0, (sizes // capacity).sum()
    plan = cutting_stock.Plan(counts, capacity)
    length = np.repeat(np.arange(capacity + 1), counts)
    rank = np.concatenate([np.arange(n) for n in counts])
    at = plan.places(length, rank)
    assert (at.groupby("row")["size"].sum().to_numpy() == length).all()
    at = at.sort_values(["sequence_id", "offset"])
    ends, number = (at["offset"] + at["size"]).to_numpy(), at.sequence_id.to_numpy()
    first = np.append(True, number[1:] != number[:-1])
    assert (at["offset"].to_numpy() == np.where(first, 0, np.append(0, ends[:-1]))).all()
    last = ends[np.append(first[1:], True)]
    assert all(size == capacity or size & (size - 1) == 0 for size in last.tolist()) and last.max() <= capacity
    assert len(last) <= length.sum() // capacity + capacity.bit_length() + 1
    assert len(plan.rows) <= 6 * capacity + 1  # does not grow with the number of documents


def test_linear_program_gets_rid_of_padding():
    """Halves of 1,000 and a third kind that only fits with two of another: no padding is possible."""
    lengths, demand = np.array([12, 20, 24, 32, 40]), np.array([40, 30, 10, 20, 30])
    program = cutting_stock.Patterns(lengths, demand, 64)
    assert np.allclose(program.columns.T @ program.uses, demand)
    assert (program.uses >= 0).all()
    assert program.costs @ program.uses <= 1.02 * (lengths @ demand) + 64
    start = cutting_stock.Patterns.__new__(cutting_stock.Patterns)
    start.lengths, start.demand, start.capacity = lengths, demand.astype(float), 64
    start._start()
    assert np.allclose(start.columns.T @ start.uses, demand)


def test_packed_documents(spark):
    rng = random.Random(4)
    rows = [*ODD, *enumerate(texts(rng, 150, 700), 10), (9, "word " * 20_000), (8, "<|endoftext|> x")]
    docs = documents(spark, rows)
    out = cutting_stock.pack_documents(docs)
    assert out.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    pieces = out.collect()
    library = Tokenizer.from_file(cutting_stock.VOCABULARY)
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows), key=str)
    by_doc, by_sequence = {}, {}
    for p in pieces:
        ids = cutting_stock.unpacked(p.ids).tolist()
        assert len(ids) == p.length
        by_doc.setdefault(p.doc_id, []).append((p.start, ids, p.doc_tokens))
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, len(ids)))
    for doc_id, ids in want:
        if doc_id != 4:
            parts = sorted(by_doc[doc_id])
            assert [x for _, part, _ in parts for x in part] == ids
            assert {n for _, _, n in parts} == {len(ids)}
            assert [s for s, _, _ in parts] == np.cumsum([0] + [len(part) for _, part, _ in parts[:-1]]).tolist()
    assert sum(len(part) for _, part, _ in by_doc[4]) == sum(len(ids) for i, ids in want if i == 4)
    for parts in by_sequence.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == 1024 or at & (at - 1) == 0
    joined = {r.sequence_id: len(r.ids) // 2 for r in cutting_stock.sequences(out).collect()}
    assert sum(joined.values()) == sum(p.length for p in pieces)
    assert cutting_stock.pack_documents(docs.limit(0)).count() == 0


# ---- importance resampling


def test_crcs_of_ngrams():
    rng = random.Random(5)
    docs = [[rng.choice(["a", "é", "word", "x" * rng.randrange(1, 300)]).encode() for _ in range(rng.randrange(9))] for _ in range(40)]
    hashes = importance_resampling.Hashes(docs)
    flat = [(d, k) for d, doc in enumerate(docs) for k in range(len(doc))]
    for n in (1, 2, 5):
        got, first = hashes.ngrams(n)
        want = [(d, k) for d, k in flat if k + n <= len(docs[d])]
        assert [flat[f] for f in first.tolist()] == want
        assert got.tolist() == [zlib.crc32(b" ".join(docs[d][k : k + n])) for d, k in want]


@pytest.mark.parametrize("least, most, buckets", [(1, 1, 10_000), (1, 2, 100), (2, 3, 70_000)])
def test_resampling_by_brute_force(spark, least, most, buckets):
    rng = random.Random(6)
    rows = [*ODD, *enumerate(texts(rng, 200), 10), (300, "w1 " * 50), (300, "w1 " * 50)]
    target = texts(rng, 20)[:19] + [None]
    wanted = spark.createDataFrame([(k, t, 0) for k, t in enumerate(target)], "item_id long, text string, row int")
    out = importance_resampling.resample(documents(spark, rows), wanted, least, most, buckets, percent=10)

    def features(text):
        w = words((text or "").encode())
        return [zlib.crc32(b" ".join(w[k : k + n])) % buckets for n in range(least, most + 1) for k in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    scored = []
    for doc_id, text in rows:
        found = features(text)
        gains = [
            math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in found
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append([doc_id, len(words((text or "").encode())), len(found), weight, score, None])
    able = sorted((r for r in scored if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for rank, row in enumerate(able[: 10 * len(able) // 100], 1):
        row[5] = rank
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, scored), key=str)
    assert importance_resampling.resample(documents(spark, rows).limit(0), wanted).count() == 0
    assert importance_resampling.resample(documents(spark, rows), wanted.limit(0)).where("rank is not null").count() > 0


# ---- registered queries, every column


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    yield con
    con.close()


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(r[k] for k in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == sorted_rows(columns, result.fetchall())


def crc(ids):
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())


@pytest.fixture(scope="module")
def corpus(duck):
    return [(i, t or "") for i, t in duck.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()]


def encoded(corpus, file, end):
    library = Tokenizer.from_file(public_tokenizers.path(file))
    return {i: library.encode(t, add_special_tokens=False).ids + [end] for i, t in corpus}


def test_byte_bpe_query(spark, corpus):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    want = []
    for i, text in corpus:
        ids = library.encode(text, add_special_tokens=False).ids
        sha = hashlib.sha256(np.asarray(ids, dtype="<u4").tobytes()).hexdigest()
        want.append((i, len(ids), sha, hashlib.sha256(text.encode()).hexdigest()))
    out = QUERIES["op4_byte_bpe"](spark, SMALL).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_ngram_query(spark, corpus):
    sets = {}
    for i, text in corpus:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text))
        sets[i] = {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} if w else set()
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 90 * len(x | y):
                p, q = sorted((root(a), root(b)))
                top[q] = p
    want = [(i, len(sets[i]), root(i)) for i in ids]
    assert sorted(map(tuple, QUERIES["op5_ngram_join"](spark, SMALL).select("doc_id", "n_shingles", "component_id").collect())) == want


def test_cutting_stock_writes_its_pieces_only(spark, monkeypatch):
    written, stored = [], cutting_stock.stored
    monkeypatch.setattr(cutting_stock, "stored", lambda df, purpose: written.append(purpose) or stored(df, purpose))
    docs = documents(spark, [(k, "some words " * (k * 37 % 400)) for k in range(40)]).repartition(5)
    out = cutting_stock.pack_documents(docs)
    assert out.agg(F.sum("length")).first()[0] == out.dropDuplicates(["doc_id"]).agg(F.sum("doc_tokens")).first()[0]
    assert written == ["rests"]


@pytest.mark.parametrize("name, file, end, capacity", [("op6_best_fit_packing", "word_bpe_49k.json", 1, 4096), ("op12_cutting_stock", "byte_bpe_50k.json", 0, 1024)])
def test_packing_queries(spark, corpus, name, file, end, capacity):
    ids = encoded(corpus, file, end)
    rows = QUERIES[name](spark, SMALL).collect()
    places, covered = {}, {i: [] for i in ids}
    for r in rows:
        assert r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length])
        covered[r.doc_id].append((r.start, r.length))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        if name == "op12_cutting_stock":
            assert r.doc_tokens == len(ids[r.doc_id])
        else:
            assert r.start == r.piece * capacity
    for i, parts in covered.items():
        assert sum(n for _, n in parts) == len(ids[i])
        assert [s for s, _ in sorted(parts)] == np.cumsum([0] + [n for _, n in sorted(parts)][:-1]).tolist()
    for parts in places.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0] + [n for _, n in sorted(parts)][:-1]).tolist()
        assert sum(n for _, n in parts) <= capacity
    assert len(places) <= 1.02 * sum(map(len, ids.values())) / capacity + 11


def test_token_file_query(spark, corpus):
    ids, start, want = encoded(corpus, "word_bpe_49k.json", 1), 0, []
    for i in sorted(ids):
        want.append((i, start, len(ids[i]), crc(ids[i])))
        start += len(ids[i])
    out = QUERIES["op7_token_files"](spark, SMALL).select("doc_id", "start", "n_tokens", "ids_crc32")
    assert sorted(map(tuple, out.collect())) == want


def test_secret_query(spark, corpus):
    kinds = {
        "assign": r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        "access": r"(AKIA[A-Z0-9]+)", "hex": r"([0-9a-f]+)",
    }
    least = {"assign": 12, "access": 18, "hex": 16}
    want = {}
    for i, text in corpus:
        found = []
        for rank, (kind, pattern) in enumerate(kinds.items()):
            flags = re.I | re.A if kind == "assign" else 0
            found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text, flags) if len(m[1]) >= least[kind]]
        base = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))
        count = Counter(kind for *_, kind in found)
        want[i] = (count["assign"], count["access"], count["hex"], hashlib.sha256(base.encode()).hexdigest(), base)
    assert any(w[4] for w in want.values())
    for r in QUERIES["op9_secret_scan"](spark, SMALL).collect():
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == want[r.doc_id][:4]
        assert set(filter(None, want[r.doc_id][4].split(","))) <= set(filter(None, r.spans.split(",")))


def test_importance_query_ranks(spark):
    rows = QUERIES["op13_importance_resampling"](spark, SMALL).collect()
    ranks = sorted(r["rank"] for r in rows if r["rank"] is not None)
    assert ranks == list(range(1, len(ranks) + 1)) and ranks
    assert os.path.exists(f"{SMALL}/documents.parquet") and len(rows) == 200
