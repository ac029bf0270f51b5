"""Toxicity by weak supervision: many noisy voters, a label model over them, a linear classifier.

1. Lexicons are counted over all labelled training texts: words, and word beginnings of 4 to 6
   letters that occur with several endings (inflected or compounded insults). All terms that speak
   for toxicity by their smoothed log-odds and by evidence are kept, however many there are.
2. Voters look at a text and say toxic or nothing: a built-in list in four groups, the learned
   terms dealt over several voters by kind and hash, and patterns of style.
3. A generative label model explains the votes of a bounded sample of training rows by a hidden
   label. By expectation maximisation it estimates each voter's accuracy, the annotator's (the
   given label) included, and the correlations of voters given the label; voters that say the
   same share one vote. It yields a posterior label per row.
4. A logistic regression is trained on the posteriors. It sees the votes and how many terms of
   what strength a text has; never labels, language, source or id.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from loanrisk.llm.common import BROADCAST_IDS, discard, only, stored, utf8_values

# A small list of English insults, in groups.
SEEDS = (
    ("idiot", "moron", "stupid", "dumb", "imbecile", "fool", "dimwit", "halfwit"),
    ("loser", "worthless", "pathetic", "useless", "failure", "coward", "clown"),
    ("scum", "trash", "garbage", "filth", "vermin", "disgusting", "vile"),
    ("hate", "kill", "shut", "bastard", "jerk", "creep", "freak", "pig"),
)
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
#: Learned terms that are broadcast together, about; more are looked up in several parts.
MOST_TERMS = 100_000
LEAST_TEXTS, LEAST_ENDINGS = 3, 3
LEAST_ODDS = 1.5
#: Chance that any term of a kind is kept though it has nothing to do with toxicity.
CHANCE = 0.05
#: Rows that the label model and the classifier are fitted on, at most.
SAMPLE = 40_000
SHARDS = 3
COUNTED = 200_000
CUT = 0.3


@dataclass
class Lexicon:
    """Learned terms and their log-odds: whole words, and beginnings by length (with their stems)."""

    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[int, dict[str, float]] = field(default_factory=lambda: {n: {} for n in PREFIXES})

    def __post_init__(self) -> None:
        self.stems = {p[: PREFIXES[0]] for table in self.prefixes.values() for p in table}


@dataclass
class Terms:
    """All learned terms (kind, term, odds). Terms with the same first letters share one of `parts`
    parts, so what a word is known by stands in one part and parts can be looked up one by one."""

    table: DataFrame | None = None
    parts: int = 1

    def lexicon(self, part: int = 0) -> Lexicon:
        if self.table is None:
            return Lexicon()
        stem = F.substring("term", 1, PREFIXES[0])
        rows = self.table.where(F.pmod(F.xxhash64(stem), F.lit(self.parts)) == part).toPandas()
        table = lambda n: dict(zip(rows.term[rows.kind == n], rows.odds[rows.kind == n]))
        return Lexicon(table(0), {n: table(n) for n in PREFIXES})


# Names of the voters, in the order of `votes`.
VOTERS = (
    *[f"seed {k}" for k in range(len(SEEDS))],
    *[f"word {k}" for k in range(SHARDS)],
    *[f"beginning {n} {k}" for n in PREFIXES for k in range(SHARDS)],
    "address", "shouting", "exclamations",
)
STRENGTHS = ("seeds", "words", "beginnings", "word odds", "beginning odds")
ADDRESS = re.compile(r"\byou(?:'re| are) (?:an? |such |so )?[a-z]+", re.I)


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def found(text: str, lexicon: Lexicon) -> np.ndarray:
    """The votes (0 or 1), numbers and sums of odds of a text; all 0 for an empty one."""
    out = np.zeros(len(VOTERS) + len(STRENGTHS))
    if not text:
        return out
    words = words_of(text)
    seeds = 0
    for k, group in enumerate(SEEDS):
        hits = len(words.intersection(group))
        out[k] = hits > 0
        seeds += hits
    at = len(SEEDS)
    known = words & lexicon.words.keys()
    for w in known:
        out[at + zlib.crc32(w.encode()) % SHARDS] = 1
    at += SHARDS
    begun = []
    for w in words - known:
        if w[: PREFIXES[0]] in lexicon.stems:
            best = 0.0
            for k, n in enumerate(PREFIXES):
                odds = lexicon.prefixes[n].get(w[:n])
                if odds is not None:
                    out[at + k * SHARDS + zlib.crc32(w[:n].encode()) % SHARDS] = 1
                    best = max(best, odds)
            if best:
                begun.append(best)
    at += SHARDS * len(PREFIXES)
    out[at] = ADDRESS.search(text) is not None
    out[at + 1] = text.isupper()
    out[at + 2] = text.count("!") > 3
    out[len(VOTERS) :] = (seeds, len(known), len(begun), sum(lexicon.words[w] for w in known), sum(begun))
    return out


def joined(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """What two parts of the terms find in a text; what does not depend on terms is in both."""
    out = np.maximum(one, other)
    out[len(VOTERS) + 1 :] = one[len(VOTERS) + 1 :] + other[len(VOTERS) + 1 :]
    return out


def features(whole: np.ndarray) -> np.ndarray:
    """The votes and the strengths from what all terms find in a text."""
    out = whole.copy()
    at = len(VOTERS)
    out[at : at + 3] = [math.log1p(x) for x in whole[at : at + 3]]
    out[at + 3 :] = min(10.0, whole[at + 3]), min(30.0, whole[at + 4])
    return out


def _count_terms(labelled: DataFrame) -> DataFrame:
    """(kind, term, n, n_clean): the toxic and the clean texts that hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {(n, toxic): Counter() for n in (0, *PREFIXES) for toxic in (0, 1)}

        def flush() -> Iterator[pa.RecordBatch]:
            for (kind, toxic), counter in counts.items():
                if counter:
                    seen, none = pa.array(list(counter.values()), pa.int64()), pa.array([0] * len(counter), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([kind] * len(counter), pa.int32()),
                            pa.array(list(counter), pa.string()),
                            *((seen, none) if toxic else (none, seen)),
                        ],
                        names=["kind", "term", "n", "n_clean"],
                    )
                counter.clear()

        for batch in batches:
            for data, toxic in zip(utf8_values(batch.column("text")), batch.column("toxic").to_pylist()):
                words = words_of(data.decode())
                for kind in (0, *PREFIXES):
                    counts[kind, toxic].update({w[:kind] for w in words if len(w) >= kind} if kind else words)
                if sum(map(len, counts.values())) > COUNTED:
                    yield from flush()
        yield from flush()

    rows = labelled.select("text", "toxic").mapInArrow(run, "kind int, term string, n long, n_clean long")
    return rows.groupBy("kind", "term").agg(F.sum("n").alias("n"), F.sum("n_clean").alias("n_clean"))


def learn_terms(labelled: DataFrame, pos_texts: int, neg_texts: int) -> Terms:
    """Terms that speak for toxicity, counted and tested over all rows of `labelled` (text, toxic),
    which holds so many toxic and clean rows."""
    toxic = stored(_count_terms(labelled).where("n > 0"), "toxic_terms")
    endings = F.explode(F.array(*[F.struct(F.lit(n).alias("kind"), F.substring("term", 1, n).alias("term")) for n in PREFIXES]))
    varied = (
        toxic.where("kind = 0")
        .select(endings.alias("p"))
        .groupBy("p.kind", "p.term")
        .agg(F.count(F.lit(1)).alias("endings"))
    )
    candidates = (
        toxic.where(F.col("n") >= LEAST_TEXTS)
        .join(varied, ["kind", "term"], "left")
        .where((F.col("kind") == 0) | (F.col("endings") >= LEAST_ENDINGS))
        .select("kind", "term", "n", "n_clean")
    )
    candidates = stored(candidates, "candidate_terms")
    tested = dict(candidates.groupBy("kind").count().collect())
    p, q = F.col("n") + 0.5, F.col("n_clean") + 0.5
    not_p, not_q = pos_texts - F.col("n") + 0.5, neg_texts - F.col("n_clean") + 0.5
    # How unlikely so many toxic texts are by chance (Chernoff), for all terms tested together.
    texts, base = F.col("n") + F.col("n_clean"), pos_texts / (pos_texts + neg_texts)
    rate = F.col("n") / texts
    other = F.greatest(1 - rate, F.lit(1e-12))
    evidence = texts * (rate * F.log(rate / base) + other * F.log(other / (1 - base)))
    enough = F.lit(False)
    for kind, number in tested.items():
        enough = F.when(F.col("kind") == kind, evidence >= math.log(number / CHANCE)).otherwise(enough)
    kept = (
        candidates.withColumn("odds", F.log(p / not_p) - F.log(q / not_q))
        .where((F.col("odds") >= LEAST_ODDS) & (rate > base) & enough)
        .select("kind", "term", "odds")
    )
    kept = stored(kept, "learned_terms")
    discard(toxic)
    discard(candidates)
    return Terms(kept, max(1, math.ceil(kept.count() / MOST_TERMS)))


def label_model(votes: np.ndarray, given: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, pd.DataFrame]:
    """Posterior P(toxic) per row, and per voter its hit rates and share; the annotator comes last."""
    v = np.column_stack([votes, given]).astype(float)
    n, m = v.shape
    posterior = 0.05 + 0.9 * given
    for _ in range(rounds):
        prior = (posterior.sum() + 1) / (n + 2)
        hit = (posterior @ v + 0.5) / (posterior.sum() + 1)
        miss = ((1 - posterior) @ v + 0.5) / ((1 - posterior).sum() + 1)
        # A voter only ever speaks for toxicity; one that does so at random says nothing.
        miss[:-1] = np.minimum(miss[:-1], hit[:-1])
        # The annotator is mostly right; without this anchor few voters could turn the label over.
        hit[-1], miss[-1] = np.clip(hit[-1], 0.9, 0.999), np.clip(miss[-1], 0.001, 0.05)
        residual = v - np.outer(posterior, hit) - np.outer(1 - posterior, miss)
        spread = residual.std(axis=0) + 1e-9
        correlation = (residual / spread).T @ (residual / spread) / n
        share = 1 / np.clip((correlation**2).sum(axis=1), 1, m)
        share[-1] = 1
        said = np.log(hit / miss)
        silent = np.log((1 - hit) / (1 - miss))
        odds = np.log(prior / (1 - prior)) + (v * said + (1 - v) * silent) @ share
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        done = np.abs(new - posterior).max() < 1e-4
        posterior = new
        if done:
            break
    names = [*VOTERS, "annotator"][-m:] if m <= len(VOTERS) + 1 else range(m)
    return posterior, pd.DataFrame({"voter": names, "hit": hit, "miss": miss, "share": share})


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Weights (the intercept last) of a ridge logistic regression on soft labels, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Model:
    terms: Terms
    weights: np.ndarray
    voters: pd.DataFrame | None = None


def probability(whole: np.ndarray, weights: np.ndarray) -> float:
    """P(toxic) from what all terms find in a text."""
    x = float(features(whole) @ weights[:-1] + weights[-1])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _looked_up(docs: DataFrame, lexicon: Lexicon, text_col: str, name: str) -> DataFrame:
    """Add what one part of the terms finds in every text to what other parts have found."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    @F.pandas_udf(ArrayType(DoubleType()))
    def first(texts: pd.Series) -> pd.Series:
        return pd.Series([found(text or "", shared.value) for text in texts])

    @F.pandas_udf(ArrayType(DoubleType()))
    def further(texts: pd.Series, before: pd.Series) -> pd.Series:
        return pd.Series([joined(x, found(text or "", shared.value)) for text, x in zip(texts, before)])

    text = F.col(f"`{text_col}`")
    return docs.withColumn(name, further(text, F.col(name)) if name in docs.columns else first(text))


def with_found(docs: DataFrame, terms: Terms, text_col: str, name: str) -> DataFrame:
    """Add what all terms find in every text (see `found`). With several parts of terms there is one
    pass over the rows for each, and the rows are written between passes."""
    rows, held = _looked_up(docs, terms.lexicon(), text_col, name), None
    for part in range(1, terms.parts):
        held, last = stored(rows, "found"), held
        if last is not None:
            discard(last)
        rows = _looked_up(held, terms.lexicon(part), text_col, name)
    return rows


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from labelled documents: `documents` has doc_id and text, `labels` doc_id and toxic.

    Labels that are null or neither 0 nor 1 are left out; of several labels of a document the
    larger counts. Terms are counted over all labelled rows, the label model and the classifier
    use `sample` of them (all, if they are fewer), those with the smallest hash. Without labels of both kinds the built-in
    voters decide alone.
    """
    known = (
        only(labels, doc_id="doc_id", toxic="toxic")
        .where("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    known = stored(known, "labels")
    small = known.count() <= BROADCAST_IDS
    labelled = only(documents, doc_id="doc_id", text="text").join(F.broadcast(known) if small else known, "doc_id")
    sizes = dict(labelled.groupBy("toxic").count().collect())
    if len(sizes) < 2:
        weights = np.zeros(len(VOTERS) + len(STRENGTHS) + 1)
        weights[: len(SEEDS)] = 3.0
        weights[-1] = -3.0
        return Model(Terms(), weights)
    terms = learn_terms(labelled, sizes[1], sizes[0])
    # Ids are chosen by hash among those that have a document, before texts are looked at; repeated
    # rows of an id can still be more than the bound.
    by_hash = (F.xxhash64("doc_id"), "doc_id")
    chosen = labelled.select("doc_id").distinct().orderBy(*by_hash).limit(sample)
    rows = labelled.join(F.broadcast(chosen), "doc_id", "left_semi")
    rows = with_found(rows, terms, "text", "x").select("doc_id", "toxic", "x")
    rows = rows.orderBy(*by_hash, "x").limit(sample).select("toxic", "x").toArrow()
    x = np.array([features(np.array(whole)) for whole in rows.column("x").to_pylist()]).reshape(rows.num_rows, -1)
    given = rows.column("toxic").to_numpy().astype(float)
    posterior, voters = label_model(x[:, : len(VOTERS)], given)
    return Model(terms, logistic(x, posterior), voters)


def with_score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """Add P(toxic) of every whole text; null counts as empty, which has a score too."""
    weights = model.weights
    if model.terms.parts > 1:

        @F.pandas_udf(DoubleType())
        def weigh(whole: pd.Series) -> pd.Series:
            return whole.map(lambda x: probability(x, weights)).astype("float64")

        found_in = with_found(docs, model.terms, text_col, "_found")
        return found_in.withColumn(name, weigh("_found")).drop("_found")
    shared = docs.sparkSession.sparkContext.broadcast(model.terms.lexicon())

    @F.pandas_udf(DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        one = lambda text: probability(found(text or "", shared.value), weights)
        return texts.map(one, na_action=None).astype("float64")

    return docs.withColumn(name, score(F.col(f"`{text_col}`")))


def held_out(id_col: str = "doc_id"):
    """The fold that no label is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def score_documents(
    documents: DataFrame, labels: DataFrame, cut: float = CUT, sample: int = SAMPLE
) -> DataFrame:
    """One row per input row: `doc_id`, `held_out`, `score`, `predicted`.

    Only labels outside the held-out fold are learned from. Null and empty texts are scored like
    any other; null ids are not held out; repeated rows are kept; other columns are not read; an
    empty table gives an empty result.
    """
    docs = only(documents, doc_id="doc_id", text="text")
    model = fit(docs, labels.where(~held_out()), sample)
    scored = with_score(docs, model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= cut, 1).otherwise(0).cast("int").alias("predicted"),
    )


def drop_toxic(documents: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The input rows, all columns, whose score is below `cut`; the model is that of `score_documents`."""
    model = fit(documents, labels.where(~held_out()))
    return with_score(documents, model, name="_score").where(F.col("_score") < cut).drop("_score")
