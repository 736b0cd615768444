"""Toxicity by a factorization machine over hashed terms.

A document is the set of its terms: its lower-cased words and their first four
and five characters (so that inflected forms of a word share a term), each
hashed to 62 bits.  The machine scores

    w0 + sum_i w_i + sum_{i<j} <v_i, v_j>

over the terms present and squashes that to 0..1.  The pairwise part learns
what two terms mean together, such as an insult beside a group mention, which
no sum of single weights can tell.

Training is bounded, whatever the corpus: of the labelled rows that may be
learnt from, the ``max_rows`` with the smallest hash of their id; of their
terms, the ``max_terms`` that tell the labels apart best (chi-square) among
those in at least ``min_docs`` of these rows.  An id with several texts gives one.  Only hashed terms of that
sample reach the driver.  The model (at most ``max_terms * (factors + 2)``
numbers) goes along with the scoring tasks.  Every document is scored, whole;
a task works on ``ROWS`` rows at a time, however large the batches are that Spark
hands it, as each term present takes a row of factors.

Defined cases: a null or empty text has no terms and scores by the bias alone;
rows whose label is neither 0 nor 1 are no training rows; an id labelled more
than once counts as 1 if any label is 1; without a usable training row every
score is 0, and with one class the score is that class's share, smoothed; a
null id is never labelled; repeated rows and extra columns pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.llm.common import written

WORDS = re.compile(r"\w+")
PREFIXES = (4, 5)
KNOWN_WORDS = 1 << 18  # entries of a task's table of words seen
ROWS = 128             # rows whose terms and factors a task holds side by side


@dataclass(frozen=True)
class Model:
    terms: np.ndarray    # hashed terms, sorted
    bias: float
    linear: np.ndarray   # one weight a term
    factors: np.ndarray  # one row a term


def word_terms(word: str) -> list[int]:
    """Hashed terms of one lower-cased word."""
    parts = [word] + [f"{word[:n]}*" for n in PREFIXES if len(word) >= n]
    return [int.from_bytes(hashlib.blake2b(p.encode("utf-8", "surrogatepass"), digest_size=8)
                           .digest(), "big") >> 2 for p in parts]


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, at most ``ROWS`` at a time."""
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def held_out(key: Column, folds: int = 5) -> Column:
    """Rows that no label is learnt from: crc32 of the id as text, modulo ``folds``, is 0."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == 0


def training_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                  label: str = "toxic", max_rows: int = 12_000) -> DataFrame:
    """(label, terms) of the bounded training sample."""
    sample = (labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(F.col(key)))
              .groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("key"), "key").limit(max_rows))
    # at most max_rows rows of two numbers: a bounded side
    found = (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
             .join(F.broadcast(sample), "key"))
    # one text of an id, so that no id outweighs others and max_rows bounds the rows
    found = (found.groupBy("key", "label").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))
             .select("label", "text"))

    def run(batches):
        known: dict[str, list[int]] = {}
        for b in _slices(batches):
            out = []
            for t in b["text"].to_pylist():
                terms: set[int] = set()
                for w in set(WORDS.findall((t or "").lower())):
                    if w not in known:
                        if len(known) >= KNOWN_WORDS:
                            known.clear()
                        known[w] = word_terms(w)
                    terms.update(known[w])
                out.append(sorted(terms))
            yield pa.RecordBatch.from_arrays([b["label"], pa.array(out, pa.list_(pa.int64()))],
                                             names=["label", "terms"])

    return found.mapInArrow(run, "label int, terms array<long>")


def fit(rows: DataFrame, max_terms: int = 4096, min_docs: int = 5, factors: int = 8,
        epochs: int = 30, rate: float = 0.1, l2: float = 1e-4, seed: int = 7) -> Model:
    """Train on (label, terms) rows; see the module text for what bounds them."""
    numbered = written(rows.withColumn("row", F.monotonically_increasing_id()), "training")
    n, pos = numbered.agg(F.count("*"), F.sum("label")).first()
    n, pos = int(n), int(pos or 0)
    empty = (np.zeros(0, np.int64), np.zeros(0), np.zeros((0, factors)))
    if n == 0:
        return Model(empty[0], -np.inf, *empty[1:])
    if pos in (0, n):
        share = (pos + 0.5) / (n + 1)
        return Model(empty[0], float(np.log(share / (1 - share))), *empty[1:])
    single = numbered.select("row", "label", F.explode("terms").alias("term"))
    a = F.sum("label")
    c = F.count("*")
    gap = a * F.lit(float(n)) - c * F.lit(float(pos))
    best = (single.groupBy("term").agg(a.alias("a"), c.alias("c"), gap.alias("gap"))
            .where(F.col("c") >= min_docs)
            .withColumn("chi2", F.col("gap") ** 2 / (F.col("c") * (F.lit(n + 1.0) - F.col("c"))))
            .orderBy(F.desc("chi2"), "term").limit(max_terms).select("term"))
    terms = np.sort(np.array([r[0] for r in best.collect()], np.int64))
    chosen = {int(t) for t in terms}
    kept = numbered.select("row", "label", F.array_intersect(
        "terms", F.lit(sorted(chosen)) if chosen else F.array().cast("array<long>")).alias("terms"))
    data = sorted(kept.collect())
    y = np.array([r[1] for r in data], float)
    lists = [np.searchsorted(terms, np.array(sorted(r[2]), np.int64)) for r in data]
    return Model(terms, *_train(lists, y, len(terms), factors, epochs, rate, l2, seed))


def _train(lists, y, size, factors, epochs, rate, l2, seed):
    """Mini-batch AdaGrad on the logistic loss."""
    rng = np.random.default_rng(seed)
    w0, w = float(np.log(y.mean() / (1 - y.mean()))), np.zeros(size)
    v = rng.normal(0, 0.02, (size, factors))
    g0, gw, gv = 1e-8, np.full(size, 1e-8), np.full((size, factors), 1e-8)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for batch in np.array_split(order, max(1, len(y) // 128)):
            idx = np.concatenate([lists[i] for i in batch])
            row = np.repeat(np.arange(len(batch)), [len(lists[i]) for i in batch])
            z, s = _score(idx, row, len(batch), w0, w, v)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[batch]) / len(batch)
            g0 += err.sum() ** 2
            w0 -= rate * err.sum() / np.sqrt(g0)
            if not len(idx):
                continue
            d = np.bincount(idx, err[row], size) + l2 * w
            gw += d * d
            w -= rate * d / np.sqrt(gw)
            # d/dv_i = err * (sum of the row - v_i)
            push = err[row, None] * (s[row] - v[idx])
            dv = np.zeros_like(v)
            np.add.at(dv, idx, push)
            touched = np.unique(idx)
            dv[touched] += l2 * v[touched]
            gv += dv * dv
            v -= rate * dv / np.sqrt(gv)
    return w0, w, v


def _score(idx, row, n, w0, w, v):
    """Raw scores of n rows and their factor sums; idx and row: terms present, by row."""
    s = np.zeros((n, v.shape[1]))
    q = np.zeros(n)
    z = np.full(n, w0)
    if len(idx):
        part = v[idx]
        for f in range(v.shape[1]):
            s[:, f] = np.bincount(row, part[:, f], n)
        q = np.bincount(row, (part * part).sum(1), n)
        z = z + np.bincount(row, w[idx], n)
    return z + 0.5 * ((s * s).sum(1) - q), s


def with_score(df: DataFrame, model: Model, text: str = "text", score: str = "score",
               columns: list[str] | None = None) -> DataFrame:
    """``df`` (its ``columns``; default all) with a score from 0 to 1."""
    keep = [c for c in (df.columns if columns is None else columns) if c != score]
    needed = keep if text in keep else [*keep, text]
    src = df.select(*needed)
    schema = T.StructType([*[src.schema[c] for c in keep], T.StructField(score, T.DoubleType())])

    def run(batches):
        place = {int(t): i for i, t in enumerate(model.terms)}
        known: dict[str, tuple[int, ...]] = {}
        for b in _slices(batches):
            flat, counts = [], []
            for value in b[text]:
                found: set[int] = set()
                for w in set(WORDS.findall((value.as_py() or "").lower())):
                    hits = known.get(w)
                    if hits is None:
                        if len(known) >= KNOWN_WORDS:
                            known.clear()
                        hits = known[w] = tuple(place[t] for t in word_terms(w) if t in place)
                    if hits:
                        found.update(hits)
                flat += sorted(found)
                counts.append(len(found))
            idx = np.array(flat, np.int64)
            row = np.repeat(np.arange(len(counts)), counts)
            z, _ = _score(idx, row, len(counts), model.bias, model.linear, model.factors)
            p = np.where(np.isneginf(z), 0.0, 1 / (1 + np.exp(-np.clip(z, -500, 500))))
            yield pa.RecordBatch.from_arrays([*[b[c] for c in keep], pa.array(p, pa.float64())],
                                             names=[*keep, score])

    return src.mapInArrow(run, schema)
