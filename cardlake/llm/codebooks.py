"""Vector codes by product codebooks, with Orchard's search for the nearest entry.

Vectors become integers, ``floor(scale * x)``, and are cut into ``parts`` equal
stretches.  Each part position has a codebook of ``entries`` stretches, fitted
in ``rounds`` rounds of assigning and averaging; a vector's code is the number
of the nearest entry for each part.  All distances are squared and integer.

Orchard's search: for every entry the codebook keeps the other entries sorted
by distance from it.  A part starts at some entry (the one nearest in the first
component) and goes down that entry's list.  An entry that is nearer, or as
near with a smaller number, becomes the new base, and the search goes on at the
top of its list; entries measured before are marked and not measured again.
Once the next entry of the list is more than twice as far from the base as the
part is (four times in squares), it and all after it are farther from the part than
the base, and the search ends.  A batch of parts searches side by side.

Tasks add up their parts by entry, so a round shuffles one row for a task and
entry; the driver holds the codebooks (``entries`` by dimension) only.

Defined cases: left out are vectors that are null, hold a component that is
null, not finite, or of 2**26 or more as an integer (their squared distances
wouldn't fit a long), or differ in length from the one with the smallest id;
null ids come last among the starting entries; repeated ids and equal
vectors are rows of their own (of equal ids the smaller vector starts first);
a codebook has as many entries as there are vectors, if these are fewer; an
entry without parts stays; null labels are one label; an empty table gives an
empty one; other columns are ignored.  A length that ``parts`` doesn't divide is an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.centroids import as_rows, whole_numbers
from cardlake.llm.common import small, written

LIMIT = 1 << 26  # exclusive bound of an integer component
SLICE = 1 << 16  # parts that search side by side


class Codebook:
    """The entries of one part position with their sorted neighbour lists."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        d = entries[:, None, :] - entries[None, :, :]
        between = np.einsum("abi,abi->ab", d, d)
        # an entry itself comes first in its list (equal entries: the smaller number)
        self.list = np.lexsort((np.broadcast_to(np.arange(len(entries)), between.shape), between))
        self.far = np.take_along_axis(between, self.list, 1)
        order = np.lexsort((np.arange(len(entries)), entries[:, 0]))
        self.by_first, self.first = order, entries[order, 0]

    def _start(self, x: np.ndarray) -> np.ndarray:
        right = np.searchsorted(self.first, x[:, 0]).clip(max=len(self.first) - 1)
        left = np.maximum(right - 1, 0)
        nearer = np.abs(self.first[left] - x[:, 0]) <= np.abs(self.first[right] - x[:, 0])
        return self.by_first[np.where(nearer, left, right)]

    def _squares(self, x: np.ndarray, which: np.ndarray) -> np.ndarray:
        d = x - self.entries[which]
        return np.einsum("ij,ij->i", d, d)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(nearest entry, squared distance, distances measured) of each row of ``x``."""
        base = self._start(x)
        best = self._squares(x, base)
        seen = np.zeros((len(x), len(self.entries)), bool)
        seen[np.arange(len(x)), base] = True
        at = np.zeros(len(x), np.int64)
        open_, measured = np.arange(len(x)), len(x)
        while len(open_):
            b, place = base[open_], at[open_]
            going = self.far[b, place] <= 4 * best[open_]
            open_, b, place = open_[going], b[going], place[going]
            other = self.list[b, place]
            new = ~seen[open_, other]
            rows, which = open_[new], other[new]
            seen[rows, which] = True
            measured += len(rows)
            d = self._squares(x[rows], which)
            nearer = (d < best[rows]) | ((d == best[rows]) & (which < base[rows]))
            at[open_] = place + 1
            moved = rows[nearer]
            base[moved], best[moved], at[moved] = which[nearer], d[nearer], 0
            open_ = open_[at[open_] < len(self.entries)]
        return base, best, measured


def _coded(x: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the rows of ``x`` (a column for each part) and their summed squared distances."""
    size = x.shape[1] // len(books)
    codes, error = np.empty((len(x), len(books)), np.int64), np.zeros(len(x), np.int64)
    for i in range(0, len(x), SLICE):
        for p, book in enumerate(books):
            codes[i:i + SLICE, p], d, _ = book.nearest(x[i:i + SLICE, p * size:(p + 1) * size])
            error[i:i + SLICE] += d
    return codes, error


def _next_books(points: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round over (parts, entries, size): floors of the means, unused entries as they are."""
    parts, entries, size = books.shape

    def run(batches):
        made = [Codebook(b) for b in books]
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, size), object)
        for b in batches:
            x = as_rows(b["x"], parts * size)
            codes, _ = _coded(x, made)
            for p in range(parts):
                mine = x[:, p * size:(p + 1) * size]
                for e in np.unique(codes[:, p]):
                    rows = mine[codes[:, p] == e]
                    n[p, e] += len(rows)
                    total[p, e] += rows.sum(0)
        p, e = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(n[p, e]),
             pa.array([[str(v) for v in t] for t in total[p, e]], pa.list_(pa.string()))],
            names=["part", "entry", "n", "total"])

    sums = (points.select("x").mapInArrow(run, "part int, entry int, n long, total array<string>")
            .select("part", "entry", "n", F.posexplode("total").alias("at", "v")).groupBy("part", "entry", "at")
            .agg(F.sum("n").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("v")))
    out = books.copy()
    for r in sums.collect():  # parts * entries * size numbers
        out[r["part"], r["entry"], r["at"]] = int(r["v"]) // r["n"]
    return out


def fitted(points: DataFrame, parts: int, entries: int, rounds: int) -> np.ndarray:
    """Codebooks (parts, entries, size) of the (id, x) table."""
    first = points.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    x = np.array([r["x"] for r in first], np.int64)
    books = x.reshape(len(x), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = _next_books(points, books)
    return books


def with_codes(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
               scale: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every kept vector: two hex digits
    for each part, the summed squared distance to the entries, its sum over the label, and the
    digest of all codebooks.  ``entries`` is at most 256."""
    names = vectors.select(F.col(key).alias("id"), whole_numbers(F.col(vector), scale).alias("x"),
                           F.col(label).alias("label"))
    fits = F.forall("x", lambda c: (c < LIMIT) & (c >= -LIMIT)) & (F.size("x") > 0)
    points = written(names.where(F.col("x").isNotNull() & fits), "vectors")
    first = points.orderBy(F.col("id").asc_nulls_last(), "x").select("x").first()
    if first is None:
        return points.select(F.col("id").alias(key), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                             F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    dims = len(first["x"])
    if dims % parts:
        raise ValueError(f"{parts} equal parts of {dims} components don't exist")
    points = points.where(F.size("x") == dims)
    books = fitted(points, parts, entries, rounds)
    text = [f"{i:02x}" for i in range(256)]

    def run(batches):
        made = [Codebook(b) for b in books]
        for b in batches:
            codes, error = _coded(as_rows(b["x"], dims), made)
            yield pa.RecordBatch.from_arrays(
                [b["id"], b["label"], pa.array(["".join(text[c] for c in row) for row in codes], pa.string()),
                 pa.array(error)], names=["id", "label", "code", "error"])

    kinds = dict(points.dtypes)
    coded = written(points.select("id", "label", "x").mapInArrow(
        run, f"id {kinds['id']}, label {kinds['label']}, code string, error long"), "coded")
    sums = written(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.join(small(sums, 64), F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
