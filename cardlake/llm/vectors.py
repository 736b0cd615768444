"""Near-duplicate vectors by product quantisation with exact rerank.

Vectors are compared by cosine.  Unit vectors with cosine >= t are at most
``r = sqrt(2 - 2 t)`` apart, and everything here prunes by that distance:

1. Coarse inverted lists: each vector goes to the list of its nearest centroid.
2. Residual codes: the difference to the centroid is cut into subspaces, each
   coded by the nearest of a small codebook; the exact error of the code is
   kept with it.
3. Sufficient probes: a vector y of another list lies beyond the plane halfway
   between the two centroids, and no nearer and no farther from its own
   centroid than the list's members are.  So x probes the lists whose plane is
   within ``reach * r`` of x and whose shell (smallest to largest distance of a
   member) is within r of x.  With reach 1, the default, no pair can be missed.
   Of two lists only the one that comes first probes the other; what is found
   counts for both sides.
4. Asymmetric distances: x is compared with the decoded code of y.  As y's
   distance from its code is known, ``x . code >= y . code - (1 - t) - r * error``
   for every y within r of x (the triangle inequality, squared): no pair is missed.
5. Exact rerank: cosine in double precision from the vectors themselves.

Centroids and codebooks are fitted on the ``sample_rows`` distinct vectors
with the smallest hash (a bounded sample); there is a list for each
``list_rows`` vectors and ``max_lists`` at most.  Every vector is indexed and
every vector is a query.

Equal vectors are one point with a number of copies.  Neighbouring lists form
cells of up to ``block_rows`` members, a larger list is cut into blocks.  A vector
probes a share of the lists, so copies of it for each of them would take disk with
the square of the table; vectors stay where they are instead.  In a pass every
task holds the members of some cells (up to ``held_bytes``), and all points go by
where they are stored; there are as many passes as it takes to hold each member
once.  From a block come counts, and only such links as keep its points connected,
never all pairs.  Rows meet their points by a digest of the vector (128 bits).

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing; vectors of different length link with nothing;
a null id is no component's smallest (of null ids only, the component is null),
but its vector links like any other; an id with several vectors has the links of
each and one component; an empty table gives an empty one; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import components, released, small, written
from cardlake.session import shared_path

SLICE = 1024  # vectors whose distances to all centroids are held at a time
SLACK = 1e-7  # rounding, on the side of keeping candidates
HELD_BYTES = 16 << 20  # vectors of members that a task holds at a time
NARROW = 256  # members of a block from which on its lists are probed one by one
RERANK = 65536  # pairs whose cosines are computed at a time


def usable(v: Column) -> Column:
    """Whether a vector is one that can link."""
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & ~odd & F.exists(v, lambda x: x != 0), F.lit(False))


def digest(v: Column) -> Column:
    """128 bits of a vector's numbers, equal for equal vectors (0 and -0 are one number)."""
    numbers = F.concat_ws(",", F.transform(v, lambda x: (x + F.lit(0).cast("tinyint")).cast("string")))
    return F.unhex(F.substring(F.sha2(numbers, 256), 1, 32))


def _padded(rows: list, size: int, kind: str) -> np.ndarray:
    """Vectors as rows of one array, shorter ones filled up with zeros."""
    out = np.zeros((len(rows), size), kind)
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    return out


def _unit(raw: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision."""
    out = raw.astype(float)
    out /= np.abs(out).max(1, keepdims=True)
    return out / np.sqrt((out * out).sum(1, keepdims=True))


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * x @ c.T, 0)


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row of c nearest to each row of x, a slice of x at a time."""
    return np.concatenate([_squares(x[i:i + SLICE], c).argmin(1) for i in range(0, len(x), SLICE)])


def _lloyd(x: np.ndarray, k: int, rounds: int, rng) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        count = np.bincount(near, minlength=len(c))
        c[count > 0] = total[count > 0] / count[count > 0, None]
    return c


class Index:
    """Centroids and residual codebooks."""

    def __init__(self, sample: np.ndarray, lists: int, parts: int, words: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.centroids = _lloyd(sample, lists, 5, rng)
        near = _nearest(sample, self.centroids)
        rest = sample - self.centroids[near]
        self.cuts = [c for c in np.array_split(np.arange(sample.shape[1]), parts) if len(c)]
        self.books = [_lloyd(rest[:, c], words, 6, rng) for c in self.cuts]

    def encode(self, x: np.ndarray):
        """(list, codes, error of the code) of unit vectors, and their squared distances to centroids."""
        d2 = _squares(x, self.centroids)
        near = d2.argmin(1)
        rest = x - self.centroids[near]
        codes = np.empty((len(x), len(self.cuts)), np.uint8)
        lost = np.zeros(len(x))
        for j, (c, book) in enumerate(zip(self.cuts, self.books)):
            d = _squares(rest[:, c], book)
            codes[:, j] = d.argmin(1)
            lost += ((rest[:, c] - book[codes[:, j]]) ** 2).sum(1)
        return near, codes, np.sqrt(lost), d2

    def probes(self, x: np.ndarray, near: np.ndarray, own: np.ndarray, which: np.ndarray, reach: float,
               radius: float, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which of some lists a vector must probe (module text, 3).  ``own``: its distance to its centroid."""
        d2 = _squares(x, self.centroids[which])
        apart = np.sqrt(_squares(self.centroids[near], self.centroids[which]))
        far = np.sqrt(d2)
        return ((d2 - (own * own)[:, None] <= 2 * apart * (reach * radius + SLACK) + SLACK)
                & (far <= high[which] + radius + SLACK) & (far >= low[which] - radius - SLACK))

    def decode(self, near: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes stand for."""
        out = self.centroids[near]
        for j, (c, book) in enumerate(zip(self.cuts, self.books)):
            out[:, c] += book[codes[:, j]]
        return out


class Cells:
    """Lists in an order that keeps neighbours together, cut into cells of ``rows`` members or one list,
    and those into passes of about ``held`` members or one cell."""

    def __init__(self, index: Index, facts: list, rows: int, held: int):
        lists = len(index.centroids)
        self.count = np.zeros(lists, np.int64)
        self.low, self.high = np.full(lists, np.inf), np.full(lists, -np.inf)
        for which, n, low, high in facts:
            self.count[which], self.low[which], self.high[which] = n, low, high
        rough = _lloyd(index.centroids, math.isqrt(lists), 5, np.random.default_rng(6))
        self.order = np.argsort(_nearest(index.centroids, rough), kind="stable")
        self.rank = np.empty(lists, np.int64)
        self.rank[self.order] = np.arange(lists)
        starts = self._cut(self.count[self.order], rows)
        self.cell = np.empty(lists, np.int64)
        self.cell[self.order] = np.searchsorted(starts, np.arange(lists), "right") - 1
        total = np.bincount(self.cell, self.count, len(starts)).astype(np.int64)
        begin = self._cut(total, held)
        # (cells, parts) of each pass: a cell that is too large alone takes several, by point
        self.passes = [(np.arange(a, z), max(1, -(-int(total[a:z].sum()) // held)))
                       for a, z in zip(begin, [*begin[1:], len(total)])]

    @staticmethod
    def _cut(sizes: np.ndarray, most: int) -> list[int]:
        """Where runs of up to ``most``, or of one size, begin."""
        starts, held = [0], 0
        for i, n in enumerate(sizes):
            if held and held + n > most:
                starts.append(i)
                held = 0
            held += int(n)
        return starts


def fit(points: DataFrame, n: int, size: int, sample_rows: int, max_lists: int, list_rows: int,
        parts: int, words: int) -> Index:
    rows = (points.orderBy(F.xxhash64("v"), "pt").limit(sample_rows).select("v").collect())
    sample = _unit(_padded([r["v"] for r in rows], size, "f8"))
    lists = max(1, min(max_lists, -(-n // list_rows), len(sample)))
    return Index(sample, lists, parts, min(words, len(sample)))


def _slices(batches):
    for b in batches:
        for i in range(0, b.num_rows, SLICE):
            yield b.slice(i, SLICE)


def _members(points: DataFrame, index: Index, size: int, number: str) -> DataFrame:
    """One row a point, with its list, code and distance to the centroid."""
    def run(batches):
        for b in _slices(batches):
            raw = b["v"].to_pylist()
            padded = _padded(raw, size, number)
            near, codes, lost, d2 = index.encode(_unit(padded))
            yield pa.RecordBatch.from_arrays(
                [pa.array(near, pa.int32()), b["pt"], b["id"], b["copies"], b["digest"],
                 pa.array([len(v) for v in raw], pa.int32()),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(lost),
                 pa.array(np.sqrt(d2[np.arange(len(near)), near])),
                 pa.array([v.tobytes() for v in padded], pa.binary())],
                names=["list", "pt", "id", "copies", "digest", "size", "codes", "error", "far", "v"])

    kind = dict(points.dtypes)["id"]
    return points.mapInArrow(run, f"list int, pt long, id {kind}, copies long, digest binary, size int, "
                                  "codes binary, error double, far double, v binary")


LINK = "a long, b long, n long"


class Block:
    """Members of a cell, or of a part of one, that queries are compared with."""

    def __init__(self, rows: dict, at: np.ndarray, index: Index, rank: np.ndarray, radius: float, slack: float):
        self.raw, self.pt, self.id = rows["v"][at], rows["pt"][at], rows["id"][at]
        self.copies, self.size, self.rank = rows["copies"][at], rows["size"][at], rank[rows["list"][at]]
        code = index.decode(rows["list"][at], rows["codes"][at])
        least = (np.einsum("ij,ij->i", _unit(self.raw), code) - radius * radius / 2 - radius * rows["error"][at])
        self.code, self.least = code.astype("f4").T.copy(), (least - slack).astype("f4")
        # parts that links found so far leave, and what queries of earlier lists found
        self.label, self.more = np.arange(len(at)), np.zeros(len(at), np.int64)

    def links(self, who: np.ndarray, x4: np.ndarray, x: np.ndarray, rank: np.ndarray, rows: dict,
              threshold: float) -> tuple[list, list, list]:
        """(a, b, n) of some queries, ``who`` of the rows, against the members.  ``x``: the rows' unit vectors,
        ``x4``: in single precision, ``rank``: of their lists."""
        q, m = np.divmod(np.flatnonzero(x4[who] @ self.code >= self.least), len(self.least))
        if not len(q):
            return [], [], []
        q, pts, ids, copies, sizes = who[q], rows["pt"], rows["id"], rows["copies"], rows["size"]
        ok = rank[q] <= self.rank[m]
        q, m = q[ok], m[ok]
        cos = np.concatenate([np.einsum("ij,ij->i", x[q[i:i + RERANK]], _unit(self.raw[m[i:i + RERANK]]))
                              for i in range(0, len(q), RERANK)] or [np.zeros(0)])
        ok = (cos >= threshold) & (sizes[q] == self.size[m]) & (pts[q] != self.pt[m])
        q, m = q[ok], m[ok]
        # two vectors of one id have no link with each other
        ok = (ids[q] != self.id[m]) | np.equal(ids[q], None)
        q, m = q[ok.astype(bool)], m[ok.astype(bool)]
        total = np.zeros(len(pts), np.int64)
        np.add.at(total, q, self.copies[m])
        other = rank[q] < self.rank[m]
        np.add.at(self.more, m[other], copies[q[other]])
        a, b, n = [], [], []
        cut = np.searchsorted(q, np.arange(len(pts) + 1))
        for i in np.unique(q):
            these, lab = m[cut[i]:cut[i + 1]], self.label
            labels, first = np.unique(lab[these], return_index=True)
            for k, f in enumerate(first):  # one link to each part of the block it joins
                a.append(pts[i])
                b.append(self.pt[these[f]])
                n.append(total[i] if k == 0 else 0)
            if len(labels) > 1:
                lab[np.isin(lab, labels)] = labels[0]
        return a, b, n


def _columns(rows, size: int, number: str) -> dict:
    """Rows of members (an Arrow table or batch) as arrays."""
    out = {c: np.array(rows[c].to_pylist(), np.int64) for c in ("list", "pt", "copies", "size")}
    out["id"] = np.array([*rows["id"].to_pylist(), None], object)[:-1]
    out["far"] = np.array(rows["far"].to_pylist())
    out["v"] = np.frombuffer(b"".join(rows["v"].to_pylist()), number).reshape(-1, size)
    return out


def _compared(members: DataFrame, some: tuple, index: Index, cells: Cells, size: int, number: str,
              threshold: float, reach: float, radius: float, block_rows: int, path: str) -> None:
    """Writes the links (a, b, n) that one pass finds: all points against the members of some cells.
    ``some``: the cells, and which of how many parts of their members."""
    which, part, parts = some
    lists = np.flatnonzero(np.isin(cells.cell, which))
    mine = members.where(F.col("list").isin([int(c) for c in lists]))
    if parts > 1:
        mine = mine.where(F.pmod(F.hash("pt"), F.lit(parts)) == part)
    table = mine.select("list", "pt", "id", "copies", "size", "codes", "error", "far", "v").toArrow()
    rows = _columns(table, size, number)
    rows["codes"] = np.frombuffer(b"".join(table["codes"].to_pylist()), np.uint8).reshape(-1, len(index.cuts))
    rows["error"] = np.array(table["error"].to_pylist())
    del table
    slack = 2.0 ** -22 * (size + 8)  # rounding of a product in single precision
    rank, order, cell, low, high = cells.rank, cells.order, cells.cell, cells.low, cells.high
    least = min(NARROW, block_rows)
    held = members.sparkSession.sparkContext.broadcast((rows, index))

    def compare(batches):
        def batch(a, b, n):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, n)], names=["a", "b", "n"])

        (rows, index), blocks = held.value, []
        at = np.argsort(rank[rows["list"]], kind="stable")
        place = rank[rows["list"][at]]  # lists of a cell are neighbours in rank
        start = 0
        for end in [*np.flatnonzero(np.diff(place)) + 1, len(place)]:
            # a list that is large, or ends its cell, or fills the block
            last = end == len(place) or cell[order[place[end]]] != cell[order[place[end - 1]]]
            if last or np.searchsorted(place, place[end], "right") - start > least:
                for i in range(start, end, block_rows):
                    some = at[i:min(end, i + block_rows)]
                    probed = np.isin(lists, rows["list"][some])
                    blocks.append((np.flatnonzero(probed), Block(rows, some, index, rank, radius, slack)))
                start = end
        for b in _slices(batches):
            own = _columns(b, size, number)
            x, near = _unit(own["v"]), own["list"]
            x4 = x.astype("f4")
            must = index.probes(x, near, own["far"], lists, reach, radius, low, high)
            # of two lists the one that comes first probes the other
            must &= rank[lists][None, :] >= rank[near][:, None]
            for probed, block in blocks:
                who = np.flatnonzero(must[:, probed].any(1))
                if len(who):
                    found = block.links(who, x4, x, rank[near], own, threshold)
                    if found[0]:
                        yield batch(*found)
        for _, block in blocks:
            # what queries of earlier lists found counts for the members, too
            more = block.more > 0
            if more.any():
                yield batch(block.pt[more], block.pt[more], block.more[more])

    found = members.select("list", "pt", "id", "copies", "size", "far", "v").mapInArrow(compare, LINK)
    found.write.mode("append").parquet(path)
    held.destroy()


def near_duplicates(df: DataFrame, key: str = "vec_id", vector: str = "embedding",
                    threshold: float = 0.95, reach: float = 1.0,
                    sample_rows: int = 32_000, max_lists: int = 2048, list_rows: int = 25,
                    parts: int = 8, words: int = 64, block_rows: int = 2048,
                    held_bytes: int = HELD_BYTES) -> DataFrame:
    """(key, n_links, component_id, kept) of every row; see the module text."""
    src = df.select(F.col(key).alias("id"), F.col(vector).alias("v"))
    points = written(src.where(usable(F.col("v"))).groupBy("v")
                     .agg(F.min("id").alias("id"), F.count("*").alias("copies"))
                     .withColumns({"pt": F.monotonically_increasing_id(), "digest": digest(F.col("v"))}), "points")
    facts = points.agg(F.count("*"), F.max(F.size("v"))).first()
    kind = dict(src.dtypes)["id"]
    if not facts[0]:
        return src.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"),
                          F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    n, size = int(facts[0]), int(facts[1])
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))
    index = fit(points, n, size, sample_rows, max_lists, list_rows, parts, words)
    # vectors travel in their own precision
    number = "<f4" if dict(src.dtypes)["v"] == "array<float>" else "<f8"
    members = written(_members(points, index, size, number), "members")
    released(points)
    # at most max_lists rows of four numbers
    cells = Cells(index, members.groupBy("list").agg(F.count("*"), F.min("far"), F.max("far")).collect(),
                  block_rows, max(1, held_bytes // (size * np.dtype(number).itemsize)))
    path = shared_path(df.sparkSession, "found")
    for which, parts_of in cells.passes:
        for part in range(parts_of):
            _compared(members, (which, part, parts_of), index, cells, size, number, threshold, reach, radius,
                      block_rows, path)
    found = df.sparkSession.read.schema(LINK).parquet(path)
    points = members.select("pt", "id", "copies", "digest")
    degree = written(found.groupBy(F.col("a").alias("pt")).agg(F.sum("n").alias("n")), "degree")
    # the vectors of one id are one node
    named = points.where("id is not null").select("id", "pt")
    twice = written(named.groupBy("id").agg(F.min("pt").alias("a"), F.count("*").alias("c"))
                    .where("c > 1").drop("c"), "twice")
    same = written(named.join(small(twice, 32), "id").select("id", "a", F.col("pt").alias("b")), "same")
    whole = written(same.join(degree, same["b"] == degree["pt"]).groupBy("id").agg(F.sum("n").alias("all_n")),
                    "whole")
    part = written(components(found.select("a", "b").unionByName(same.select("a", "b")))
                   .withColumnRenamed("id", "pt"), "parts")
    name = written(points.select("pt", "id").join(part, "pt").groupBy("component")
                   .agg(F.min("id").alias("component_id")), "names")
    facts = (points.join(degree, "pt", "left").join(small(whole, 32), "id", "left")
             .join(part.join(name, "component").select("pt", "component_id"), "pt", "left")
             .select("digest", (F.coalesce("all_n", "n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component_id", "id").alias("component_id")))
    # rows without a point spread out by keys that no digest is equal to
    met = F.when(usable(F.col("v")), digest(F.col("v"))).otherwise(F.unhex(F.hex(F.xxhash64("id"))))
    rows = src.select("id", met.alias("met"))
    linked = rows.join(facts, rows["met"] == facts["digest"], "left")
    return linked.select(
        rows["id"].alias(key), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", rows["id"]).alias("component_id"),
        F.coalesce(rows["id"] == F.coalesce("component_id", rows["id"]), F.lit(True)).alias("kept"))
