"""Sharding, clustering and codes against brute-force versions on small tables."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardlake.llm import centroids, codebooks, shards

NAN, INF = float("nan"), float("inf")


# ---- sharding ---------------------------------------------------------------------------

def smallest(sizes, k):
    """Smallest largest sum of k contiguous stretches, by trying every cut."""
    best = {0: 0}
    ends = np.cumsum([0, *sizes]).tolist()
    for _ in range(k):
        best = {j: min(max(m, ends[j] - ends[i]) for i, m in best.items() if i <= j) for j in range(len(ends))}
    return best[len(sizes)]


@given(st.lists(st.integers(1, 60), max_size=14), st.integers(1, 6), st.integers(0, 2))
@settings(max_examples=200, deadline=None)
def test_cuts_are_minimax_and_leave_no_shard_empty(sizes, k, big):
    sizes = sizes + [500] * min(big, 1)
    b = shards.Bounds({f"{i:03x}": (s, True) for i, s in enumerate(sizes)})
    capacity = shards.smallest_capacity(b, k)
    assert capacity == max(smallest(sizes, k), -(-sum(sizes) // k))
    ends = [0, *shards.cuts(b, capacity, k), b.total]
    got = [y - x for x, y in zip(ends, ends[1:])]
    assert max(got) <= capacity and not b.touched and set(ends) <= {0, *b.end}
    assert sum(g > 0 for g in got) == min(k, len(sizes))


def _shard_rows(seed):
    rng = random.Random(seed)
    rows = [(i, "é" * rng.choice([0, 1, 5, 40, 300])+ str(rng.randint(0, 80))) for i in range(150)]
    rows += [(1000 + i, "hot text " * 20) for i in range(120)] + [(7, "one id")] * 90 + [(None, "null id"), (None, None),
                                                                                       (3, None), (3, ""), (4, "")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,k", [(0, 1), (1, 7), (2, 40)])
def test_shards_of_a_table(spark, seed, k, monkeypatch):
    monkeypatch.setattr(shards, "DIGITS", 1)
    monkeypatch.setattr(shards, "CHILDREN", 1)
    rows = _shard_rows(seed)
    df = spark.createDataFrame([(*r, 5, "s") for r in rows], "doc_id long, text string, size int, digest string")
    got = shards.sharded(df, k).collect()
    group = collections.Counter()
    for i, t in rows:
        group["" if t is None else hashlib.sha256(t.encode()).hexdigest()] += len((t or "").encode()) + 16
    capacity = max(smallest([group[g] for g in sorted(group)], k), -(-sum(group.values()) // k))
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r)
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in rows)
    for s, mine in by.items():
        assert 0 <= s < k and sum(r["size"] for r in mine) <= capacity
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
    if k > 1:
        assert max(sum(r["size"] for r in mine) for mine in by.values()) >= smallest([group[g] for g in sorted(group)], k)
    where = collections.defaultdict(set)
    for r in got:
        where[r["size"], r.text_crc32].add(r.shard)
    assert all(len(w) == 1 for w in where.values())
    assert {(r.doc_id, r.text_crc32) for r in got} == {
        (i, None if t is None else zlib.crc32(t.encode())) for i, t in rows}


def test_shards_of_little(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, shards.sharded(df, 5).collect())) == [(1, 17, zlib.crc32(b"a"), 1, 0), (2, 16, None, 0, 0)]
    assert shards.sharded(df.where("false"), 5).collect() == []


def test_shards_use_no_python(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    plan = shards.sharded(df, 2)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- clustering -------------------------------------------------------------------------

def brute_clusters(rows, dims, scale, k, rounds, seed=1):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            x = [math.floor(scale * x) for x in v]
            if all(-centroids.LIMIT <= c < centroids.LIMIT for c in x):
                kept.append((i, x))
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), x) for i, x in kept if i is not None)[:k]
    cs = [x for _, x in first]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(cs))
    for _ in range(rounds):
        mine = collections.defaultdict(list)
        for _, x in kept:
            mine[nearest(x)[1]].append(x)
        cs = [[sum(col) // len(mine[n]) for col in zip(*mine[n])] if mine[n] else c for n, c in enumerate(cs)]
    done = [(i, *nearest(x)) for i, x in kept] if cs else []
    by = collections.Counter()
    for _, d, n in done:
        by[n] += d
    return collections.Counter((i, n, d, by[n], sum(by.values()), hashlib.sha256(",".join(map(str, cs[n])).encode()).hexdigest())
                               for i, d, n in done)


def _vectors(n, dims, seed, latent=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, latent or dims))
    if latent:
        x = x @ rng.normal(size=(latent, dims))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(np.round(x, 2))]
    rows += rows[:5] + [(n + i, rows[3][1]) for i in range(n // 2)]  # repeated rows; half of all are equal
    return rows + [(None, rows[8][1]), (900, None), (901, []), (902, [1.0] * (dims - 1)), (903, [1.0] * (dims - 1) + [None]),
                   (904, [NAN] * dims), (905, [1.0] * (dims - 1) + [-INF]), (906, [1e30] * dims)]


@pytest.mark.parametrize("n,dims,k,rounds,pivots,latent", [(120, 4, 6, 3, 2, None), (90, 6, 16, 2, 8, 1), (5, 3, 16, 3, 8, None),
                                                           (60, 4, 5, 0, 5, 2)])
def test_clusters_equal_brute_force(spark, n, dims, k, rounds, pivots, latent):
    rows = _vectors(n, dims, n, latent)
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "vec_id long, embedding array<double>, x int, cluster string")
    out = centroids.clustered(df.repartition(5), dims=dims, scale=64, k=k, rounds=rounds, pivots=pivots)
    assert collections.Counter(map(tuple, out.collect())) == brute_clusters(rows, dims, 64, k, rounds)


def test_clusters_of_nothing(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0]), (2, None)], "vec_id long, embedding array<float>")
    for part in (df, df.where("false")):
        out = centroids.clustered(part, dims=2)
        assert out.collect() == [] and dict(out.dtypes)["distance"] == "bigint"


@given(st.integers(0, 10 ** 6))
@settings(max_examples=60, deadline=None)
def test_bounds_lose_nothing_and_save_work(seed):
    rng = np.random.default_rng(seed)
    kind = seed % 3
    x = rng.integers(-9, 9, (200, 8)) if kind == 0 else (rng.normal(size=(200, 1)) * rng.normal(size=8) * 1000).astype(int)
    if kind == 2:
        x = x * 100_000
    c = x[rng.integers(0, 200, 12)] + rng.integers(-2, 2, (12, 8))
    best, distance, measured = centroids.assign(x, centroids.pivot_distances(x, c[:6]), c, c[:6])
    every = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (best == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert measured <= every.size and (kind == 0 or measured < every.size / 2)


# ---- codes ------------------------------------------------------------------------------

@given(st.integers(0, 10 ** 6), st.integers(1, 20))
@settings(max_examples=80, deadline=None)
def test_search_finds_the_nearest_entry(seed, entries):
    rng = np.random.default_rng(seed)
    wide = 3 if seed % 2 else 1 << 25
    book = rng.integers(-wide, wide, (entries, 4))
    x = np.concatenate([rng.integers(-wide, wide, (60, 4)), book])
    best, distance, measured = codebooks.Codebook(book).nearest(x)
    every = ((x[:, None] - book[None]) ** 2).sum(2)
    assert (best == every.argmin(1)).all() and (distance == every.min(1)).all() and measured <= every.size


def test_search_stops_early():
    rng = np.random.default_rng(3)
    book = rng.normal(size=(64, 2)) * 10_000
    x = (book[rng.integers(0, 64, 500)] + rng.normal(size=(500, 2)) * 50).astype(np.int64)
    _, _, measured = codebooks.Codebook(book.astype(np.int64)).nearest(x)
    assert measured < 500 * 64 / 3


def brute_codes(rows, scale, parts, entries, rounds):
    kept = []
    for i, v, label in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            x = [math.floor(scale * x) for x in v]
            if all(-codebooks.LIMIT <= c < codebooks.LIMIT for c in x):
                kept.append((i, x, label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return collections.Counter()
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    size = len(kept[0][1]) // parts
    cut = [[x[p * size:(p + 1) * size] for p in range(parts)] for _, x, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            mine = collections.defaultdict(list)
            for c in cut:
                mine[nearest(p, c[p])[1]].append(c[p])
            books[p] = [[sum(col) // len(mine[n]) for col in zip(*mine[n])] if mine[n] else e for n, e in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    done = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    by = collections.Counter()
    for (_, _, label), d in zip(kept, done):
        by[label] += sum(x for x, _ in d)
    return collections.Counter((i, "".join(f"{n:02x}" for _, n in d), sum(x for x, _ in d), by[label], digest)
                               for (i, _, label), d in zip(kept, done))


@pytest.mark.parametrize("n,dims,parts,entries,rounds", [(100, 8, 4, 6, 3), (40, 6, 2, 16, 6), (4, 4, 4, 16, 2)])
def test_codes_equal_brute_force(spark, n, dims, parts, entries, rounds):
    rows = [(i, v, None if k % 3 == 0 else k % 2) for k, (i, v) in enumerate(_vectors(n, dims, n + 1))]
    rows = [r for r in rows if r[0] not in (900, 901, 902) or r[1] is None] + [(950, [1.0], 1), (951, [], 1)]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "vec_id long, embedding array<double>, label int, id int, code string")
    out = codebooks.with_codes(df.repartition(5), parts=parts, entries=entries, rounds=rounds)
    assert collections.Counter(map(tuple, out.collect())) == brute_codes(rows, 4096, parts, entries, rounds)


def test_codes_of_nothing(spark):
    df = spark.createDataFrame([(1, None, 1), (2, [NAN], 1)], "vec_id long, embedding array<float>, label int")
    assert codebooks.with_codes(df).collect() == [] and codebooks.with_codes(df.where("false")).collect() == []
    with pytest.raises(ValueError):
        codebooks.with_codes(spark.createDataFrame([(1, [1.0] * 9, 1)], df.schema))
