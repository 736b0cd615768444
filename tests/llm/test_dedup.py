"""Operators that compare rows, each against a brute-force version on small tables."""

import collections
import hashlib
import math
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardlake.llm import decontaminate, jaccard, line_templates, overlap_tree, suffixes, vectors
from cardlake.session import ensure_checkpoint_dir
from tests.llm.test_shingles_components import brute as word_set


def union_find(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# ---- vectors ---------------------------------------------------------------------------

def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b))


@pytest.mark.parametrize("settings_", [{}, {"block_rows": 4, "max_lists": 3},
                                       {"list_rows": 5, "words": 4, "parts": 3}])
def test_vectors_equal_all_pairs(spark, settings_):
    rng = np.random.default_rng(8)
    rows, i = [], 0
    for center in rng.normal(size=(12, 10)):
        for _ in range(int(rng.integers(1, 25))):
            rows.append((i, (center + rng.normal(size=10) * rng.uniform(0, 0.35)).astype(np.float32).tolist()))
            i += 1
    rows += [(i + k, rows[k % 3][1]) for k in range(30)]                       # copies
    rows += [(900, [2 * x for x in rows[0][1]]), (901, None), (902, []), (903, [0.0] * 10),
             (904, [None] + [1.0] * 9), (905, [float("nan")] * 10), (906, [float("inf")] + [1.0] * 9),
             (907, rows[0][1][:9]), (908, rows[0][1][:9]), (909, [1e30] * 10), (910, [1e-30] * 10)]
    ok = {k: v for k, v in rows if v and None not in v and all(map(math.isfinite, v)) and any(v)}
    links = [(a, b) for a in ok for b in ok if a != b and len(ok[a]) == len(ok[b]) and cosine(ok[a], ok[b]) >= 0.95]
    part = union_find(links, [k for k, _ in rows])
    degree = collections.Counter(a for a, _ in links)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df, **settings_).collect()}
    assert got == {k: (degree[k], part[k], part[k] == k) for k, _ in rows}


def test_recall_in_many_dimensions(spark):
    """All pairs at the very threshold, where the default probes may miss some."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(600, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.normal(size=(600, 64))
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    near = 0.9505 * base + math.sqrt(1 - 0.9505 ** 2) * side
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate((base, near)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vectors.near_duplicates(df, list_rows=10).agg({"n_links": "sum"}).first()[0]
    assert 1200 * 0.99 <= got <= 1200


def _linked(rows, t=0.95):
    """Directed links at cosine t or more, by vector."""
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return dict(zip((k for k, _ in rows), ((x @ x.T >= t).sum(1) - 1).tolist()))


@pytest.mark.parametrize("latent", [2, 3, 4, 5])
def test_vectors_that_vary_in_few_directions(spark, latent):
    rng = np.random.default_rng(latent)
    x = rng.normal(size=(1200, latent)) @ np.linalg.qr(rng.normal(size=(64, latent)))[0].T
    rows = list(enumerate(x.tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(df, block_rows=300).collect()}
    assert got == _linked(rows)


@pytest.mark.parametrize("held", [64 * 8 * 20, 64 * 8 * 90, 64 * 8 * 500])
def test_vectors_in_passes(spark, held):
    """Each member is held once, whatever a pass holds."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 3)) @ np.linalg.qr(rng.normal(size=(64, 3)))[0].T
    rows = list(enumerate(x.tolist()))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    some = {"max_lists": 4, "block_rows": 50, "held_bytes": held}
    got = {r.vec_id: r.n_links for r in vectors.near_duplicates(df, **some).collect()}
    assert got == _linked(rows)


def test_vectors_are_not_copied_for_the_lists_they_probe(spark):
    """In 64 dimensions a vector probes most lists; what is written stays a few times the table."""
    root = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "cardlake-runs")

    def used():
        return {f: os.path.getsize(f) for d, _, names in os.walk(root) for f in (os.path.join(d, n) for n in names)}

    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 64)).astype(np.float32)
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<float>")
    before = used()
    assert vectors.near_duplicates(df, block_rows=100).agg({"n_links": "sum"}).first()[0] == 0
    assert sum(size for f, size in used().items() if f not in before) < 3 * x.nbytes


def test_vectors_with_signed_zeros(spark):
    """0 and -0 are one number, in vectors that are equal otherwise."""
    rows = [(1, [0.0, 1.0, 0.25]), (2, [-0.0, 1.0, 0.25]), (3, [-0.0, -1.0, 0.0]), (4, [0.0, 0.0, -0.0]), (5, None)]
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df).collect()}
        assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True), 4: (0, 4, True), 5: (0, 5, True)}


def test_vectors_edges(spark):
    schema = "vec_id long, embedding array<float>, v int, id string"
    assert vectors.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, [1.0, 0.0], 1, "x"), (1, [1.0, 0.0], 1, "x"), (None, [1.0, 0.0], 1, "y"), (2, [0.0, 1.0], 0, None)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id) for r in got) == [(0, 2, 1), (1, 2, 1), (1, 2, 1), (2, 0, 2)]


def test_vectors_under_null_ids_only(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(1, [1.0, 0.0, 0.0]), (None, [1.0, 0.3, 0.0]), (2, [1.0, 0.6, 0.0]), (None, [0.0, 0.0, 1.0]), (None, [0.0, 0.1, 1.0])]
    got = vectors.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id or 0) for r in got) == [
        (0, 1, 0), (0, 1, 0), (0, 2, 1), (1, 1, 1), (2, 1, 1)]
    nulls = vectors.near_duplicates(spark.createDataFrame([(None, [1.0, 2.0])] * 3, schema)).collect()
    assert [r.n_links for r in nulls] == [2, 2, 2]


# ---- documents -------------------------------------------------------------------------

@pytest.mark.parametrize("all_of_them", [True, False])
def test_a_crowd_leaves_its_pairs_in_small_batches(all_of_them):
    """Points that all allow each other: what one batch of them finds would be millions of rows at once."""
    class Rows:
        repartition = sortWithinPartitions = lambda self, *_: self
        mapInArrow = lambda self, run, _: run

    hashes = np.random.default_rng(3).integers(0, 1 << 63, 40).astype(np.uint64)
    n = jaccard.BLOCK + 3000
    here = np.arange(n) < jaccard.BLOCK
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, 7)), pa.array(np.zeros(n, np.int32)), pa.array(np.where(here, 0, 1).astype(np.int32)),
         pa.array(np.arange(n)), pa.array(np.full(n, 40, np.int32)), pa.array(np.arange(n)), pa.array(here & (np.arange(n) < 700)),
         pa.array([[7]] * n, pa.list_(pa.int64())), pa.array([overlap_tree.count_vector(hashes)] * n),
         pa.array([overlap_tree.bitmap(hashes)] * n)],
        names=["key", "block", "part", "id", "n", "component", "outside", "known", "counts", "bits"])
    rows = found = 0
    for out in jaccard.tree_pairs(Rows(), all_of_them)(iter([batch])):
        assert out.num_rows <= jaccard.SEARCH * jaccard.BLOCK * 5 // 4
        rows, found = rows + out.num_rows, found + int((out["share"].to_numpy() >= 0).sum())
    if all_of_them:  # each pair of two that search once
        assert rows == found == 3700 * (jaccard.BLOCK - 700) + 700 * 699 // 2
    else:
        assert found == 3700 and rows <= found + 2 * jaccard.BLOCK


# ---- suffixes --------------------------------------------------------------------------

@given(st.lists(st.binary(max_size=20).map(lambda b: bytes(x % 3 for x in b)), max_size=60))
@settings(max_examples=80, deadline=None)
def test_multikey_quicksort_sorts(strings):
    rows = suffixes._matrix(strings, 20) if strings else np.zeros((0, 24), np.uint8)
    order = suffixes.multikey_quicksort(rows.view(">u8"))
    assert [bytes(rows[i]) for i in order] == sorted(bytes(r) for r in rows)


def brute_repeats(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[j:j + length] for b in data for j in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if seen[b[j:j + length]] > 1:
                gone[j:j + length] = b"\1" * length
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), len(b) - len(rest), len(re.findall(b"\1+", bytes(gone))),
                    hashlib.sha256(rest).hexdigest(), rest))
    return out


def _repeat_texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 4)))
    shared = [" ".join(word() for _ in range(rng.randint(4, 20))) for _ in range(6)]
    texts = []
    for _ in range(70):
        parts = []
        for _ in range(rng.randint(0, 6)):
            s = rng.choice(shared)
            parts.append(s[rng.randint(0, 9):] if rng.random() < 0.5 else " ".join(word() for _ in range(12)))
        texts.append(" ".join(parts))
    return texts + [texts[0], None, "", "a" * 100, "ab" * 60, "short"]


@pytest.mark.parametrize("seed, gram, hot", [(1, 12, 4096), (2, 20, 4096), (3, 12, 3), (4, 24, 4096)])
def test_repeats_equal_a_direct_count(spark, seed, gram, hot):
    texts, length = _repeat_texts(seed), 24
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = suffixes.without_repeats(df, length=length, gram=gram, hot=hot)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in out.collect()}
    assert got == dict(enumerate(brute_repeats(texts, length)))


def test_repeats_in_long_texts_and_repeated_rows(spark):
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    core = noise(70_000)
    texts = [noise(65_400) + core[:400] + noise(90_000), noise(131_000) + core[:400] + noise(10), noise(50) + core + noise(5), core]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(7, noise(300), "x")] * 2 + [(8, noise(100), "x")] * 2 \
        + [(9, "one" + noise(250), "x"), (9, "two" + noise(250), "x"), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, doc string")
    want = brute_repeats([r[1] for r in rows], 200)
    got = suffixes.without_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(tuple(r)[1:] for r in got) == sorted(w[:4] for w in want)
    assert suffixes.without_repeats(df.where("false")).collect() == []


# ---- line templates ----------------------------------------------------------------------

def brute_lines(rows, depth=3, min_tokens=4, min_docs=5, similarity=0.8, exact_docs=2, short_docs=10):
    """Kept text of each (id, text)."""
    big = float("inf")

    def plain(line):
        return tuple(w for w in re.split(r"[ \t\x0b\x0c\r]+", line.strip(" ")) if w)

    def masked(t):
        return t if len(t) < min_tokens else tuple("<*>" if re.search("[0-9]", w) else w for w in t)

    def note(where, t, text, i):
        have, low = where.get(t, (set(), big))
        where[t] = have | {text}, min(low, big if i is None else i)

    lines, exact, least = {}, {}, collections.defaultdict(int)
    for i, text in rows:
        for t in filter(None, map(plain, (text or "").split("\n"))):
            m = masked(t)
            note(lines, m, text, i)
            least[m] = max(least[m], short_docs if len(t) < min_tokens else exact_docs if m == t else min_docs)
            if m != t:
                note(exact, t, text, i)
    keeper = {t: low for t, (have, low) in lines.items() if len(have) >= least[t]}
    leaves = collections.defaultdict(list)
    for t in lines:
        if len(t) >= min_tokens:
            leaves[len(t), t[:depth]].append(t)
    for leaf in leaves.values():
        count = collections.Counter()
        for t in leaf:
            for place in enumerate(t):
                count[place] += len(lines[t][0])
        templates = collections.defaultdict(list)
        for t in leaf:
            shape = tuple(p for p in enumerate(t) if count[p] >= min_docs)
            templates[shape if len(shape) >= similarity * len(t) else t].append(t)
        for alike in templates.values():
            if sum(len(lines[t][0]) for t in alike) >= min_docs:
                low = min(lines[t][1] for t in alike)
                keeper.update((t, min(low, keeper.get(t, big))) for t in alike)
    same = {t: low for t, (have, low) in exact.items() if len(have) >= exact_docs}

    def stays(line, i):
        t, i = plain(line), big if i is None else i
        return keeper.get(masked(t), i) == i and same.get(t, i) == i
    return [None if text is None else "\n".join(x for x in text.split("\n") if stays(x, i)) for i, text in rows]


@pytest.mark.parametrize("seed", range(2))
def test_lines_equal_a_direct_parse(spark, seed):
    rng = random.Random(seed)
    def line():
        kind = rng.randint(0, 5)
        if kind == 0:
            return f"user {rng.choice(['ann', 'bob', 'cy', 'di', 'ed', 'flo'])} logged in at {rng.randint(0, 99)}:10 from the office today ok"
        if kind == 1:
            return "all rights reserved by\tthe owner " * rng.randint(1, 2)
        if kind == 2:
            return rng.choice(["", " ", "a b c", "x 1 2", "one two three four"])
        return " ".join(rng.choice("a b c d e f g h".split()) for _ in range(rng.randint(1, 9)))
    rows = [(i, "\n".join(line() for _ in range(rng.randint(0, 8)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, rows[0][1]), (102, rows[0][1]), (103, "w " * 3000 + "\nall rights reserved by the owner")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, leaf int")
    out = line_templates.drop_recurring(df, lines="n", dropped="gone")
    got = collections.Counter((r.doc_id, r.text, r.leaf) for r in out.collect())
    want = brute_lines(rows)
    assert got == collections.Counter((r[0], t, 1) for r, t in zip(rows, want))
    lost = {r[0]: (len(r[1].split("\n")), len(r[1].split("\n")) - len(t.split("\n")) if t or not r[1] else None)
            for r, t in zip(rows, want) if r[1] is not None}
    for r in out.where("text is not null and text <> ''").collect():
        assert (r.n, r.gone) == lost[r.doc_id]


def test_variable_fields_and_keeper(spark):
    rows = [(i, f"body number one of {w}\nrequest from host {w} took very long to answer") for i, w in
            enumerate("ash elm fir oak yew".split())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = dict(line_templates.drop_recurring(df).collect())
    assert got[0].endswith("answer") and all("request" not in got[i] for i in range(1, 5))
    assert line_templates.drop_recurring(df.where("false")).collect() == []
    alone = line_templates.drop_recurring(spark.createDataFrame(rows[:4], "doc_id long, text string"))
    assert dict(alone.collect()) == dict(rows[:4])


@pytest.mark.parametrize("copies", [2, 3, 4])
def test_long_lines_that_recur_exactly(spark, copies):
    rng = random.Random(copies)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    plain, fields, other = words(60), words(30) + " 12 " + words(30), words(8) + " 7"
    rows = [(i, f"{words(9)}\n{plain}\n{fields.replace(' ', '  ')}\n{other}{i}") for i in range(copies)] + [(9, words(70))]
    got = dict(line_templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    first = lambda t: t.split("\n")[0] + "\n" + t.split("\n")[3]
    assert got == {k: t if k in (0, 9) else first(t) for k, t in rows}


def test_short_lines_that_recur(spark):
    rows = [(i, f"own{i} text\nAll rights reserved.\n\nPage {i}\nPage\t7\n}}") for i in range(24)]
    rows += [(100 + i, f"more{i}\nAd.") for i in range(9)]
    got = dict(line_templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == {k: t if k in (0, *range(100, 109)) else f"own{k} text\n" + f"\nPage {k}" * (k != 7)
                   for k, t in rows}


def test_columns_that_clash(spark):
    """Extra columns pass through; those named like the outputs are replaced."""
    shared = "a passage that many documents share " * 12
    rows = [(i, f"{shared}\nown {i} words here", 1, 2, 3, 4, 5, 6) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, begins int, n_bytes int, kept int, __drop int, "
                                       "__doc int, n_lines int")
    out = suffixes.without_repeats(docs)
    assert sorted(out.columns) == sorted(["doc_id", "begins", "__drop", "__doc", "n_lines", "kept", "n_bytes",
                                          "n_removed", "n_spans", "kept_sha256"])
    assert all((r.begins, r["__drop"], r["__doc"], r.n_lines) == (1, 4, 5, 6) and r.n_bytes > 400 and r.n_removed > 400
               for r in out.collect())
    out = line_templates.drop_recurring(docs, lines="n_lines", dropped="n_dropped")
    assert sorted(out.columns) == sorted([*docs.columns, "n_dropped"])
    got = {r.doc_id: (r.n_lines, r.n_dropped, r["__drop"]) for r in out.collect()}
    assert got == {0: (2, 0, 4), 1: (2, 1, 4), 2: (2, 1, 4)}


# ---- decontamination -----------------------------------------------------------------------

def test_leaks_equal_direct_containment(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(40)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, some(rng.choice([1, 2, 4, 5, 6, 12, 30, 80]))) for i in range(30)] + [(30, None), (31, ""), (5, some(9))]
    docs = []
    for i in range(60):
        t = some(rng.randint(0, 200)).split()
        for _ in range(rng.randint(0, 3)):
            item = (rng.choice(items)[1] or "").upper().split()
            if item and rng.random() < 0.4:
                item[rng.randrange(len(item))] = "changed"
            at = rng.randint(0, len(t))
            t[at:at] = item
        docs.append((i, "\n ".join(t)))
    docs += [(70, None), (71, " "), (72, items[0][1]), (72, items[0][1])]
    want = []
    for d, text in docs:
        w = (text or "").encode().lower().split()
        for k, item in items:
            q = word_set(item)
            have = {tuple(w[i:i + n]) for n in {len(s) for s in q} for i in range(len(w) - n + 1)}
            if q and 4 * len(q & have) >= 3 * len(q):
                want.append((d, k, len(q & have), len(q), len(q & have) / len(q)))
    got = decontaminate.leaks(spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, n int"),
                              spark.createDataFrame([(*k, 0) for k in items], "item_id long, text string, shingle int"))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_items_of_all_sizes_have_bounds_of_their_own(spark):
    """Items of 1 to 5,000 words, whole and with every fifth of ten shingles changed, in long documents."""
    rng = random.Random(9)
    some = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    items = [(n, some(n)) for n in (1, 2, 3, 5, 8, 20, 90, 400, 1500, 5000)]
    docs = [(n, " ".join(some(300) + item + some(300))) for n, item in items]
    cut = [(10_000 + n, " ".join(some(50) + item[:n * 9 // 10] + some(50))) for n, item in items if n >= 90]
    half = [(20_000 + n, " ".join(some(50) + item[:n // 2] + some(50))) for n, item in items if n >= 90]
    table = spark.createDataFrame([(n, " ".join(w)) for n, w in items], "item_id long, text string")
    got = decontaminate.leaks(spark.createDataFrame(docs + cut + half, "doc_id long, text string"), table)
    assert sorted((r.doc_id, r.item_id) for r in got.collect()) == sorted(
        [(n, n) for n, _ in items] + [(10_000 + n, n) for n, _ in items if n >= 90])
    rows = decontaminate.item_shingles(table, "item_id", "text", 5, 3, 4)
    bounds = {c: int(top) / 2 ** 64 for c, top, _, _ in decontaminate._tables(rows)}
    assert set(bounds) == {max(1, n - 4).bit_length() for n, _ in items}
    assert all(bounds[max(1, n - 4).bit_length()] < 0.35 for n in (400, 1500, 5000))


@pytest.mark.parametrize("docs, items", [([], [(1, "a b c")]), ([(1, "a b c")], []), ([(1, None)], [(1, None)])])
def test_no_leaks(spark, docs, items):
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id long, text string"),
                              spark.createDataFrame(items, "item_id long, text string"))
    assert got.collect() == []


# ---- Jaccard join ---------------------------------------------------------------------------

def brute_groups(rows):
    sets = [word_set(t) for _, t in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    part = union_find(links, range(len(rows)))
    least = {}
    for i, (k, _) in enumerate(rows):
        least[part[i]] = min(least.get(part[i], k), k)
    return sorted((k, len(sets[i]), least[part[i]]) for i, (k, _) in enumerate(rows))


def _near_copies(seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(14):
        base = [f"t{rng.randint(0, 300)}" for _ in range(rng.choice([1, 3, 5, 9, 30, 120]))]
        for _ in range(rng.randint(1, 9)):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 20))):
                t[rng.randrange(len(t))] = f"e{rng.randint(0, 9)}"
            rows.append(" ".join(t) if rng.random() < 0.5 else "\t".join(t).upper())
    common = " ".join(f"common{i}" for i in range(40))
    rows += [f"{common} " + " ".join(f"own{j}x{i}" for i in range(30)) for j in range(40)]
    rows += [common + " " + " ".join(f"z{i}" for i in range(k)) for k in range(0, 40, 2)]   # a chain of links
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,crowd,block", [(0, 32, 2048), (1, 2, 5), (2, 5, 2048)])
def test_groups_equal_all_pairs(spark, seed, crowd, block, monkeypatch):
    monkeypatch.setattr(jaccard, "LINKS_PER_BLOCK", 3)
    monkeypatch.setattr(jaccard, "CROWD", crowd)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = _near_copies(seed) + [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A  b"), (905, "w " * 20000)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, n int, id string")
    got = jaccard.similar_groups(df)
    assert sorted(map(tuple, got.collect())) == brute_groups(rows)


def test_groups_edges(spark):
    schema = "doc_id long, text string"
    assert jaccard.similar_groups(spark.createDataFrame([], schema)).collect() == []
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (None, "a b c d e f g"), (3, "x y"), (None, None), (2, "X y")]
    got = jaccard.similar_groups(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [
        (0, 0, 0), (0, 3, 5), (2, 1, 2), (3, 1, 2), (5, 3, 5), (5, 3, 5)]


def test_crowded_group_of_near_copies(spark, monkeypatch):
    """Copies that differ from each other more than from their origin, which isn't the smallest id."""
    monkeypatch.setattr(jaccard, "BLOCK", 40)
    rng = random.Random(9)
    base = [f"t{i}" for i in range(150)]
    rows = []
    for i in range(110):
        t = list(base)
        for _ in range(rng.choice([1, 3, 5, 7, 9])):
            t[rng.randrange(150)] = f"e{i}x{rng.randint(0, 99)}"
        rows.append((i, " ".join(t)))
    rows.append((200, " ".join(base)))
    got = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute_groups(rows)


def test_a_pair_leaves_the_crowded_subtrees_once(spark, monkeypatch):
    """Texts that share many leading shingles, below the similarity but within the bound of the counts."""
    common = " ".join(f"common{i}" for i in range(238))
    rows = [(j, f"{common} " + " ".join(f"own{j}x{i}" for i in range(48))) for j in range(40)]
    rows += [(100 + j, t.rsplit(" ", 1)[0]) for j, t in rows[:3]]  # links of their own
    tables = []

    def kept(rows, all_of_them, real=jaccard.tree_pairs):
        tables.append(jaccard.written(real(rows, all_of_them), "pairs"))
        return tables[-1]

    monkeypatch.setattr(jaccard, "tree_pairs", kept)
    got = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute_groups(rows)
    pairs = [tuple(sorted((r.id, r.id2))) for r in tables[-1].collect()]
    assert len(pairs) == len(set(pairs)) and len(pairs) > 100
    assert max(t.count() for t in tables) <= 43 * 42 // 2


@pytest.mark.parametrize("known", [0, 1, 3])
def test_pairs_that_know_few_of_their_subtrees(spark, known, monkeypatch):
    """What points carry only saves rows, and texts under one id are points of their own."""
    monkeypatch.setattr(jaccard, "KNOWN", max(known, 1))
    if not known:
        monkeypatch.setattr(jaccard, "_known", lambda column: np.full((len(column), 1), np.iinfo(np.int64).max))
    monkeypatch.setattr(jaccard, "CROWD", 2)
    rows = _near_copies(5 + known)
    assert sorted(map(tuple, jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect())
                  ) == brute_groups(rows)


def test_long_texts_that_share_half_leave_no_pair(spark, monkeypatch):
    """256 groups can't tell sets of thousands apart, bitmaps can; and no table of pairs carries shingles."""
    common = " ".join(f"common{i}" for i in range(1500))
    rows = [(j, f"{common} " + " ".join(f"own{j}x{i}" for i in range(1200))) for j in range(36)]
    rows += [(100 + j, t.rsplit(" ", 1)[0]) for j, t in rows[:3]]
    made = []

    def kept(rows, all_of_them, real=jaccard.tree_pairs):
        made.append(jaccard.written(real(rows, all_of_them), "pairs"))
        return made[-1]

    monkeypatch.setattr(jaccard, "tree_pairs", kept)
    got = jaccard.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect())) == brute_groups(rows)
    assert len(made) > 1 and sum(t.count() for t in made) <= 12


@given(st.integers(0, 10 ** 6))
@settings(max_examples=40, deadline=None)
def test_bitmaps_bound_every_overlap(seed):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 900)
    sets = [np.unique(np.concatenate((base[:rng.integers(1, 900)][rng.random() < 0.9:],
                                      rng.integers(0, 1 << 63, rng.integers(1, 90))))).astype(np.uint64) for _ in range(30)]
    sets.append(np.zeros(0, np.uint64))
    size = np.array([len(s) for s in sets])
    maps = [overlap_tree.bitmap(s) for s in sets]
    i, j = np.repeat(np.arange(31), 31), np.tile(np.arange(31), 31)
    bound = overlap_tree.Bitmaps(maps, size).bound(overlap_tree.Bitmaps(maps, size), i, j)
    both = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)])
    assert (bound >= both).all() and (bound <= np.minimum(size[i], size[j])).all()
    assert (bound[i == j] == size).all()


@pytest.mark.parametrize("batch", [2, 7, 1000])
def test_pairs_of_small_subtrees_across_batches(spark, batch):
    rng = random.Random(batch)
    rows = sorted({(rng.randint(0, 12), rng.randint(0, 30)) for _ in range(120)})
    rows = [(k, p, 100 + p % 2 * 40, p % 5, k, p % 3) for k, p in rows]
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = jaccard.small_pairs(spark.createDataFrame(
            rows, "key long, p long, n int, at int, last long, component long")).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)
    want = sorted((a[1], b[1], a[3], b[3], a[4]) for a in rows for b in rows
                  if a[0] == b[0] and a[1] < b[1] and a[5] != b[5] and a[2] == b[2])
    assert sorted((r.p, r.p2, r.at, r.at2, r.last) for r in got) == want


def test_met_before_leaves_each_pair_its_smallest_known_key():
    rng = np.random.default_rng(2)
    sets = [np.sort(rng.choice(60, rng.integers(1, 30), replace=False)) for _ in range(40)]
    known = jaccard._known(pa.array([x[:jaccard.KNOWN].tolist() for x in sets], pa.list_(pa.int64())).slice(1))
    i, j = np.triu_indices(39, 1)
    stays = {}
    for key in range(60):
        both = np.array([key in sets[a + 1] and key in sets[b + 1] for a, b in zip(i, j)])
        x, y = i[both], j[both]
        left = ~jaccard._met_before(key, known, known, x, y)
        for a, b in zip(x[left], y[left]):
            stays.setdefault((a, b), []).append(key)
    for a, b in zip(i, j):
        shared = np.intersect1d(sets[a + 1], sets[b + 1])
        assert stays.get((a, b), [])[:1] == shared[:1].tolist()


def test_words_that_cancel_out_in_sums_of_powers(spark):
    """Thue-Morse words: they collide under any polynomial modulo 2**64."""
    a = "a"
    for _ in range(12):
        a += a.translate({97: 98, 98: 97})
    b = a.translate({97: 98, 98: 97})
    for n in (64, 1024, 4096):
        docs = spark.createDataFrame([(1, a[:n]), (2, b[:n])], "doc_id long, text string")
        assert [r.component_id for r in jaccard.similar_groups(docs).orderBy("doc_id").collect()] == [1, 2]
        items = docs.where("doc_id = 1").withColumnRenamed("doc_id", "item_id")
        assert [r.doc_id for r in decontaminate.leaks(docs, items).collect()] == [1]


@given(st.integers(0, 10 ** 6))
@settings(max_examples=40, deadline=None)
def test_overlap_tree_loses_nothing(seed):
    rng = np.random.default_rng(seed)
    sets, base = [], rng.integers(0, 1 << 63, 300)
    for i in range(150):
        keep = base[rng.random(300) < rng.choice([0.1, 0.6, 0.9])]
        sets.append(np.unique(np.concatenate((keep, rng.integers(0, 1 << 63, rng.integers(0, 60))))).astype(np.uint64))
    own = rng.integers(0, 40, 150)
    counts = overlap_tree.as_matrix([overlap_tree.count_vector(s) for s in sets])
    size = np.array([len(s) for s in sets])
    i, j, bound = overlap_tree.Tree(counts, size, own, 3, 4).search(counts[:30], size[:30], own[:30])
    found = dict(zip(zip(i.tolist(), j.tolist()), bound.tolist()))
    assert all(own[a] != own[b] for a, b in found) and len(found) == len(i)
    for a in range(30):
        for b in range(150):
            both = len(np.intersect1d(sets[a], sets[b]))
            assert found.get((a, b), both) >= both
            if own[a] != own[b] and 7 * both >= 3 * (size[a] + size[b]):
                assert (a, b) in found
    best = overlap_tree.best_of_each(i, j, bound, size, size)
    assert sorted(i[best].tolist()) == sorted(set(i.tolist()))


def test_large_counts_take_four_bytes():
    many = np.zeros(70_000, np.uint64)
    assert overlap_tree.as_matrix([overlap_tree.count_vector(many), overlap_tree.count_vector(many[:0])])[:, 0].tolist() == [70_000, 0]
