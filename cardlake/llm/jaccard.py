"""N-gram Jaccard join over an R-tree of hashed token groups.

A document is the set of its 5-word shingles.  Shingles are hashed into
groups, and a document is the point of its group counts: |A & B| can't exceed
the sum over the groups of min(a_g, b_g).  Such points are joined in four steps:

1. Root.  The index fans out by shingle.  Shingles have one order for all
   documents: by hash, after that those of groups that hold far more than
   others (bounded list), lightest first.  Linked documents share
   3/7 (|A| + |B|) >= 3/4 max(|A|, |B|) shingles, hence one among the first
   |A| - ceil(3/4 |A|) + 1 of each.  A document enters the subtrees of these
   leading shingles only.
2. First links.  Every point is verified against the one point (the smallest of a
   subtree) that it meets most often.  Subtrees whose points are then all in one
   component hold no unknown link between components and go.
3. Crowded subtrees (more than ``CROWD`` points) are R-trees of the group counts
   (``overlap_tree``).  Points outside the largest component of their subtree
   search it for points of other components that the summed minima allow, and
   then the bitmaps of both sets (``overlap_tree.Bitmaps``), which tell long sets
   apart where 256 groups can't.  Two
   points meet in every crowded subtree that both are in, often dozens, and their
   bound is the same in each; the first one that both know they share reports
   them (each point carries the smallest ``KNOWN`` keys of its crowded
   subtrees), so a pair leaves once and not once a subtree.
   Points that have no such pair left drop out of the rounds after.  As
   long as an eighth of them find a link so, each takes its best partner only,
   and near copies join in a few rounds of one pair a point.
4. What is still apart: all that the searches allow now, and the pairs of the other
   subtrees, each of at most ``CROWD`` adjacent rows of a sorted partition.  The
   latter are then known with all leading shingles that both have, and pruned by
   their number plus the most that those after them can add.

Survivors are verified on the whole texts by their 64-bit shingle hashes.

Texts with the same shingle set are one point, which has a number of its own:
only numbers move with the shingles, ids and texts come in where pairs are verified.  A crowded subtree is cut into blocks of
``BLOCK`` points, and the searching points visit each block, so no task holds
more than a block.  No link between components is lost, which is what the
result needs: ids of components, not the pairs inside them.

Defined cases: null, empty and blank texts have no shingles, and link with
nothing; a text of fewer than five words is one shingle; an id that occurs
with several texts is linked if any of them is; rows with a null id get the
component of the smallest non-null id linked with their text, if any; repeated
rows stay; an empty table gives an empty one; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm import overlap_tree
from cardlake.llm.common import SMALL_BYTES, components, small, written
from cardlake.llm.shingles import WIDTH, Shingler, texts

GROUP_BITS = 20      # groups that counts are kept of, to find the heavy ones
HEAVY_GROUPS = 1 << 16
LINKS_PER_BLOCK = 256
CROWD = 32           # points of the largest subtree that is joined pair by pair
BLOCK = 2048         # points of a crowded subtree that a task holds
KNOWN = 16           # keys of crowded subtrees that a point carries
PAIRS = 1 << 13      # pairs whose known keys are compared at a time
SEARCH = 256         # points that search a block at a time; what they find leaves before the next do
NUM, DEN = 3, 4      # the similarity of linked documents, as a fraction


def needed(n):
    """The smallest overlap that a set of n needs with any partner: ceil(3/4 n)."""
    return -(-n * NUM // DEN)


def heavy_groups(docs: DataFrame, text: str, width: int) -> np.ndarray:
    """Groups with many times the mean count, heaviest last (at most HEAVY_GROUPS).

    Each task reports the groups that stand out among its own rows; their sums
    order coordinates, which steers how much work the index saves and never
    what it finds.
    """
    def run(batches):
        counts = np.zeros(1 << GROUP_BITS, np.int64)
        maker = Shingler(width)
        for b in batches:
            for t in texts(b[text]):
                found = maker.shingles(t)
                np.add.at(counts, (found >> np.uint64(64 - GROUP_BITS)).astype(np.int64), 1)
        out = np.flatnonzero(counts >= 10 + 4 * counts.mean())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), pa.array(counts[out])],
                                         names=["grp", "n"])

    top = (docs.select(text).mapInArrow(run, "grp long, n long").groupBy("grp")
           .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "grp").limit(HEAVY_GROUPS))
    return np.array([r["grp"] for r in reversed(top.collect())], np.int64)


POINT = "id {id}, n int, digest binary, last long, lead array<long>, counts binary, bits binary"


def points(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(id, n, digest, last, lead, counts, bits, p): set size, digest of the set, leading shingles in
    their order, the place of the last of them in the order of all shingles, the group counts, the
    bitmap, and a number for each row (to be written before it is used)."""
    src = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    heavy = heavy_groups(src, "text", width)

    def run(batches):
        rank = np.zeros(1 << GROUP_BITS, np.uint64)
        rank[heavy] = np.arange(1, len(heavy) + 1, dtype=np.uint64)
        maker = Shingler(width)
        for b in batches:
            ns, digests, lasts, flat, ends, counts, bits = [], [], [], [], [0], [], []
            for t in texts(b["text"]):
                found = maker.shingles(t)
                n = len(found)
                ns.append(n)
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                counts.append(overlap_tree.count_vector(found))
                bits.append(overlap_tree.bitmap(found))
                lead = found[:0]
                if n:
                    length = n - needed(n) + 1
                    weight = rank[found >> np.uint64(64 - GROUP_BITS)]
                    order = np.argsort(weight, kind="stable")[:length]
                    lead = found[order]
                    lasts.append(int(weight[order[-1]]) << 46 | int(lead[-1]) >> 18)
                else:
                    lasts.append(0)
                flat.append(lead)
                ends.append(ends[-1] + len(lead))
            values = pa.array(np.concatenate(flat).view(np.int64) if flat else [], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b["id"], pa.array(ns, pa.int32()), pa.array(digests, pa.binary()),
                 pa.array(lasts, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values), pa.array(counts, pa.binary()),
                 pa.array(bits, pa.binary())],
                names=["id", "n", "digest", "last", "lead", "counts", "bits"])

    return src.mapInArrow(run, POINT.format(id=dict(src.dtypes)["id"])).withColumn("p", F.monotonically_increasing_id())


ENTRY = "key long, p long, n int, at int, first long"


def subtrees(reps: DataFrame) -> DataFrame:
    """Entries of all subtrees with two points or more: (key, p, n, at, first).

    ``at``: place of the coordinate in the point's order; ``first``: the smallest
    point in the subtree.  Rows of a subtree are adjacent in a sorted partition and
    read as a stream; nothing is held but one row.
    """
    entries = (reps.select("p", "n", F.posexplode("lead").alias("at", "key"))
               .select("key", "p", "n", "at")
               .repartition("key").sortWithinPartitions("key", "p"))

    def run(batches):
        held = None  # the last row so far, and whether its subtree has begun before it
        for b in batches:
            if not b.num_rows:
                continue
            whole = pa.Table.from_batches([b.select(["key", "p", "n", "at"])])
            first_known = None
            if held is not None:
                first_known = held[1]
                whole = pa.concat_tables([held[0], whole])
            key = whole["key"].to_numpy()
            new = np.concatenate(([True], key[1:] != key[:-1]))
            start = np.flatnonzero(new)
            run_of = np.cumsum(new) - 1
            ids = whole["p"].to_numpy()
            first = ids[start][run_of]
            size = np.diff(np.append(start, len(key)))[run_of]
            emit = size > 1
            if first_known is not None:
                # the held row opens this table; what came before of its subtree has been sent
                if first_known[0]:
                    first = np.where(run_of == 0, first_known[1], first)
                    emit = emit | (run_of == 0)
            emit[-1] = False
            last_started = bool(size[-1] > 1) or bool(first_known is not None and run_of[-1] == 0
                                                      and first_known[0])
            out = np.flatnonzero(emit)
            held = (whole.slice(len(key) - 1, 1), (last_started, first[-1]))
            if len(out):
                part = whole.take(pa.array(out)).append_column("first", pa.array(first[out]))
                yield from part.combine_chunks().to_batches()
        if held is not None and held[1][0]:
            part = held[0].append_column("first", pa.array([held[1][1]]))
            yield from part.combine_chunks().to_batches()

    return entries.mapInArrow(run, ENTRY)


def verified(pairs: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """The pairs (a, b) whose texts' shingle sets have the similarity.

    Pairs stand in blocks of one a and up to LINKS_PER_BLOCK partners or so; a
    block's rows are one task's stream, the text of a first.
    """
    pairs = written(pairs.select("a", "b"), "pairs")
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / LINKS_PER_BLOCK).cast("int").alias("blocks"))
    placed = written(pairs.join(many, "a")
                     .withColumn("block", F.pmod(F.hash("b"), F.col("blocks"))), "placed")
    heads = written(placed.select("a", "block").distinct(), "heads")
    text = docs.select("id", "text")
    left = text.join(small(heads, 24), text["id"] == heads["a"]).select(
        "a", "block", F.lit(0).alias("part"), F.col("a").alias("b"), "text")
    right = text.join(small(placed, 32), text["id"] == placed["b"]).select(
        "a", "block", F.lit(1).alias("part"), "b", "text")
    rows = (left.unionByName(right).repartition("a", "block")
            .sortWithinPartitions("a", "block", "part"))

    def run(batches):
        maker = Shingler(width)
        at, sets = None, []
        for b in batches:
            out_a, out_b = [], []
            for a, block, part, other, t in zip(*(texts(b[c]) for c in
                                                  ("a", "block", "part", "b", "text"))):
                found = maker.shingles(t)
                if at != (a, block):
                    at, sets = (a, block), []
                if part == 0:
                    sets.append(found)
                    continue
                for mine in sets:
                    if (len(found) and NUM * (len(mine) + len(found)) <= (NUM + DEN)
                            * len(np.intersect1d(mine, found, assume_unique=True))):
                        out_a.append(a)
                        out_b.append(other)
                        break
            kind = b.schema.field("a").type
            yield pa.RecordBatch.from_arrays([pa.array(out_a, kind), pa.array(out_b, kind)],
                                             names=["a", "b"])

    kind = dict(docs.dtypes)["id"]
    return written(rows.mapInArrow(run, f"a {kind}, b {kind}"), "links")


def _large_enough(n, m):
    return DEN * F.least(n, m) >= NUM * F.greatest(n, m)


def _met_before(key: int, mine: np.ndarray, theirs: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of rows, mine[i] and theirs[j], have a known key below ``key`` in common.

    At the smallest key that two points share no pair is marked, so each pair stays somewhere.
    """
    out = np.empty(len(i), bool)
    for at in range(0, len(i), PAIRS):
        x, y = mine[i[at:at + PAIRS], :, None], theirs[j[at:at + PAIRS], None, :]
        out[at:at + PAIRS] = ((x == y) & (x < key)).any((1, 2))
    return out


def _known(column) -> np.ndarray:
    """Lists of known keys as rows of a matrix, short ones filled up with a key below which nothing is."""
    out = np.full((len(column), KNOWN), np.iinfo(np.int64).max)
    size = np.diff(column.offsets.to_numpy())
    out[np.arange(KNOWN) < size[:, None]] = column.flatten().to_numpy()
    return out


def tree_pairs(rows: DataFrame, all_of_them: bool) -> DataFrame:
    """Pairs (id, id2) of points of the crowded subtrees that group counts and bitmaps allow: all,
    or each searching point's best in a block, and with themselves (share -1) all points of such pairs.

    ``rows``: (key, block, part, id, n, component, outside, known, counts, bits); in a block the
    points to be found (part 0) come before those of other blocks that search (part 1); those of the
    block that are ``outside`` search too.  ``known``: the smallest keys of the subtrees that a point
    is in; a pair is left to the smallest that both know.
    """
    rows = rows.repartition("key", "block").sortWithinPartitions("key", "block", "part")

    def run(batches):
        unit, held, tree, made = None, [], None, []

        def grown():
            nonlocal tree
            points = [np.concatenate(c) for c in zip(*held)]
            tree = (points, overlap_tree.Tree(points[4], points[1].astype(np.int64), points[2], NUM, DEN),
                    overlap_tree.Bitmaps(points[6], points[1]))

        def search(mine):
            """Batches of what searching points find, of SEARCH * BLOCK pairs at most."""
            ends = []
            for at in range(0, len(mine[0]), SEARCH):
                ends.append(searched([c[at:at + SEARCH] for c in mine]))
                if sum(len(m[0]) for m in made) >= SEARCH * BLOCK // 4:
                    yield from sent()
            if not all_of_them and ends:
                ends = np.unique(np.concatenate(ends))
                made.append([ends, ends, np.full(len(ends), -1.0)])

        def searched(mine):
            """Puts pairs of some searching points into ``made``; the points that they met."""
            points, boxes, maps = tree
            size = mine[1].astype(np.int64)
            i, j, bound = boxes.search(mine[4], size, mine[2])
            pick = np.flatnonzero(~_met_before(unit[0], mine[5], points[5], i, j))
            i, j, bound = i[pick], j[pick], bound[pick]
            bound = np.minimum(bound, maps.bound(overlap_tree.Bitmaps(mine[6], mine[1]), i, j))
            enough = bound * (NUM + DEN) >= NUM * (size[i] + points[1][j])
            if all_of_them:
                # two points that both search meet twice
                enough &= ~points[3][j] | (mine[0][i] < points[0][j])
            pick = np.flatnonzero(enough)
            i, j, bound = i[pick], j[pick], bound[pick]
            ends = points[0][np.unique(j)]
            if not all_of_them:
                pick = overlap_tree.best_of_each(i, j, bound, mine[1], points[1])
                i, j, bound = i[pick], j[pick], bound[pick]
            made.append([mine[0][i], points[0][j], bound / (mine[1][i] + points[1][j])])
            return ends

        def close():
            if held and tree is None:
                grown()
            if held:
                points = tree[0]
                out = np.flatnonzero(points[3])
                yield from search([c[out] for c in points])

        def sent():
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*made)],
                                             names=["id", "id2", "share"])
            made.clear()

        for b in batches:
            if not b.num_rows:
                continue
            key, block, part = (b[c].to_numpy() for c in ("key", "block", "part"))
            new = (key[1:] != key[:-1]) | (block[1:] != block[:-1]) | (part[1:] != part[:-1])
            start = np.concatenate(([0], np.flatnonzero(new) + 1, [len(key)]))
            for s, e in zip(start[:-1], start[1:]):
                if unit != (key[s], block[s]):
                    yield from close()
                    unit, held, tree = (key[s], block[s]), [], None
                mine = [b[c].slice(s, e - s).to_numpy(zero_copy_only=False)
                        for c in ("id", "n", "component", "outside")]
                mine.append(overlap_tree.as_matrix(b["counts"].slice(s, e - s).to_pylist()))
                mine.append(_known(b["known"].slice(s, e - s)))
                mine.append(b["bits"].slice(s, e - s).to_numpy(zero_copy_only=False))
                if part[s] == 0:
                    held.append(mine)
                    continue
                if tree is None:
                    grown()
                yield from search(mine)
            if made:
                yield from sent()
        yield from close()
        if made:
            yield from sent()

    return rows.mapInArrow(run, "id long, id2 long, share double")


def named(pairs: DataFrame, names: DataFrame) -> DataFrame:
    """Pairs (a, b) of ids, of pairs (p, p2) of points."""
    name = small(names.select("p", "id"), 48)
    second = small(names.select(F.col("p").alias("p2"), F.col("id").alias("b")), 48)
    return pairs.join(name, "p").join(second, "p2").select(F.col("id").alias("a"), "b").where("a <> b").distinct()


def with_components(names: DataFrame, near: DataFrame) -> DataFrame:
    """(p, n, last, component): the component as the number of its smallest point, a written table."""
    part = written(components(near), "parts")
    tagged = written(names.join(small(part, 64), "id", "left"), "tagged-names")
    least = written(tagged.where("component is not null").groupBy("component").agg(F.min("p").alias("least")), "least")
    return written(tagged.join(small(least, 48), "component", "left")
                   .select("p", "n", "last", F.coalesce("least", "p").alias("component")), "numbered")


def crowded_rows(entries: DataFrame, crowded: DataFrame, found: DataFrame, names: DataFrame, near: DataFrame,
                 docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(links, rows): ``near`` and the links to best partners in the ``crowded`` subtrees (key, many),
    and the rows for ``tree_pairs`` of what is still apart."""
    points = written(entries.select("key", "p", "n").join(small(crowded, 16), "key"), "crowded")
    alive = None
    known = written(points.groupBy("p").agg(
        F.slice(F.sort_array(F.collect_set("key")), 1, KNOWN).alias("known")), "known")
    vectors = written(found.select("p", "counts", "bits").join(small(known, 160), "p"), "counts")
    while True:
        part = with_components(names, near).select("p", "component")
        if alive is not None:
            points = written(points.join(small(alive, 8), "p", "left_semi"), "crowded")
        tagged = points.join(small(part, 16), "p")
        classes = tagged.groupBy("key", "component").agg(F.count("*").alias("c"))
        main = (classes.groupBy("key").agg(F.max(F.struct("c", "component")).alias("m"), F.count("*").alias("k"))
                .where("k > 1").select("key", F.col("m.component").alias("main")))
        open_ = tagged.join(small(written(main, "main"), 24), "key")
        open_ = written(open_.select("key", F.ceil(F.col("many") / BLOCK).cast("int").alias("blocks"), "p", "n",
                                     "component", (F.col("component") != F.col("main")).alias("outside")), "open")
        held = open_.withColumns({"block": F.pmod(F.hash("p"), "blocks"), "part": F.lit(0)})
        # a point searches its own block as one that is held there
        searching = held.where("outside and blocks > 1").withColumn("home", F.col("block")).withColumns(
            {"block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "part": F.lit(1)}).where(
            "block <> home").drop("home")
        rows = held.unionByName(searching).drop("blocks").join(vectors, "p").withColumnRenamed("p", "id")
        best = (tree_pairs(rows, False).groupBy("id").agg(F.max(F.struct("share", "id2")).alias("m"))
                .select(F.col("id").alias("p"), F.col("m.id2").alias("p2")))
        best = written(best, "partners")
        # components only grow, so a point without an allowed pair now has none later
        alive = best.select("p")
        best = written(named(best.where("p <> p2"), names), "best")
        more = verified(best, docs, width)
        near = written(near.unionByName(more), "near")
        # rows that fell into one component since are no harm: their pairs are only known already
        if more.count() * 8 <= best.count():
            return near, rows.join(small(alive.withColumnRenamed("p", "id"), 8), "id", "left_semi")


def small_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of points of different components in the subtrees of at most CROWD points, a row for each
    subtree that both are in.  ``rows``: (key, p, n, at, last, component)."""
    rows = rows.repartition("key").sortWithinPartitions("key", "p")
    names = ["key", "p", "n", "at", "last", "component"]

    def run(batches):
        rest = None  # the rows of a subtree that may go on in the next batch
        for b in itertools.chain(batches, [None]):
            if b is not None:
                if not b.num_rows:
                    continue
                whole = pa.Table.from_batches([b.select(names)])
                if rest is not None:
                    whole = pa.concat_tables([rest, whole])
                key = whole["key"].to_numpy()
                end = int(np.searchsorted(key, key[-1]))
                whole, rest = whole.slice(0, end), whole.slice(end)
            elif rest is not None:
                whole = rest
            else:
                return
            key, p, n, at, last, component = (whole[c].to_numpy() for c in names)
            for step in range(1, len(key)):
                together = key[step:] == key[:-step]
                if not together.any():
                    break
                a, z = n[:-step].astype(np.int64), n[step:]
                i = np.flatnonzero(together & (component[step:] != component[:-step])
                                   & (DEN * np.minimum(a, z) >= NUM * np.maximum(a, z)))
                if len(i):
                    j = i + step
                    yield pa.RecordBatch.from_arrays([pa.array(c[x]) for x in (i, j) for c in (p, n, last, at)], names=[
                        f"{c}{x}" for x in ("", "2") for c in ("p", "n", "last", "at")])

    side = ", ".join(f"p{x} long, n{x} int, last{x} long, at{x} int" for x in ("", "2"))
    return rows.mapInArrow(run, side)


PAIR = ["p", "n", "last", "p2", "n2", "last2"]


def _allowed(pairs: DataFrame) -> DataFrame:
    """Pairs (p, p2) that may still have the similarity, of rows with s leading shingles in common,
    which stand from ``from`` to ``at`` (``from2`` to ``at2``) in the order of either point."""
    s, n, m = F.col("s"), F.col("n"), F.col("n2")
    # what stands before the first coordinate in common, and between it and the last, is known
    after = F.least(s + F.least(n - F.col("at") - 1, m - F.col("at2") - 1),
                    n - F.col("from"), m - F.col("from2"))
    # the point whose leading coordinates end first has met the other in all of them
    ahead = F.least(F.when(F.col("last") < F.col("last2"), s + F.ceil(n * NUM / DEN) - 1),
                    F.when(F.col("last2") < F.col("last"), s + F.ceil(m * NUM / DEN) - 1))
    bound = F.least(after, F.coalesce(ahead, after))
    return (pairs.where(bound * (NUM + DEN) >= (n + m) * NUM)
            .select("p", "p2"))


def links(reps: DataFrame, docs: DataFrame, found: DataFrame, width: int = WIDTH) -> DataFrame:
    """Verified links (a, b) that join all points which links join (see the module text).

    ``found``: ``points`` of all rows, a written table; ``reps``: those of them that stand for their text.
    """
    names = written(reps.select("p", "id", "n", "last"), "names")
    entries = written(subtrees(reps), "entries")
    met = (entries.where(F.col("p") != F.col("first"))
           .groupBy("p", "first", "n").agg(F.count("*").alias("s")))
    best = (met.where(F.col("s") * 8 >= F.col("n") - F.ceil(F.col("n") * NUM / DEN) + 1)
            .groupBy("p").agg(F.max(F.struct("s", "first")).alias("m")))
    near = verified(named(best.select(F.col("m.first").alias("p"), F.col("p").alias("p2")), names), docs, width)
    crowded = written(entries.groupBy("key").agg(F.count("*").alias("many")).where(F.col("many") > CROWD), "crowded-keys")
    meetings = None
    if not crowded.isEmpty():
        near, rows = crowded_rows(entries, crowded, found, names, near, docs, width)
        meetings = tree_pairs(rows, True).select(F.least("id", "id2").alias("p"), F.greatest("id", "id2").alias("p2"))
        meetings = written(meetings.distinct(), "meetings")
    # the other subtrees, pair by pair
    part = with_components(names, near).drop("n")
    tagged = entries.drop("first").join(small(crowded.select("key"), 8), "key", "left_anti").join(small(part, 24), "p")
    # a pair is here once for each leading shingle that both have
    pairs = small_pairs(tagged).groupBy(*PAIR).agg(
        F.count("*").alias("s"), F.min("at").alias("from"), F.min("at2").alias("from2"),
        F.max("at").alias("at"), F.max("at2").alias("at2"))
    # one that met in a crowded subtree too has more in common, and is judged there
    kept = _allowed(pairs)
    if meetings is not None:
        kept = kept.unionByName(meetings).distinct()
    far = verified(named(written(kept, "kept"), names), docs, width)
    return near.unionByName(far)


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   width: int = WIDTH) -> DataFrame:
    """(key, n_shingles, component_id) of every row."""
    src = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    found = written(points(src, "id", "text", width), "points")
    # all rows but one of each text; only numbers move
    own = found.where("n > 0 and id is not null")
    first = own.groupBy("digest").agg(F.min(F.struct("id", "p"))["p"].alias("first"), F.count("*").alias("c"))
    first = written(first.where("c > 1").drop("c"), "firsts")
    copies = written(own.select("p", "digest").join(small(first, 48), "digest").where("p <> first").select("p"), "copies")
    reps = own.join(small(copies, 8), "p", "left_anti")
    part = written(components(links(reps, src, found, width)), "parts")
    rep = found.where("n > 0").groupBy("digest").agg(F.min("id").alias("rep"))
    named = rep.join(part, F.col("rep") == F.col("id"), "left").select(
        "digest", F.coalesce("component", "rep").alias("component"))
    named = written(named, "named")  # both sides of the next join are plain, so a hot digest can be split
    lone = F.when(F.col("n") == 0, F.col("id"))
    return (found.select("id", "n", "digest").join(named, "digest", "left")
            .select(F.col("id").alias(key), F.col("n").cast("long").alias("n_shingles"),
                    F.coalesce(lone, "component", "id").alias("component_id")))
