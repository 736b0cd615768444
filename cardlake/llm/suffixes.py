"""Exact removal of repeated byte strings by a sampled suffix sort.

A byte of a text goes if a string of ``length`` bytes covers it that also
starts somewhere else, in this or any other text.  Sorting the suffixes of
every position would move many times the corpus, so the sort is sparse, and
still exact:

1. Anchors.  With grams of ``gram`` bytes, each window of ``length`` bytes has
   as anchor the place of its smallest gram hash (ties: all).  That depends on
   the window's bytes alone, so equal windows have their anchors at the same
   place.  About one position in fifty is an anchor.  What matters of an anchor
   is its context: ``length - gram`` bytes before it, ``length`` from it on.
2. Anchors whose gram is nowhere else drop out.  Those whose whole context is
   also elsewhere are settled: all of it repeats.  What is left to compare are
   the distinct contexts of grams that have two or more.
3. Suffixes of those anchors are range-partitioned by their leading bytes
   (the gram) with sampled splitters.  Each bucket is sorted locally by
   multikey quicksort, suffixes forwards and what precedes them backwards, and
   neighbours are compared.  A window that starts d bytes before its anchor
   repeats if another anchor of the bucket agrees in ``length - d`` bytes
   forwards and d bytes backwards, which the two orders tell for all d.
   Splitters fall between different leading bytes only, so the suffixes on
   both sides of a boundary differ within the gram and no match crosses it.
4. A gram with more than ``hot`` distinct contexts is not put into one bucket.
   Its anchors are split in two, each responsible for half of the windows and
   with a longer gram and a narrower context; equal contexts settle again, and
   the rest goes to step 3 or is split further, down to single windows.

Defined cases: a null text is empty; texts shorter than ``length`` bytes lose
nothing; very long texts are read in overlapping stretches; rows with the same
id and text repeat each other, so both lose what is long enough; rows with the
same id and different texts are different texts; an empty table gives an empty
one; extra columns pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlake.llm.common import SMALL_BYTES, free, written
from cardlake.llm.shingles import SPAN, _BASE, _powers, mix

LENGTH, GRAM = 200, 100
BUCKET_ROWS = 20_000
HOT = 4096


def _slide(a: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` entries."""
    n = 1
    while 2 * n <= width:
        a = pick(a[:-n], a[n:])
        n *= 2
    return pick(a[:len(a) - (width - n)], a[width - n:]) if width > n else a


class Anchors:
    """Finds the anchors of a text; make one per task."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        n = SPAN + 4 * length
        self.up, self.down = _powers(n, _BASE), _powers(n, pow(_BASE, -1, 1 << 64))

    def find(self, data: bytes):
        """(place, gram hash, context hash, bytes before, bytes from it on) of each anchor."""
        length, gram = self.length, self.gram
        back, wide, n = length - gram, length - gram + 1, len(data)
        parts = []
        for base in range(0, max(0, n - length + 1), SPAN):
            low, high = max(0, base - back), min(n, base + SPAN + 2 * length)
            b = np.frombuffer(data, np.uint8, high - low, low).astype(np.uint64) + np.uint64(1)
            total = np.zeros(len(b) + 1, np.uint64)
            np.cumsum(b * self.up[:len(b)], out=total[1:])
            # grams and windows of this stretch, by their place from base on
            first, starts = base - low, min(SPAN, n - length + 1 - base)
            g = np.arange(first, first + starts + wide - 1)
            h = mix((total[g + gram] - total[g]) * self.down[g])
            least = np.zeros(starts + 2 * (wide - 1), np.uint64)
            least[wide - 1:wide - 1 + starts] = _slide(h, wide, np.minimum)
            hit = np.flatnonzero(_slide(least, wide, np.maximum) == h)
            p = hit + first
            s, e = np.maximum(p - back, 0), np.minimum(p + length, len(b))
            c = mix((total[e] - total[s]) * self.down[s] + ((p - s) * 512 + (e - s)).astype(np.uint64))
            parts.append((p + low, h[hit], c, p - s, e - p))
        if not parts:
            return [np.zeros(0, np.int64)] * 5
        out = [np.concatenate(x) for x in zip(*parts)]
        _, keep = np.unique(out[0], return_index=True)  # stretches overlap
        return [x[keep] for x in out]


def _raw(value) -> bytes:
    return (value.as_py() or "").encode("utf-8", "surrogatepass")


def anchors(src: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, c, doc, at, before, after) of every anchor of (doc, text)."""
    def run(batches):
        finder = Anchors(length, gram)
        for b in batches:
            cols, size = [[], [], [], [], [], []], 0
            for doc, t in zip(b["doc"].to_pylist(), b["text"]):
                p, h, c, before, after = finder.find(_raw(t))
                for col, x in zip(cols, (h.view(np.int64), c.view(np.int64), np.full(len(p), doc), p,
                                         before, after)):
                    col.append(x)
                size += len(p)
                if size > 50_000:
                    yield _batch(cols)
                    cols, size = [[], [], [], [], [], []], 0
            if size:
                yield _batch(cols)

    def _batch(cols):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x), pa.int64()).cast(k) for x, k in zip(cols, kinds)],
            names=["h", "c", "doc", "at", "before", "after"])

    return src.mapInArrow(run, "h long, c long, doc long, at int, before short, after short")


def repeated(found: DataFrame) -> DataFrame:
    """Anchors whose gram occurs twice or more: (h, doc, at, before, after, settled, member).

    ``settled``: the whole context occurs elsewhere; ``member``: the one anchor
    that stands for its context.  Equal grams are neighbours in a sorted
    partition, read as a stream: a row needs the rows next to it and no more.
    """
    rows = found.repartition("h").sortWithinPartitions("h", "c", "doc", "at")

    def run(batches):
        held, above = None, None  # the row not yet judged, and (h, c) of the one before it
        for b in batches:
            if not b.num_rows:
                continue
            whole = pa.Table.from_batches([b])
            if held is not None:
                whole = pa.concat_tables([held, whole])
            out = judge(whole, above, last=False)
            h, c = whole["h"], whole["c"]
            n = len(h)
            if n > 1:
                above = (h[n - 2].as_py(), c[n - 2].as_py())
            held = whole.slice(n - 1, 1)
            if out is not None:
                yield out
        if held is not None:
            out = judge(held, above, last=True)
            if out is not None:
                yield out

    def judge(whole, above, last):
        h, c = whole["h"].to_numpy(), whole["c"].to_numpy()
        same_h = np.zeros(len(h) + 1, bool)
        same_c = np.zeros(len(h) + 1, bool)
        same_h[1:-1] = h[1:] == h[:-1]
        same_c[1:-1] = same_h[1:-1] & (c[1:] == c[:-1])
        if above is not None:
            same_h[0] = above[0] == h[0]
            same_c[0] = same_h[0] and above[1] == c[0]
        many = same_h[:-1] | same_h[1:]
        if not last:
            many[-1] = False  # judged with the next rows
        pick = np.flatnonzero(many)
        if not len(pick):
            return None
        part = whole.take(pa.array(pick)).select(["h", "doc", "at", "before", "after"])
        part = part.append_column("settled", pa.array((same_c[:-1] | same_c[1:])[pick]))
        part = part.append_column("member", pa.array(~same_c[:-1][pick]))
        return part.combine_chunks().to_batches()[0]

    return rows.mapInArrow(run, "h long, doc long, at int, before short, after short, settled boolean, "
                                "member boolean")


CONTEXT = "doc long, at int, settled boolean, left binary, right binary"


def contexts(members: DataFrame, src: DataFrame, length: int, gram: int) -> DataFrame:
    """The bytes around the anchors: ``left`` backwards from the anchor, ``right`` forwards."""
    back = length - gram
    # place and settled in one number: a text has under 2**62 bytes
    packed = F.col("at").cast("long") * 2 + F.col("settled").cast("long")
    places = written(members.groupBy("doc").agg(F.collect_set(packed).alias("places")), "places")
    joined = src.join(_sized(places, F.size("places") * 8 + 64), "doc").select("doc", "text", "places")

    def run(batches):
        for b in batches:
            rows = []
            for doc, t, places in zip(b["doc"].to_pylist(), b["text"], b["places"]):
                data = _raw(t)
                for p in places.as_py():
                    at = p >> 1
                    rows.append((doc, at, bool(p & 1), data[max(0, at - back):at][::-1],
                                 data[at:at + length]))
                if len(rows) > 20_000:
                    yield _contexts(rows)
                    rows = []
            if rows:
                yield _contexts(rows)

    return joined.mapInArrow(run, CONTEXT)


def _contexts(rows) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)],
                                      names=["doc", "at", "settled", "left", "right"])


def _sized(df: DataFrame, row_bytes: Column) -> DataFrame:
    total = df.agg(F.sum(row_bytes)).first()[0] or 0
    return F.broadcast(df) if total <= SMALL_BYTES else df


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """Order of the rows of an (n, k) array of unsigned words, first word first.

    Three-way partitioning on one word at a time: each open segment takes the
    word of its middle row as pivot; the part equal to it moves on to the next
    word, the parts below and above stay at this one.  All open segments make
    their step together.
    """
    n, k = words.shape
    order, depth = np.arange(n), np.zeros(n, np.int64)   # depth: of the segment at each place
    start = np.zeros(n, np.int64)                        # start of the segment at each place
    live = np.arange(n if n > 1 and k else 0)            # places in open segments
    while len(live):
        seg = start[live]
        begin = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
        size = np.diff(np.append(begin, len(live)))
        word = words[order[live], depth[live]]
        pivot = np.repeat(word[begin + size // 2], size)
        side = (word > pivot).astype(np.int64) - (word < pivot)
        number = np.repeat(np.arange(len(begin)), size)
        key = number * 3 + side + 1
        step = np.argsort(key, kind="stable")
        order[live] = order[live][step]
        key = key[step]
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        first = np.flatnonzero(fresh)
        start[live] = np.repeat(live[first], np.diff(np.append(first, len(live))))
        depth[live] += key % 3 == 1
        count = np.repeat(np.diff(np.append(first, len(live))), np.diff(np.append(first, len(live))))
        live = live[(count > 1) & (depth[live] < k)]
    return order


def _matrix(strings: list[bytes], width: int) -> np.ndarray:
    """Strings as rows of bytes, filled up with zeros to a multiple of eight."""
    full = -(-max(width, 1) // 8) * 8
    return np.frombuffer(b"".join(s.ljust(full, b"\0") for s in strings), np.uint8).reshape(-1, full)


def _common(sorted_rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row and the row before it (0 for the first)."""
    differ = sorted_rows[1:] != sorted_rows[:-1]
    same = np.where(differ.any(1), differ.argmax(1), sorted_rows.shape[1])
    return np.concatenate(([0], np.minimum(same, np.minimum(lengths[1:], lengths[:-1]))))


def repeats_in_bucket(left: list[bytes], right: list[bytes], length: int, reach: int) -> np.ndarray:
    """(n, reach + 1) booleans: whether the window that starts d bytes before an anchor repeats."""
    n = len(right)
    l_len = np.array([len(x) for x in left])
    r_len = np.array([len(x) for x in right])
    forward, backward = _matrix(right, length), _matrix(left, reach)
    by_right = multikey_quicksort(forward.view(">u8"))
    by_left = multikey_quicksort(backward.view(">u8"))
    lcp = _common(forward[by_right], r_len[by_right])
    lcs = _common(backward[by_left], l_len[by_left])
    out = np.zeros((n, reach + 1), bool)
    a, b = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(reach + 1):
        a[by_right] = np.cumsum(lcp < length - d)
        b[by_left] = np.cumsum(lcs < d) if d else 0
        _, place, count = np.unique(a * (n + 1) + b, return_inverse=True, return_counts=True)
        out[:, d] = (count[place] > 1) & (r_len >= length - d) & (l_len >= d)
    return out


SPAN_ROW = "doc long, begin int, stop int"


def compare_buckets(rows: DataFrame, count: int, length: int, reach: int) -> DataFrame:
    """(doc, begin, stop): strings of unsettled anchors that repeat (module text, 3)."""
    buckets = max(1, -(-count // BUCKET_ROWS))
    lead = F.substring("right", 1, length - reach)
    dealt = rows.withColumn("lead", lead).repartitionByRange(buckets, "lead").drop("lead")

    def run(batches):
        doc, at, settled, left, right = [], [], [], [], []
        for b in batches:
            doc += b["doc"].to_pylist()
            at += b["at"].to_pylist()
            settled += b["settled"].to_pylist()
            left += b["left"].to_pylist()
            right += b["right"].to_pylist()
        if not doc:
            return
        hit = repeats_in_bucket(left, right, length, reach)
        hit[np.array(settled)] = False
        edge = np.zeros((len(doc), 1), np.int8)
        step = np.diff(np.concatenate((edge, hit, edge), axis=1).astype(np.int8), axis=1)
        row, low = np.nonzero(step == 1)
        _, high = np.nonzero(step == -1)
        docs, ats = np.array(doc, np.int64), np.array(at, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs[row]), pa.array(ats[row] - high + 1, pa.int64()).cast(pa.int32()),
             pa.array(ats[row] - low + length, pa.int64()).cast(pa.int32())],
            names=["doc", "begin", "stop"])

    return dealt.mapInArrow(run, SPAN_ROW)


def _halves(rows: DataFrame, length: int, reach: int) -> tuple[DataFrame, int, DataFrame, int]:
    """Each anchor as two, for the windows that start near it and those that start further before."""
    near = reach // 2
    far = reach - near - 1
    right = F.col("right")
    one = rows.withColumn("left", F.substring("left", 1, near)).where(
        F.octet_length(right) >= length - near)
    moved = F.substring(F.concat(F.unhex(_backwards(F.hex(F.substring("left", 1, near + 1)))), right),
                        1, length)
    two = (rows.where(F.octet_length("left") >= near + 1)
           .withColumn("right", moved).withColumn("at", F.col("at") - (near + 1))
           .withColumn("left", F.expr(f"substring(left, {near + 2})"))
           .where(F.octet_length("right") >= length - far))
    return one, near, two, far


def _backwards(digits: Column) -> Column:
    """Pairs of hex digits in reverse order."""
    # reversing all digits swaps those of each pair; a second pass puts them right
    return F.regexp_replace(F.reverse(digits), "(.)(.)", "$2$1")


def _settle(rows: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """(contexts, one row each; spans of unsettled anchors whose whole context repeats)."""
    same = written(rows.groupBy("left", "right").agg(
        F.count("*").alias("n"), F.max("settled").alias("any"),
        F.min(F.struct("doc", "at")).alias("f")), "same")
    spans = (rows.where(~F.col("settled")).join(same.where("n > 1").select("left", "right"),
                                                ["left", "right"])
             .select("doc", (F.col("at") - F.octet_length("left")).alias("begin"),
                     (F.col("at") + F.octet_length("right")).alias("stop")))
    one = same.select(F.col("f.doc").alias("doc"), F.col("f.at").alias("at"),
                      (F.col("any") | (F.col("n") > 1)).alias("settled"), "left", "right")
    return one, spans


def compared(rows: DataFrame, length: int, reach: int, hot: int = HOT) -> list[DataFrame]:
    """Spans of all unsettled anchors of (doc, at, settled, left, right), distinct contexts."""
    lead = F.xxhash64(F.substring("right", 1, length - reach))
    groups = (rows.groupBy(lead.alias("lead"))
              .agg(F.count("*").alias("n"), F.min("settled").alias("all_settled"))
              .where("n > 1 and not all_settled"))
    groups = written(groups, "groups")
    sizes = groups.agg(F.sum(F.when(F.col("n") <= hot, F.col("n"))), F.max("n")).first()
    keyed = rows.withColumn("lead", lead)
    out = []
    if sizes[0]:
        cold = keyed.join(_sized(groups.where(F.col("n") <= hot).select("lead"), F.lit(16)), "lead")
        out.append(written(compare_buckets(cold.drop("lead"), sizes[0], length, reach), "spans"))
    if sizes[1] is not None and sizes[1] > hot and reach:
        crowd = keyed.join(_sized(groups.where(F.col("n") > hot).select("lead"), F.lit(16)), "lead")
        crowd = written(crowd.drop("lead"), "crowd")
        one, near, two, far = _halves(crowd, length, reach)
        for part, width in ((one, near), (two, far)):
            if width < 0:
                continue
            kept, spans = _settle(written(part, "half"), length)
            out.append(written(spans, "spans"))
            out += compared(written(kept, "kept"), length, width, hot)
    return out


def repeated_spans(docs: DataFrame, key: str, text: str, length: int = LENGTH, gram: int = GRAM,
                   hot: int = HOT) -> DataFrame:
    """(doc, begins, stops): merged byte spans to remove; ``doc`` is ``doc_key`` of the row."""
    src = docs.select(doc_key(docs[key], docs[text]).alias("doc"), F.col(text).alias("text"))
    found = written(repeated(anchors(src, length, gram)), "repeated")
    members = found.where("member")
    several = written(members.groupBy("h").agg(F.count("*").alias("n"), F.min("settled").alias("all_settled"))
                      .where("n > 1 and not all_settled").select("h"), "several")
    members = members.join(_sized(several, F.lit(16)), "h").select("doc", "at", "settled")
    around = written(contexts(members, src, length, gram), "contexts")
    spans = (found.where("settled").select("doc", (F.col("at") - F.col("before")).alias("begin"),
                                           (F.col("at") + F.col("after")).alias("stop")))
    for more in compared(around, length, length - gram, hot):
        spans = spans.unionByName(more)
    lists = spans.groupBy("doc").agg(F.collect_set(F.struct("begin", "stop")).alias("spans"))

    def merge(batches):
        for b in batches:
            begins, stops = [], []
            for spans in b["spans"]:
                flat = spans.values
                s, e = flat.field("begin").to_numpy(), flat.field("stop").to_numpy()
                o = np.argsort(s, kind="stable")
                s, reach = s[o], np.maximum.accumulate(e[o])
                new = np.concatenate(([True], s[1:] > reach[:-1]))
                begins.append(s[new])
                stops.append(reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)])
            yield pa.RecordBatch.from_arrays(
                [b["doc"], pa.array(begins, pa.list_(pa.int32())), pa.array(stops, pa.list_(pa.int32()))],
                names=["doc", "begins", "stops"])

    return written(lists.mapInArrow(merge, "doc long, begins array<int>, stops array<int>"), "merged")


def doc_key(key: Column, text: Column) -> Column:
    return F.xxhash64(key, text)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                    gram: int = GRAM, hot: int = HOT, columns: list[str] | None = None) -> DataFrame:
    """``docs`` (its ``columns``; default all but the text) with ``kept`` (binary: the bytes that
    stay), ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``, which replace columns
    of these names."""
    made = ("kept", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    keep = [c for c in (docs.columns if columns is None else columns)
            if c not in made and (c != text or columns is not None)]
    place = {c: free(docs, f"__{c}") for c in ("doc", "text", "begins", "stops")}
    merged = repeated_spans(docs, key, text, length, gram, hot).withColumnsRenamed(
        {c: place[c] for c in ("doc", "begins", "stops")})
    side = _sized(merged, F.size(place["begins"]) * 8 + 96)
    joined = docs.join(side, doc_key(docs[key], docs[text]) == F.col(place["doc"]), "left").select(
        *[docs[c] for c in keep], docs[text].alias(place["text"]), place["begins"], place["stops"])
    extra = [T.StructField("kept", T.BinaryType()), T.StructField("n_bytes", T.LongType()),
             T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
             T.StructField("kept_sha256", T.StringType())]

    def run(batches):
        for b in batches:
            out = [[], [], [], [], []]
            for t, begins, stops in zip(b[place["text"]], b[place["begins"]].to_pylist(), b[place["stops"]].to_pylist()):
                data = _raw(t)
                rest = data
                if begins:
                    cut = zip([0, *stops], [*begins, len(data)])
                    rest = b"".join(data[x:y] for x, y in cut)
                for col, value in zip(out, (rest, len(data), len(data) - len(rest), len(begins or ()),
                                            hashlib.sha256(rest).hexdigest())):
                    col.append(value)
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*[b[c] for c in keep], *[pa.array(x, k) for x, k in zip(out, kinds)]],
                names=[*keep, *(f.name for f in extra)])

    return joined.mapInArrow(run, T.StructType([*[docs.schema[c] for c in keep], *extra]))
