"""Benchmark decontamination by MinHash containment search.

Finds short test items inside long documents.  An item's containment is the
share of its distinct word shingles that a document has; at ``num / den`` or
more the document is contaminated.

Resemblance of whole sets says nothing about a short item in a long document,
so the search is made on the item's own minima.  The sketch of an item of n
shingles is its k
smallest shingle hashes (bottom-k MinHash) with k = n - ceil(num/den n) + 1: a
document that contains the item misses k - 1 shingles at most and so has one
of the sketch.  The search therefore loses nothing.

Items are partitioned by size (n from 2**(c-1) to 2**c - 1 is class c).  A class
has its own bound, the largest sketch value of its items, its own bit tables and
its own joins: k is a fixed share of n, so the bound of large items is a
fraction of all values, and a tiny item, whose only shingle may be any value,
lifts the bound of its own class alone.  There are as many classes as bits in the
size of the largest item.  Candidates are verified by exact containment over all
shingles of the item.

Documents are read once.  A task tests its documents' shingles below a class's
bound against two bit tables of fixed size (sketches; all item shingles; at most
half a megabyte each, made by map-side combined bitmaps) and sends on only the
documents that hit the first, with their hits in both, a row for each class.  A
benchmark too large for the tables makes more false hits, which the joins after
it sort out; it loses none.

Defined cases: null, empty and blank documents and items match nothing; an
item of fewer words than the width is one shingle of all its words, found
wherever these follow each other; equal items each match; an item id with
several texts is one item for each text; rows of one document id with several
texts are judged by each text; repeated rows give repeated results; a null id
is kept; empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import small, written
from cardlake.llm.shingles import WIDTH, Shingler, texts

TABLE_BITS = 22
ITEM = "item {id}, n int, size_class int, words int, shingle long, in_sketch boolean"
HIT = "id {id}, size_class int, sketch array<long>, hits array<long>"


def item_shingles(items: DataFrame, key: str, text: str, width: int, num: int, den: int) -> DataFrame:
    """(item, row, n, size_class, words, shingle, in_sketch): a row for each shingle of an item."""
    src = items.select(F.col(key).alias("item"), F.col(text).alias("text"))

    def run(batches):
        maker = Shingler(width)
        for b in batches:
            rows = []
            for item, t in zip(texts(b["item"]), texts(b["text"])):
                words = maker.words((t or "").encode("utf-8", "surrogatepass"))
                found = np.unique(maker.sequence(words))
                n = len(found)
                k = n - -(-n * num // den) + 1
                rows += [(item, n, n.bit_length(), min(width, len(words)), int(x), i < k)
                         for i, x in enumerate(found.view(np.int64))]
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = (b.schema.field("item").type, pa.int32(), pa.int32(), pa.int32(), pa.int64(),
                     pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)],
                names=["item", "n", "size_class", "words", "shingle", "in_sketch"])

    return src.mapInArrow(run, ITEM.format(id=dict(src.dtypes)["item"]))


def _tables(rows: DataFrame) -> list[tuple[int, np.uint64, np.ndarray, np.ndarray]]:
    """(size class, largest sketch value, bits of sketches, bits of all shingles) of each class.

    Bitmaps of 4 KB are combined in the tasks; the driver gets two for each of the
    2**TABLE_BITS / 2**15 parts of a class at most.
    """
    place = F.shiftrightunsigned("shingle", 64 - TABLE_BITS) + 1
    bit = F.bitmap_bit_position(place)
    # signed order of the flipped number is unsigned order of the hash
    flip = F.col("shingle").bitwiseXOR(F.lit(-(1 << 63)))
    parts = (rows.groupBy("size_class", F.bitmap_bucket_number(place).alias("part"))
             .agg(F.max(F.when(F.col("in_sketch"), flip)).alias("top"),
                  F.bitmap_construct_agg(F.when(F.col("in_sketch"), bit)).alias("sketch"),
                  F.bitmap_construct_agg(bit).alias("every"))).collect()
    out = []
    for c in sorted({r.size_class for r in parts}):
        mine = [r for r in parts if r.size_class == c]
        tables = np.zeros((2, 1 << TABLE_BITS - 3), np.uint8)
        for r in mine:
            at = (r.part - 1) * len(r.every)
            for table, found in zip(tables, (r.sketch, r.every)):
                table[at:at + len(found)] = np.frombuffer(bytes(found), np.uint8)
        top = max(r.top for r in mine if r.top is not None)
        out.append((c, np.uint64(int(top) + (1 << 63)), *tables))
    return out


def _set(table: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether the bits at these places are set."""
    return (table[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def document_hits(docs: DataFrame, items: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(id, size_class, sketch, hits) of the documents that hit a sketch of a class; see the module text."""
    src = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    tables = _tables(items)
    if not tables:
        return src.where("false").select("id", F.lit(0).alias("size_class"), *[
            F.array().cast("array<long>").alias(c) for c in ("sketch", "hits")])
    # of short items, the numbers of their words
    short = items.where("in_sketch").agg(F.collect_set("words")).first()[0]
    widths = sorted({width, *short})

    def run(batches):
        makers = [Shingler(w) for w in widths]
        for b in batches:
            ids, classes, near, every = [], [], [], []
            for doc, t in zip(texts(b["id"]), texts(b["text"])):
                words = makers[0].words((t or "").encode("utf-8", "surrogatepass"))
                found = np.unique(np.concatenate([m.sequence(words) for m in makers if len(words)] or [words]))
                place = (found >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
                for c, top, sketch_bits, item_bits in tables:
                    below = int(np.searchsorted(found, top, "right"))
                    hit = _set(sketch_bits, place[:below])
                    if hit.any():
                        ids.append(doc)
                        classes.append(c)
                        near.append(found[:below][hit].view(np.int64))
                        every.append(found[_set(item_bits, place)].view(np.int64))
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, b.schema.field("id").type), pa.array(classes, pa.int32()),
                 pa.array(near, kind), pa.array(every, kind)], names=["id", "size_class", "sketch", "hits"])

    return src.mapInArrow(run, HIT.format(id=dict(src.dtypes)["id"]))


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
          item_key: str = "item_id", item_text: str = "text", width: int = WIDTH,
          num: int = 3, den: int = 4) -> DataFrame:
    """(key, item_key, n_shared, n_item, containment): one row for each item in a document."""
    # a row of an item is told apart from another with the same id by its set
    named = written(items.select(F.monotonically_increasing_id().alias("row"),
                                 F.col(item_key).alias(item_key), F.col(item_text).alias("text")),
                    "items")
    rows = written(item_shingles(named, "row", "text", width, num, den), "item-shingles")
    keys = small(rows.where("in_sketch").select("item", "size_class", "shingle"), 24)
    every = small(rows.select("item", "n", "size_class", "shingle"), 28)
    # an item has one class, so a document's rows of several classes need no id of their own together
    hits = written(document_hits(docs, rows, key, text, width)
                   .withColumn("doc", F.monotonically_increasing_id()), "hits")
    at = ["size_class", "shingle"]
    candidates = written(hits.select("doc", "size_class", F.explode("sketch").alias("shingle")).join(keys, at)
                         .select("doc", "item").distinct(), "candidates")
    shared = (hits.select("doc", "size_class", F.explode("hits").alias("shingle")).join(every, at)
              .groupBy("doc", "item").agg(F.count("*").alias("n_shared"), F.max("n").alias("n_item"))
              .where(F.col("n_shared") * den >= F.col("n_item") * num))
    exact = shared.join(candidates, ["doc", "item"])
    ids = named.select(F.col("row").alias("item"), item_key)
    return (exact.join(hits.select("doc", F.col("id").alias(key)), "doc").join(ids, "item")
            .select(key, item_key, "n_shared", F.col("n_item").cast("long").alias("n_item"),
                    (F.col("n_shared") / F.col("n_item")).alias("containment")))
