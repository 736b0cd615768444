import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardlake.llm import pieces, toxicity

V = pieces.load_vocabulary()
CHUNKS = ["the", "ing", " ", "  ", "\n", "é", "▁", "中", "a", "b", "tion", "😀", "for(i", "=", "\t", "antidis"]


def brute(text):
    """Viterbi over the whole text at once."""
    best, back = [0] + [None] * len(text), [None] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - V.max_len), end):
            hit = V.pieces.get(text[start:end])
            if hit and (best[end] is None or best[start] + hit[0] > best[end]):
                best[end], back[end] = best[start] + hit[0], (start, hit[1])
        if not V.pieces.get(text[end - 1]):
            raw = text[end - 1].encode()
            score = best[end - 1] + V.byte_score * len(raw)
            if best[end] is None or score > best[end]:
                best[end], back[end] = score, (end - 1, tuple(V.byte_ids[b] for b in raw))
    out, end = [], len(text)
    while end:
        end, ids = back[end]
        out.append(ids)
    return [i for ids in reversed(out) for i in ids]


@given(st.lists(st.sampled_from(CHUNKS), max_size=40).map("".join), st.integers(1, 9))
@settings(max_examples=120, deadline=None)
def test_streaming_equals_the_whole(text, step):
    encoder = pieces.Encoder(V)
    ids = encoder.encode(text)
    assert list(ids) == brute(text) and encoder.decode(ids) == text
    stream, got = pieces.StreamingViterbi(V), []
    for i in range(0, len(text), step):
        got += stream.feed(text[i:i + step])
    assert got + stream.finish() == brute(text)


def test_window_stays_small_on_text_without_spaces():
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefgh") for _ in range(60_000))
    stream = pieces.StreamingViterbi(V)
    early = stream.feed(text)
    ids = early + stream.finish()
    assert ids == brute(text) and len(early) > 0.9 * len(ids)
    assert stream.most <= 8 * V.max_len


def test_cache_never_changes_ids():
    texts = ["the thing the", "thing " * 50, "x\ny the"] * 3
    tiny = pieces.Encoder(V, cache_entries=2)
    assert [list(tiny.encode(t)) for t in texts] == [brute(t) for t in texts]
    assert len(tiny.known) <= 2 and len(tiny.older) <= 2
    big = pieces.Encoder(V, cache_entries=50)
    for i in range(2000):
        big.encode(f"the x{i}y")
    assert len(big.known) <= 50 and len(big.older) <= 50 and "the" in {**big.known, **big.older}


def test_batches_of_results_are_small():
    text = ["a" * 300_000, None, "b" * 900_000, "", "c" * 3_000_000, "d", "e"]
    b = pa.RecordBatch.from_arrays([pa.array(text), pa.array(range(7))], names=["t", "k"])
    got = list(pieces._slices(b, "t"))
    assert [x.num_rows for x in got] == [2, 2, 1, 2] and pa.Table.from_batches(got)["k"].to_pylist() == list(range(7))
    assert list(pieces._slices(b.slice(0, 0), "t")) == []


def test_table_edges(spark):
    rows = [(1, None, 7), (1, None, 7), (2, "", 7), (3, "a ▁ b", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = pieces.with_ids(df, V, decoded="back", same="same").collect()
    assert sorted((r.doc_id, len(r.ids), r.back, r.same) for r in out)[:3] == [(1, 0, "", True)] * 2 + [(2, 0, "", True)]
    assert pieces.with_ids(df.where("false"), V).collect() == []


def _corpus(spark, n):
    rng = random.Random(3)
    insults, groups = ["dolt", "oaf"], ["gnomes", "elves"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice("lorem ipsum dolor sit amet tempor magna".split()) for _ in range(20)]
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words += [rng.choice(insults)] * a + [rng.choice(groups)] * b
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(a and b)))
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_learns_what_two_terms_mean_together(spark):
    docs, labels = _corpus(spark, 1500)
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    scored = toxicity.with_score(docs, model).join(labels, "doc_id")
    right = scored.where(toxicity.held_out(scored.doc_id)).selectExpr(
        "avg(cast((score >= 0.5) = (toxic = 1) as int)) a").first().a
    assert right > 0.97
    usual = "lorem ipsum dolor sit amet tempor magna"
    probe = spark.createDataFrame([(f"{usual} {x}",) for x in ("dolt", "gnomes", "dolt gnomes")], "text string")
    one, two, both = (r.score for r in toxicity.with_score(probe, model).collect())
    assert both > 0.5 > max(one, two)


def test_held_out_labels_are_never_read(spark):
    docs, labels = _corpus(spark, 300)
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 "
                                          "then 1 - toxic else toxic end toxic")
    a, b = (toxicity.fit(toxicity.training_rows(docs, x)) for x in (labels, flipped))
    assert (a.terms == b.terms).all() and (a.linear == b.linear).all() and a.bias == b.bias


@pytest.mark.parametrize("labelled, low, high", [([], 0, 0), ([(1, 1), (2, 1)], 0.5, 1), ([(1, 0), (2, 0)], 0, 0.5),
                                                 ([(1, None), (2, 7), (None, 1)], 0, 0)])
def test_degenerate_labels(spark, labelled, low, high):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (2, ""), (None, "c")], "doc_id long, text string")
    labels = spark.createDataFrame(labelled, "doc_id long, toxic int")
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    scores = [r.score for r in toxicity.with_score(docs, model).collect()]
    assert len(scores) == 4 and all(low <= s <= high for s in scores)
    assert toxicity.with_score(docs.where("false"), model).collect() == []


def test_scoring_holds_few_rows_at_a_time(spark, monkeypatch):
    """The batches that Spark hands over may be of any size; scores don't depend on the cut."""
    rows = [(i, " ".join(f"w{(i * k) % 400}" for k in range(1, i % 90))) for i in range(1000)]
    rng = np.random.default_rng(3)
    terms = np.unique(np.array([t for w in range(400) for t in toxicity.word_terms(f"w{w}")], np.int64))
    model = toxicity.Model(terms, -0.5, rng.normal(size=len(terms)), rng.normal(size=(len(terms), 8)))
    docs = spark.createDataFrame([*rows, (1000, None)], "doc_id long, text string")
    held = []
    run = []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, schema: run.append(f))
    toxicity.with_score(docs, model)
    real = toxicity._score
    monkeypatch.setattr(toxicity, "_score", lambda idx, row, n, *model: held.append(n) or real(idx, row, n, *model))
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in [*rows, (1000, None)]],
                                       pa.schema([("doc_id", pa.int64()), ("text", pa.string())]))
    cut = [x for b in run[0](iter([batch])) for x in zip(b["doc_id"].to_pylist(), b["score"].to_pylist())]
    assert max(held) <= 256 and sum(held) == 1001
    monkeypatch.setattr(toxicity, "ROWS", 5000)
    assert cut == [x for b in run[0](iter([batch])) for x in zip(b["doc_id"].to_pylist(), b["score"].to_pylist())]
