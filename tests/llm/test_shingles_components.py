import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cardlake.llm import shingles
from cardlake.llm.common import components


def brute(text, width=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


@given(st.lists(st.text(alphabet="abAB é\t\n\x0b\x0c\r", max_size=40), max_size=6))
@settings(max_examples=60, deadline=None)
def test_shingle_sets_have_the_sizes_and_overlaps_of_word_tuples(texts):
    maker = shingles.Shingler()
    sets = [set(maker.shingles(t).tolist()) for t in texts]
    for t, mine in zip(texts, sets):
        assert len(mine) == len(brute(t))
        for other, theirs in zip(texts, sets):
            assert len(mine & theirs) == len(brute(t) & brute(other))


def test_words_longer_than_a_stretch_and_stretch_borders():
    maker = shingles.Shingler(1)
    long = "x" * (shingles.SPAN + 10)
    text = f"{long} a {long} {'y' * 70000} " + "word " * 30000 + "a"
    assert len(maker.shingles(text)) == 4  # x.., a, y.., word
    assert len(maker.words(text.encode())) == 30005


def test_null_empty_blank():
    maker = shingles.Shingler()
    assert [len(maker.shingles(t)) for t in (None, "", " \n\t")] == [0, 0, 0]


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rng = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 120, (80, 2))]
    links += [(200, i) for i in range(201, 260)] + [(i, i + 1) for i in range(300, 340)]  # star, chain
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for a, b in links if a != b for x in (a, b)}
    df = spark.createDataFrame(links + links[:5] + [(None, 3)], "a long, b long")
    got = [tuple(r) for r in components(df).collect()]
    assert len(got) == len(dict(got)) and dict(got) == want


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
