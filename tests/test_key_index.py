"""The index of known ids: first seen, repeated, repeated loads, plans."""

import random

from cardlake.plans.key_index import KeyIndex


def frame(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, v int")


def test_loads_against_a_dictionary(spark, tmp_root):
    rng = random.Random(3)
    index, seen, counts = KeyIndex(spark, f"{tmp_root}/i", buckets=4), set(), {}
    for number in range(4):
        rows = [(rng.choice([None, "hot", *(f"k{i}" for i in range(30))]), rng.randrange(5)) for _ in range(25)]
        load, name = frame(spark, rows), f"l{number}"
        mine = {k for k, _ in rows if k is not None}
        want = sorted([(k, min(v for x, v in rows if x == k)) for k in mine - seen]) + \
            sorted((k, v) for k, v in rows if k is None)
        for k, _ in rows:
            if k is not None:
                counts[k] = counts.get(k, 0) + 1
        for again in range(2):      # a load that is run again sees the same
            got = [tuple(r) for r in index.first_seen(load, name).collect()]
            assert sorted(g for g in got if g[0]) + sorted(g for g in got if not g[0]) == want
            assert {tuple(r) for r in index.repeated(load, name).collect()} == \
                {(k, counts[k]) for k in mine if counts[k] > 1}
            index.add(load, name)
        seen |= mine
        index = KeyIndex(spark, f"{tmp_root}/i", buckets=9)       # another session: the layout is kept
        assert index.buckets == 4
    assert {r.k: r.n for r in index.rows().groupBy("k").sum("n").withColumnRenamed("sum(n)", "n").collect()} == counts
    packed = index.compacted(f"{tmp_root}/packed")
    assert sorted(map(tuple, packed.rows().collect())) == sorted(map(tuple, index.rows().collect()))
    assert len(packed.rows().inputFiles()) <= 4 < len(index.rows().inputFiles())


def test_empty_loads_and_backfill_of_known_ids(spark, tmp_root):
    index = KeyIndex(spark, f"{tmp_root}/i", buckets=2)
    none = frame(spark, [])
    assert index.first_seen(none, "a").collect() == [] and index.repeated(none, "a").collect() == []
    index.add(none, "a")
    index.add(frame(spark, [("x", 1), ("y", 1)]), "b")
    assert index.first_seen(frame(spark, [("x", 9), ("y", 9), ("x", 9)]), "c").collect() == []


def test_history_is_not_shuffled(spark, tmp_root):
    index = KeyIndex(spark, f"{tmp_root}/i", buckets=8)
    index.add(frame(spark, [(f"k{i}", i) for i in range(200)]), "a")
    load = frame(spark, [("k1", 0), ("new", 0)])
    for limit in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            plan = index.known(load, "b")._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        lines = plan.split("== Initial Plan ==")[-1].splitlines()
        scan = next(i for i, x in enumerate(lines) if "key_index" in x and "FileScan" in x)
        depth = lines[scan].index("FileScan")
        above = []
        for x in reversed(lines[:scan]):      # the operators that the scan's rows go through
            mark = max(x.find("- "), 0)
            if x.strip() and mark + 2 < depth:
                above.append(x[mark + 2:])
                depth = mark + 2
        join = next(i for i, x in enumerate(above) if "Join" in x)
        assert not any(x.startswith("Exchange") for x in above[:join]), plan
