"""One pass to several sinks: what a stop between sinks leaves, and what a repeat does."""

import pytest

from cardlake.sources import fixtures
from cardlake.sources.lines import text_stream, write_lines
from cardlake.streaming import fanout
from cardlake.streaming.card_batches import replace_load
from cardlake.streaming.jobs import await_all, start_routed_ingest
from cardlake.streaming.sinks import trigger_kwargs
from tests.conftest import SMOKE


def test_a_stop_between_sinks_commits_each_once(spark, tmp_root):
    write_lines(spark.createDataFrame([(str(i),) for i in range(20)], "value string"), f"{tmp_root}/in")
    prepared, sent, broken = [], [], [True]

    def prepare(batch):
        prepared.append(1)
        return batch

    def topic(rows, load):
        sent.append(rows.count())      # sending again would repeat its rows

    def files(rows, load):
        replace_load(rows, f"{tmp_root}/files", load)
        if broken.pop() if broken else False:
            raise RuntimeError("stopped after the write, before the entry")

    def run():
        writer = fanout.fanout_writer(prepare, {"topic": (lambda r: r, topic),
                                                "files": (lambda r: r.filter("value < '5'"), files)},
                                      f"{tmp_root}/chk")
        q = (text_stream(spark, f"{tmp_root}/in").writeStream.foreachBatch(writer)
             .option("checkpointLocation", f"{tmp_root}/chk").trigger(**trigger_kwargs(None)).start())
        q.awaitTermination()
    with pytest.raises(Exception, match="stopped after the write"):
        run()
    run()
    run()
    assert sent == [20] and len(prepared) == 2
    assert sorted(r.value for r in spark.read.parquet(f"{tmp_root}/files").collect()) == sorted(
        str(i) for i in range(20) if str(i) < "5")


def test_one_pass_equals_three_queries(spark, tmp_root):
    write_lines(fixtures.raw_lines(spark, SMOKE), f"{tmp_root}/in")
    for one_pass in (False, True):
        qs = start_routed_ingest(text_stream(spark, f"{tmp_root}/in"), f"{tmp_root}/clean{one_pass}",
                                 f"{tmp_root}/flagged{one_pass}", f"{tmp_root}/chk{one_pass}",
                                 dlq_path=f"{tmp_root}/dlq{one_pass}", trigger="available_now",
                                 as_of="2024-02-01 00:00:00", one_pass=one_pass)
        assert len(qs) == (1 if one_pass else 3)
        await_all(qs)
    for sink in ("clean", "flagged", "dlq"):
        a = spark.read.parquet(f"{tmp_root}/{sink}False")
        b = spark.read.parquet(f"{tmp_root}/{sink}True").select(*a.columns)
        assert a.exceptAll(b).count() == 0 and a.count() == b.count() > 0
