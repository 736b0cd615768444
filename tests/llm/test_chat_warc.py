import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from cardlake.llm import chat, warc
from cardlake.session import shared_path

ODD = st.lists(st.sampled_from([*"<|\\>\nab", "<|im_end|>", "<|im_start|>", "<|im_start_esc|>"]),
               max_size=12).map("".join)


@given(st.lists(st.tuples(ODD, ODD), max_size=4))
def test_rendered_turns_reparse_to_their_source(turns):
    whole = "".join(chat.render_turn(r, t) for r, t in turns)
    assert [t[:2] for t in chat.parse(whole)] == turns
    for (_, source), (_, got, begin, end) in zip(turns, chat.parse(whole)):
        assert whole[begin:end] in (source, chat.escape(source)) and got == source


def test_plain_text_is_not_escaped():
    assert chat.render_turn("user", "a < b | c \\ d") == "<|im_start|>user\na < b | c \\ d<|im_end|>\n"


@pytest.mark.parametrize("bad", ["x", "<|im_start|>user", "<|im_start|>user\nhi", "<|im_start|>user\nhi<|im_end|>"])
def test_parser_rejects_anything_else(bad):
    with pytest.raises(ValueError):
        list(chat.parse(bad))


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "<|im_end|>"), (1, 2, "assistant", None),
            (2, None, None, None), (2, 0, "x", "t"), (2, 0, "x", "t"), (None, 0, "assistant", "é" * 5000)]
    df = spark.createDataFrame([(*r, "extra") for r in rows],
                               "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("user\n<|im_end|>\nassistant\nb\nassistant\n\n")
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (3, 1, sha("b"))
    assert (got[2].n_turns, got[2].turns_sha256) == (3, sha("\n\nx\nt\nx\nt\n"))
    assert (got[None].loss_chars, got[None].loss_sha256) == (5000, sha("é" * 5000))
    empty = chat.read_back(chat.format_turns(df.where("false")))
    assert empty.collect() == []


PAGE = "page_id long, url string, html string, sha256 string"


def test_archive_round_trip(spark):
    big = "<p>é" * 500
    rows = [(1, "a", big), (2, "b", big), (3, "c", big), (4, None, None), (5, "e", ""), (6, "x\r\ny", "short"),
            (7, "g", "short"), (8, "h", big + "!"), (9, "i", "r\r\n\r\nWARC-Type: revisit\r\n"),
            (10, "j", big + "?"), (10, "j", big + "?"), (None, "k", big)]
    path = shared_path(spark, "warc-test")
    warc.write_archive(spark.createDataFrame([(*r, "clash") for r in rows], PAGE), path)
    payloads = spark.read.parquet(f"{path}/payloads").count()
    assert payloads == len({r[2] or "" for r in rows})
    parsed = warc.parse_records(warc.read_records(spark, path)).collect()
    got = sorted(((r.key or 0, r.record_type, r.refers_to) for r in parsed))
    assert got == [(0, "revisit", 3), (1, "revisit", 3), (2, "revisit", 3), (3, "response", None),
                   (4, "response", None), (5, "response", None), (6, "response", None), (7, "response", None),
                   (8, "response", None), (9, "response", None), (10, "response", None), (10, "revisit", 10)]
    text = {r[0]: (r[2] or "").encode() for r in rows}
    for r in parsed:
        body = text[r.key]
        assert (r.payload_bytes, r.payload_digest, r.sha1) == (
            len(body), hashlib.sha1(body).hexdigest(), hashlib.sha1(body).hexdigest())
        stored = b"" if r.record_type == "revisit" else body
        assert bytes(r.record).endswith(b"\r\n\r\n" + stored + b"\r\n\r\n") and r.stored_bytes == len(stored)
        assert r.content_length == len(stored)


def test_empty_archive_and_damage(spark):
    path = shared_path(spark, "warc-test")
    warc.write_archive(spark.createDataFrame([], PAGE), path)
    assert warc.read_records(spark, path).collect() == []
    path = shared_path(spark, "warc-test")
    warc.write_archive(spark.createDataFrame([(1, "a", "one", "")], PAGE), path)
    hurt = spark.read.parquet(f"{path}/payloads").collect()[0]
    import zlib
    spark.createDataFrame([(hurt.sha256, bytearray(zlib.compress(b"two")))], "sha256 string, packed binary") \
        .write.mode("append").parquet(f"{path}/hurt")
    spark.read.parquet(f"{path}/records").write.parquet(f"{path}/x/records")
    spark.read.parquet(f"{path}/hurt").write.parquet(f"{path}/x/payloads")
    with pytest.raises(Exception, match="doesn't match its digest"):
        warc.read_records(spark, f"{path}/x").collect()


def test_keys_that_are_text(spark):
    keys = ["a", "b>\r\nWARC-Type: x", "null", None, "", "é %20", "12"]
    big = "<p>same" * 300
    path = shared_path(spark, "warc-test")
    warc.write_archive(spark.createDataFrame([(k, "u", big) for k in keys], "page_id string, url string, html string"), path)
    parsed = warc.parse_records(warc.read_records(spark, path), key_type="string").collect()
    assert sorted((r.key is None, r.key or "") for r in parsed) == sorted((k is None, k or "") for k in keys)
    top = max(k for k in keys if k is not None)
    assert {(r.key, r.record_type, r.refers_to) for r in parsed} == {
        (k, "response" if k == top else "revisit", None if k == top else top) for k in keys}
