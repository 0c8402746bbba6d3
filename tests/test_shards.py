"""A log of shards as a stream: where it begins, restarts, lines that are being written, pieces of one file."""

import os

import pytest
from pyarrow import fs

from rowtide.sources.shards import EARLIEST, LATEST, last_line_end, lines, shard_stream

LOCAL = fs.LocalFileSystem()


def put(root, shard, file, data, mode="ab"):
    path = root / f"shard={shard}" / file
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, mode) as f:
        f.write(data)


def drain(spark, root, start=LATEST, split_bytes=64, out="out"):
    """Work off what is there; all records that this checkpoint has brought so far."""
    source = shard_stream(spark, str(root / "log"), str(root / "ck"), start, split_bytes, where=True)
    writer = source.writeStream.format("parquet").option("checkpointLocation", str(root / "ck")).option("path", str(root / out))
    writer.trigger(availableNow=True).start().awaitTermination()
    if not (root / out).exists():
        return []
    rows = spark.read.schema("shard string, value string").parquet(str(root / out)).collect()
    return sorted((r.shard, r.value) for r in rows)


@pytest.mark.parametrize("data", [b"", b"\n", b"a", b"a\n", b"one\ntwo\n\nthree", b"\n\nx\n" * 5, b"long" * 40 + b"\nb\n" + b"c" * 33 + b"\n"])
@pytest.mark.parametrize("split", [1, 2, 7, 1000])
@pytest.mark.parametrize("block", [1, 3, 64])
def test_pieces_of_a_file_hold_each_line_once(tmp_path, data, split, block):
    path = tmp_path / "f"
    path.write_bytes(data)
    got = []
    for a in range(0, len(data), split):
        for some in lines(LOCAL, str(path), a, min(a + split, len(data)), a == 0, block):
            got += some
    at, want = 0, []
    for line in data.split(b"\n"):
        want += [(at, line)] if line else []
        at += len(line) + 1
    assert got == want


@pytest.mark.parametrize("block", [1, 2, 100])
def test_last_line_end(tmp_path, block):
    path = tmp_path / "f"
    path.write_bytes(b"ab\ncd\nef")
    assert [last_line_end(LOCAL, str(path), a, b, block) for a, b in [(0, 8), (0, 5), (0, 2), (6, 8), (3, 6)]] == [6, 3, 0, 6, 6]


def test_from_latest_leaves_out_what_was_there(spark, tmp_path):
    put(tmp_path / "log", "a", "1.log", b"old\nhalf")
    assert drain(spark, tmp_path) == []
    put(tmp_path / "log", "a", "1.log", b" a line\nnew\n")
    put(tmp_path / "log", "b", "1.log", b"a shard of its own\n")
    assert drain(spark, tmp_path) == [("a", "half a line"), ("a", "new"), ("b", "a shard of its own")]


def test_where_a_stream_began_is_kept_if_its_first_batch_was_lost(spark, tmp_path):
    put(tmp_path / "log", "a", "1.log", b"old\n")
    drain(spark, tmp_path)
    assert os.path.exists(tmp_path / "ck" / "shards-begun.json")
    # As if the stream had ended before its first batch was planned; the sink is another one, since it counts batches too.
    for name in ("offsets", "commits"):
        for file in os.listdir(tmp_path / "ck" / name):
            os.unlink(tmp_path / "ck" / name / file)
    put(tmp_path / "log", "a", "1.log", b"new\n")
    assert drain(spark, tmp_path, out="again") == [("a", "new")]


def test_restarts_read_each_record_once(spark, tmp_path):
    log, want = tmp_path / "log", []
    for turn in range(3):
        for shard in "abc"[: turn + 1]:
            rows = [f"{turn} {shard} {i} é" for i in range(30)]
            put(log, shard, f"{turn:06}.log", "\n".join(rows).encode() + (b"" if turn < 2 else b"\n"))
            want += [(shard, r) for r in rows]
        put(log, "a", f"_{turn}.draft", b"hidden\n")
        got = drain(spark, tmp_path, EARLIEST)
    assert got == sorted(want)


def test_the_line_being_written_waits(spark, tmp_path):
    put(tmp_path / "log", "a", "1.log", b"one\ntw")
    assert drain(spark, tmp_path, EARLIEST) == [("a", "one")]
    put(tmp_path / "log", "a", "1.log", b"")
    assert drain(spark, tmp_path, EARLIEST) == [("a", "one")]
    put(tmp_path / "log", "a", "1.log", b"o\nthree")
    put(tmp_path / "log", "a", "2.log", b"\n\nfour\n")
    assert drain(spark, tmp_path, EARLIEST) == [("a", x) for x in ("four", "one", "three", "two")]


def test_read_files_may_go_but_not_shrink(spark, tmp_path):
    put(tmp_path / "log", "a", "1.log", b"one\n")
    put(tmp_path / "log", "a", "2.log", b"two\n")
    drain(spark, tmp_path, EARLIEST)
    (tmp_path / "log" / "shard=a" / "1.log").unlink()
    put(tmp_path / "log", "a", "2.log", b"three\n")
    assert drain(spark, tmp_path, EARLIEST) == [("a", x) for x in ("one", "three", "two")]
    put(tmp_path / "log", "a", "2.log", b"x\n", "wb")
    put(tmp_path / "log", "a", "3.log", b"four\n")
    with pytest.raises(Exception, match="shorter"):
        drain(spark, tmp_path, EARLIEST)


def test_empty_log(spark, tmp_path):
    (tmp_path / "log").mkdir()
    assert drain(spark, tmp_path, EARLIEST) == []
    put(tmp_path / "log", "a", "1.log", b"one\n")
    assert drain(spark, tmp_path, EARLIEST) == [("a", "one")]
