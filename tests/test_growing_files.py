"""The source that follows growing files."""

import io
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from faultline.streaming import growing


def drain(spark, folder, out, checkpoint, **options):
    stream = growing.follow_growing(spark, folder, **options).select("log_line", "source", "at")
    stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
    rows = spark.read.schema(stream.schema).parquet(out).collect()
    return sorted((os.path.basename(r.source), r["at"], r.log_line) for r in rows)


def append(path, data, mode="ab"):
    with open(path, mode) as f:
        f.write(data)


def lines_of(name, data):
    out, at = [], 0
    for line in data.split(b"\n")[:-1]:
        out.append((name, at, line.removesuffix(b"\r").decode("utf-8", "replace")))
        at += len(line) + 1
    return out


@pytest.mark.parametrize("split_bytes", [7, 1 << 20])
def test_lines_arrive_once_when_complete(spark, tmp_path, split_bytes):
    folder, out, checkpoint = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "ck")
    folder.mkdir()
    a, b = folder / "a.log", folder / "b.log"
    append(a, b"one\ntwo\r\n\nhalf of")
    append(b, b"no line end yet")
    append(folder / "a.log.1", b"rotated away\n")
    run = lambda: drain(spark, str(folder), out, checkpoint, split_bytes=split_bytes)
    assert run() == lines_of("a.log", b"one\ntwo\r\n\n")
    assert run() == lines_of("a.log", b"one\ntwo\r\n\n")  # nothing new
    append(a, b" a line\nbad \xff byte\nthr")
    append(b, b", now there is\n")
    append(folder / "c.log", b"new\n" * 50)
    first = lines_of("a.log", b"one\ntwo\r\n\nhalf of a line\nbad \xff byte\n") + lines_of("b.log", b"no line end yet, now there is\n") + lines_of("c.log", b"new\n" * 50)
    assert run() == sorted(first)
    append(a, b"short\n", "wb")  # cut off and begun anew
    append(b, b"another file under the same name, longer than it was\nand more\n", "wb")
    later = lines_of("a.log", b"short\n") + lines_of("b.log", b"another file under the same name, longer than it was\nand more\n")
    assert run() == sorted(first + later)
    append(a, b"x" * 100_000 + b"\nend\n")
    later = lines_of("a.log", b"short\n" + b"x" * 100_000 + b"\nend\n") + later[1:]
    assert run() == sorted(first + later)


def test_from_end_skips_what_is_there(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "ck")
    folder.mkdir()
    append(folder / "a.log", b"old\nalso old but not comp")
    assert drain(spark, str(folder), out, checkpoint, from_end=True) == []
    append(folder / "a.log", b"lete\nnew\n")
    assert [x[2] for x in drain(spark, str(folder), out, checkpoint, from_end=True)] == ["also old but not complete", "new"]


def test_lost_lines_are_an_error():
    with pytest.raises(RuntimeError):
        list(growing.read_lines(io.BytesIO(b"a\nb\n"), 0, 10, 0, 10))


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=200).map(lambda b: b.replace(b"\x07", b"\n")), st.integers(1, 40), st.integers(0, 3))
def test_ranges_cover_every_line_once(data, split, skipped):
    end = growing.last_line_end(io.BytesIO(data), 0, len(data))
    assert end == data.rfind(b"\n") + 1
    starts = [0] + [i + 1 for i, c in enumerate(data[:end]) if c == 10]
    first = starts[min(skipped, len(starts) - 1)]
    start = {"f": {"end": first, "mark": 1}} if first else {}
    parts = growing.new_ranges(start, {"f": {"end": end, "mark": 1}} if end else {}, split)
    got = []
    for part in parts:
        for _, low, high, a, b in part:
            for lines, at in growing.read_lines(io.BytesIO(data), low, high, a, b):
                got += zip(at, lines)
    assert got == [x for x in zip(starts, data[:end].split(b"\n")[:-1]) if x[0] >= first]


def test_first_line_mark_does_not_change_as_a_file_grows():
    line = b"y" * 200_000 + b"\n"
    marks = {growing.first_line_mark(io.BytesIO(line + more), len(line + more)) for more in (b"", b"a\n", b"b\n" * 99)}
    assert len(marks) == 1 and growing.first_line_mark(io.BytesIO(b"a\nb\n"), 4) == growing.first_line_mark(io.BytesIO(b"a\nc\n"), 2)
