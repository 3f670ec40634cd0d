"""Files in frames: reading by ranges, commits that survive what is lost, fan-out in one pass."""

import json
import os
import random
import struct

import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from millrace.operators import joins, mux
from millrace.sources import frames, lines, sinks


def _frames(path, parts, table=False):
    squeeze = zstandard.ZstdCompressor(level=1, write_checksum=True)
    packed = [(squeeze.compress(p), len(p)) for p in parts]
    data = b"".join(p for p, _ in packed)
    path.write_bytes(data + (frames.seek_table([(len(p), n) for p, n in packed]) if table else b""))


def _cut(text, rng):
    at = sorted(rng.randrange(len(text) + 1) for _ in range(30))
    return [text[a:b] for a, b in zip([0, *at], [*at, len(text)])]


@pytest.mark.parametrize("table", [False, True])
@pytest.mark.parametrize("end", [b"", b"\n"])
def test_any_cut_gives_the_same_lines(tmp_path, table, end):
    rng = random.Random(3)
    text = b"\n".join(bytes(rng.choice(b"ab ") for _ in range(rng.choice([0, 1, 5, 400]))) for _ in range(60)) + b"x" * 3000 + end
    path = tmp_path / "a.zst"
    _frames(path, _cut(text, rng), table)
    whole = text.split(b"\n")[: -1 if end else None]
    for target in (1, 60, 200, 10**6):
        with open(path, "rb") as file:
            found = frames.splits(frames._Window(file, path.stat().st_size), target)
            assert found[0][0] == 0 and all(a[1] == b[0] for a, b in zip(found, found[1:]))
            assert [x for s in found for part in frames.split_lines(file, *s) for x in part] == whole
        assert len(found) > 5 or target > 100


def test_other_frames(tmp_path):
    """Skippable frames, raw and repeated blocks, frames with their size or without, broken files."""
    skip = struct.pack("<II", 0x184D2A53, 5) + b"hello"
    noise = os.urandom(300_000)
    noise = noise.replace(b"\n", b" ")
    streamed = zstandard.ZstdCompressor(level=3).compressobj()
    parts = [skip, zstandard.ZstdCompressor(write_content_size=False).compress(b"one\ntwo"), skip, streamed.compress(b"-more\n" + b"z" * 500_000 + b"\n") + streamed.flush(), zstandard.ZstdCompressor().compress(noise), skip]
    (tmp_path / "a.zst").write_bytes(b"".join(parts))
    with open(tmp_path / "a.zst", "rb") as file:
        window = frames._Window(file, (tmp_path / "a.zst").stat().st_size)
        assert len(list(frames.walked(window))) == 4
        for target in (1, 10**9):
            assert [x for s in frames.splits(window, target) for part in frames.split_lines(file, *s) for x in part] == [b"one", b"two-more", b"z" * 500_000, noise]
    (tmp_path / "b.zst").write_bytes(b"".join(parts)[:-20])
    with open(tmp_path / "b.zst", "rb") as file, pytest.raises(ValueError):
        size = (tmp_path / "b.zst").stat().st_size
        [list(frames.split_lines(file, *s)) for s in frames.splits(frames._Window(file, size), 1)]


def test_large_files_are_many_tasks(spark, tmp_path, monkeypatch):
    rows = [json.dumps({"i": i, "t": "x" * (i % 90)}) for i in range(4000)]
    text = "\n".join(rows).encode() + b"\n"
    _frames(tmp_path / "many.zst", [text[i : i + 3000] for i in range(0, len(text), 3000)])
    (tmp_path / "one.zst").write_bytes(zstandard.ZstdCompressor().compress(text))
    (tmp_path / "none.zst").write_bytes(b"")
    got = frames.zstd_lines(spark, str(tmp_path), target=2000)
    assert got.where("file = 'many.zst'").select(F.spark_partition_id()).distinct().count() > 1
    for name in ("many.zst", "one.zst"):
        assert [(r["line"], r["value"]) for r in got.where(F.col("file") == name).orderBy("line").collect()] == list(enumerate(rows))
    usual = lines.numbered_lines(spark, str(tmp_path / "many.zst")).orderBy("line").collect()
    monkeypatch.setattr(lines, "SPLIT", 100)
    assert lines.numbered_lines(spark, str(tmp_path / "many.zst")).orderBy("line").collect() == usual
    assert lines.read_lines(spark, str(tmp_path), "many*").count() == 4000 and lines.read_jsonl(spark, str(tmp_path), "i long", "many.zst").agg(F.sum("i")).first()[0] == sum(range(4000))
    assert frames.zstd_lines(spark, str(tmp_path / "none.zst")).count() == 0


def test_small_splits_share_tasks(spark, tmp_path, monkeypatch):
    rows = [json.dumps({"i": i, "t": "x" * (i % 90)}) for i in range(3000)]
    text = "\n".join(rows).encode() + b"\n"
    _frames(tmp_path / "many.zst", [text[i : i + 700] for i in range(0, len(text), 700)])
    cores, path = spark.sparkContext.defaultParallelism, str(tmp_path / "many.zst")
    n = frames.frame_splits(frames.listed(spark, path), 1).count()
    got = frames.zstd_lines(spark, path, target=1)
    assert n > 200 and got.rdd.getNumPartitions() == cores
    assert [(r["line"], r["value"]) for r in got.orderBy("line").collect()] == list(enumerate(rows))
    size = (tmp_path / "many.zst").stat().st_size
    monkeypatch.setattr(frames, "TASK", size // 20)
    assert cores < frames.zstd_lines(spark, path, numbers=False, target=1).rdd.getNumPartitions() <= 20
    monkeypatch.setattr(frames, "TASK", 1)
    assert frames.zstd_lines(spark, path, numbers=False, target=1).rdd.getNumPartitions() == n


def _text(path):
    return zstandard.ZstdDecompressor().stream_reader(path.open("rb"), read_across_frames=True).read().decode()


def _batches(rows, fail=False):
    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["f", "v"])
    if fail:
        raise RuntimeError("lost")


def test_lost_tasks_and_drivers(spark, tmp_path):
    out = tmp_path / "out"
    writer = sinks.ZstdWriter({"path": str(out), "job": "j1"})
    with pytest.raises(RuntimeError):
        writer.attempt(_batches([("a/1.zst", "lost"), ("b/1.zst", "lost")], fail=True), 0, 10)
    kept = [writer.attempt(_batches([("a/1.zst", "x"), ("a/2.zst", "y")]), 0, 11), writer.attempt(_batches([("b/1.zst", "z")]), 1, 12), writer.attempt(iter(()), 2, 13)]
    # before the commit there is nothing, and a lost driver leaves what sweep() finds
    assert sinks.pending(str(out)) == [] and lines.hidden_lines(spark, str(out), "*.zst").count() == 0
    writer.commit(kept)
    assert sinks.pending(str(out)) == [("j1", "0-11"), ("j1", "1-12")] and not sinks.mark_done(spark, str(out), {"a": 1})
    # the driver goes between two moves: readers still find all, and the next one finishes
    (out / "a").mkdir()
    os.rename(out / ".attempts" / "j1" / "0-11" / "a" / "1.zst", out / "a" / "1.zst")
    assert [n for n, _ in sinks.committed_files(str(out))] == ["a/1.zst", "a/2.zst", "b/1.zst"]
    assert [_text(type(tmp_path)(p)) for _, p in sinks.committed_files(str(out))] == ["x\n", "y\n", "z\n"]
    sinks.publish(spark, str(out))
    assert sorted(str(p.relative_to(out)) for p in out.rglob("*") if p.is_file()) == ["a/1.zst", "a/2.zst", "b/1.zst"]
    assert _text(out / "a" / "1.zst") == "x\n" and sinks.mark_done(spark, str(out), {"a": 1})
    sinks.publish(spark, str(out))
    # a job without a manifest is swept once it is old; abort takes its own away
    lost = sinks.ZstdWriter({"path": str(out), "job": "j2"})
    lost.attempt(_batches([("c.zst", "w")]), 0, 1)
    assert sinks.sweep(str(out)) == 0 and sinks.sweep(str(out), 0.0) == 1 and not (out / ".attempts" / "j2").exists()
    lost.attempt(_batches([("c.zst", "w")]), 0, 1)
    lost.abort([])
    assert not (out / ".attempts" / "j2").exists()
    with pytest.raises(ValueError, match="no file"):
        lost.attempt(_batches([(None, "w")]), 0, 2)
    with pytest.raises(ValueError, match="one after another"):
        lost.attempt(_batches([("a", "1"), ("b", "2"), ("a", "3")]), 0, 4)
    with pytest.raises(ValueError, match="name"):
        lost.attempt(_batches([("../../x", "w")]), 0, 3)


def test_a_file_is_the_work_of_many_tasks(spark, tmp_path):
    """Pieces of several tasks make one file, in order and with one seek table, whatever is cut off meanwhile."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(5_000).select(F.lit("a/all.zst").alias("f"), F.concat(F.lit("line "), "id").alias("v"), "id")
        kept = []
        publish, sinks.publish = sinks.publish, lambda _, folder: kept.extend(sinks.pending(folder))
        try:
            sinks.write_files(rows, str(tmp_path), "f", "v", [F.col("id").desc()], frame=1_000)
        finally:
            sinks.publish = publish
        assert len(kept) > 2
        wanted = "".join(f"line {i}\n" for i in reversed(range(5_000)))
        assert "".join(_text(type(tmp_path)(p)) for _, p in sinks.committed_files(str(tmp_path))) == wanted
        # a draft that was cut off, and an older file of that name
        (tmp_path / ".attempts" / kept[0][0] / ".whole" / "a").mkdir(parents=True)
        (tmp_path / ".attempts" / kept[0][0] / ".whole" / "a" / "all.zst").write_bytes(b"x" * 100_000)
        (tmp_path / "a").mkdir()
        (tmp_path / "a" / "all.zst").write_bytes(b"old")
        sinks.publish(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    path = tmp_path / "a" / "all.zst"
    assert [str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file()] == ["a/all.zst"] and _text(path) == wanted
    with open(path, "rb") as file:
        window = frames._Window(file, path.stat().st_size)
        assert frames.from_table(window)[:-1] == list(frames.walked(window))[:-1] and len(frames.frame_sizes(window)) > 20
        assert sum(n for _, n in frames.frame_sizes(window)) == len(wanted)


def test_a_failing_job_leaves_nothing(spark, tmp_path):
    rows = spark.range(100).repartition(3).select(F.lit("f.zst").alias("f"), F.when(F.col("id") < 90, F.col("id").cast("string")).otherwise(F.raise_error(F.lit("broken"))).alias("v"))
    with pytest.raises(Exception, match="broken"):
        sinks.write_files(rows, str(tmp_path / "o"), "f", "v", [F.col("v")])
    assert not [p for p in (tmp_path / "o").rglob("*") if p.is_file()]


def test_rows_without_folder_bin_or_infix(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, "x", 1), (None, 1, "x", 2), (None, None, None, 3), ("", 1, "x", 4), ("a", None, "x", 5), ("a", 1, None, 6), ("..", 1, "x", 7), ("a/b", 1, "x", 8)], "lang string, bin int, infix string, id int")
    sinks.write_shards(rows, str(tmp_path), ["lang"], "bin", [("id", True)], 50, "infix", lines=True)
    found = {str(p.relative_to(tmp_path)): [json.loads(x)["id"] for x in _text(p).splitlines()] for p in tmp_path.rglob("*.zst")}
    none = sinks.NO_VALUE
    assert found == {"a/1_1.x.jsonl.zst": [1], f"{none}/1_1.x.jsonl.zst": [2, 4], f"{none}/1.jsonl.zst": [3], "a/1.x.jsonl.zst": [5], "a/1_1.jsonl.zst": [6], "%2E%2E/1_1.x.jsonl.zst": [7], "a%2Fb/1_1.x.jsonl.zst": [8]}


def test_fan_out_in_one_pass(spark, tmp_path):
    rows = spark.createDataFrame([(0, i, json.dumps({"a": i, "b": [i]})) for i in range(50)], "batch int, line int, value string").repartition(3)
    specs = [("x", mux.parse_spec("a")), ("y/z", mux.parse_spec("*,c=a")), ("x", mux.parse_spec("b"))]
    recs = joins.records(rows)
    sinks.write_fan_out(recs, str(tmp_path / "one"), specs)
    sinks.write_fan_out(recs, str(tmp_path / "two"), specs, together=True)
    read = lambda d: sorted(x for p in (tmp_path / d).rglob("*.zst") for x in _text(p).splitlines())
    assert read("one/x") == sorted(f'{{"b":[{i}]}}' for i in range(50)) and read("one/y") == sorted(f'{{"a":{i},"b":[{i}],"c":{i}}}' for i in range(50))
    assert read("two/x") == sorted([f'{{"b":[{i}]}}' for i in range(50)] + [f'{{"a":{i}}}' for i in range(50)])
    plan = mux.fanned(recs, specs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_splice(spark):
    rows = [('{"a":1}', '{"b":2}', '{"a":3}'), ("{}", '{"b":2}', "{}"), ('{"a":1}', "{}", '{"c":3}\n'), ("{}", "{}", "{}"), ('{"a":1}  ', "{}", "{}"), ("{}", "{}", '{"z":{}}'), ('{"a":1}', None, "{}")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [r[0] for r in df.select(joins.spliced([F.col(c) for c in "abc"])).collect()]
    assert got == ['{"a":1,"b":2,"a":3}', '{"b":2}', '{"a":1,"c":3}', "{}", '{"a":1}', '{"z":{}}', None]
    assert [r[0] for r in df.select(joins.spliced([F.col("a")])).collect()][4] == '{"a":1}'
    with pytest.raises(Exception, match="no JSON object"):
        spark.createDataFrame([("{}", "[1]")], "a string, b string").select(joins.spliced([F.col("a"), F.col("b")])).collect()


def test_an_empty_file_follows_a_full_one(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for k in (1, 2):
        _frames(source / f"3_{k}.jsonl.l.zst", [b"12345\n" * 2])
        _frames(source / f"4_{k}.jsonl.l.zst", [b"123\n"])
    _frames(source / "5_1.jsonl.l.zst", [b"12345\n" * 4])
    sinks.reshard(spark, str(source), str(target), size=12)
    assert {p.name: _text(p) for p in target.iterdir() if p.is_file() and not p.name.startswith(".")} == {"3_1.jsonl.zst": "12345\n" * 2, "3_2.jsonl.zst": "12345\n" * 2, "3_3.jsonl.zst": "", "4_1.jsonl.zst": "123\n" * 2, "5_1.jsonl.zst": "12345\n" * 4}
    assert lines.numbered_lines(spark, str(target / "3_3.jsonl.zst")).count() == 0
