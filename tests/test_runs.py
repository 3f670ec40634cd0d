"""Merges of sorted runs, and statistics that grow with what comes."""

import json
import random

import pytest
import zstandard
from pyspark.sql import functions as F

from millrace.operators import joins, route, runs, stats
from millrace.plans.queries import corpus
from millrace.sources import sinks
from millrace.streaming import partials
from millrace.streaming.incremental import stream_parquet


def _run(path, rows, frame=400):
    data = "".join(json.dumps(r) + "\n" for r in rows).encode()
    path.write_bytes(b"".join(zstandard.ZstdCompressor().compress(data[i : i + frame]) for i in range(0, len(data), frame)))
    return str(path)


def _ordered(files):
    """All rows by number, falling; of equal ones those of the last run first, in their order."""
    rows = [(-r["wds"], -k, i, r) for k, rs in enumerate(files) for i, r in enumerate(rs)]
    return [(r["wds"], -k, r) for _, k, _, r in sorted(rows, key=lambda x: x[:3])]


@pytest.mark.parametrize("values, entry, part", [(1000, 300, 900), (4, 300, 900), (1, 1, 1), (1000, 1 << 20, 1 << 26)])
def test_merge(spark, tmp_path, values, entry, part):
    """However few numbers there are, and however the order is cut."""
    rng = random.Random(values)
    files = [sorted(({"wds": rng.randrange(values) / 7, "i": i, "t": "x" * rng.randrange(60)} for i in range(n)), key=lambda r: -r["wds"]) for n in (150, 60, 0, 1, 200)]
    paths = [_run(tmp_path / f"run{k}.zst", rows) for k, rows in enumerate(files)]
    got = runs.merged(spark, paths, runs.number_of("wds"), entry=entry, part=part)
    rows = got.collect()
    assert [(r["number"], r["run"], json.loads(r["value"])) for r in rows] == _ordered(files)
    parts = [(r["part"], r["place"]) for r in rows]
    assert parts == sorted(parts) and (len({p for p, _ in parts}) > 3) == (part < 1000)
    high = [(n, k, r) for n, k, r in _ordered(files) if 0.2 <= n <= 0.6]
    assert [(r["number"], r["run"], json.loads(r["value"])) for r in runs.merged(spark, paths, runs.number_of("wds"), 0.2, 0.6, entry, part).collect()] == high


def test_lines_are_not_sorted(spark, tmp_path):
    paths = [_run(tmp_path / f"{k}.zst", [{"wds": [5 - i], "k": k} for i in range(5)]) for k in range(2)]
    plan = runs.merged(spark, paths, runs.number_of("wds"))._jdf.queryExecution().executedPlan().toString()
    # the only sort below the map is of the list of parts
    assert plan.index("MapInArrow") < plan.index("Sort")
    broken = _run(tmp_path / "broken.zst", [{"wds": 1}, {"wds": 2}])
    with pytest.raises(Exception, match="not sorted"):
        runs.merged(spark, [broken], runs.number_of("wds")).collect()


@pytest.mark.parametrize("values, task", [(1000, 1), (4, 1), (1000, 8 << 20)])
def test_merge_reads_runs_a_few_times(spark, tmp_path, monkeypatch, values, task):
    """However small the parts, tasks are not many more than the frames of a run, and what all read is in proportion to the runs."""
    rng = random.Random(values)
    files = [sorted(({"wds": rng.randrange(values) / 7, "i": i, "t": "x" * rng.randrange(60)} for i in range(300)), key=lambda r: -r["wds"]) for _ in range(8)]
    paths = [_run(tmp_path / f"run{k}.zst", rows) for k, rows in enumerate(files)]
    monkeypatch.setattr(runs, "TASK", task, raising=False)
    index = runs.run_index(spark, paths, runs.number_of("wds"), 1)
    entries, cores = index.count(), spark.sparkContext.defaultParallelism
    assert entries > 300 and index.rdd.getNumPartitions() < entries / 16
    read, number = spark.sparkContext.accumulator(0), runs.number_of("wds")

    def key(line):
        read.add(1)
        return number(line)

    got = runs.merged(spark, paths, key, entry=1, part=1)
    wanted = max(cores, 4 * entries // len(files) if task == 1 else 0)
    assert got.rdd.getNumPartitions() == wanted
    before = read.value
    rows = got.collect()
    assert [(r["number"], r["run"], json.loads(r["value"])) for r in rows] == _ordered(files)
    assert read.value - before < (8 if task == 1 else 2) * len(rows)
    # places count within parts, which are as many as asked for
    parts = [(r["part"], r["place"]) for r in rows]
    assert parts == sorted(set(parts)) and len({p for p, _ in parts}) > wanted
    assert all(place == 0 for (part, place), (last, _) in zip(parts, [(-1, 0), *parts]) if part != last)


def test_runs_are_named_by_uri(spark, tmp_path):
    files = [[{"wds": 5 - i, "k": k} for i in range(5)] for k in range(2)]
    paths = [_run(tmp_path / f"{k}.zst", rows) for k, rows in enumerate(files)]
    for named in (["file://" + p for p in paths], ["file:" + p for p in paths], [paths[0], "file://" + paths[1]]):
        got = runs.merged(spark, named, runs.number_of("wds")).collect()
        assert [(r["number"], r["run"], json.loads(r["value"])) for r in got] == _ordered(files)


def _stats(rows):
    return stats.pool_statistics(rows.withColumn("crawl", F.lit("c")), ("file", "crawl"))


def test_statistics_go_on_where_they_were(spark, tmp_path):
    src, store, seen = (str(tmp_path / n) for n in ("src", "store", "seen"))
    rows = lambda a, b: spark.range(a, b).selectExpr("CAST(id AS string) AS text", "CASE WHEN id % 3 > 0 THEN 'x' END AS lang", "repeat('y', id) AS xml", "CAST(NULL AS string) AS md")
    schema = rows(0, 1).schema
    read = []
    summarise = lambda df: read.append(1) or _stats(df)
    go = lambda: partials.update(partials.with_file(stream_parquet(spark, src, schema)), summarise, store, seen).awaitTermination()
    total = lambda: partials.added_up(partials.partials(spark, store), ["crawl"]).drop("file").collect()
    fresh = lambda: partials.added_up(_stats(spark.read.schema(schema).parquet(src).withColumn("file", F.lit("all"))), ["crawl"]).collect()
    rows(0, 20).repartition(3).write.parquet(src)
    go()
    assert total() == fresh() and len(read) == 1
    go()
    assert total() == fresh() and len(read) == 1
    rows(20, 31).coalesce(1).write.mode("append").parquet(src)
    go()
    assert total() == fresh() and len(read) == 2
    # a batch that comes again, and a file that a later batch has anew, count once
    first = spark.read.parquet(f"{store}/batch=0")
    first.write.mode("overwrite").parquet(f"{store}/batch=7")
    assert total() == fresh()
    partials.compact(spark, store, str(tmp_path / "compact"))
    assert partials.added_up(partials.partials(spark, str(tmp_path / "compact")), ["crawl"]).drop("file").collect() == fresh()


def test_total_has_an_object_for_each_file(spark, data, tmp_path):
    docs = corpus(spark, data).withColumn("skipped", F.col("doc_id") % 10 == 0)
    labels = spark.read.parquet(f"{data}/labels.parquet").select("doc_id", F.lit(0).alias("line"), F.col("quality").alias("value"))
    found = route.filter_statistics(route.judged(joins.annotate(docs, {"quality": labels}, "doc_id")).withColumn("file", F.concat("file", F.lit(".jsonl.zst"))), ("quality",))
    sinks.write_filter_json(spark, str(tmp_path), route.filter_json(found, ("quality",)))
    total = json.loads((tmp_path / ".filter.json").read_text())
    files = {r["file"] for r in found.collect() if r["file"]}
    assert files == {k for k in total if k.endswith(".zst")} and total["files"] == len(files)
    for name in files:
        assert total[name] == json.loads((tmp_path / f".{name.removesuffix('.jsonl.zst')}.filter.json").read_text())
    assert total["documents"] == sum(total[f]["documents"] for f in files) and total["noisy"]["lid"]["characters"] == sum(total[f]["noisy"]["lid"]["characters"] for f in files)
