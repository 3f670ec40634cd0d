"""Queries of the engine's operators over the Parquet tables, with SQL that gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions import text as X
from millrace.functions.html import TagFilter, html_records
from millrace.functions.ids import document_id
from millrace.functions.lid import fit_linear, identify, labelled_language
from millrace.functions.xml2md import markdown_lines, xml_to_markdown
from millrace.operators import joins, mux, quality, route, runs, shard, stats, urls
from millrace.plans import stages
from millrace.session import spread
from millrace.sources import frames, lines, sinks
from millrace.sources.shared import settle, shared_dir
from millrace.streaming import partials
from millrace.streaming.incremental import stream_parquet

# What the scored corpus has and the tables lack, as expressions that both engines read alike.
DERIVED = {
    "id": "lpad(CAST(doc_id AS STRING), 10, '0')",
    "file": "concat('part-', CAST(doc_id % 7 AS STRING))",
    "batch": "CAST(doc_id % 4 AS BIGINT)",
    "crawl_id": "CASE doc_id % 5 WHEN 0 THEN 'archivebot.7' WHEN 1 THEN 'wide00016.2' WHEN 2 THEN NULL WHEN 3 THEN 'archivebot' ELSE 'CC-MAIN-2025-05' END",
    "wds": "CAST((doc_id * 37) % 101 AS DOUBLE) / 100",
    "reason": "CASE doc_id % 13 WHEN 0 THEN 'optout' WHEN 1 THEN 'adult_ut1_x' WHEN 2 THEN 'length_short' WHEN 3 THEN 'other' ELSE 'keep' END",
    "openlid": "CASE WHEN doc_id % 41 = 0 THEN NULL WHEN doc_id % 17 = 0 THEN 'cmn_Hans' WHEN lang = 'en' THEN 'eng_Latn' WHEN lang = 'de' THEN 'deu_Latn' WHEN lang = 'fr' THEN 'fra_Latn' ELSE 'spa_Latn' END",
    "glotlid": "CASE WHEN doc_id % 17 = 0 THEN 'cmn_Hani' WHEN doc_id % 19 = 0 THEN 'ita_Latn' WHEN lang = 'en' THEN 'eng_Latn' WHEN lang = 'de' THEN 'deu_Latn' WHEN lang = 'fr' THEN 'fra_Latn' ELSE 'spa_Latn' END",
    "prob": "CAST(doc_id % 97 AS DOUBLE) / 96",
    "u": "concat('https://host', CAST(doc_id % 23 AS STRING), '.example.org/p/', CAST(doc_id AS STRING))",
    "xml": "CASE WHEN doc_id % 6 = 0 THEN NULL ELSE concat('<p>', text, '</p>') END",
    "error": "CASE doc_id % 8 WHEN 0 THEN 'Could not parse' WHEN 1 THEN 'timed out' ELSE NULL END",
}
SCORED = "WITH scored AS (SELECT doc_id, text, lang, source, n_chars, " + ", ".join(f"{e} AS {n}" for n, e in DERIVED.items()) + " FROM documents)"
ROUTE = """CASE WHEN reason = 'optout' THEN 'blocked' WHEN wds < 0.5 OR NOT ok OR prob < 0.5 OR reason <> 'keep' THEN 'noisy' ELSE 'clean' END"""
NOISE = """CASE WHEN reason = 'optout' THEN NULL WHEN wds < 0.5 THEN 'wds' WHEN NOT ok THEN 'lid' WHEN prob < 0.5 THEN 'prob'
    WHEN starts_with(reason, 'adult_ut1') THEN 'adult_ut1' WHEN starts_with(reason, 'adult_text') THEN 'adult_text' WHEN starts_with(reason, 'length') THEN 'length'
    WHEN starts_with(reason, 'word_avg') THEN 'word_avg' WHEN starts_with(reason, 'char_avg') THEN 'char_avg' WHEN starts_with(reason, 'lang_ratio') THEN 'lang_ratio'
    WHEN reason <> 'keep' THEN reason END"""
ROUTED = (
    SCORED
    + f""", fit AS (SELECT *, coalesce(openlid = glotlid OR (split_part(openlid, '_', 1) = split_part(glotlid, '_', 1) AND split_part(openlid, '_', 2) IN ('Hans', 'Hant')
        AND split_part(glotlid, '_', 2) = 'Hani'), false) AS ok FROM scored),
    routed AS (SELECT *, {ROUTE} AS route, {NOISE} AS noise, CAST(floor(wds * 10) AS INTEGER) AS wds_bin,
        CASE WHEN crawl_id = 'archivebot' THEN 'ab' WHEN starts_with(crawl_id, 'wide') THEN 'ia' ELSE 'cc' END AS infix FROM fit)"""
)


def table(spark: SparkSession, d: str, name: str, deal: bool = False) -> DataFrame:
    """A table's rows; deal: where Python work follows, in no fewer partitions than there are cores."""
    df = spark.read.parquet(f"{d}/{name}.parquet")
    return spread(df) if deal else df


def scored(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").selectExpr("doc_id", "text", "lang", "source", "n_chars", *(f"{e} AS {n}" for n, e in DERIVED.items()))


def corpus(spark: SparkSession, d: str) -> DataFrame:
    """The scored corpus in the record layout that routing reads."""
    lid = lambda c: F.struct(F.array(c).alias("lang"), F.array("prob").alias("prob"))
    return scored(spark, d).select("id", "doc_id", "text", "file", "crawl_id", F.array("wds").alias("doc_scores"), F.col("reason").alias("filter"), lid("openlid").alias("openlid_v3"), lid("glotlid").alias("glotlid_v3"))


QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query("SELECT doc_id, lang, source, CAST(length(text) AS BIGINT) AS characters FROM documents")
def scan_documents(spark, d):
    rows = table(spark, d, "documents").select(F.to_json(F.struct("doc_id", "text", "lang", "source")).alias("value"))
    return lines.parsed(rows, "doc_id long, text string, lang string, source string").select("doc_id", "lang", "source", F.length("text").cast("long").alias("characters"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_guard(spark, d):
    rows = lines.checked_objects(table(spark, d, "events").select("event_id", F.col("props").alias("value")))
    return lines.variants(rows).select("event_id", F.try_variant_get("rec", "$.k", "bigint").alias("k"))


@query(ROUTED + " SELECT id, route, noise, wds_bin, infix FROM routed")
def route_documents(spark, d):
    return route.routed(corpus(spark, d)).select("id", "route", "noise", "wds_bin", "infix")


@query(
    ROUTED
    + """, counted AS (SELECT file, route, length(text) AS n, CASE WHEN noise IN ('wds', 'lid', 'prob', 'adult_ut1', 'adult_text', 'length', 'word_avg', 'char_avg', 'lang_ratio') THEN noise
        WHEN noise IS NOT NULL THEN 'filter' END AS noise FROM routed)
    SELECT file, route, noise, count(*) AS documents, CAST(coalesce(sum(n), 0) AS BIGINT) AS characters FROM counted GROUP BY GROUPING SETS ((file, route, noise), (route, noise))"""
)
def route_stats(spark, d):
    return route.route_statistics(route.routed(corpus(spark, d)))


_PARTS = [(p, f"part = '{p}'") for p in route.PARTS] + [(f"noisy_{r}", f"part = 'noisy' AND noise = '{r}'") for r in route.NOISE]


@query(
    ROUTED
    + """, seen AS (SELECT file, length(text) AS n, labels.quality, CASE WHEN routed.doc_id % 10 = 0 THEN 'skipped' WHEN routed.doc_id % 29 = 0 THEN NULL ELSE route END AS part,
        CASE WHEN noise IN ('wds', 'lid', 'prob', 'adult_ut1', 'adult_text', 'length', 'word_avg', 'char_avg', 'lang_ratio') THEN noise WHEN noise IS NOT NULL THEN 'filter' END AS noise, routed.doc_id % 10 > 0 AS read
        FROM routed LEFT JOIN labels ON routed.doc_id = labels.doc_id)
    SELECT file, CASE WHEN grouping(file) = 1 THEN count(DISTINCT file) END AS files, count(part) AS documents, CAST(coalesce(sum(n) FILTER (part IS NOT NULL), 0) AS BIGINT) AS characters,
        count(*) FILTER (part IS NULL) AS invalid, count(quality) FILTER (read) AS annotations, count(*) FILTER (read AND quality IS NULL) AS missing_quality, """
    + ", ".join(f"count(*) FILTER ({c}) AS {n}_documents, CAST(coalesce(sum(n) FILTER ({c}), 0) AS BIGINT) AS {n}_characters" for n, c in _PARTS)
    + " FROM seen GROUP BY GROUPING SETS ((file), ())"
)
def filter_stats(spark, d):
    labels = table(spark, d, "labels").select("doc_id", F.lit(0).alias("line"), F.col("quality").alias("value"))
    # some documents lack a required field
    docs = corpus(spark, d).withColumn("filter", F.when(F.col("doc_id") % 29 > 0, F.col("filter"))).withColumn("skipped", F.col("doc_id") % 10 == 0)
    return route.filter_statistics(route.judged(joins.annotate(docs, {"quality": labels}, "doc_id")), ("quality",))


@query("SELECT md5(text) AS id, count(*) AS copies FROM documents GROUP BY md5(text) HAVING count(*) > 1")
def duplicate_ids(spark, d):
    return joins.duplicate_ids(table(spark, d, "documents"), F.md5("text"))


@query("SELECT CAST(sum(n) AS BIGINT) AS n, count(*) FILTER (n > 1) AS ids, CAST(sum(n - 1) AS BIGINT) AS d FROM (SELECT count(*) AS n FROM documents GROUP BY md5(text))")
def duplicate_totals(spark, d):
    return joins.duplicate_totals(table(spark, d, "documents"), F.md5("text"))


@query("SELECT doc_id, md5(text) AS id FROM documents WHERE md5(text) NOT IN (SELECT md5(text) FROM documents GROUP BY md5(text) HAVING count(*) > 1)")
def skip_anti_join(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.md5("text").alias("id"))
    return joins.skip_ids(docs, joins.duplicate_ids(docs))


@query("SELECT d.doc_id, l.quality AS quality, CASE WHEN t.toxic = 1 THEN t.toxic END AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN labels t ON d.doc_id = t.doc_id")
def annotation_join(spark, d):
    labels = table(spark, d, "labels").withColumn("line", F.lit(0))
    side = {"quality": labels.select("doc_id", "line", F.col("quality").alias("value")), "toxic": labels.select("doc_id", "line", F.when(F.col("toxic") == 1, F.col("toxic")).alias("value"))}
    return joins.annotate(table(spark, d, "documents").select("doc_id"), side, "doc_id")


@query("SELECT 'quality' AS annotation, count(l.quality) AS present, count(*) - count(l.quality) AS missing FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def annotation_stats(spark, d):
    labels = table(spark, d, "labels").select("doc_id", F.lit(0).alias("line"), F.col("quality").alias("value"))
    return joins.annotation_statistics(joins.annotate(table(spark, d, "documents").select("doc_id"), {"quality": labels}, "doc_id"), ["quality"])


@query("SELECT d.source AS batch, d.doc_id AS line, CASE WHEN l.toxic = 1 THEN NULL ELSE d.lang END AS lang, d.source, CAST(l.quality AS BIGINT) AS quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def positional_merge(spark, d):
    docs = table(spark, d, "documents").select(F.col("source").alias("batch"), F.col("doc_id").alias("line"), "lang", "source")
    one = docs.select("batch", "line", F.to_json(F.struct("lang", "source")).alias("value"))
    # the second source gives toxic documents a language of null, which wins over the first's
    rows = docs.join(table(spark, d, "labels").withColumnRenamed("doc_id", "line"), "line")
    two = rows.select("batch", "line", F.concat(F.lit('{"quality":'), F.col("quality").cast("string"), F.when(F.col("toxic") == 1, ',"lang":null}').otherwise("}")).alias("value"))
    merged = joins.merge_by_position([joins.records(one), joins.records(two)])
    get = lambda k, t: F.try_variant_get(F.element_at("rec", F.lit(k)), "$", t).alias(k)
    return merged.select("batch", "line", get("lang", "string"), get("source", "string"), get("quality", "bigint"))


@query("SELECT event_id, event_type FROM events")
def mux_select(spark, d):
    df = table(spark, d, "events")
    return df.select(*mux.typed_projection(df.columns, mux.parse_spec("event_id, event_type, absent")))


@query("SELECT event_id, event_type AS kind FROM events")
def mux_rename(spark, d):
    df = table(spark, d, "events")
    return df.select(*mux.typed_projection(df.columns, mux.parse_spec("event_id,kind=event_type")))


@query("SELECT event_id, user_id, event_type, event_type AS kind FROM events")
def mux_star_rename(spark, d):
    df = table(spark, d, "events").select("event_id", "user_id", "event_type")
    return df.select(*mux.typed_projection(df.columns, mux.parse_spec("*,kind=event_type")))


@query("""SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || ',"kk":' || json_extract_string(props, '$.k') || '}' AS value FROM events""")
def mux_records(spark, d):
    recs = joins.records(table(spark, d, "events"), "props", ("event_id",))
    return recs.select("event_id", F.to_json(mux.project(F.col("rec"), mux.parse_spec("*,kk=k"))).alias("value"))


@query("SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL OR l.toxic = 0")
def robots_mask(spark, d):
    masks = table(spark, d, "labels").select("doc_id", F.lit(True).alias("present"), (F.col("toxic") == 0).alias("allowed"))
    docs = table(spark, d, "documents").select("doc_id").join(masks, "doc_id", "left")
    return docs.where(joins.robots_allowed(F.coalesce("present", F.lit(False)), F.col("allowed"))).select("doc_id")


def _folded(source: str, group: str, order: str, size: str, limit: int, before: bool, keep: str = "doc_id") -> str:
    """SQL of a running sum that starts anew, row by row."""
    roll = f"f.held + n.size > {limit}" if before else f"f.held >= {limit}"
    return f"""
    numbered AS (SELECT {group} AS g, {keep}, {size} AS size, row_number() OVER (PARTITION BY {group} ORDER BY {order}) AS i FROM {source}),
    folded AS (SELECT g, i, CAST(1 AS BIGINT) AS shard, CAST(size AS BIGINT) AS held FROM numbered WHERE i = 1
        UNION ALL SELECT n.g, n.i, CASE WHEN {roll} THEN f.shard + 1 ELSE f.shard END, CASE WHEN {roll} THEN n.size ELSE f.held + n.size END
        FROM folded f JOIN numbered n ON f.g = n.g AND n.i = f.i + 1)"""


@query("WITH RECURSIVE " + _folded("documents", "source", "doc_id", "n_chars", 20_000, False) + " SELECT n.g AS source, n.doc_id, f.shard FROM numbered n JOIN folded f ON n.g = f.g AND n.i = f.i")
def greedy_shards(spark, d):
    return shard.greedy_shards(table(spark, d, "documents"), ["source"], [("doc_id", True)], ["doc_id"], "n_chars", 20_000)


@query("WITH RECURSIVE " + _folded("documents", "lang", "doc_id", "n_chars", 50_000, True) + " SELECT n.g AS lang, n.doc_id, f.shard AS batch FROM numbered n JOIN folded f ON n.g = f.g AND n.i = f.i")
def next_fit_batches(spark, d):
    return shard.greedy_shards(table(spark, d, "documents"), ["lang"], [("doc_id", True)], ["doc_id"], "n_chars", 50_000, "batch", before=True)


@query(
    ROUTED.replace("WITH scored", "WITH RECURSIVE scored")
    + ","
    + _folded("routed", "wds_bin", "wds DESC, id DESC", "CAST(length(text) AS BIGINT)", 100_000, False, "id")
    + " SELECT n.g AS wds_bin, n.id, f.shard, n.g || '_' || f.shard || '.jsonl.zst' AS name FROM numbered n JOIN folded f ON n.g = f.g AND n.i = f.i"
)
def bin_shards(spark, d):
    docs = route.routed(corpus(spark, d)).select("wds_bin", F.col("doc_scores")[0].alias("wds"), "id", F.length("text").alias("n"))
    from millrace.sources.sinks import shard_names

    return shard.greedy_shards(docs, ["wds_bin"], [("wds", False), ("id", False)], ["id"], "n", 100_000).withColumn("name", shard_names())


def _scratch(spark, name: str) -> str:
    return f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@query("""SELECT CASE WHEN lang = 'de' THEN '__HIVE_DEFAULT_PARTITION__' ELSE lang END AS lang, CASE WHEN doc_id % 5 > 0 THEN doc_id % 3 END AS bin, CASE WHEN doc_id % 7 > 0 THEN source END AS infix,
    count(*) AS lines, min(doc_id) AS first, max(doc_id) AS last FROM documents GROUP BY ALL""")
def shard_writer_nulls(spark, d):
    """Files by columns that are null in some rows, one of each group, written and read again: the names tell the groups."""
    path = _scratch(spark, "nulls")
    docs = table(spark, d, "documents").select(F.when(F.col("lang") != "de", F.col("lang")).alias("lang"), F.when(F.col("doc_id") % 5 > 0, F.col("doc_id") % 3).alias("bin"), F.when(F.col("doc_id") % 7 > 0, F.col("source")).alias("infix"), "doc_id")
    sinks.write_shards(docs, path, ["lang"], "bin", [("doc_id", True)], 1 << 40, "infix")
    rows = lines.read_lines(spark, f"{path}/*", "*.jsonl.zst", trace=True)
    part = lambda i: F.nullif(F.regexp_extract("path", r"/([^/]+)/(?:([0-9]+)_)?1(?:[.]([^/]+))?[.]jsonl[.]zst$", i), F.lit(""))
    doc = F.get_json_object("value", "$.doc_id").cast("long")
    return rows.groupBy(part(1).alias("lang"), part(2).cast("long").alias("bin"), part(3).alias("infix")).agg(F.count(F.lit(1)).alias("lines"), F.min(doc).alias("first"), F.max(doc).alias("last"))


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS line, CAST(length(text) AS BIGINT) AS characters FROM documents")
def frame_ranges(spark, d):
    """One file of many frames, written and read again by ranges of frames, with the numbers of its lines."""
    path = _scratch(spark, "frames")
    docs = table(spark, d, "documents").select("doc_id", F.to_json(F.struct("doc_id", "text")).alias("v"), F.lit("all.jsonl.zst").alias("f"))
    sinks.write_files(docs, path, "f", "v", [F.col("doc_id")], frame=1 << 16)
    rows = frames.zstd_lines(spark, path, target=1 << 17)
    return lines.parsed(rows, "doc_id long, text string").select("doc_id", "line", F.length("text").cast("long").alias("characters"))


@query("""SELECT 'ids' AS output, '{"event_id":' || event_id || '}' AS value FROM events UNION ALL SELECT 'kinds', '{"event_id":' || event_id || ',"kind":"' || event_type || '"}' FROM events
    UNION ALL SELECT 'users', '{"user_id":' || user_id || '}' FROM events""")
def fan_out(spark, d):
    """Three outputs of one pass, written and read again."""
    path = _scratch(spark, "fan")
    rows = table(spark, d, "events").select("event_id", F.to_json(F.struct("event_id", "user_id", "event_type")).alias("value"))
    sinks.write_fan_out(joins.records(rows, keys=("event_id",)), path, [(name, mux.parse_spec(s)) for name, s in (("ids", "event_id"), ("kinds", "event_id,kind=event_type"), ("users", "user_id"))])
    back = lines.read_lines(spark, f"{path}/*", "*.jsonl.zst", trace=True)
    return back.select(F.regexp_extract("path", "/([^/]+)/[^/]*$", 1).alias("output"), "value")


@query("""SELECT doc_id, '{' || concat_ws(',', CASE WHEN doc_id % 4 > 0 THEN '"id":' || doc_id END, CASE WHEN doc_id % 3 > 0 THEN '"lang":"' || lang || '"' END, CASE WHEN doc_id % 5 > 0 THEN '"lang":null,"n":' || n_chars END) || '}' AS value FROM documents""")
def json_splice(spark, d):
    """Line-parallel objects put together as text: some are empty, and a key comes twice."""
    field = lambda when, *parts: F.when(when, F.concat(F.lit("{"), *(F.lit(p) if i % 2 == 0 else F.col(p).cast("string") for i, p in enumerate(parts)), F.lit("}"))).otherwise("{}")
    parts = [field(F.col("doc_id") % 4 > 0, '"id":', "doc_id"), field(F.col("doc_id") % 3 > 0, '"lang":"', "lang", '"'), field(F.col("doc_id") % 5 > 0, '"lang":null,"n":', "n_chars")]
    return table(spark, d, "documents").select("doc_id", joins.spliced(parts).alias("value"))


_FIRST = "coalesce(list_position(list_transform(f.used, lambda u: u + n.size <= 400000), true), 0)"


@query(
    f"""WITH RECURSIVE items AS (SELECT source, size, row_number() OVER (ORDER BY size DESC, source) AS i FROM (SELECT source, CAST(sum(n_chars) AS DOUBLE) AS size FROM documents GROUP BY source)),
    filled AS (SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS VARCHAR) AS source, CAST(0 AS DOUBLE) AS size, CAST([] AS DOUBLE[]) AS used, CAST(0 AS BIGINT) AS batch
        UNION ALL SELECT n.i, n.source, n.size, CASE WHEN {_FIRST} = 0 THEN list_append(f.used, n.size) ELSE list_transform(f.used, lambda u, k: CASE WHEN k = {_FIRST} THEN u + n.size ELSE u END) END,
            CASE WHEN {_FIRST} = 0 THEN len(f.used) ELSE {_FIRST} - 1 END FROM filled f JOIN items n ON n.i = f.i + 1)
    SELECT batch, source, size FROM filled WHERE i > 0"""
)
def ffd_batches(spark, d):
    sizes = table(spark, d, "documents").groupBy("source").agg(F.sum("n_chars").alias("size"))
    return shard.ffd_batches(sizes, "source", "size", 400_000.0)


@query("SELECT source, n, CAST((row_number() OVER (ORDER BY n DESC, source) - 1) // 3 AS BIGINT) AS batch, CAST(((row_number() OVER (ORDER BY n DESC, source) - 1) // 3) % 4 AS BIGINT) AS node FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)")
def round_robin_tasks(spark, d):
    paths = table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return shard.round_robin(paths, [F.desc("n"), F.asc("source")], 3, 4)


@query(SCORED + " SELECT id, wds, CAST(floor(wds * 10) AS INTEGER) AS wds_bin FROM scored")
def wds_bins_sorted(spark, d):
    return quality.release_order(quality.with_score(corpus(spark, d)).select("id", "wds", X.wds_bin(F.col("wds")).alias("wds_bin")))


@query(SCORED + " SELECT id, lag(id) OVER (ORDER BY wds DESC, id DESC) AS before FROM scored WHERE wds >= 0.9")
def release_neighbours(spark, d):
    """The order of the best, as it is written: each row with the one before it in the file."""
    path = f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}/sorted-{uuid.uuid4().hex}"
    best = quality.score_range(quality.with_score(corpus(spark, d)), 0.9).select("id", "wds")
    sinks.write_shards(best, path, [], None, [("wds", False), ("id", False)], 1 << 40)
    rows = lines.numbered_lines(spark, path).select("line", F.get_json_object("value", "$.id").alias("id"))
    return rows.alias("a").join(rows.select((F.col("line") + 1).alias("line"), F.col("id").alias("before")), "line", "left").select("id", "before")


@query(
    SCORED
    + """ SELECT id, wds, CAST(run AS INTEGER) AS run, row_number() OVER (ORDER BY wds DESC, run DESC, id DESC) - 1 AS place
        FROM (SELECT id, wds, dense_rank() OVER (ORDER BY source) - 1 AS run FROM scored) WHERE wds >= 0.25"""
)
def merged_runs(spark, d):
    """The sorted file of each source, written, and merged with the others into one order of the better scores."""
    path = _scratch(spark, "runs")
    docs = scored(spark, d).select("source", "id", "wds", "text")
    sinks.write_shards(docs, path, ["source"], None, [("wds", False), ("id", False)], 1 << 40)
    files = [f"{path}/{r['source']}/1.jsonl.zst" for r in docs.select("source").distinct().orderBy("source").collect()]
    # small ranges, so that there are many at any size of the tables
    lines_ = runs.merged(spark, files, runs.number_of("wds"), 0.25, entry=1 << 16, part=1 << 18)
    rows = settle(lines_.select("part", "place", "number", "run", F.get_json_object("value", "$.id").alias("id")), "merged")
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(F.broadcast(sizes.select("part", before.alias("before"))), "part").select("id", F.col("number").alias("wds"), "run", (F.col("before") + F.col("place")).alias("place"))


@query(SCORED + " SELECT id, wds FROM scored WHERE wds >= 0.25 AND wds < 0.75")
def wds_range(spark, d):
    return quality.score_range(quality.with_score(corpus(spark, d)), 0.25, 0.75).select("id", "wds")


@query(SCORED + " SELECT id FROM scored WHERE CAST(trunc(wds * 10) AS INTEGER) = 7")
def wds_single_bin(spark, d):
    return quality.single_bin(scored(spark, d).withColumn("s", F.col("wds") * 10), 7, "s").select("id")


@query(SCORED + " SELECT CAST(floor(wds * 10) AS INTEGER) AS wds_bin, count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS characters FROM scored GROUP BY 1")
def wds_bin_counts(spark, d):
    return quality.bin_counts(scored(spark, d), scale=1)


@query(
    SCORED
    + """, mapped AS (SELECT source AS collection, coalesce(openlid, 'null') AS lang, coalesce(error, 'OK') AS traferr, CASE WHEN length(coalesce(text, '')) = 0 THEN '0' WHEN length(text) = 1 THEN '1' ELSE '>1' END AS lenclass,
        length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1 AS nl, length(coalesce(text, '')) AS ch FROM scored)
    SELECT collection, lang, traferr, lenclass, CAST(sum(nl) AS BIGINT) AS text_newlines, CAST(sum(ch) AS BIGINT) AS text_chars, count(*) AS docs, CAST(grouping(collection, lang, traferr, lenclass) AS INTEGER) AS level
    FROM mapped GROUP BY GROUPING SETS ((collection, lang, traferr, lenclass), (lang, traferr, lenclass), (traferr, lenclass), ())"""
)
def traferr_stats_grouping_sets(spark, d):
    docs = scored(spark, d).select(F.col("source").alias("collection"), F.array("openlid").alias("lang"), F.when(F.col("error").isNotNull(), F.array("error")).alias("traferr"), "text")
    return stats.error_rollup(stats.error_map(docs))


@query("SELECT lang AS value, count(*) AS n FROM documents GROUP BY lang")
def value_frequencies(spark, d):
    return stats.value_frequencies(table(spark, d, "documents"), F.col("lang"))


@query("SELECT replace(props, ' ', '') AS value, count(*) AS n FROM events GROUP BY 1")
def field_frequencies(spark, d):
    return stats.value_frequencies(table(spark, d, "events"), mux.field_text(F.to_json(F.parse_json("props"))))


@query("SELECT source AS path, size, CAST(row_number() OVER o AS INTEGER) AS n, CAST(7 * sum(size) OVER o AS DOUBLE) / 1099511627776 AS tib FROM (SELECT source, CAST(sum(n_chars) AS BIGINT) AS size FROM documents GROUP BY source) WINDOW o AS (ORDER BY size DESC, source)")
def temp_space(spark, d):
    return stats.space_estimate(table(spark, d, "documents").groupBy(F.col("source").alias("path")).agg(F.sum("n_chars").alias("size")))


@query("SELECT CAST(sum(n_chars) AS DOUBLE) / 1073741824 AS gigabytes FROM documents")
def total_size(spark, d):
    return stats.total_gigabytes(table(spark, d, "documents"), "n_chars")


@query("SELECT dir, min(n) AS fewest, max(n) AS most, count(*) AS files FROM (SELECT doc_id % 3 AS dir, lang AS file, count(*) AS n FROM documents GROUP BY ALL) GROUP BY dir HAVING min(n) <> max(n)")
def linecount_mismatch(spark, d):
    counts = table(spark, d, "documents").groupBy((F.col("doc_id") % 3).alias("dir"), F.col("lang").alias("file")).agg(F.count(F.lit(1)).alias("lines"))
    return stats.uneven_counts(counts)


def _pool(spark, d):
    return scored(spark, d).select(F.coalesce("crawl_id", F.lit("none")).alias("crawl"), "batch", F.col("openlid").alias("lang"), "text", "xml", F.when(F.col("doc_id") % 9 > 0, F.col("text")).alias("md"))


POOL = SCORED + ", pool AS (SELECT coalesce(crawl_id, 'none') AS crawl, batch, openlid AS lang, text, xml, CASE WHEN doc_id % 9 > 0 THEN text END AS md FROM scored)"
_SUMS = """count(*) AS lines, CAST(sum(length(text)) AS BIGINT) AS chars, count(*) FILTER (text IS NULL) AS null_text, count(*) FILTER (lang IS NULL) AS null_lang,
    CAST(coalesce(sum(length(xml)), 0) AS BIGINT) AS xml_chars, CAST(coalesce(sum(length(md)), 0) AS BIGINT) AS md_chars, count(*) FILTER (xml IS NULL) AS null_xml, count(*) FILTER (md IS NULL) AS null_md"""


@query(POOL + f" SELECT crawl, batch, {_SUMS} FROM pool GROUP BY crawl, batch")
def pool_stats(spark, d):
    return stats.pool_statistics(_pool(spark, d))


@query(POOL + f" SELECT coalesce(split_part(crawl, '.', 1), 'total') AS crawl, {_SUMS} FROM pool GROUP BY GROUPING SETS ((split_part(crawl, '.', 1)), ())")
def pool_stats_merged(spark, d):
    return stats.merged_pool_statistics(stats.pool_statistics(_pool(spark, d)).drop("batch"))


@query(POOL + f" SELECT coalesce(split_part(crawl, '.', 1), 'total') AS crawl, {_SUMS} FROM pool GROUP BY GROUPING SETS ((split_part(crawl, '.', 1)), ())")
def incremental_stats(spark, d):
    """The pools' statistics from sums by file: of half the documents, then, in a second run that reads only those, of the rest."""
    path = _scratch(spark, "stream")
    pool = _pool(spark, d).withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)))
    for half in (0, 1):
        pool.where(F.col("half") == half).drop("half").write.mode("append").parquet(f"{path}/in")
        stream = partials.with_file(stream_parquet(spark, f"{path}/in", pool.drop("half").schema))
        partials.update(stream, lambda rows: stats.pool_statistics(rows, ("file", "crawl")), f"{path}/sums", f"{path}/seen").awaitTermination()
    return stats.merged_pool_statistics(partials.partials(spark, f"{path}/sums").drop("file"))


@query(POOL + " SELECT crawl, batch, coalesce(lang, 'null') AS lang, count(*) AS lang_docs, CAST(sum(length(text)) AS BIGINT) AS lang_chars FROM pool GROUP BY ALL")
def pool_languages(spark, d):
    return stats.pool_languages(_pool(spark, d))


@query(POOL + " SELECT crawl, coalesce(lang, 'null') AS k, count(*) AS v FROM pool GROUP BY ALL")
def pool_language_maps(spark, d):
    maps = stats.language_maps(stats.pool_languages(_pool(spark, d)))
    return stats.merged_maps(maps, "lang_docs").select("crawl", F.explode("lang_docs").alias("k", "v"))


@query(r"SELECT doc_id, regexp_replace(regexp_replace(lower(trim(replace(text, chr(10), ' '))), '\s\s+', ' ', 'g'), '[^\p{L}\p{M}\p{Nd}\p{Pc}\p{Zs}]|\p{Nd}', '', 'g') AS text FROM documents")
def lid_normalise(spark, d):
    return table(spark, d, "documents").select("doc_id", X.lid_normalise(F.col("text")).alias("text"))


@query("SELECT doc_id, CAST(length(text) AS BIGINT) AS characters, CAST(length(text) - length(replace(text, chr(10), '')) + 1 AS BIGINT) AS text_lines, CASE WHEN length(text) = 0 THEN '0' WHEN length(text) = 1 THEN '1' ELSE '>1' END AS lenclass FROM documents")
def char_counts(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.length(t).cast("long").alias("characters"), X.line_count(t).alias("text_lines"), X.length_class(t).alias("lenclass"))


@query("SELECT doc_id, to_base64(encode(text)) AS coded, text FROM documents")
def base64_decode(spark, d):
    coded = table(spark, d, "documents").select("doc_id", F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"\s", "").alias("coded"))
    return coded.withColumn("text", X.decoded_base64(F.col("coded")))


@query("SELECT doc_id, CAST(q + CASE WHEN r > 5 OR (r = 5 AND q % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE) / 10000 AS p, lang AS label FROM (SELECT doc_id, lang, doc_id * 5 // 10 AS q, doc_id * 5 % 10 AS r FROM documents)")
def label_cleaning(spark, d):
    p = (F.col("doc_id") * 5).cast("decimal(18,5)") / F.lit(100000).cast("decimal(6,0)")
    return table(spark, d, "documents").select("doc_id", X.rounded_probability(p).cast("double").alias("p"), X.bare_label(F.concat(F.lit("__label__"), "lang")).alias("label"))


@query(SCORED + " SELECT DISTINCT split_part(openlid, '_', 1) AS language FROM scored WHERE openlid IS NOT NULL")
def dataset_languages(spark, d):
    return urls.languages(scored(spark, d).where("openlid IS NOT NULL"), "openlid")


@query(SCORED + " SELECT id, u FROM scored WHERE openlid = 'eng_Latn' AND NOT (contains(u, 'host3.example.org') OR contains(u, 'host11.example.org'))")
def domain_filter(spark, d):
    docs = scored(spark, d).where("openlid = 'eng_Latn'")
    return urls.drop_domains(docs, "eng_Latn", {"eng_Latn": ["host3.example.org", "host11.example.org"]}).select("id", "u")


@query(r"SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '^(https?:)?(//)?((thther\.example\.com/)|(blog\.ththsh\.example\.com/))')")
def url_filter(spark, d):
    return table(spark, d, "pages").where(~urls.url_blocklist(F.col("url"), ["thther.example.com", "blog.ththsh.example.com"])).select("page_id", "url")


@query(SCORED + " SELECT lang, string_agg('https://data.example.org/' || lang || '/' || file, chr(10) ORDER BY file) AS map FROM (SELECT DISTINCT lang, file FROM scored) GROUP BY lang")
def language_maps(spark, d):
    return urls.shard_maps(scored(spark, d).select("lang", "file").distinct(), "https://data.example.org/")


def _manifest(spark, d):
    docs = table(spark, d, "documents")
    n = lambda c: F.sum(c).cast("long")
    words = F.size(F.split("text", " "))
    return docs.groupBy(F.col("lang").alias("name")).agg(n(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("documents"), n(X.line_count(F.col("text"))).alias("segments"), n(words).alias("tokens"), n(F.length("text")).alias("characters"))


@query(
    """WITH m AS (SELECT lang AS name, sum(strlen(text)) AS bytes, count(*) AS documents, sum(length(text) - length(replace(text, chr(10), '')) + 1) AS segments, sum(len(string_split(text, ' '))) AS tokens, sum(length(text)) AS characters FROM documents GROUP BY lang),
    t AS (SELECT * FROM m UNION ALL SELECT 'total', sum(bytes), sum(documents), sum(segments), sum(tokens), sum(characters) FROM m)
    SELECT name, format('{:,}', CAST(bytes AS BIGINT)) AS bytes, format('{:,}', CAST(documents AS BIGINT)) AS documents, format('{:,}', CAST(segments AS BIGINT)) AS segments, format('{:,}', CAST(tokens AS BIGINT)) AS tokens, format('{:,}', CAST(characters AS BIGINT)) AS characters FROM t"""
)
def dataset_card(spark, d):
    return urls.card_table(_manifest(spark, d))


@query()
def document_ids(spark, d):
    return table(spark, d, "pages").select("page_id", document_id(F.lit("part"), F.col("url"), F.col("page_id").cast("string")).alias("id"))


def _pages(spark, d):
    return table(spark, d, "pages", deal=True).select("page_id", "url", html_records()(F.col("html")).alias("r"))


@query()
def html_extract(spark, d):
    return _pages(spark, d).select("page_id", "r.t", "r.x", "r.traferr")


@query("SELECT page_id, [regexp_extract(html, '<html lang=\"([^\"]*)\"', 1)] AS htmllang FROM pages")
def lang_hints(spark, d):
    return _pages(spark, d).select("page_id", "r.htmllang")


@query("SELECT page_id, CASE WHEN page_id % 5 = 0 THEN ['div', 'id', 'my-WP-Translate'] END AS tagfilter FROM pages")
def tag_filter(spark, d):
    marked = F.concat(F.col("html"), F.when(F.col("page_id") % 5 == 0, '<div id="my-WP-Translate"></div>').otherwise(""))
    return table(spark, d, "pages", deal=True).select("page_id", html_records(tags=TagFilter())(marked)["tagfilter"].alias("tagfilter"))


@query(
    """SELECT doc_id, 'Language ' || lang || chr(10) || 'Document ' || doc_id || ' & its text' AS t, [lang, lang || '_' || upper(lang)] AS metalang,
        CASE WHEN doc_id % 3 > 0 THEN [lang || '-' || doc_id] END AS htmllang FROM documents"""
)
def html_fields(spark, d):
    tag = F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit('<html lang="'), "lang", F.lit("-"), "doc_id", F.lit('">'))).otherwise("<html>")
    head = F.concat(F.lit('<head><meta property="og:locale" content="'), "lang", F.lit("_"), F.upper("lang"), F.lit('"><meta http-equiv="content-language" content="'), "lang", F.lit('"></head>'))
    body = F.concat(F.lit("<body><nav><a href=/>Home</a></nav><article><h1>Language "), "lang", F.lit("</h1><p>Document "), "doc_id", F.lit(" &amp; its\n text</article><footer>end</footer></body></html>"))
    rows = table(spark, d, "documents", deal=True).select("doc_id", html_records()(F.concat(tag, head, body)).alias("r"))
    return rows.select("doc_id", "r.t", "r.metalang", "r.htmllang")


@query()
def xml_to_md(spark, d):
    return _pages(spark, d).select("page_id", xml_to_markdown("r.x").alias("c")).select("page_id", "c.md", "c.error", "c.severity")


@query(
    """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '## Language ' || lang || chr(10) || chr(10) || 'Document **' || doc_id || '** in \\*' || lang || '\\* here' WHEN 1 THEN '- ' || lang || chr(10) || '- [' || doc_id || '](http://x.org/' || doc_id || ')'
        WHEN 2 THEN '| lang | id |' || chr(10) || '|---|---|' || chr(10) || '| ' || lang || ' | ' || doc_id || ' |' WHEN 3 THEN '' END AS md,
        CASE WHEN doc_id % 5 = 3 THEN 1 WHEN doc_id % 5 = 4 THEN 3 END AS severity FROM documents"""
)
def markdown_forms(spark, d):
    """The forms that the tables' pages lack, of texts made from ids and languages."""
    forms = [
        ['<head rend="h2">Language ', "lang", "</head><p>Document <hi rend=\"#b\">", "doc_id", "</hi> in *", "lang", "* here</p>"],
        ["<list><item>", "lang", '</item><item><ref target="http://x.org/', "doc_id", '">', "doc_id", "</ref></item></list>"],
        ['<table><row><cell role="head">lang</cell><cell role="head">id</cell></row><row><cell>', "lang", "</cell><cell>", "doc_id", "</cell></row></table>"],
        [" "],
        ["<list><p>no item</p></list>"],
    ]
    body = F.lit(None).cast("string")
    for i, parts in enumerate(forms):
        body = F.when(F.col("doc_id") % 5 == i, F.concat(*(F.col(p).cast("string") if p in ("lang", "doc_id") else F.lit(p) for p in parts))).otherwise(body)
    xml = F.concat(F.lit("<doc><main>"), body, F.lit("</main></doc>"))
    return table(spark, d, "documents", deal=True).select("doc_id", xml_to_markdown(xml).alias("c")).select("doc_id", "c.md", "c.severity")


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'no json ' || doc_id WHEN 2 THEN '{"md":null}' ELSE '{"md":"Document ' || doc_id || '"}' END AS line FROM documents""")
def md_lines(spark, d):
    xml = F.concat(F.lit('{"x":"<doc><main><p>Document '), "doc_id", F.lit('</p></main></doc>"}'))
    line = F.when(F.col("doc_id") % 4 == 0, "  ").when(F.col("doc_id") % 4 == 1, F.concat(F.lit("no json "), "doc_id")).when(F.col("doc_id") % 4 == 2, '{"x": null}').otherwise(xml)
    return table(spark, d, "documents", deal=True).select("doc_id", markdown_lines(line, md_only=True).alias("line"))


@query("SELECT count(*) FILTER (doc_id % 7 > 1) AS ok, count(*) AS total FROM documents")
def conversion_success(spark, d):
    """Some documents are broken XML and some have no content: neither is a success."""
    part = F.col("doc_id") % 7
    xml = F.when(part == 0, "<doc><main><p>open").when(part == 1, "<doc><main> </main></doc>").otherwise(F.concat(F.lit("<doc><main><p>"), "doc_id", F.lit("</p></main></doc>")))
    return stats.conversion_success(table(spark, d, "documents", deal=True).select(xml_to_markdown(xml)["md"].alias("md")))


@query(SCORED + """ SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN openlid END AS lang FROM scored""")
def labelled_languages(spark, d):
    """Only where a second label follows, and none where there is no identification."""
    rest = F.when(F.col("doc_id") % 3 == 1, '","deu_Latn"],"prob":[0.9,0.1]}}').when(F.col("doc_id") % 3 == 2, '", "x"]}}').otherwise('"]}}')
    line = F.concat(F.lit('{"id":1,"openlid-v3": {"lang": ["'), "openlid", rest)
    return scored(spark, d).select("doc_id", labelled_language(F.coalesce(line, F.lit('{"openlid-v3":null}'))).alias("lang"))


@query("SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 4 > 0 THEN 'Text ' || doc_id END AS md, CASE doc_id % 4 WHEN 0 THEN '' ELSE '<doc><main><p>Text ' || doc_id || '</p></main></doc>' END AS xml FROM documents")
def pool_markup(spark, d):
    xml = F.when(F.col("doc_id") % 4 == 0, "").otherwise(F.concat(F.lit("<doc><main><p>Text "), "doc_id", F.lit("</p></main></doc>")))
    return mux.pool_record(table(spark, d, "documents", deal=True).select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("t"), xml.alias("x")))["markup"]


@query("SELECT lang, (i - 1) // 50 + 1 AS number, count(*) AS lines, min(doc_id) AS first, max(doc_id) AS last FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS i FROM documents) GROUP BY ALL")
def shard_writer(spark, d):
    """Files of 50 lines a language, written and read again."""
    path = f"{shared_dir(spark)}/millrace/{spark.sparkContext.applicationId}/written-{uuid.uuid4().hex}"
    sinks.write_shards(table(spark, d, "documents").select("lang", "doc_id"), path, ["lang"], None, [("doc_id", True)], 50, lines=True)
    rows = lines.read_lines(spark, f"{path}/*", "*.jsonl.zst", trace=True)
    lang, number = F.regexp_extract("path", r"/([^/]+)/([0-9]+)\.jsonl\.zst$", 1), F.regexp_extract("path", r"/([^/]+)/([0-9]+)\.jsonl\.zst$", 2)
    doc = F.get_json_object("value", "$.doc_id").cast("long")
    return rows.groupBy(lang.alias("lang"), number.cast("long").alias("number")).agg(F.count(F.lit(1)).alias("lines"), F.min(doc).alias("first"), F.max(doc).alias("last"))


@query(
    "WITH RECURSIVE "
    + _folded("documents", "source", "doc_id", "n_chars", 20_000, False)
    + """, totals AS (SELECT n.g AS source, f.shard, count(*) AS documents, CAST(sum(n.size) AS BIGINT) AS bytes FROM numbered n JOIN folded f ON n.g = f.g AND n.i = f.i GROUP BY ALL)
    SELECT * FROM totals UNION ALL SELECT source, shard + 1, 0, 0 FROM totals t WHERE bytes >= 20000 AND shard = (SELECT max(shard) FROM totals u WHERE u.source = t.source)"""
)
def shard_sizes(spark, d):
    docs = table(spark, d, "documents")
    return shard.shard_totals(shard.greedy_shards(docs, ["source"], [("doc_id", True)], ["doc_id", "n_chars"], "n_chars", 20_000), ["source"], "n_chars", 20_000)


def _model(spark, d):
    model = fit_linear(table(spark, d, "documents"))
    return lambda: model


@query()
def language_id(spark, d):
    return table(spark, d, "documents", deal=True).select("doc_id", identify(F.col("text"), _model(spark, d), "openlid-v3").alias("openlid_v3"))


@query(
    """SELECT doc_id, CASE WHEN doc_id % 5 > 1 AND length(text) > 0 THEN (SELECT least(3, count(DISTINCT lang)) FROM documents WHERE length(text) > 0) END AS labels,
        CASE WHEN doc_id % 5 > 1 AND length(text) > 0 THEN true END AS falling, CASE WHEN doc_id % 5 > 1 AND length(text) > 0 THEN true END AS shares FROM documents"""
)
def language_id_forms(spark, d):
    """What an identification has whatever the model: none for null and empty texts, else the likeliest three, best first."""
    docs = table(spark, d, "documents", deal=True)
    text = F.when(F.col("doc_id") % 5 > 1, F.col("text")).when(F.col("doc_id") % 5 == 1, "")
    rows = docs.select("doc_id", identify(text, _model(spark, d), "openlid-v3").alias("r")).select("doc_id", "r.lang", "r.prob")
    labels = F.when(F.size(F.array_distinct("lang")) == F.size("prob"), F.size("lang").cast("long"))
    falling = F.when(F.col("prob").isNotNull(), F.sort_array("prob", asc=False) == F.col("prob"))
    total = F.aggregate("prob", F.lit(0.0), lambda a, p: a + p)
    return rows.select("doc_id", labels.alias("labels"), falling.alias("falling"), F.when(total.isNotNull(), (total > 0) & (total < 1.001)).alias("shares"))


@query()
def stage2(spark, d):
    return stages.pages_to_text(table(spark, d, "pages", deal=True).select("page_id", F.col("html").alias("h")), _model(spark, d))


@query()
def stage3(spark, d):
    model = _model(spark, d)
    rows = table(spark, d, "documents", deal=True).select(F.lit("f").alias("f"), F.col("source").alias("u"), F.col("doc_id").cast("string").alias("ts"), F.col("text").alias("t"), F.concat(F.lit("<doc><main><p>"), F.regexp_replace("text", "[<&>]", " "), F.lit("</p></main></doc>")).alias("x"))
    return stages.augment(rows, {"openlid-v3": model, "glotlid-v3": model})


@query(
    ROUTED.replace("WITH scored", "WITH RECURSIVE scored")
    + ", "
    + _folded("routed", "route || '/' || wds_bin", "wds DESC, id DESC", "CAST(strlen(text) AS BIGINT)", 100_000, False, "id, route, wds_bin")
    + " SELECT n.route, n.wds_bin, f.shard, count(*) AS documents, CAST(sum(n.size) AS BIGINT) AS bytes FROM numbered n JOIN folded f ON n.g = f.g AND n.i = f.i GROUP BY ALL"
)
def release(spark, d):
    out = stages.release(corpus(spark, d), 100_000)
    return out.groupBy("route", "wds_bin", "shard").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.octet_length("text")).cast("long").alias("bytes"))
