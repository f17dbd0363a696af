"""Written lakes: sinks, layouts, merges, and scans of what they leave behind.

Each query writes posts with whole document texts and their scores below the session's shared folder
and reads them back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import audit, cost
from tidemark.operators.parity import name_collisions, schema_diff
from tidemark.operators.summary import daily_summary
from tidemark.plans import views as v
from tidemark.plans.etl import run_etl
from tidemark.plans.queries.enrichment import FREQUENT, stored_rows
from tidemark.plans.registry import query
from tidemark.schema import ENRICHED, conform
from tidemark.session import local_table, scratch_path
from tidemark.sinks import lake as sink
from tidemark.sources import lake as scan
from tidemark.sources.posts import read_posts

RUN_TS = dt.datetime(2024, 2, 1)

_LAKES: dict[tuple[str, str], str] = {}


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return stored_rows(spark, sf)


def written_lake(spark: SparkSession, sf: str) -> str:
    """The event-date lake of a table folder, written once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LAKES:
        root = scratch_path(spark, "lake")
        sink.write_event_date(enriched(spark, sf), root)
        _LAKES[key] = root
    return _LAKES[key]


_BY_DAY = """
SELECT strftime(ts, '%Y-%m-%d') AS event_day, count(*) AS post_count, CAST(sum(CAST(floor(value * 100) AS BIGINT)) AS BIGINT) AS likes
FROM events GROUP BY 1"""


def _by_day(lake: DataFrame) -> DataFrame:
    return lake.groupBy("event_day").agg(F.count(F.lit(1)).alias("post_count"), F.sum("like_count").alias("likes"))


@query("event_date_write", _BY_DAY)
def q_event_date_write(spark, sf):
    root = scratch_path(spark, "event-date")
    sink.write_event_date(enriched(spark, sf), root)
    return _by_day(scan.read_lake(spark, root, ENRICHED))


@query(
    "event_date_partitions",
    "SELECT strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS post_count, true AS in_place FROM events GROUP BY 1",
)
def q_event_date_partitions(spark, sf):
    """Hive-style read: the directory date of every row agrees with its stored day."""
    lake = scan.read_lake(spark, written_lake(spark, sf), ENRICHED)
    return lake.groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.count(F.lit(1)).alias("post_count"),
        F.bool_and(F.col("event_day") == F.col("event_date").cast("string")).alias("in_place"),
    )


@query("flat_lake_scan", "SELECT count(*) AS post_count, count(DISTINCT strftime(ts, '%Y-%m-%d')) AS days, CAST(0 AS BIGINT) AS partition_columns FROM events")
def q_flat_lake_scan(spark, sf):
    """Discovery off: only stored columns, so the partition column is absent."""
    flat = scan.read_lake_flat(spark, written_lake(spark, sf))
    present = int("event_date" in flat.columns)
    return flat.agg(
        F.count(F.lit(1)).alias("post_count"),
        F.count_distinct("event_day").alias("days"),
        F.lit(present).cast("bigint").alias("partition_columns"),
    )


@query(
    "pruned_day_scan",
    """
SELECT event_type AS source, count(*) AS post_count FROM events
WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16' GROUP BY 1""",
)
def q_pruned_day_scan(spark, sf):
    """One day of the written lake: the date filter picks a directory, not rows."""
    lake = scan.read_lake(spark, written_lake(spark, sf), ENRICHED)
    return lake.filter(F.col("event_date") == F.lit("2024-01-15").cast("date")).groupBy("source").agg(
        F.count(F.lit(1)).alias("post_count")
    )


@query("lake_inventory", "SELECT 'event_date=' || strftime(ts, '%Y-%m-%d') AS partition, count(*) AS rows, true AS sized FROM events GROUP BY 1")
def q_lake_inventory(spark, sf):
    objects = scan.object_inventory(spark, written_lake(spark, sf), ENRICHED)
    return objects.groupBy("partition").agg(F.sum("rows").alias("rows"), F.bool_and(F.col("bytes") > 0).alias("sized"))


@query(
    "small_file_report",
    "SELECT count(*) AS rows, count(DISTINCT strftime(ts, '%Y-%m-%d')) AS days, true AS all_listed, true AS bytes_agree, true AS all_small, true AS share_in_range FROM events",
)
def q_small_file_report(spark, sf):
    """Object count, sizes and fixed overhead. Sizes depend on the writer, so they are checked here."""
    root = written_lake(spark, sf)
    objects = scan.object_inventory(spark, root, ENRICHED)
    overhead = cost.fit_sizes(objects).select("overhead_bytes").scalar()
    listed = scan.listing(spark, root).agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b"))
    counted = objects.agg(F.sum("rows").alias("rows"), F.count_distinct("partition").alias("days"))
    both = audit.small_files(objects, overhead).join(listed).join(counted)
    return both.select(
        "rows",
        "days",
        (F.col("objects") == F.col("n")).alias("all_listed"),
        (F.col("total_bytes") == F.col("b")).alias("bytes_agree"),
        (F.col("small_objects") == F.col("objects")).alias("all_small"),
        F.col("overhead_share").isNotNull().alias("share_in_range"),
    )


_TYPES = {
    "id": "string", "created_at": "string", "text": "string", "like_count": "int64", "retweet_count": "int64",
    "reply_count": "int64", "quote_count": "int64", "source": "string", "engagement_total": "int64",
    "sentiment_score": "double", "sentiment_label": "string", "event_day": "string", "scorer": "string",
    "scorer_version": "string",
}


@query(
    "file_schemas",
    "SELECT * FROM (VALUES "
    + ", ".join(f"('{c}', '{t}', true)" for c, t in _TYPES.items())
    + ") t(\"column\", type, in_every_file) WHERE (SELECT count(*) FROM events) > 0",
)
def q_file_schemas(spark, sf):
    """Column types read from every file's footer."""
    schemas = scan.file_schemas(spark, written_lake(spark, sf), glob="part-*")
    n_files = schemas.agg(F.count_distinct("file")).scalar()
    return schemas.groupBy("column", "type").agg(F.count_distinct("file").alias("n")).select(
        "column", "type", (F.col("n") == n_files).alias("in_every_file")
    )


@query(
    "schema_drift",
    """
SELECT "column", type, baseline_type FROM (VALUES ('like_count', 'double', 'int64'), ('source', 'int32', 'string')) t("column", type, baseline_type)
WHERE (SELECT count(*) FROM events) > 0""",
)
def q_schema_drift(spark, sf):
    """A second batch with other types next to a typical one, against the typical schema."""
    root = scratch_path(spark, "drift")
    posts = enriched(spark, sf).drop("event_date")
    posts.write.options(**sink.COMPACT).parquet(f"{root}/typical")
    posts.withColumn("like_count", F.col("like_count").cast("double")).withColumn(
        "source", F.length("source")
    ).write.options(**sink.COMPACT).parquet(f"{root}/drifted")
    schemas = scan.file_schemas(spark, root, glob="part-*")
    typical = schemas.filter(F.col("file").contains("/typical/")).select("column", "type").distinct()
    return schema_diff(schemas, typical).select("column", "type", "baseline_type").distinct()


@query(
    "drifted_lake_read",
    "SELECT event_type AS source, 2 * count(*) AS post_count, CAST(2 * sum(CAST(floor(value * 100) AS BIGINT)) AS BIGINT) AS likes FROM events GROUP BY 1",
)
def q_drifted_lake_read(spark, sf):
    """Two batches that disagree on a column's type, read under one declared schema."""
    root = scratch_path(spark, "drifted")
    posts = enriched(spark, sf)
    posts.write.options(**sink.COMPACT).parquet(f"{root}/a")
    posts.withColumn("like_count", F.col("like_count").cast("double")).drop("scorer").write.options(**sink.COMPACT).parquet(f"{root}/b")
    lake = scan.read_drifted(spark, root, ENRICHED, glob="part-*")
    return lake.groupBy("source").agg(F.count(F.lit(1)).alias("post_count"), F.sum("like_count").alias("likes"))


@query(
    "drifted_days_read",
    """
WITH d AS (SELECT strftime(ts, '%Y-%m-%d') AS event_date, day(ts) AS n, event_id, CAST(floor(value * 100) AS BIGINT) AS likes FROM events)
SELECT event_date, sum(CASE WHEN n % 3 = 0 THEN 2 ELSE 1 END)::BIGINT AS post_count, CAST(sum(likes * CASE WHEN n % 3 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS likes,
       count(*) FILTER (n % 3 <> 1) AS with_scorer
FROM d WHERE event_date >= '2024-01-05' GROUP BY 1""",
)
def q_drifted_days_read(spark, sf):
    """An event-date lake in which some days hold another type, and some days both: read with its dates, from the fifth on."""
    root = scratch_path(spark, "drifted-days")
    posts = enriched(spark, sf)
    day = F.dayofmonth("event_date") % 3
    sink.write_event_date(posts.filter(day != 1), root)
    other = posts.withColumn("like_count", F.col("like_count").cast("double")).drop("scorer")
    sink.write_days(other.filter(day != 2), root)
    lake = scan.read_drifted(spark, root, ENRICHED, glob="part-*").filter(F.col("event_date") >= F.lit("2024-01-05").cast("date"))
    return lake.groupBy(F.col("event_date").cast("string").alias("event_date")).agg(
        F.count(F.lit(1)).alias("post_count"), F.sum("like_count").alias("likes"), F.count("scorer").alias("with_scorer")
    )


@query(
    "odd_name_inventory",
    """
SELECT 'kind=' || event_type || ' a%3Ab+c%25' AS partition, count(*) AS rows, true AS sized FROM events GROUP BY 1""",
)
def q_odd_name_inventory(spark, sf):
    """Partition values with a blank, a colon, a plus and a percent sign, which the file system spells in its own way."""
    root = scratch_path(spark, "odd names")
    posts = v.event_posts(spark, sf).withColumn("kind", F.concat("source", F.lit(" a:b+c%")))
    posts.write.partitionBy("kind").parquet(root)
    return scan.object_inventory(spark, root).groupBy("partition").agg(F.sum("rows").alias("rows"), F.bool_and(F.col("bytes") > 0).alias("sized"))


@query(
    "run_date_write",
    """
SELECT '2024' AS year, '02' AS month, '01' AS day, count(*) AS post_count,
       count(DISTINCT strftime(ts, '%Y-%m-%d')) AS days FROM events""",
)
def q_run_date_write(spark, sf):
    """Compatibility layout: all days end up in the run's one partition."""
    root = scratch_path(spark, "run-date")
    sink.write_run_date(enriched(spark, sf), root, RUN_TS)
    # Text, because partition discovery would read 02 as the number 2.
    keys = [T.StructField(k, T.StringType()) for k in ("year", "month", "day")]
    lake = scan.read_lake(spark, root, T.StructType([*ENRICHED.fields, *keys]))
    return lake.groupBy("year", "month", "day").agg(
        F.count(F.lit(1)).alias("post_count"), F.count_distinct("event_day").alias("days")
    )


@query(
    "summary_write",
    v.with_ctes(v.SQL_FACTS, v.SQL_WORDS, v.SQL_LEXICON, v.SQL_NET, v.SQL_SCORED, body="""
SELECT event_day, count(*) AS post_count, count(*) FILTER (sentiment_label = 'negative') AS negative, '2024-02-01' AS run_date
FROM scored GROUP BY 1"""),
)
def q_summary_write(spark, sf):
    """Written twice for one run date; the second write replaces the first."""
    root = scratch_path(spark, "summary")
    summary = daily_summary(enriched(spark, sf))
    for _ in range(2):
        sink.write_summary(summary, root, RUN_TS.date())
    return scan.read_lake(spark, root).select(
        "event_day", "post_count", "negative", F.col("run_date").cast("string").alias("run_date")
    )


@query(
    "append_write",
    """
SELECT strftime(ts, '%Y-%m-%d') AS event_day, 2 * count(*) AS post_count, count(DISTINCT event_id) AS distinct_posts, CAST(2 AS BIGINT) AS run_stamps
FROM events GROUP BY 1""",
)
def q_append_write(spark, sf):
    """The same batch appended by two runs is there twice."""
    root = scratch_path(spark, "append")
    for hour in (0, 1):
        sink.append_posts(enriched(spark, sf), root, RUN_TS + dt.timedelta(hours=hour))
    return scan.read_lake(spark, root).groupBy("event_day").agg(
        F.count(F.lit(1)).alias("post_count"),
        F.count_distinct("id").alias("distinct_posts"),
        F.count_distinct("run_ts").alias("run_stamps"),
    )


@query("idempotent_overwrite", _BY_DAY)
def q_idempotent_overwrite(spark, sf):
    """A repeated write of whole days leaves one copy, and other days stay."""
    root = scratch_path(spark, "overwrite")
    posts = enriched(spark, sf)
    sink.overwrite_days(posts, root)
    sink.overwrite_days(posts.filter(F.col("event_day") >= "2024-01-20"), root)
    return _by_day(scan.read_lake(spark, root, ENRICHED))


@query(
    "merge_write",
    """
SELECT strftime(ts, '%Y-%m-%d') AS event_day, count(*) AS post_count,
       CAST(sum(CAST(floor(value * 100) AS BIGINT) + CASE WHEN event_type = 'click' THEN 1000 ELSE 0 END) AS BIGINT) AS likes
FROM events GROUP BY 1""",
)
def q_merge_write(spark, sf):
    """Merging updated click posts twice: each id once, with the update, and nothing lost."""
    root = scratch_path(spark, "merge")
    posts = enriched(spark, sf)
    sink.merge_posts(posts, root)
    update = posts.filter(F.col("source") == "click").withColumn("like_count", F.col("like_count") + 1000)
    for _ in range(2):
        sink.merge_posts(update, root)
    return _by_day(scan.read_lake(spark, root, ENRICHED))


@query(
    "touched_days",
    """
SELECT strftime(ts, '%Y-%m-%d') AS event_day, count(*) AS post_count FROM events
WHERE CAST(ts AS DATE) IN (SELECT CAST(ts AS DATE) FROM events WHERE value > 400) GROUP BY 1""",
)
def q_touched_days(spark, sf):
    """Existing rows in the days a batch touches (a semi-join on the day)."""
    root = written_lake(spark, sf)
    batch = enriched(spark, sf).filter(F.col("like_count") > 40000)
    touched = sink.touched(scan.read_lake(spark, root, ENRICHED), batch)
    return touched.groupBy("event_day").agg(F.count(F.lit(1)).alias("post_count"))


@query("declared_write", "SELECT count(*) AS post_count, CAST(15 AS BIGINT) AS columns, CAST(sum(user_id) AS BIGINT) AS replies FROM events")
def q_declared_write(spark, sf):
    """Counts arrive as strings and doubles; the declared schema decides what is stored."""
    root = scratch_path(spark, "declared")
    loose = enriched(spark, sf).withColumn("like_count", F.col("like_count").cast("string")).withColumn(
        "reply_count", F.col("reply_count").cast("double")
    )
    conform(loose, ENRICHED).write.options(**sink.COMPACT).parquet(root)
    back = scan.read_lake(spark, root, ENRICHED)
    return back.agg(
        F.count(F.lit(1)).alias("post_count"),
        F.lit(len(spark.read.parquet(root).columns)).cast("bigint").alias("columns"),
        F.sum("reply_count").alias("replies"),
    )


@query(
    "write_receipt",
    """
SELECT count(*) AS post_count, strftime(min(ts), '%Y-%m-%d') AS first_day, strftime(max(ts), '%Y-%m-%d') AS last_day,
       CAST(sum(CAST(floor(value * 100) AS BIGINT) + CAST(props->>'$.k' AS BIGINT) + user_id) AS BIGINT) AS total_engagement FROM events""",
)
def q_write_receipt(spark, sf):
    """Counted during the write, without a second pass."""
    root = scratch_path(spark, "receipt")
    receipt = sink.write_with_receipt(enriched(spark, sf), lambda df: sink.write_event_date(df, root), root)
    row = [(receipt["post_count"], receipt["first_day"], receipt["last_day"], receipt["total_engagement"])]
    return local_table(spark, row, "post_count bigint, first_day string, last_day string, total_engagement bigint")


@query(
    "name_collisions",
    "SELECT 'source' AS name WHERE (SELECT count(*) FROM events) > 0",
)
def q_name_collisions(spark, sf):
    """A layout keyed by a stored column: the key and the column share a name."""
    root = written_lake(spark, sf)
    columns = scan.file_schemas(spark, root, glob="part-*").select("column")
    keyed = scratch_path(spark, "by-source")
    # The writer takes the key out of the files, so the layout alone cannot show the clash.
    scan.read_lake(spark, root, ENRICHED).select("id", "source").write.partitionBy("source").parquet(keyed)
    paths = scan.listing(spark, keyed).select(F.regexp_extract("key", r"((?:[^/=]+=[^/]*/)+)[^/]*$", 1).alias("partition"))
    return name_collisions(paths, columns)


@query(
    "reader_probes",
    """
SELECT * FROM (VALUES ('hive', true), ('flat', true), ('one object', true), ('text filter on a number key', false)) t(reader, ok)
WHERE (SELECT count(*) FROM events) > 0""",
)
def q_reader_probes(spark, sf):
    """Which reads of the lake work. A day-of-month key named like the stored day breaks the filter."""
    root = written_lake(spark, sf)
    clash = scratch_path(spark, "clash")
    lake = scan.read_lake(spark, root, ENRICHED)
    lake.select("id", F.dayofmonth("event_date").alias("day")).write.partitionBy("day").parquet(clash)
    one = scan.object_inventory(spark, root, ENRICHED).orderBy("key").limit(1).select("key").first()["key"]
    probes = [
        scan.read_probe("hive", lambda: scan.read_lake(spark, root).count()),
        scan.read_probe("flat", lambda: scan.read_lake_flat(spark, root).count()),
        scan.read_probe("one object", lambda: scan.object_rows(spark, one)),
        scan.read_probe(
            "text filter on a number key",
            lambda: scan.read_lake(spark, clash).filter(F.col("day") == "2024-01-15").count(),
        ),
    ]
    return local_table(spark, [(p["reader"], p["ok"]) for p in probes], "reader string, ok boolean")


def _landed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as JSON posts: a tenth without an id, a tenth with a null id, a tenth sharing ids."""
    docs = v.table(spark, sf, "documents")
    kind = F.col("doc_id") % 10
    ident = F.when(kind == 2, F.concat(F.lit("r"), F.expr("cast(doc_id div 30 as string)"))).when(kind > 2, F.col("doc_id").cast("string"))
    day = F.format_string("2024-01-%02dT08:00:00.000Z", F.lit(1) + F.expr("doc_id div 30") % 28)
    post = F.struct(ident.alias("id"), day.alias("created_at"), "text", "source", F.struct(F.col("doc_id").alias("like_count")).alias("public_metrics"))
    # A null field is left out of the JSON, so a stored null is put in by hand.
    line = F.to_json(post)
    null_id = F.concat(F.lit('{"id":null,'), F.substring(line, F.lit(2), F.length(line)))
    return docs.select("doc_id", F.when(kind == 1, null_id).otherwise(line).alias("value"))


@query(
    "etl_run",
    """
WITH p AS (
  SELECT doc_id, strftime(DATE '2024-01-01' + CAST(doc_id // 30 % 28 AS INTEGER), '%Y-%m-%d') AS event_day, doc_id % 10 < 2 AS no_id,
         CASE WHEN doc_id % 10 = 2 THEN 'r' || (doc_id // 30) ELSE CAST(doc_id AS VARCHAR) END AS id FROM documents),
k AS (SELECT event_day, doc_id FROM p WHERE no_id UNION ALL SELECT event_day, max(doc_id) FROM p WHERE NOT no_id GROUP BY event_day, id)
SELECT event_day, count(*) AS lake_posts, count(*) AS summary_posts, CAST(sum(doc_id) AS BIGINT) AS lake_likes, CAST(sum(doc_id) AS BIGINT) AS total_engagement,
       (SELECT count(*) FROM k) AS receipt_posts, CAST(1 AS BIGINT) AS rejected FROM k GROUP BY event_day""",
)
def q_etl_run(spark, sf):
    """The whole run, twice, over posts with absent, null and shared ids and one broken line."""
    landed, target = scratch_path(spark, "etl-in"), scratch_path(spark, "etl")
    lines = _landed_documents(spark, sf).select("value")
    lines.unionByName(spark.range(1).select(F.lit("{broken").alias("value"))).write.text(landed)
    for _ in range(2):
        receipt = run_etl(spark, landed, target, RUN_TS, scorer=FREQUENT)
    lake = scan.read_lake(spark, f"{target}/posts", ENRICHED).groupBy("event_day").agg(F.count(F.lit(1)).alias("lake_posts"), F.sum("like_count").alias("lake_likes"))
    summary = scan.read_lake(spark, f"{target}/daily_summary").select("event_day", F.col("post_count").alias("summary_posts"), "total_engagement")
    return lake.join(summary, "event_day", "full_outer").withColumns(
        {"receipt_posts": F.lit(receipt["post_count"]).cast("bigint"), "rejected": F.lit(receipt["rejected"]).cast("bigint")}
    )


@query(
    "etl_two_batches",
    """
WITH p AS (
  SELECT doc_id, strftime(DATE '2024-01-01' + CAST(doc_id // 30 % 28 AS INTEGER), '%Y-%m-%d') AS event_day, doc_id % 10 < 2 AS no_id,
         CASE WHEN doc_id % 10 = 2 THEN 'r' || (doc_id // 30) ELSE CAST(doc_id AS VARCHAR) END AS id FROM documents),
k AS (SELECT event_day, doc_id FROM p WHERE no_id UNION ALL SELECT event_day, max(doc_id) FROM p WHERE NOT no_id GROUP BY event_day, id)
SELECT event_day, count(*) AS lake_posts, count(*) AS summary_posts, CAST(sum(doc_id) AS BIGINT) AS lake_likes, CAST(sum(doc_id) AS BIGINT) AS total_engagement,
       CAST(0 AS BIGINT) AS rejects FROM k GROUP BY event_day""",
)
def q_etl_two_batches(spark, sf):
    """Three runs of one date, each with some of the days: lake and summary hold all days, rejects are the last run's."""
    target = scratch_path(spark, "etl")
    lines = _landed_documents(spark, sf).withColumn("part", F.expr("doc_id div 30") % 28 % 3)
    broken = spark.range(2).select(F.lit("{broken").alias("value"))
    for part in range(3):
        landed = scratch_path(spark, "etl-in")
        batch = lines.filter(F.col("part") == part).select("value")
        (batch if part == 2 else batch.unionByName(broken)).write.text(landed)
        run_etl(spark, landed, target, RUN_TS, scorer=FREQUENT)
    lake = scan.read_lake(spark, f"{target}/posts", ENRICHED).groupBy("event_day").agg(F.count(F.lit(1)).alias("lake_posts"), F.sum("like_count").alias("lake_likes"))
    summary = scan.read_lake(spark, f"{target}/daily_summary").select("event_day", F.col("post_count").alias("summary_posts"), "total_engagement")
    rejects = spark.read.parquet(f"{target}/rejects").agg(F.count(F.lit(1))).scalar()
    return lake.join(summary, "event_day", "full_outer").withColumn("rejects", rejects)


_DOCUMENT_POSTS = """
SELECT source, count(*) AS post_count, CAST(sum(doc_id) AS BIGINT) AS likes, count(*) FILTER (doc_id % 10 = 0) AS no_id,
       count(*) FILTER (doc_id % 10 = 1) AS null_id, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY 1"""


def _read_back(spark, path, fmt):
    return read_posts(spark, path, fmt).groupBy("source").agg(
        F.count(F.lit(1)).alias("post_count"),
        F.sum("like_count").alias("likes"),
        F.count_if(F.col("id") == "").alias("no_id"),
        F.count_if(F.col("id") == "None").alias("null_id"),
        F.sum(F.length("text")).alias("chars"),
    )


def _arrays(spark, sf, before: str, after: str) -> str:
    """Files that each hold one array of up to a thousand posts."""
    path = scratch_path(spark, "arrays")
    batch = _landed_documents(spark, sf).groupBy(F.expr("doc_id div 1000").alias("part")).agg(F.concat_ws(",", F.collect_list("value")).alias("posts"))
    batch.select("part", F.concat(F.lit(before), "posts", F.lit(after)).alias("value")).write.partitionBy("part").text(path)
    return f"{path}/*"


@query("array_posts", _DOCUMENT_POSTS)
def q_array_posts(spark, sf):
    return _read_back(spark, _arrays(spark, sf, "[", "]"), "json")


@query("search_posts", _DOCUMENT_POSTS)
def q_search_posts(spark, sf):
    return _read_back(spark, _arrays(spark, sf, '{"data":[', '],"meta":{"result_count":1}}'), "search")
