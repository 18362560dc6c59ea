"""Queries of ledgers, decisions, forms, probe documents, names and plans over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipweave.functions import text as X
from clipweave.operators import captions, catalog, decisions, forms, ledgers, media, planner
from clipweave.plans.queries import BLANK_SQL, SPANS, _clips, _spans, query
from clipweave.sources import table

# -- ledgers

LEDGER_SQL = """
    o AS (SELECT o_orderkey, o_custkey % 7 AS file, o_orderstatus, o_orderpriority, o_custkey, o_orderdate FROM orders)"""


def _records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, d, "orders")
    text = lambda c: F.col(c).cast("string")
    slices = orders.where("o_orderkey % 3 <> 0").select(
        F.col("o_orderkey").alias("at"), F.concat(F.lit("in/"), "o_orderkey").alias("source_path"), F.concat("o_orderkey", F.lit(".mp4")).alias("filename"), F.md5(text("o_orderkey")).alias("md5"),
        F.lit("100MB").alias("size"), F.col("o_custkey").alias("slice_count"), F.lit("out").alias("output_dir"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("note"), F.lit("2024-01-01 08:00").alias("time"),
    )
    mixes = orders.where("o_orderkey % 3 = 0").select(
        F.col("o_orderkey").alias("at"), F.lit("lib").alias("source"), F.concat(F.lit("v"), "o_orderkey").alias("script"), F.col("o_custkey").alias("count"), F.lit("out").alias("output_dir"),
        F.col("o_orderstatus").alias("status"), F.lit("2024-01-01 08:00").alias("time"), text("o_orderkey").alias("seed"), F.col("o_orderpriority").alias("batch"),
    )
    return slices, mixes


def _ledger(spark: SparkSession, d: str) -> DataFrame:
    slices, mixes = _records(spark, d)
    return ledgers.rendered([("## Slices", list(ledgers.SLICES), slices, ["at"], list(ledgers.SLICES)), ("## Mixes", list(ledgers.MIXES), mixes, ["at"], list(ledgers.MIXES))], "# Ledger")


@query("""
    WITH s AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS i, * FROM orders WHERE o_orderkey % 3 <> 0), m AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS i, * FROM orders WHERE o_orderkey % 3 = 0),
    n AS (SELECT count(*) AS n FROM s), k AS (SELECT count(*) AS k FROM m)
    SELECT * FROM (VALUES (1, '# Ledger'), (2, ''), (3, '## Slices'), (4, ''), (5, '| # | source_path | filename | md5 | size | slice_count | output_dir | status | note | time |'), (6, '|---|---|---|---|---|---|---|---|---|---|')) v(line_no, line)
    UNION ALL SELECT 6 + i, '| ' || i || ' | in/' || o_orderkey || ' | ' || o_orderkey || '.mp4 | ' || md5(o_orderkey::VARCHAR) || ' | 100MB | ' || o_custkey || ' | out | ' || o_orderstatus || ' | ' || o_orderpriority || ' | 2024-01-01 08:00 |' FROM s
    UNION ALL SELECT 7 + n, '' FROM n UNION ALL SELECT 8 + n, '## Mixes' FROM n UNION ALL SELECT 9 + n, '' FROM n
    UNION ALL SELECT 10 + n, '| # | source | script | count | output_dir | status | time | seed | batch |' FROM n UNION ALL SELECT 11 + n, '|---|---|---|---|---|---|---|---|---|' FROM n
    UNION ALL SELECT 11 + n + i, '| ' || i || ' | lib | v' || o_orderkey || ' | ' || o_custkey || ' | out | ' || o_orderstatus || ' | 2024-01-01 08:00 | ' || o_orderkey || ' | ' || o_orderpriority || ' |' FROM m, n
    UNION ALL SELECT 12 + n + k, '' FROM n, k""")
def ledger_render(spark: SparkSession, d: str) -> DataFrame:
    return _ledger(spark, d)


@query("""
    SELECT 'in/' || o_orderkey AS source_path, o_orderkey || '.mp4' AS filename, md5(o_orderkey::VARCHAR) AS md5, '100MB' AS size, o_custkey AS slice_count, 'out' AS output_dir, o_orderstatus AS status,
        CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE '' END AS note, '2024-01-01 08:00' AS time
    FROM orders WHERE o_orderkey % 3 <> 0""")
def ledger_slices(spark: SparkSession, d: str) -> DataFrame:
    """Read back from the text, rows of odd orders in the old layout, which has no note."""
    lines = _ledger(spark, d).withColumn("file", F.lit("ledger"))
    odd = F.regexp_extract("line", r"\| in/(\d+) ", 1).try_cast("long") % 2 == 1
    cells = ledgers.table_cells(lines.withColumn("line", F.when(odd, F.regexp_replace("line", r" \| [^|]* (\| [^|]* \|)$", " $1")).otherwise(F.col("line"))), "## Slices")
    return ledgers.slice_rows(cells).drop("file", "line_no")


@query("""
    SELECT 'lib' AS source, 'v' || o_orderkey AS script, o_custkey AS count, 'out' AS output_dir, o_orderstatus AS status, '2024-01-01 08:00' AS time, o_orderkey::VARCHAR AS seed, o_orderpriority AS batch
    FROM orders WHERE o_orderkey % 3 = 0""")
def ledger_mixes(spark: SparkSession, d: str) -> DataFrame:
    return ledgers.mix_rows(ledgers.table_cells(_ledger(spark, d).withColumn("file", F.lit("ledger")), "## Mixes")).drop("file", "line_no")


@query("""
    SELECT l_orderkey, left(string_agg(l_partkey || '[' || l_returnflag || ']' || CASE WHEN l_quantity = 25 THEN '' ELSE '@' || (l_quantity / 25)::DECIMAL(9, 2)::DOUBLE || 'x' END, '; ' ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice), 200) AS used,
        array_to_string(list_sort(list_distinct(list(l_linestatus))), ',') AS transitions
    FROM lineitem GROUP BY l_orderkey""")
def mix_entries(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").withColumn("place", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")).withColumn("speed", F.col("l_quantity") / 25).withColumn("name", F.col("l_partkey").cast("string"))
    return ledgers.mix_entry(rows, ["l_orderkey"], "place", "name", "l_returnflag", "speed", "l_linestatus")


@query("""
    SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M') AS stamped FROM events""")
def ledger_times(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", ledgers.minute(F.col("ts")).alias("stamped"))


# -- decisions


def _decisions(spark: SparkSession, d: str) -> DataFrame:
    return _spans(spark, d).select("user_id", F.col("event_id").alias("index"), F.col("s").alias("start"), (F.col("e") - 2_000_000).alias("end"), F.col("event_type").alias("category"))


@query(f"""
    WITH x AS (SELECT user_id, event_id, s, e - 2000000 AS e, event_type FROM ({SPANS})), y AS (SELECT *, lag(e) OVER (PARTITION BY user_id ORDER BY s, event_id) AS before FROM x)
    SELECT user_id, event_id AS index, 'category' AS fault FROM x WHERE event_type NOT IN ('view', 'click', 'purchase')
    UNION ALL SELECT user_id, event_id, 'span' FROM x WHERE e <= s UNION ALL SELECT user_id, event_id, 'overlap' FROM y WHERE s < before - 10""")
def decision_faults(spark: SparkSession, d: str) -> DataFrame:
    return decisions.faults(_decisions(spark, d), "user_id", ("view", "click", "purchase"), slack=10)


@query("""
    WITH f AS (SELECT CASE WHEN min(l.quality) = 1 THEN md5(text) ELSE left(md5(text), 8) END AS name, min(l.doc_id) AS plan FROM documents d JOIN labels l USING (doc_id) WHERE text IS NOT NULL GROUP BY text)
    SELECT doc_id, coalesce(a.plan, b.plan) AS plan FROM documents d LEFT JOIN f a ON a.name = md5(d.text) LEFT JOIN f b ON b.name = left(md5(d.text), 8)""")
def decision_lookup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.md5("text").alias("md5"))
    held = docs.where("md5 IS NOT NULL").join(table(spark, d, "labels"), "doc_id").groupBy("md5").agg(F.min("quality").alias("q"), F.min("doc_id").alias("plan"))
    files = held.select(F.when(F.col("q") == 1, F.col("md5")).otherwise(F.left("md5", F.lit(8))).alias("name"), "plan")
    return decisions.looked_up(docs, files, "md5", "name", "plan").select("doc_id", "plan")


@query(f"""
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY s, event_id) - 1 AS place, s AS start, e - 2000000 AS end_ms, event_type AS category FROM ({SPANS})""")
def decision_cuts(spark: SparkSession, d: str) -> DataFrame:
    rows = _decisions(spark, d).withColumns({"reason": F.lit(""), "speech": F.lit("")})
    each = decisions.cuts(rows, "user_id").select("user_id", F.posexplode("cuts").alias("place", "c"))
    return each.select("user_id", F.col("place").cast("long").alias("place"), "c.start", F.col("c.end").alias("end_ms"), "c.category")


@query(f"""
    SELECT user_id, event_id AS index, s AS start, e AS "end", '待复核' AS category, '' AS reason FROM ({SPANS})""")
def decision_template(spark: SparkSession, d: str) -> DataFrame:
    return decisions.template(_spans(spark, d).select("user_id", F.col("event_id").alias("index"), F.col("s").alias("start"), F.col("e").alias("end")), ["user_id"])


# -- forms

FORM_ITEMS = {k: k for k in forms.ITEMS}


def _answers(spark: SparkSession, d: str) -> DataFrame:
    """A form for each customer."""
    c = F.col
    said = {
        "status": F.when(c("c_custkey") % 3 == 0, " OK ").otherwise("draft"), "scopes": F.concat(F.lower("c_mktsegment"), F.lit("\n\n machinery ")), "do_slice": F.when(c("c_custkey") % 2 == 0, "是的").otherwise("否"),
        "mix_count": F.when(c("c_custkey") % 5 == 0, "many").otherwise((c("c_custkey") % 5).cast("string")), "mix_rows": F.concat((c("c_custkey") % 4).cast("string"), F.lit("，2\n9")), "strength": (c("c_custkey") % 6).cast("string"),
    }
    rows = F.array(*(F.struct(F.lit(i).alias("line_no"), F.lit(k).alias("item"), v.alias("answer")) for i, (k, v) in enumerate(said.items())))
    return table(spark, d, "customer").select("c_custkey", F.explode(rows).alias("r")).select("c_custkey", "r.*")


@query("""
    SELECT c_custkey, c_custkey % 3 = 0 AS ready, array_to_string(list_filter([lower(c_mktsegment), 'machinery'], lambda x: x IN ('building', 'machinery', 'household')), ',') AS scopes,
        array_to_string(list_concat(list_transform(list_filter(list_distinct([lower(c_mktsegment), 'machinery']), lambda x: x NOT IN ('building', 'machinery', 'household')), lambda x: 'unknown scope: ' || x), CASE WHEN c_custkey % 5 = 0 THEN ['the number of mixes is none'] ELSE [] END), ',') AS warnings,
        c_custkey % 2 = 0 AS do_slice, true AS do_shorts, CASE WHEN c_custkey % 5 = 0 THEN 5 ELSE greatest(1, c_custkey % 5)::INT END AS mix_count,
        CASE WHEN c_custkey % 4 = 0 THEN '2' ELSE (c_custkey % 4) || ',2' END AS mix_rows, CASE WHEN c_custkey % 6 = 1 THEN '轻' WHEN c_custkey % 6 = 3 THEN '强' ELSE '中' END AS strength, '1080x1920' AS size
    FROM customer""")
def form_settings(spark: SparkSession, d: str) -> DataFrame:
    made = forms.settings(_answers(spark, d), ("building", "machinery", "household"), 3, ["c_custkey"], FORM_ITEMS).drop("scripts_from", "opening")
    return made.withColumns({c: F.array_join(c, ",") for c in ("scopes", "warnings", "mix_rows")})


@query("SELECT o_orderkey, (['a', 'b', 'c'])[(o_orderkey % 3 + 1)::INT] AS script FROM orders")
def script_turns(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", forms.script_for(F.array(*map(F.lit, "abc")), F.col("o_orderkey")).alias("script"))


SCRIPTS_SQL = f"SELECT doc_id, trim(replace(text, chr(10), ' '), {BLANK_SQL}) AS text FROM documents WHERE text IS NOT NULL AND length(text) < 400 AND NOT regexp_matches(text, '[0-9]+ *[块元]|[红黄蓝绿黑白紫灰棕]')"


@query(f"""
    WITH s AS ({SCRIPTS_SQL}) SELECT row_number() OVER (ORDER BY doc_id) AS number, text, CAST(round(length(text) * 20 / 9.0) AS BIGINT) AS tenths FROM s WHERE text <> ''""")
def scripts_to_form(spark: SparkSession, d: str) -> DataFrame:
    """Short documents as scripts, numbered anew with the tenths of a second that they take."""
    docs = table(spark, d, "documents").where("text IS NOT NULL AND length(text) < 400 AND NOT text RLIKE '[0-9]+ *[块元]|[红黄蓝绿黑白紫灰棕]'")
    rows = docs.select(F.col("doc_id").alias("number"), F.replace("text", F.lit("\n"), F.lit(" ")).alias("text"))
    made = forms.to_form(rows, F.lit("19元11包"), F.lit(""), F.array(F.lit("根治")))
    return made.select("number", "text", F.round(F.col("seconds") * 10).cast("long").alias("tenths"))


# -- media


def _probes(spark: SparkSession, d: str) -> DataFrame:
    stream = '{"streams":[{"codec_type":"audio","codec_name":"aac"},{"codec_type":"video","codec_name":"h264","width":%d,"height":%d,"avg_frame_rate":"%d/%d"}%s],"format":{"duration":"%s"}}'
    audio = F.when(F.col("p_partkey") % 2 == 0, "").otherwise(',{"codec_type":"video","codec_name":"mjpeg","width":9,"height":9}')
    made = F.format_string(stream, F.col("p_size") * 10, (F.col("p_partkey") % 600), F.col("p_partkey") % 100, F.col("p_partkey") % 4, audio, F.when(F.col("p_partkey") % 9 == 0, "N/A").otherwise((F.col("p_partkey") % 40).cast("string")))
    return table(spark, d, "part").select("p_partkey", made.alias("json"))


@query("""
    WITH p AS (SELECT p_partkey, (p_size * 10)::INT AS width, (p_partkey % 600)::INT AS height, CASE WHEN p_partkey % 9 = 0 THEN 0.0 ELSE (p_partkey % 40)::DOUBLE END AS duration FROM part)
    SELECT p_partkey, duration, width, height, CASE WHEN p_partkey % 4 = 0 THEN 0.0 ELSE (p_partkey % 100)::DOUBLE / (p_partkey % 4) END AS fps, true AS has_audio, 'h264' AS vcodec,
        height >= width AND width > 0 AS portrait, width > height AS landscape, CASE WHEN duration < 10 THEN 'skipped_short' WHEN width = 0 THEN 'failed' ELSE 'done' END AS status
    FROM p""")
def probe_media(spark: SparkSession, d: str) -> DataFrame:
    info = F.col("info")
    rows = _probes(spark, d).withColumn("info", media.probed(F.col("json")))
    return rows.select("p_partkey", "info.*", media.is_portrait(info).alias("portrait"), media.is_landscape(info).alias("landscape"), media.status(info["duration"], info["width"] == 0).alias("status"))


@query("""
    SELECT p_partkey, 1 AS number, left(md5(p_partkey::VARCHAR), 8) || '_001_' || p_brand || '.mp4' AS name,
        CASE WHEN p_partkey % 9 = 0 OR p_partkey % 40 = 0 THEN 'no duration' WHEN p_size <> 40 OR p_partkey % 600 <> 300 THEN 'wrong size' END AS fault,
        CASE WHEN p_partkey % 9 = 0 OR p_partkey % 40 = 0 OR p_size <> 40 OR p_partkey % 600 <> 300 THEN 'failed' ELSE 'done' END AS status
    FROM part""")
def short_import(spark: SparkSession, d: str) -> DataFrame:
    rows = _probes(spark, d).withColumn("info", media.probed(F.col("json"))).join(table(spark, d, "part").select("p_partkey", "p_brand"), "p_partkey").withColumn("md5", F.md5(F.col("p_partkey").cast("string")))
    return media.short_exports(rows, "md5", "p_brand", F.col("info"), (400, 300)).select("p_partkey", "number", "name", "fault", "status")


@query(f"""
    SELECT event_id, k AS frame, least(t, e - 100) AS at_ms, 'seg_' || lpad((event_id % 2000)::VARCHAR, greatest(3, length((event_id % 2000)::VARCHAR))::INT, '0') || '_f' || k || '.jpg' AS name
    FROM (SELECT event_id, e, unnest([0, 1, 2]) AS k, unnest([s + 300, (s + e) // 2, greatest(s + 300, e - 300)]) AS t FROM ({SPANS}))""")
def frame_jobs(spark: SparkSession, d: str) -> DataFrame:
    rows = _spans(spark, d).withColumn("number", F.col("event_id") % 2000)
    return media.frame_jobs(rows, ["event_id"], "number", "s", "e").select("event_id", "frame", "at_ms", "name")


@query(r"""
    SELECT doc_id, replace(replace(replace(replace(left(text, 200), '\', '\\'), '''', '\'''), ':', '\:'), '%', '\%') AS drawn, replace(replace(source, '''', '''\'''''), ':', '\:') AS path FROM documents""")
def escapes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", media.drawn_text(F.left("text", F.lit(200))).alias("drawn"), media.filter_path(F.col("source")).alias("path"))


@query(f"""
    SELECT doc_id, regexp_matches(trim(text, {BLANK_SQL}), '(\\.|!)$') AS ends, regexp_matches(trim(text, {BLANK_SQL}), '^(The|Der)') AS starts, printf('%.0fMB', n_chars / 7.0) AS size, CAST(floor(n_chars * 4.5) AS INT) AS chars,
        regexp_replace(left(text, 100), '([0-9]+\\s*[a-c])', '{{\\\\c&H0000FF&}}\\1{{\\\\c&HFFFFFF&}}', 'g') AS highlighted, left(regexp_replace(replace(left(text, 60), ' ', '_'), '[^\\p{{L}}\\p{{N}}\\-_.]', '', 'g'), 40) AS safe
    FROM documents""")
def text_rules(spark: SparkSession, d: str) -> DataFrame:
    text = F.col("text")
    return table(spark, d, "documents").select(
        "doc_id", X.ends_with_any(text, (".", "!")).alias("ends"), X.starts_with_any(text, ("The", "Der")).alias("starts"), X.megabytes(F.col("n_chars") / 7 * 1_000_000).alias("size"), X.chars_for(F.col("n_chars")).alias("chars"),
        X.highlighted(F.left(text, F.lit(100)), "abc").alias("highlighted"), X.safe_name(F.left(text, F.lit(60))).alias("safe"),
    )


@query("""
    SELECT page_id, page_id % 3 = 0 OR regexp_matches(lower(url), '\\.(mp4|mov|avi|mkv|webm|m4v)$') AS video FROM pages""")
def video_scan(spark: SparkSession, d: str) -> DataFrame:
    mime = F.when(F.col("page_id") % 3 == 0, "video/mp4").otherwise("text/html")
    return table(spark, d, "pages").select("page_id", X.is_video(mime, F.col("url")).alias("video"))


@query("""
    SELECT p_partkey, CASE WHEN contains(p_name, 'ring') THEN 'jewel' WHEN contains(p_name, 'blue') THEN 'colour' ELSE 'review' END AS category,
        CASE WHEN contains(p_name, 'ring') THEN 'keyword ring' WHEN contains(p_name, 'blue') THEN 'keyword blue' ELSE 'none' END AS reason FROM part""")
def category_reason(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", X.category_reason(F.col("p_name"), {"ring": "jewel", "blue": "colour"}, "review").alias("found")).select("p_partkey", "found.*")


# -- catalogs


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.regexp_extract("url", "[^/]*$", 0).alias("name"), F.md5("html").alias("digest"))


CLASSED = r"""
    f AS (SELECT page_id, regexp_extract(url, '[^/]*$', 0) AS name, md5(html) AS digest FROM pages),
    g AS (SELECT *, coalesce(page_id <> min(page_id) OVER (PARTITION BY digest), false) AS redundant, count(*) OVER (PARTITION BY digest) AS copies,
        regexp_full_match(lower(name), '\.ds_store|thumbs\.db|desktop\.ini|\.pip_cache\.json|\._.*|.*\.tmp|.*\.temp|~\$.*') AS junk, regexp_matches(lower(name), '.\.(txt|md|doc|docx|pdf|xls|xlsx)$') AS document FROM f)"""


@query(f"""
    WITH {CLASSED} SELECT count(*) AS scanned, count(*) FILTER (junk) AS junk, count(*) FILTER (redundant) AS redundant, count(*) FILTER (copies > 1 AND NOT redundant) AS kept,
        count(*) FILTER (document AND NOT junk AND NOT redundant) AS documents, count(*) FILTER (junk OR redundant) AS trashed FROM g""")
def catalog_summary(spark: SparkSession, d: str) -> DataFrame:
    return catalog.summary(_pages(spark, d), "name", "digest", "page_id")


@query(f"WITH {CLASSED} SELECT page_id, name FROM g WHERE junk OR redundant")
def trash_list(spark: SparkSession, d: str) -> DataFrame:
    return catalog.trash(_pages(spark, d), "name", "digest", "page_id").select("page_id", "name")


def _edges(spark: SparkSession, d: str) -> DataFrame:
    regions = table(spark, d, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("node"), F.lit(None).cast("string").alias("parent"), F.col("r_name").alias("name"))
    nations = table(spark, d, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("node"), F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.col("n_name").alias("name"))
    return regions.unionByName(nations)


@query("""
    WITH p AS (SELECT 'r' || r_regionkey AS node, r_name AS path, 0 AS depth FROM region UNION ALL SELECT 'n' || n_nationkey, r_name || '/' || n_name, 1 FROM nation JOIN region ON r_regionkey = n_regionkey)
    SELECT node, path, depth, row_number() OVER (ORDER BY path COLLATE C, node) AS scan_ord FROM p""".replace(" COLLATE C", ""))
def tree_scan(spark: SparkSession, d: str) -> DataFrame:
    return catalog.scanned(_edges(spark, d), "node", "parent", "name")


@query("SELECT r_name || '/' || n_name AS path, 'n' || n_nationkey AS node FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey = (SELECT min(n_nationkey) FROM nation)")
def path_lookup(spark: SparkSession, d: str) -> DataFrame:
    """The first nation, found again by its path."""
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    path = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).orderBy("n_nationkey").select(F.concat("r_name", F.lit("/"), "n_name")).first()[0]
    return spark.createDataFrame([(path, catalog.resolved(_edges(spark, d), "node", "parent", "name", path))], "path string, node string")


@query("SELECT doc_id, n_chars, (SELECT count(*) FROM documents) - 20 AS more FROM documents ORDER BY n_chars, doc_id LIMIT 20")
def first_shown(spark: SparkSession, d: str) -> DataFrame:
    rows, more = catalog.shown(table(spark, d, "documents").select("doc_id", "n_chars"), ["n_chars", "doc_id"])
    return rows.withColumn("more", F.lit(more).cast("long"))


# -- usage and plans


@query("""
    SELECT p_partkey, sum(n)::BIGINT AS n FROM (SELECT p_partkey, p_size::BIGINT AS n FROM part UNION ALL SELECT l_partkey, 1 FROM lineitem) GROUP BY p_partkey""")
def usage_merge(spark: SparkSession, d: str) -> DataFrame:
    before = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("long").alias("n"))
    return planner.used_more(before, table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "n")


@query("SELECT l_orderkey, count(*) AS clips, round(sum(l_quantity), 2) AS duration FROM lineitem GROUP BY l_orderkey")
def plan_durations(spark: SparkSession, d: str) -> DataFrame:
    return planner.duration(table(spark, d, "lineitem"), ["l_orderkey"], "l_quantity")


@query("SELECT p_brand, count(*) AS clips, array_to_string(list_sort(list(p_partkey)), ',') AS ids FROM part GROUP BY p_brand")
def clips_by_category(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("clips"), F.array_join(F.array_sort(F.collect_list("p_partkey")), ",").alias("ids"))


@query("SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)")
def missing_clips(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "part").where("p_size > 5").withColumnRenamed("p_partkey", "l_partkey")
    return planner.missing_files(table(spark, d, "lineitem"), files, "l_partkey").select("l_partkey", "l_orderkey", "l_linenumber")


@query(rf"""
    WITH s AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[.!?;]'), lambda x: trim(x, {BLANK_SQL})), lambda x: x <> '') AS parts FROM documents),
    e AS (SELECT doc_id, parts, unnest(parts) AS sentence, generate_subscripts(parts, 1) - 1 AS sentence_no FROM s)
    SELECT doc_id, sentence_no::INT AS sentence_no, length(sentence) AS chars, round(57.0 * length(sentence) / list_sum(list_transform(parts, lambda x: length(x))), 6) AS seconds FROM e""")
def sentence_targets(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", F.lit(60.0).alias("total"), F.lit(3.0).alias("hook"))
    rows = planner.sentence_targets(docs, ["doc_id"], "text", "total", "hook", ".!?;")
    return rows.select("doc_id", "sentence_no", F.length("sentence").alias("chars"), F.round("seconds", 6).alias("seconds"))


def _library(spark: SparkSession, d: str) -> DataFrame:
    clips = _clips(spark, d).select(F.col("p_brand").alias("category"), F.col("p_partkey").alias("clip_id"), F.concat_ws("_", F.split_part("p_name", F.lit(" "), F.lit(1)), "p_type").alias("source"), F.col("p_size").cast("double").alias("duration"), F.col("used").alias("usage"))
    return clips


@query()
def sentence_plan(spark: SparkSession, d: str) -> DataFrame:
    """Plans by the sentences of a script, with durations aligned to the time that it takes."""
    clips = _library(spark, d)
    script = spark.createDataFrame([("a first sentence here. a second one that is rather longer than it! short; and the last of them",)], "text string").withColumns({"total": planner.audio_target(F.lit(100.0), F.lit(4.0), F.col("text")), "hook": F.lit(4.0)})
    targets = planner.sentence_targets(script, [], "text", "total", "hook", ".!?;")
    plans = planner.sentence_plans(clips.where("category <> 'Brand#1'"), targets, list(range(10)), clips.where("category = 'Brand#1'"))
    return planner.assembled(plans, F.lit(104.0), by_script=True)


@query("""
    WITH t AS (SELECT c_custkey, unnest([0, 1, 2]) AS i FROM customer)
    SELECT c_custkey, (15 + i)::BIGINT AS line_no, 'Dialogue: 0,0:00:0' || i || '.00,0:00:0' || (i + 1) || '.00,sub,,0,0,0,,line ' || i AS text FROM t""")
def subtitle_events(spark: SparkSession, d: str) -> DataFrame:
    """The events of a subtitle file, whose head is tested apart."""
    rows = table(spark, d, "customer").select("c_custkey", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("line_no"))
    rows = rows.withColumns({"line": F.concat(F.lit("line "), "line_no"), "start_ms": F.col("line_no") * 1000, "end_ms": (F.col("line_no") + 1) * 1000})
    return captions.subtitle_file(captions.events(rows), "c_custkey").where("text LIKE 'Dialogue%'").select("c_custkey", (F.col("line_no") + 4).alias("line_no"), "text")
