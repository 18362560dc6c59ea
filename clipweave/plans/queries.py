"""The library's queries over the driver's tables, each with the same question in SQL where SQL can ask it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipweave.functions import text as X
from clipweave.operators import captions, catalog, folds, intervals, library, media, planner, transcripts
from clipweave.sources import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
#: Stand-ins for the domain's delimiters in the tables' languages.
MARKS = "[,.!?;]"
BLANK_SQL = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
KEYWORDS = {"ring": "jewel", "widget": "part", "bolt": "part", "gear": "machine", "hot": "warm", "blue": "colour"}
POSITIONS = {"PROMO": "start", "LARGE": "middle", "ECONOMY": "end"}
UNFINISHED = ("and", "the", "of", "et", "und", "de", ",")
CONTINUING = ("The", "And", "Et", "Und", "Le")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# -- catalogs


@query("""
    SELECT doc_id, min(doc_id) OVER w AS kept, count(*) OVER w AS copies, doc_id <> min(doc_id) OVER w AS redundant
    FROM documents WHERE text IS NOT NULL WINDOW w AS (PARTITION BY md5(text)) QUALIFY count(*) OVER w > 1""")
def dup_report(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.md5("text").alias("digest"))
    return catalog.with_duplicates(docs, "digest", "doc_id").where("copies > 1").select("doc_id", "kept", "copies", "redundant")


@query(r"""
    WITH f AS (SELECT page_id, regexp_extract(url, '[^/]*$', 0) AS name, md5(html) AS digest FROM pages),
    g AS (SELECT *, page_id <> min(page_id) OVER (PARTITION BY digest) AS redundant FROM f)
    SELECT page_id, name, CASE
        WHEN regexp_full_match(lower(name), '\.ds_store|thumbs\.db|desktop\.ini|\.pip_cache\.json|\._.*|.*\.tmp|.*\.temp|~\$.*') THEN 'junk'
        WHEN redundant THEN 'duplicate'
        WHEN regexp_matches(lower(name), '.\.(txt|md|doc|docx|pdf|xls|xlsx)$') THEN 'document' ELSE 'kept' END AS class
    FROM g""")
def clean_classify(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", F.regexp_extract("url", "[^/]*$", 0).alias("name"), F.md5("html").alias("digest"))
    return catalog.classified(pages, "name", "digest", "page_id").select("page_id", "name", "class")


@query("""
    SELECT count(*) AS scanned, count(*) FILTER (copies > 1 AND redundant) AS redundant, count(DISTINCT digest) FILTER (copies > 1) AS kept
    FROM (SELECT md5(text) AS digest, count(*) OVER w AS copies, doc_id <> min(doc_id) OVER w AS redundant FROM documents WINDOW w AS (PARTITION BY md5(text)))""")
def clean_summary(spark: SparkSession, d: str) -> DataFrame:
    sizes = table(spark, d, "documents").groupBy(F.md5("text").alias("digest")).agg(F.count("*").alias("copies"))
    several = F.col("digest").isNotNull() & (F.col("copies") > 1)
    return sizes.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("scanned"), F.coalesce(F.sum(F.when(several, F.col("copies") - 1)), F.lit(0)).alias("redundant"), F.count_if(several).alias("kept"))


@query("""
    SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS done, count(*) FILTER (o_orderstatus = 'P') AS skipped, count(*) FILTER (o_orderstatus = 'O') AS failed
    FROM orders GROUP BY o_orderpriority""")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    is_ = lambda s: F.count_if(F.col("o_orderstatus") == s)
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(is_("F").alias("done"), is_("P").alias("skipped"), is_("O").alias("failed"))


@query("SELECT source, count(*) AS n_files, sum(n_chars)::BIGINT AS size FROM documents GROUP BY source")
def folder_totals(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("n_files"), F.sum("n_chars").alias("size"))


@query("SELECT doc_id, source FROM documents x WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = x.doc_id AND l.toxic <> 1)")
def resume_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return catalog.unprocessed(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id", F.col("toxic") == 1)


@query("""
    WITH RECURSIVE e AS (
        SELECT 'r' || r_regionkey AS node, NULL AS parent, r_name AS name FROM region
        UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation
        UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name FROM customer),
    walk AS (
        SELECT node, name AS path, 0 AS depth FROM e WHERE parent IS NULL
        UNION ALL SELECT e.node, w.path || '/' || e.name, w.depth + 1 FROM e JOIN walk w ON e.parent = w.node)
    SELECT node, path, depth FROM walk""")
def tree_walk(spark: SparkSession, d: str) -> DataFrame:
    edge = lambda t, node, parent, name: table(spark, d, t).select(node.alias("node"), parent.alias("parent"), F.col(name).alias("name"))
    key = lambda letter, c: F.concat(F.lit(letter), F.col(c))
    edges = (
        edge("region", key("r", "r_regionkey"), F.lit(None).cast("string"), "r_name")
        .unionByName(edge("nation", key("n", "n_nationkey"), key("r", "n_regionkey"), "n_name"))
        .unionByName(edge("customer", key("c", "c_custkey"), key("n", "c_nationkey"), "c_name"))
    )
    return catalog.tree_paths(edges, "node", "parent", "name")


@query("SELECT doc_id, source, n_chars FROM documents ORDER BY n_chars, doc_id LIMIT 20")
def smallest_n(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "source", "n_chars").orderBy("n_chars", "doc_id").limit(20)


@query("""
    SELECT event_id, (json_extract_string(props, '$.k'))::INT AS k, props IS NOT NULL AND json_extract_string(props, '$.k') IS NOT NULL AS has_k FROM events""")
def probe_json(spark: SparkSession, d: str) -> DataFrame:
    parsed = F.from_json("props", "k int")
    return table(spark, d, "events").select("event_id", parsed["k"].alias("k"), parsed["k"].isNotNull().alias("has_k"))


# -- folds


@query("""
    WITH RECURSIVE r AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
    walk AS (
        SELECT source, doc_id, i, n_chars AS acc, 0::BIGINT AS batch FROM r WHERE i = 1
        UNION ALL
        SELECT r.source, r.doc_id, r.i, CASE WHEN w.acc + r.n_chars > 20000 THEN r.n_chars ELSE w.acc + r.n_chars END,
               CASE WHEN w.acc + r.n_chars > 20000 THEN w.batch + 1 ELSE w.batch END
        FROM walk w JOIN r ON r.source = w.source AND r.i = w.i + 1)
    SELECT source, doc_id, batch FROM walk""")
def size_batches(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("source", "doc_id", "n_chars")
    return folds.size_batches(docs, "source", ["doc_id"], "n_chars", 20_000, ["doc_id"])


@query("""
    WITH e AS (SELECT user_id, list(epoch_us(ts) ORDER BY ts) AS ts FROM events GROUP BY user_id),
    k AS (SELECT user_id, list_reduce(ts[2:], lambda acc, t: CASE WHEN t - acc[len(acc)] > 7200000000 THEN list_append(acc, t) ELSE acc END, [ts[1]]) AS kept FROM e)
    SELECT user_id, unnest(kept) AS at_us FROM k""")
def gap_dedup(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select("user_id", F.unix_micros("ts").alias("at_us"))
    return folds.gap_dedup(events, "user_id", "at_us", 7_200_000_000)


# -- intervals

SPANS = "SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS s, epoch_us(ts) // 1000 + CAST(floor(value * 60000) AS BIGINT) AS e FROM events"


def _spans(spark: SparkSession, d: str) -> DataFrame:
    start = F.unix_millis("ts")
    return table(spark, d, "events").select("event_id", "user_id", "event_type", start.alias("s"), (start + F.floor(F.col("value") * 60000)).alias("e"))


def _spoken(spans: DataFrame) -> DataFrame:
    return spans.where("event_type IN ('view', 'click')").select("user_id", F.col("event_id").alias("sent_id"), F.col("s").alias("ss"), F.col("e").alias("se"), F.col("event_id").cast("string").alias("said"))


@query(f"""
    WITH x AS ({SPANS}), seg AS (SELECT * FROM x WHERE event_type NOT IN ('view', 'click')), sent AS (SELECT * FROM x WHERE event_type IN ('view', 'click'))
    SELECT seg.event_id AS seg_id, coalesce(string_agg(sent.event_id::VARCHAR, ' ' ORDER BY sent.s, sent.event_id), '') AS speech
    FROM seg LEFT JOIN sent ON seg.user_id = sent.user_id AND seg.s <= sent.e AND sent.s <= seg.e
        AND 2 * (least(seg.e, sent.e) - greatest(seg.s, sent.s)) >= least(2000, sent.e - sent.s)
    GROUP BY seg.event_id""")
def overlap_assign(spark: SparkSession, d: str) -> DataFrame:
    spans = _spans(spark, d)
    segments = spans.where("event_type NOT IN ('view', 'click')").select("user_id", F.col("event_id").alias("seg_id"), "s", "e")
    return intervals.spoken_text(segments, _spoken(spans), "user_id").select("seg_id", "speech")


@query(f"""
    WITH x AS ({SPANS})
    SELECT b.event_id, b.s AS at_ms FROM x b WHERE b.event_type = 'error' AND NOT EXISTS (
        SELECT 1 FROM x t WHERE t.event_type IN ('view', 'click') AND t.user_id = b.user_id AND t.s + 150 < b.s AND b.s < t.e - 150)""")
def boundary_anti(spark: SparkSession, d: str) -> DataFrame:
    spans = _spans(spark, d)
    bounds = spans.where("event_type = 'error'").select("event_id", "user_id", F.col("s").alias("at_ms"))
    return intervals.outside_sentences(bounds, _spoken(spans), "user_id", "at_ms").select("event_id", "at_ms")


@query(f"""
    WITH x AS ({SPANS}), y AS (SELECT *, lag(e) OVER (PARTITION BY user_id ORDER BY s, event_id) AS previous_end FROM x)
    SELECT event_id, user_id, s, previous_end FROM y WHERE s < previous_end - 10""")
def neighbor_overlap(spark: SparkSession, d: str) -> DataFrame:
    return intervals.neighbour_overlaps(_spans(spark, d), "user_id", "s", "e", "event_id").select("event_id", "user_id", "s", "previous_end")


def _sources(spark: SparkSession, d: str) -> DataFrame:
    """A user's events as a source: hours since the year began stand for seconds."""
    hour = (F.unix_millis("ts") - 1_704_067_200_000) / F.lit(3_600_000.0)
    said = F.struct(hour.alias("start"), (hour + F.least(F.col("value") / 10, F.lit(6.0))).alias("end"))
    return table(spark, d, "events").groupBy("user_id").agg(F.sort_array(F.collect_list(hour)).alias("scenes"), F.sort_array(F.collect_list(F.when(F.col("event_type") == "view", said))).alias("spoken")).withColumn("duration", F.lit(720.0))


HOURS = "(epoch_us(ts) // 1000 - 1704067200000) / 3600000.0::DOUBLE"
SPAN = "STRUCT(s DOUBLE, e DOUBLE)[]"


@query(f"""
    WITH b AS (SELECT user_id, list_sort(list_distinct(list_concat([0.0::DOUBLE, 720.0::DOUBLE], list_filter(list({HOURS}), lambda t: t > 0.5 AND t < 719.5)))) AS b FROM events GROUP BY user_id),
    i AS (SELECT user_id, b, list_filter(list_transform(range(1, len(b)), lambda k: {{'s': b[k], 'e': b[k + 1]}}), lambda x: x.e - x.s > 0.3) AS spans FROM b),
    a AS (SELECT user_id, b, spans, list_reduce(spans, lambda acc, x: CASE WHEN x.e - coalesce(acc.waits, x.s) < 2 THEN {{'out': acc.out, 'waits': coalesce(acc.waits, x.s)}}
        ELSE {{'out': list_append(acc.out, {{'s': coalesce(acc.waits, x.s), 'e': x.e}}), 'waits': NULL::DOUBLE}} END, {{'out': []::{SPAN}, 'waits': NULL::DOUBLE}}) AS r FROM i),
    p AS (SELECT user_id, b, unnest(CASE WHEN r.waits IS NULL THEN r.out WHEN len(r.out) = 0 THEN [{{'s': r.waits, 'e': spans[-1].e}}] ELSE list_append(r.out[:-2], {{'s': r.out[-1].s, 'e': spans[-1].e}}) END) AS p FROM a),
    q AS (SELECT user_id, p, list_concat(list_concat([p.s], list_filter(b, lambda t: t > p.s AND t < p.e)), [p.e]) AS c FROM p),
    g AS (SELECT user_id, unnest(CASE WHEN p.e - p.s <= 8 THEN [p] ELSE list_reduce(list_transform(range(1, len(c)), lambda k: {{'s': c[k], 'e': c[k + 1]}}),
        lambda acc, x: CASE WHEN len(acc) > 0 AND acc[-1].e - acc[-1].s < 2 THEN list_append(acc[:-2], {{'s': acc[-1].s, 'e': x.e}}) ELSE list_append(acc, x) END, []::{SPAN}) END) AS g, p.e - p.s > 8 AS long FROM q),
    n AS (SELECT user_id, g.s AS s, g.e - g.s AS d, CASE WHEN long THEN greatest(1, round_even((g.e - g.s) / 8, 0)::INT) ELSE 1 END AS n FROM g),
    k AS (SELECT user_id, s + unnest(range(0, n)) * d / n AS s, s + (unnest(range(0, n)) + 1) * d / n AS e FROM n)
    SELECT user_id, (row_number() OVER (PARTITION BY user_id ORDER BY s) - 1)::INT AS cut_no, round(s, 2) AS start, round(e, 2) AS "end" FROM k WHERE e - s >= 1.7""")
def cut_plan(spark: SparkSession, d: str) -> DataFrame:
    plans = intervals.with_cuts(_sources(spark, d).drop("spoken"), "duration", "scenes")
    return plans.select("user_id", F.posexplode("cuts").alias("cut_no", "cut")).select("user_id", "cut_no", "cut.start", "cut.end")


@query()
def snap_plan(spark: SparkSession, d: str) -> DataFrame:
    plans = intervals.with_cuts(_sources(spark, d), "duration", "scenes", "spoken")
    return plans.select("user_id", F.posexplode("cuts").alias("cut_no", "cut")).select("user_id", "cut_no", "cut.start", "cut.end")


@query("""
    SELECT event_id, i AS k, 1000 + 5000 * i AS t_ms
    FROM (SELECT event_id, unnest(range(0, CASE WHEN CAST(floor(value * 1000) AS BIGINT) - 501 >= 1000 THEN (CAST(floor(value * 1000) AS BIGINT) - 1501) // 5000 + 1 ELSE 0 END)) AS i FROM events)""")
def sample_times(spark: SparkSession, d: str) -> DataFrame:
    times = X.sample_times(F.floor(F.col("value") * 1000))
    return table(spark, d, "events").select("event_id", F.posexplode(times).alias("k", "t_ms")).withColumn("k", F.col("k").cast("long"))


@query(f"""
    WITH x AS ({SPANS})
    SELECT event_id, unnest([0, 1, 2]) AS k, least(unnest([s + 300, (s + e) // 2, greatest(s + 300, e - 300)]), e - 100) AS t_ms FROM x""")
def probe_times(spark: SparkSession, d: str) -> DataFrame:
    return _spans(spark, d).select("event_id", F.posexplode(X.probe_times(F.col("s"), F.col("e"))).alias("k", "t_ms"))


# -- transcripts

SEGMENTS = "SELECT conv_id, turn, turn * 60000 AS start_ms, turn * 60000 + length(coalesce(text, '')) * 200 AS end_ms, coalesce(text, '') AS text FROM conversations"


def _segments(spark: SparkSession, d: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    start = F.col("turn") * 60000
    return table(spark, d, "conversations").select("conv_id", "turn", start.alias("start_ms"), (start + F.length(text) * 200).alias("end_ms"), text.alias("text"))


@query(rf"""
    WITH s AS ({SEGMENTS}),
    p AS (SELECT *, list_filter(list_transform(string_split(regexp_replace(text, '([,.!?;:])', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, {BLANK_SQL})), lambda x: x <> '') AS parts FROM s),
    q AS (SELECT conv_id, turn, start_ms, end_ms, CASE WHEN end_ms - start_ms > 9000 AND len(parts) > 1 THEN parts ELSE [text] END AS parts FROM p),
    r AS (SELECT conv_id, turn, start_ms, end_ms, unnest(parts) AS text, generate_subscripts(parts, 1) - 1 AS part FROM q),
    t AS (SELECT *, sum(length(text)) OVER (PARTITION BY conv_id, turn ORDER BY part)::BIGINT AS upto, sum(length(text)) OVER (PARTITION BY conv_id, turn)::BIGINT AS total FROM r)
    SELECT conv_id, turn, part::BIGINT AS part, text,
        CASE WHEN total = 0 THEN start_ms ELSE start_ms + (end_ms - start_ms) * (upto - length(text)) // total END AS start_ms,
        CASE WHEN total = 0 THEN start_ms ELSE start_ms + (end_ms - start_ms) * upto // total END AS end_ms
    FROM t""")
def segment_refine(spark: SparkSession, d: str) -> DataFrame:
    return transcripts.refined(_segments(spark, d), ["conv_id", "turn"], marks=",.!?;:").withColumn("part", F.col("part").cast("long"))


@query(f"""
    WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM ({SEGMENTS})),
    walk AS (
        SELECT conv_id, i, 1 AS grp, start_ms, end_ms, text FROM s WHERE i = 1
        UNION ALL
        SELECT s.conv_id, s.i, w.grp + (NOT same)::INT, CASE WHEN same THEN w.start_ms ELSE s.start_ms END, s.end_ms, CASE WHEN same AND length(w.text) >= length(s.text) THEN w.text ELSE s.text END
        FROM walk w JOIN s ON s.conv_id = w.conv_id AND s.i = w.i + 1,
        LATERAL (SELECT list_distinct(list_filter(string_split(w.text, ''), lambda c: c <> '')) AS a, list_distinct(list_filter(string_split(s.text, ''), lambda c: c <> '')) AS b),
        LATERAL (SELECT len(list_intersect(a, b)) AS inter),
        LATERAL (SELECT len(a) > 0 AND len(b) > 0 AND 100 * inter > 90 * (len(a) + len(b) - inter) AS same))
    SELECT conv_id, start_ms, end_ms, text FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id, grp ORDER BY i DESC) = 1""")
def segment_dedup(spark: SparkSession, d: str) -> DataFrame:
    return transcripts.without_repeats(_segments(spark, d), "conv_id", ["turn"], percent=90)


@query(f"""
    WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM ({SEGMENTS})),
    walk AS (
        SELECT conv_id, i, 1 AS grp, start_ms, end_ms, text FROM s WHERE i = 1
        UNION ALL
        SELECT s.conv_id, s.i, w.grp + (NOT same)::INT, CASE WHEN same THEN w.start_ms ELSE s.start_ms END, s.end_ms, CASE WHEN same THEN trim(w.text || ' ' || s.text, {BLANK_SQL}) ELSE s.text END
        FROM walk w JOIN s ON s.conv_id = w.conv_id AND s.i = w.i + 1,
        LATERAL (SELECT (regexp_matches(trim(w.text, {BLANK_SQL}), '({"|".join(UNFINISHED)})$') OR regexp_matches(trim(s.text, {BLANK_SQL}), '^({"|".join(CONTINUING)})')) AND w.end_ms - w.start_ms < 200000 AS same))
    SELECT conv_id, start_ms, end_ms, text FROM walk QUALIFY row_number() OVER (PARTITION BY conv_id, grp ORDER BY i DESC) = 1""")
def segment_merge(spark: SparkSession, d: str) -> DataFrame:
    return transcripts.merged(_segments(spark, d), "conv_id", ["turn"], 200_000, UNFINISHED, CONTINUING)


@query("""
    WITH p AS (SELECT doc_id, source, text, lag(text) OVER (PARTITION BY source ORDER BY doc_id) AS before FROM documents),
    s AS (SELECT doc_id, list_distinct(list_filter(string_split(text, ''), lambda c: c <> '')) AS a, list_distinct(list_filter(string_split(before, ''), lambda c: c <> '')) AS b FROM p WHERE before IS NOT NULL)
    SELECT doc_id, len(list_intersect(a, b)) AS common, len(a) + len(b) - len(list_intersect(a, b)) AS whole FROM s""")
def char_jaccard(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    docs = table(spark, d, "documents").select("doc_id", "source", X.characters(F.col("text")).alias("a"))
    before = F.lag("a").over(Window.partitionBy("source").orderBy("doc_id"))
    pairs = docs.withColumn("b", before).where("b is not null")
    return pairs.select("doc_id", F.size(F.array_intersect("a", "b")).cast("long").alias("common"), F.size(F.array_union("a", "b")).cast("long").alias("whole"))


# -- scripts and captions


@query(f"""
    SELECT doc_id, CAST(round(length(trim(text, {BLANK_SQL})) * 20 / 9.0) AS BIGINT) AS tenths,
        CAST(floor(round(length(trim(text, {BLANK_SQL})) * 20 / 9.0) * 9 / 20) AS INT) AS chars FROM documents""")
def speech_seconds(spark: SparkSession, d: str) -> DataFrame:
    tenths = F.round(X.seconds_to_say(F.col("text")) * 10).cast("long")
    return table(spark, d, "documents").select("doc_id", tenths.alias("tenths"), X.chars_for(tenths / 10).alias("chars"))


CAPTIONS = rf"""
    p AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM (
        SELECT doc_id, list_filter(string_split(regexp_replace(trim(text, {BLANK_SQL}), '([,.!?;])', '\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS parts FROM documents)),
    l AS (SELECT doc_id, i, k, substring(part, (k * 24 + 1)::INT, 24) AS line FROM (SELECT *, unnest(range(0, (length(part) + 23) // 24)) AS k FROM p)),
    n AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY i, k) - 1 AS line_no FROM l WHERE trim(line, {BLANK_SQL}) <> '')"""


def _captions(spark: SparkSession, d: str) -> DataFrame:
    return captions.lines(table(spark, d, "documents"), ["doc_id"], "text", 24, ",.!?;").withColumn("line_no", F.col("line_no").cast("long"))


@query(f"WITH {CAPTIONS} SELECT doc_id, line_no, line FROM n")
def caption_lines(spark: SparkSession, d: str) -> DataFrame:
    return _captions(spark, d)


TIMES = """
    t AS (SELECT *, sum(length(line)) OVER (PARTITION BY doc_id ORDER BY line_no)::BIGINT AS upto, sum(length(line)) OVER (PARTITION BY doc_id)::BIGINT AS whole FROM n),
    x AS (SELECT doc_id, line_no, line, 600000 * (upto - length(line)) // whole AS start_ms, 600000 * upto // whole AS end_ms FROM t)"""


@query(f"WITH {CAPTIONS}, {TIMES} SELECT doc_id, line_no, start_ms, end_ms FROM x")
def caption_times(spark: SparkSession, d: str) -> DataFrame:
    rows = _captions(spark, d).withColumn("total", F.lit(600_000).cast("long"))
    return captions.timed(rows, ["doc_id"], "total").select("doc_id", "line_no", "start_ms", "end_ms")


@query(f"""
    WITH {CAPTIONS}, {TIMES}
    SELECT doc_id, line_no, printf('Dialogue: 0,%d:%02d:%02d.%02d,%d:%02d:%02d.%02d,sub,,0,0,0,,',
        start_ms // 3600000, start_ms // 60000 % 60, start_ms // 1000 % 60, start_ms // 10 % 100,
        end_ms // 3600000, end_ms // 60000 % 60, end_ms // 1000 % 60, end_ms // 10 % 100) || replace(replace(line, '{{', '｛'), '}}', '｝') AS event FROM x""")
def caption_events(spark: SparkSession, d: str) -> DataFrame:
    rows = _captions(spark, d).withColumn("total", F.lit(600_000).cast("long"))
    return captions.events(captions.timed(rows, ["doc_id"], "total")).select("doc_id", "line_no", "event")


@query(r"""
    SELECT doc_id, array_to_string(list_concat(CASE WHEN contains(text, 'idiot') THEN ['forbidden: idiot'] ELSE [] END,
        CASE WHEN len(list_filter(regexp_extract_all(text, '([0-9]+)\s*[a-m]', 1), lambda x: x NOT IN ('19', '11', '2'))) > 0 THEN ['price'] ELSE [] END), ',') AS faults
    FROM documents""")
def price_check(spark: SparkSession, d: str) -> DataFrame:
    faults = X.violations(F.col("text"), F.lit("19 for 11, or 2"), F.lit(""), F.array(F.lit("idiot")), units="abcdefghijklm", colours="红")
    return table(spark, d, "documents").select("doc_id", F.array_join(faults, ",").alias("faults"))


@query("""
    WITH l AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) - 1 AS line_no FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)),
    m AS (SELECT doc_id, line_no, CASE WHEN length(line) >= 80 THEN left(line, 12) END AS label FROM l)
    SELECT doc_id, line_no::BIGINT AS line_no, last_value(label IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no) AS label FROM m""")
def carry_label(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    marked = lines.select("doc_id", F.col("line_no").cast("long").alias("line_no"), F.when(F.length("line") >= 80, F.left("line", F.lit(12))).alias("label"))
    return library.carried(marked, ["doc_id"], "line_no", "label")


# -- libraries and ledgers


@query("""
    SELECT p_partkey, CASE WHEN contains(p_name, 'ring') THEN 'jewel' WHEN contains(p_name, 'widget') THEN 'part' WHEN contains(p_name, 'bolt') THEN 'part'
        WHEN contains(p_name, 'gear') THEN 'machine' WHEN contains(p_name, 'hot') THEN 'warm' WHEN contains(p_name, 'blue') THEN 'colour' ELSE 'review' END AS category FROM part""")
def keyword_category(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", X.first_category(F.col("p_name"), KEYWORDS, "review").alias("category"))


@query("""
    SELECT p_partkey, coalesce(position, 'middle') AS position
    FROM part LEFT JOIN (VALUES ('PROMO', 'start'), ('LARGE', 'middle'), ('ECONOMY', 'end')) v(p_type, position) USING (p_type)""")
def category_position(spark: SparkSession, d: str) -> DataFrame:
    dim = spark.createDataFrame(list(POSITIONS.items()), "p_type string, position string")
    return table(spark, d, "part").join(F.broadcast(dim), "p_type", "left").select("p_partkey", F.coalesce("position", F.lit("middle")).alias("position"))


@query("""
    WITH l AS (SELECT p_brand, '- ' || replace(p_name, ' ', '_') || CASE WHEN p_size % 7 = 0 THEN '.txt' ELSE '.mp4' END AS a, p_size AS size, p_type FROM part),
    i AS (SELECT p_brand, substring(a, 3) AS name, size::DOUBLE AS duration, p_type AS position FROM l WHERE ends_with(a, '.mp4')),
    f AS (SELECT p_brand, replace(p_name, ' ', '_') || '.mp4' AS name, max(p_partkey) AS file_id FROM part GROUP BY 1, 2)
    SELECT p_brand, name, duration, position, file_id FROM i JOIN f USING (p_brand, name)""")
def index_join(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    stem = F.replace("p_name", F.lit(" "), F.lit("_"))
    name = F.concat(stem, F.when(F.col("p_size") % 7 == 0, ".txt").otherwise(".mp4"))
    lines = part.select("p_brand", library.index_line(name, F.col("p_size").cast("double"), F.col("p_type"), F.lit("")).alias("line"))
    files = part.select("p_brand", F.concat(stem, F.lit(".mp4")).alias("name"), F.col("p_partkey").alias("file_id"), F.col("p_partkey").alias("ord"))
    return library.with_files(library.index_rows(lines), files, ["p_brand", "name"], "ord").select("p_brand", "name", "duration", "position", "file_id")


@query("""
    WITH l AS (SELECT lang, source, unnest(string_split(text, chr(10))) AS line FROM documents)
    SELECT DISTINCT lang, line FROM l a WHERE source >= 'src15' AND NOT EXISTS (SELECT 1 FROM l b WHERE b.source < 'src15' AND b.lang = a.lang AND b.line = a.line)""")
def index_append(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "documents").select("lang", "source", F.explode(F.split("text", "\n", -1)).alias("line"))
    return library.new_lines(lines.where("source >= 'src15'"), lines.where("source < 'src15'"), ["lang", "line"])


@query("SELECT o_orderkey, o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderpriority AS priority FROM orders")
def ledger_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    lines = table(spark, d, "orders").select(library.ledger_line(F.col("o_orderkey"), F.col("o_orderkey"), F.col("o_orderstatus"), cents, F.col("o_orderpriority")).alias("line"))
    rows = library.ledger_rows(lines, ["key", "status", "cents", "priority"])
    return rows.select(F.col("key").try_cast("long").alias("o_orderkey"), "status", F.col("cents").try_cast("long").alias("cents"), "priority")


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity <= 5 THEN 'no duration' WHEN l_returnflag <> 'N' OR l_linestatus <> 'O' THEN 'wrong size' WHEN abs(l_quantity - 5 - l_linenumber * 5) > 1 THEN 'wrong duration' END AS fault FROM lineitem")
def qc_reasons(spark: SparkSession, d: str) -> DataFrame:
    fault = X.clip_fault(F.col("l_quantity") - 5, F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_linenumber") * 5, F.lit("N"), F.lit("O"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", fault.alias("fault"))


@query("""
    SELECT o_orderkey, substring(md5(o_orderkey::VARCHAR), 1, 8) || '_' || lpad(i::VARCHAR, greatest(3, length(i::VARCHAR))::INT, '0') || '_' || o_orderpriority || '.mp4' AS name
    FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders) WHERE o_orderstatus <> 'F'""")
def export_names(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").withColumn("md5", F.md5(F.col("o_orderkey").cast("string")))
    fault = F.when(F.col("o_orderstatus") == "F", "faulty")
    return media.exports(rows, "o_custkey", ["o_orderkey"], "md5", "o_orderpriority", fault).select("o_orderkey", "name")


# -- choosing


@query("""
    WITH u AS (SELECT p_brand, p_partkey, coalesce(n, 0) AS used FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey)
    SELECT p_brand, used, p_partkey FROM u QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY used, p_partkey) = 1""")
def usage_balance(spark: SparkSession, d: str) -> DataFrame:
    return planner.least_used(_clips(spark, d), ["p_brand"], "used", "p_partkey")


def _clips(spark: SparkSession, d: str) -> DataFrame:
    used = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    return table(spark, d, "part").join(used, "p_partkey", "left").withColumn("used", F.coalesce("n", F.lit(0).cast("long"))).drop("n")


@query("""
    WITH u AS (SELECT p_brand, p_partkey, p_size, coalesce(n, 0) AS used FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey),
    t AS (SELECT *, unnest([5, 15, 25, 35, 45]) AS target FROM u)
    SELECT p_brand, target, p_partkey, row_number() OVER w AS rank FROM t WINDOW w AS (PARTITION BY p_brand, target ORDER BY abs(p_size - target), used, p_partkey) QUALIFY rank <= 3""")
def closest_topk(spark: SparkSession, d: str) -> DataFrame:
    aims = _clips(spark, d).withColumn("target", F.explode(F.array(*map(F.lit, (5, 15, 25, 35, 45)))))
    return planner.closest(aims, ["p_brand", "target"], "p_size", "target", "used", "p_partkey").select("p_brand", "target", "p_partkey", F.col("rank").cast("long").alias("rank"))


@query("""
    WITH RECURSIVE g AS (SELECT l_orderkey, list(l_quantity ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS d FROM lineitem GROUP BY l_orderkey),
    o AS (SELECT l_orderkey, d, list_reduce(d, lambda a, x: a + x, 0.0::DOUBLE) * 0.97 AS target, list_transform(d, lambda x: 1.0::DOUBLE) AS speeds,
        list_transform(list_sort(list_transform(range(2, len(d) + 1), lambda i: {'by': -d[i], 'pos': i})), lambda r: r.pos) AS ranks FROM g),
    w AS (
        SELECT l_orderkey, d, target, ranks, speeds, 0.0::DOUBLE AS off, 0 AS k FROM o
        UNION ALL
        SELECT l_orderkey, d, target, ranks, CASE WHEN moves THEN list_transform(speeds, lambda s, i: CASE WHEN i = pos THEN round(d[pos] / (now - sign(o2) * move), 3) ELSE s END) ELSE speeds END,
            CASE WHEN moves THEN o2 - sign(o2) * move ELSE o2 END, k + 1
        FROM (SELECT *, abs(o2) >= 0.05 AND move > 0.01 AS moves
            FROM (SELECT *, least(abs(o2), CASE WHEN o2 > 0 THEN now - d[pos] / 1.1::DOUBLE ELSE d[pos] / 0.9::DOUBLE - now END) AS move
                FROM (SELECT *, d[pos] / speeds[pos] AS now, CASE WHEN k % len(ranks) = 0 THEN list_reduce(list_transform(d, lambda x, i: x / speeds[i]), lambda a, x: a + x, 0.0::DOUBLE) - target ELSE off END AS o2
                    FROM (SELECT *, ranks[k % len(ranks) + 1] AS pos FROM w WHERE len(ranks) > 0 AND k < 3 * len(ranks))))))
    SELECT l_orderkey, (i - 1)::INT AS place, round(d[i] / speeds[i], 2) AS out_duration, speeds[i] AS speeds
    FROM (SELECT l_orderkey, d, speeds, unnest(range(1, len(d) + 1)) AS i FROM w WHERE k = 3 * len(ranks))""")
def align_durations(spark: SparkSession, d: str) -> DataFrame:
    rows = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    plans = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(rows)), lambda r: r["l_quantity"]).alias("durations"))
    plans = plans.withColumn("target", F.aggregate("durations", F.lit(0.0), lambda a, x: a + x) * 0.97)
    return planner.aligned(plans, "durations", "target").select("l_orderkey", F.posexplode(F.arrays_zip("out_durations", "speeds")).alias("place", "x")).select("l_orderkey", "place", F.col("x.out_durations").alias("out_duration"), "x.speeds")


@query()
def seeded_plan(spark: SparkSession, d: str) -> DataFrame:
    clips = _clips(spark, d).select(F.col("p_brand").alias("category"), F.col("p_partkey").alias("clip_id"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("stem"), F.col("p_type").alias("kind"), F.col("p_size").cast("double").alias("duration"), F.col("used").alias("usage"))
    clips = clips.withColumn("source", F.concat_ws("_", "stem", "kind")).drop("stem", "kind")
    return planner.seeded_plans(clips, list(range(20)), "Brand#1", 120.0)


from clipweave.plans import records  # noqa: E402, F401  registers its queries
