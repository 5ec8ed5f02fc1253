"""Queries over prompts, texts, records and URLs, with their oracles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.functions import scalars as S
from cardlens.operators import text as T
from cardlens.plans.base import query, r
from cardlens.sources.adapters import table

_NORM = "regexp_replace(lower(trim(coalesce({x}, ''))), '[\\s,，。.!！?？:：;；·\\-_/\\\\|]+', '', 'g')"


def norm(x: str) -> str:
    return _NORM.replace("{x}", x)


@query("""SELECT coalesce(nullif('c' || conv_id, ''), 'q' || turn) AS qid, text AS query FROM conversations WHERE turn = 0 AND role = 'user' AND trim(coalesce(text, '')) <> ''""")
def load_queries_coalesce(spark, sf) -> DataFrame:
    """First user turns as prompts, blank ones left out."""
    rows = table(spark, sf, "conversations").filter("turn = 0 AND role = 'user' AND trim(coalesce(text, '')) != ''")
    qid = F.coalesce(F.nullif(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")), F.concat(F.lit("q"), F.col("turn").cast("string")))
    return rows.select(qid.alias("qid"), F.col("text").alias("query"))


@query("SELECT lang, arg_max(text, doc_id) AS text, max(doc_id) AS doc_id FROM documents GROUP BY lang")
def query_map_last_wins(spark, sf) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.groupBy("lang").agg(F.max_by("text", "doc_id").alias("text"), F.max("doc_id").alias("doc_id"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_pointer_get(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select("event_id", S.pointer_get(F.col("props"), "/k").alias("k"))


@query(f"SELECT doc_id, {norm('text')} AS norm FROM documents")
def normalize_text(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", S.normalize_text(F.col("text")).alias("norm"))


@query("""SELECT doc_id, len(regexp_extract_all(text, '[-+]?[0-9]+(?:\\.[0-9]+)?')) AS numbers, len(regexp_extract_all(text, '(?i)(℃|°c|％|%|元|¥|￥|分钟|小时|分|h|hr|hour|min|mins|摄氏度|度)')) AS units,
coalesce(regexp_extract_all(text, '[-+]?[0-9]+(?:\\.[0-9]+)?')[1], '') AS first FROM documents""")
def text_slots(spark, sf) -> DataFrame:
    found = F.regexp_extract_all(F.col("text"), F.lit(f"({T.NUMBER})"), F.lit(1))
    slots = T.text_slots(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.size(slots["numbers"]).cast("long").alias("numbers"), F.size(slots["units"]).cast("long").alias("units"), F.coalesce(F.get(found, F.lit(0)), F.lit("")).alias("first")
    )


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN contains(s, '.') THEN regexp_replace(regexp_replace(s, '0+$', ''), '\\.$', '') ELSE s END AS number
FROM (SELECT *, printf('%.2f', l_extendedprice) AS s FROM lineitem)""")
def normalize_number(spark, sf) -> DataFrame:
    rows = table(spark, sf, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", T.normalize_number(F.format_string("%.2f", "l_extendedprice")).alias("number"))


@query()
def slot_matches(spark, sf) -> DataFrame:
    """Whether each turn, its numbers and units, shows up in the even turns of its conversation."""
    turns = table(spark, sf, "conversations").select(F.col("conv_id").alias("key"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("turn").alias("ord"), "text")
    return T.slot_coverage(turns, turns.filter("ord % 2 = 0"))


@query()
def similarity_best_match(spark, sf) -> DataFrame:
    """For each user turn the likest reply in its conversation, by their whole texts."""
    turns = table(spark, sf, "conversations").select(F.col("conv_id").alias("key"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("turn").alias("ord"), "role", "text")
    return T.best_match(turns.filter("role = 'user'"), turns.filter("role = 'assistant'"), 0.5)


@query(f"""WITH l AS (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents), n AS (SELECT doc_id, lang, {norm("line")} AS n FROM l)
SELECT n AS line, lang, count(DISTINCT doc_id) AS docs, count(*) AS times, min(doc_id) AS first FROM n WHERE length(n) >= 4 GROUP BY 1, 2 HAVING count(*) > 1""")
def repeated_lines(spark, sf) -> DataFrame:
    """Lines that come more than once in the documents of a language: one row a group."""
    lines = table(spark, sf, "documents").select("doc_id", "lang", F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.select("doc_id", "lang", S.normalize_text(F.col("line")).alias("line")).filter(F.length("line") >= 4)
    each = lines.groupBy("line", "lang", "doc_id").agg(F.count("*").alias("n"))
    return each.groupBy("line", "lang").agg(F.count("*").alias("docs"), F.sum("n").alias("times"), F.min("doc_id").alias("first")).filter("times > 1")


@query("""WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents), t AS (SELECT doc_id, trim(regexp_replace(w, '\\s+', ' ', 'g')) AS w FROM w)
SELECT doc_id, count(*) AS kept FROM t WHERE w <> '' AND NOT (length(w) <= 2 AND NOT regexp_matches(w, '[A-Za-z0-9㐀-鿿]')) GROUP BY 1""")
def decorative_filter(spark, sf) -> DataFrame:
    """Words of each document that aren't mere decoration."""
    words = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("w"))
    return words.filter(T.display_texts(F.col("w")).isNotNull()).groupBy("doc_id").agg(F.count("*").alias("kept"))


def _width(x: str, s: float, w: float, a: float, o: float) -> str:
    sp, wd, al = (f"(length({x}) - length(regexp_replace({x}, '{p}', '', 'g')))" for p in ("[ \\t\\n\\r\\x0b\\f]", "[⺀-\U0010ffff]", "[A-Za-z0-9]"))
    return f"(14.0e0 * ({sp} * {s}e0 + {wd} * {w}e0 + {al} * {a}e0 + (length({x}) - {sp} - {wd} - {al}) * {o}e0))"


@query(f"SELECT doc_id, {r(_width('text', 0.35, 1.0, 0.6, 0.45), 2)} AS width, {r(_width('text', 0.2, 0.75, 0.42, 0.28), 2)} AS least FROM documents")
def text_width_estimates(spark, sf) -> DataFrame:
    text, size = F.col("text"), F.lit(14.0)
    wide, least = S.text_width(text, size, 0.35, 1.0, 0.6, 0.45), S.text_width(text, size, 0.2, 0.75, 0.42, 0.28)
    return table(spark, sf, "documents").select("doc_id", S.rounded(wide, 2).alias("width"), S.rounded(least, 2).alias("least"))


@query("SELECT doc_id, regexp_matches(text, '[㐀-鿿豈-﫿]') AS cjk, NOT regexp_matches(text, '[A-Za-z]') AS no_latin, contains(text, '{{') AND contains(text, '}}') AS dynamic FROM documents")
def cjk_classify(spark, sf) -> DataFrame:
    text = F.col("text")
    return table(spark, sf, "documents").select("doc_id", S.has_cjk(text).alias("cjk"), (~text.rlike("[A-Za-z]")).alias("no_latin"), (text.contains("{{") & text.contains("}}")).alias("dynamic"))


@query("SELECT doc_id, source, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def missing_labels_anti(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left_anti").select("doc_id", "source", "lang")


_BEFORE, _AFTER = T.CUT_MARK.split("{name}")


@query(f"""SELECT d.doc_id, CASE WHEN length(text) > 32000 THEN left(text, 32000) || chr(10) || '{_BEFORE[1:]}' || 'doc-' || d.doc_id || '{_AFTER}' ELSE text END AS text,
coalesce(CAST(quality AS VARCHAR), '(缺失)') AS quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def export_cells(spark, sf) -> DataFrame:
    """Documents with their labels as cells of an export."""
    out = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    text = T.cell_text(F.col("text"), F.concat(F.lit("doc-"), F.col("doc_id").cast("string")))
    return out.select("doc_id", text.alias("text"), F.coalesce(F.col("quality").cast("string"), F.lit("(缺失)")).alias("quality"))


@query("""SELECT p.page_id, p.url, coalesce(b.text, '') AS query, coalesce(d.source, '') AS source FROM pages p LEFT JOIN benchmark b ON b.item_id = p.page_id LEFT JOIN documents d ON d.doc_id = p.page_id""")
def pairing_with_default(spark, sf) -> DataFrame:
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("page_id"), F.col("text").alias("q"))
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), F.col("source").alias("s"))
    out = table(spark, sf, "pages").join(b, "page_id", "left").join(d, "page_id", "left")
    return out.select("page_id", "url", F.coalesce("q", F.lit("")).alias("query"), F.coalesce("s", F.lit("")).alias("source"))


@query("SELECT r_name AS device, item_id FROM region, benchmark")
def device_cross_plan(spark, sf) -> DataFrame:
    """Every device runs every prompt: the device list is a fixed handful."""
    return table(spark, sf, "benchmark").select("item_id").crossJoin(F.broadcast(table(spark, sf, "region").select(F.col("r_name").alias("device"))))


@query("""SELECT p_partkey, coalesce(nullif(regexp_extract(CASE WHEN p_size % 3 = 0 THEN '' ELSE 'batch__' END || CASE WHEN p_size % 5 = 0 THEN 'Other-' ELSE 'Case-' END || p_size || '-' || lower(p_type) || '-' || p_partkey,
'Case-[0-9]+-(.+?)-[0-9]+$', 1), ''), 'unknown') AS scene FROM part""")
def case_scenes(spark, sf) -> DataFrame:
    """Scenes of case names, some behind a prefix, some of another kind."""
    head = F.concat(F.when(F.col("p_size") % 3 == 0, "").otherwise("batch__"), F.when(F.col("p_size") % 5 == 0, "Other-").otherwise("Case-"))
    qid = F.concat(head, F.col("p_size").cast("string"), F.lit("-"), F.lower("p_type"), F.lit("-"), F.col("p_partkey").cast("string"))
    return table(spark, sf, "part").select("p_partkey", T.scene_of(qid).alias("scene"))


@query("SELECT page_id, CASE WHEN s = '' THEN 'item' ELSE s END AS name FROM (SELECT page_id, regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS s FROM pages)")
def safe_path_name(spark, sf) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", S.safe_name(F.col("url")).alias("name"))


@query("""SELECT doc_id, md5(coalesce(nullif(regexp_extract(f, '(?i)```genui[^\\n]*\\n([\\s\\S]*?)```', 1), ''), f)) AS body FROM
(SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'before' || chr(10) || '```GenUI json' || chr(10) || text || chr(10) || '```' || chr(10) || 'after' ELSE text END AS f FROM documents)""")
def code_fence_strip(spark, sf) -> DataFrame:
    fenced = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("before\n```GenUI json\n"), F.col("text"), F.lit("\n```\nafter"))).otherwise(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.md5(T.strip_fence(fenced, "genui")).alias("body"))


@query("""SELECT user_id, count(*) AS segments FROM events GROUP BY 1""")
def json_segments(spark, sf) -> DataFrame:
    """Records of a user's stream, written behind one another, are cut apart again."""
    record = F.concat(F.lit('{"version":"v0.9","'), F.col("event_type"), F.lit('":'), F.col("props"), F.lit("}"))
    streams = _streams(table(spark, sf, "events"), record, " ")
    segments = streams.select("user_id", F.size(T.record_segments(F.col("s"))).cast("long").alias("segments"))
    return segments.groupBy("user_id").agg(F.sum("segments").alias("segments"))


def _streams(events: DataFrame, record: Column, separator: str) -> DataFrame:
    """(user_id, s): a user's records behind one another, in streams of at most 1000 event numbers,
    so that one user's events are dealt over many tasks."""
    part = F.floor(F.col("event_id") / 1000)
    return events.groupBy("user_id", part.alias("part")).agg(F.array_join(F.collect_list(record), separator).alias("s"))


@query("""SELECT user_id AS id, count(DISTINCT event_type || replace(props, ' ', '')) AS records FROM events GROUP BY 1""")
def repaired_records(spark, sf) -> DataFrame:
    """Streams whose last record lost its closing brackets: repaired, parsed, each record once."""
    record = F.concat(F.lit('{"version":"v0.9","'), F.col("event_type"), F.lit('":'), F.col("props"), F.lit("}"))
    streams = _streams(table(spark, sf, "events"), record, "\n")
    cut = streams.select(F.col("user_id").alias("id"), F.expr("substring(s, 1, length(s) - 1)").alias("text"))
    return T.repair_records(cut).select("id", "record").distinct().groupBy("id").agg(F.count("*").alias("records"))


@query("""SELECT min(event_id) AS event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id % 7 AS name FROM events GROUP BY event_type, json_extract(props, '$.k'), event_id % 7""")
def distinct_records(spark, sf) -> DataFrame:
    """Records by content: half of them have their keys in another order, a third other white space."""
    name, k = (F.col("event_id") % 7).cast("string"), F.get_json_object("props", "$.k")
    props, kind = F.concat(F.lit('"p": {"name": "a '), name, F.lit('", "k":'), k, F.lit("}")), F.concat(F.lit('"t":"'), F.col("event_type"), F.lit('"'))
    turned = F.concat(F.lit('{"k": '), k, F.lit(' , "name":"a '), name, F.lit('"}'))
    record = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("{"), props, F.lit(","), kind, F.lit("}"))).otherwise(F.concat(F.lit("{ "), kind, F.lit(', "p":'), turned, F.lit("}")))
    record = F.when(F.col("event_id") % 3 == 0, F.replace(record, F.lit(","), F.lit(",\n  "))).otherwise(record)
    rows = table(spark, sf, "events").select("event_id", "event_type", k.cast("long").alias("k"), (F.col("event_id") % 7).alias("name"), record.alias("record"))
    return T.distinct_records(rows, "record", "event_id").drop("record")


@query("""SELECT page_id, regexp_extract(url, '(https?://[^\\s"''<>]*)', 1) AS url FROM pages WHERE regexp_matches(url, '^https://[^/?#]*\\.(com|org)(/|$|[?#])') AND regexp_matches(url, '^[^?#]*\\.html$')""")
def url_filter_extract(spark, sf) -> DataFrame:
    """Secure URLs of two top domains that name a page, taken out of log lines."""
    line = F.concat(F.lit("06-01 12:00:00.000  1  2 I tag: result: "), F.col("url"), F.lit('",'))
    url = T.extract_url(line)
    rows = table(spark, sf, "pages").select("page_id", url.alias("url"))
    return rows.filter(F.col("url").rlike(r"^https://[^/?#]*\.(com|org)(/|$|[?#])") & F.col("url").rlike(r"^[^?#]*\.html$"))


@query("""SELECT conv_id, turn, string_agg(text, ' ') OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS joined FROM conversations""")
def log_window_join(spark, sf) -> DataFrame:
    """A line and the two before it as one, for what is split over lines."""
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(-2, 0)
    return table(spark, sf, "conversations").select("conv_id", "turn", F.array_join(F.collect_list("text").over(w), " ").alias("joined"))
