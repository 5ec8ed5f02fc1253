"""Fact tables (boxes, trees, metric results, deductions, colours, series) over the star schema.

The engine's operators take tidy fact tables keyed by document. These adapters derive such
tables from the given ones with whole-number arithmetic, so that results can be compared
exactly; each has its SQL twin for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Dimension, weight, and the event type that stands for it.
DIMENSIONS = [("geometry", 15.0, "signup"), ("information", 15.0, "view"), ("layout", 20.0, "click"), ("visual", 45.0, "purchase"), ("consistency", 5.0, "error")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ord, x, y, w, h, kind, fs, radius, contrast: rectangles of a card in order."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    kind = F.when(F.col("l_returnflag") == "R", "button").when(F.col("l_returnflag") == "A", "text").otherwise("image")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"),
        F.row_number().over(order).cast("long").alias("ord"),
        F.col("l_quantity").cast("double").alias("x"),
        (F.col("l_partkey") % 160).cast("double").alias("y"),
        (4 + F.col("l_suppkey") % 40).cast("double").alias("w"),
        (4 + 3 * F.col("l_linenumber")).cast("double").alias("h"),
        kind.alias("kind"),
        (8 + 2 * F.col("l_linenumber")).cast("double").alias("fs"),
        (F.col("l_suppkey") % 24).cast("double").alias("radius"),
        (1 + (F.col("l_partkey") % 21) * F.lit(0.5)).cast("double").alias("contrast"),
    )


BOXES = """(SELECT l_orderkey AS doc_id,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ord,
  CAST(l_quantity AS DOUBLE) AS x, CAST(l_partkey % 160 AS DOUBLE) AS y, CAST(4 + l_suppkey % 40 AS DOUBLE) AS w,
  CAST(4 + 3 * l_linenumber AS DOUBLE) AS h,
  CASE l_returnflag WHEN 'R' THEN 'button' WHEN 'A' THEN 'text' ELSE 'image' END AS kind,
  CAST(8 + 2 * l_linenumber AS DOUBLE) AS fs, CAST(l_suppkey % 24 AS DOUBLE) AS radius,
  CAST(1 + (l_partkey % 21) * 0.5e0 AS DOUBLE) AS contrast FROM lineitem)"""


def tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node, parent, pos, kind, hidden, action, size: region > nation > group of 20 > customer."""
    region, nation, customer = (table(spark, sf_dir, t) for t in ("region", "nation", "customer"))
    none = F.lit(None).cast("string")
    top = region.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("node"), none.alias("parent"), F.col("r_regionkey").cast("long").alias("pos"),
        F.lit("Column").alias("kind"), F.lit(False).alias("hidden"), (F.col("r_regionkey") == 1).alias("action"), F.lit(0).cast("long").alias("size"))
    mid = nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")), F.col("n_nationkey").cast("long"),
        F.lit("Row"), F.col("n_nationkey") % 7 == 0, F.col("n_nationkey") % 5 == 2, F.lit(0).cast("long"))
    g = F.floor(F.col("c_custkey") / 20).cast("long")
    group = customer.select(g.alias("g")).distinct()
    g_id = F.concat(F.lit("g"), F.col("g").cast("string"))
    group = group.select(g_id, F.concat(F.lit("n"), (F.col("g") % 25).cast("string")), F.col("g"), F.lit("Row"), F.col("g") % 9 == 4, F.lit(False), F.lit(0).cast("long"))
    leaf = customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")), F.concat(F.lit("g"), g.cast("string")), F.col("c_custkey"),
        F.when(F.col("c_custkey") % 2 == 0, "Text").otherwise("Image"), F.col("c_custkey") % 11 == 0, F.col("c_custkey") % 13 == 0,
        F.floor(F.abs(F.col("c_acctbal")) / 100).cast("long"))
    return top.union(mid).union(group).union(leaf)


TREE = """(SELECT 'r' || r_regionkey AS node, CAST(NULL AS VARCHAR) AS parent, CAST(r_regionkey AS BIGINT) AS pos, 'Column' AS kind, false AS hidden, r_regionkey = 1 AS action, 0::BIGINT AS size FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, CAST(n_nationkey AS BIGINT), 'Row', n_nationkey % 7 = 0, n_nationkey % 5 = 2, 0 FROM nation
  UNION ALL SELECT DISTINCT 'g' || (c_custkey // 20), 'n' || (c_custkey // 20 % 25), c_custkey // 20, 'Row', c_custkey // 20 % 9 = 4, false, 0::BIGINT FROM customer
  UNION ALL SELECT 'c' || c_custkey, 'g' || (c_custkey // 20), c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Text' ELSE 'Image' END, c_custkey % 11 = 0, c_custkey % 13 = 0,
    CAST(floor(abs(c_acctbal) / 100) AS BIGINT) FROM customer)"""


def metric_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, dimension, ord, score (null: skipped), weight, confidence, status."""
    dimension = F.lit(None).cast("string")
    for name, _, event in DIMENSIONS:
        dimension = F.when(F.col("event_type") == event, name).otherwise(dimension)
    score = F.least(F.lit(100.0), F.floor(F.col("value")).cast("double"))
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("doc_id"),
        dimension.alias("dimension"),
        F.col("event_id").alias("ord"),
        F.when(F.col("event_id") % 17 != 0, score).alias("score"),
        (F.col("event_id") % 5).cast("double").alias("weight"),
        (F.lit(1.0) - (F.col("event_id") % 4) * F.lit(0.25)).alias("confidence"),
        F.when(F.col("event_id") % 17 == 0, "skipped").when(F.col("event_id") % 29 == 0, "error").otherwise("ok").alias("status"),
    )


METRICS = """(SELECT user_id AS doc_id, CASE event_type WHEN 'signup' THEN 'geometry' WHEN 'view' THEN 'information' WHEN 'click' THEN 'layout' WHEN 'purchase' THEN 'visual' WHEN 'error' THEN 'consistency' END AS dimension,
  event_id AS ord, CASE WHEN event_id % 17 <> 0 THEN least(100.0e0, CAST(floor(value) AS DOUBLE)) END AS score, CAST(event_id % 5 AS DOUBLE) AS weight,
  1.0e0 - (event_id % 4) * 0.25e0 AS confidence, CASE WHEN event_id % 17 = 0 THEN 'skipped' WHEN event_id % 29 = 0 THEN 'error' ELSE 'ok' END AS status FROM events)"""

#: Deduction codes with their cap and its slope (null: no cap).
CODES = [
    ("geometry.overlap", 65.0, 20.0), ("information.number_mismatch", 70.0, 8.0), ("information.text_missing", 74.0, 24.0), ("visual.low_contrast", 74.0, 8.0),
    ("layout.overlap", 70.0, 8.0), ("layout.overflow", 70.0, 8.0), ("geometry.grid_weak", None, None), ("visual.focus_unclear", None, None),
]


def deduction_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ord, code, severity, delta, evidence, magnitude (may be null), hint."""
    codes = F.array(*[F.lit(c) for c, _, _ in CODES])
    v = F.floor(F.col("value")).cast("long")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("doc_id"),
        F.col("event_id").alias("ord"),
        F.get(codes, (F.col("event_id") % len(CODES)).cast("int")).alias("code"),
        F.when(v % 3 == 0, "high").when(v % 3 == 1, "medium").otherwise("low").alias("severity"),
        (-(v % 40) / F.lit(4.0)).alias("delta"),
        F.concat(F.lit("k="), (F.col("event_id") % 6).cast("string")).alias("evidence"),
        F.when(v % 5 != 0, (v % 8) / F.lit(8.0)).alias("magnitude"),
        F.when(v % 7 != 0, F.concat(F.lit("hint "), (v % 9).cast("string"))).otherwise("").alias("hint"),
    )


_V = "CAST(floor(value) AS BIGINT)"
DEDUCTIONS = f"""(SELECT user_id AS doc_id, event_id AS ord, [{', '.join(repr(c) for c, _, _ in CODES)}][1 + CAST(event_id % {len(CODES)} AS INT)] AS code,
  CASE {_V} % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS severity, -({_V} % 40) / 4.0e0 AS delta, 'k=' || (event_id % 6) AS evidence,
  CASE WHEN {_V} % 5 <> 0 THEN ({_V} % 8) / 8.0e0 END AS magnitude, CASE WHEN {_V} % 7 <> 0 THEN 'hint ' || ({_V} % 9) ELSE '' END AS hint FROM events)"""


def colors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ord, color: palettes of eight colours, #RRGGBB or #AARRGGBB."""
    name = F.md5(F.col("p_name"))
    n = F.when(F.col("p_partkey") % 3 == 0, 8).otherwise(6)
    return table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 8).cast("long").alias("doc_id"), F.col("p_partkey").alias("ord"), F.concat(F.lit("#"), F.substring(name, F.lit(1), n)).alias("color"))


COLORS = "(SELECT p_partkey // 8 AS doc_id, p_partkey AS ord, '#' || substr(md5(p_name), 1, CASE WHEN p_partkey % 3 = 0 THEN 8 ELSE 6 END) AS color FROM part)"


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ord, ts, v: readings of a stream in the order of time."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("doc_id"), F.row_number().over(order).cast("long").alias("ord"), "ts", F.floor(F.col("value")).cast("long").alias("v"), "event_id", "event_type"
    )


SERIES = f"(SELECT user_id AS doc_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ord, ts, {_V} AS v, event_id, event_type FROM events)"


def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of devices (users): (device, ts, seq, kind, qid, text, print, complete) of their events.

    A quarter of the events send a query. The others log the URL of a document, in one line or split
    over two, some cut for good, and then what was found there.
    """
    n = F.col("event_id")
    number = F.pmod(n * 7, F.lit(90)).cast("string")
    signature = F.sha2(number, 256)
    url = F.concat(F.lit("https://store.example/d"), number, F.lit(".md?X-Amz-Date=1&X-Amz-Signature="), signature)
    head = F.lit("01-02 03:04:05.678  11  22 I tag: ")

    def row(kind: str, text: Column | None = None, found: bool = False) -> Column:
        none = F.lit(None).cast("string")
        return F.struct(
            F.lit(kind).alias("kind"), F.concat(F.lit("q"), n.cast("string")).alias("qid") if kind == "sent" else none.alias("qid"), (none if text is None else text).alias("text"),
            (F.when(n % 11 != 0, F.sha2((n % 61).cast("string"), 256)) if found else none).alias("print"), (n % 5 != 0 if found else F.lit(False)).alias("complete"),
        )

    whole = F.array(row("line", F.concat(head, F.lit('"result":"'), url, F.lit('"'))), row("body", url, True))
    split = F.array(row("line", F.concat(head, F.lit("result: "), F.substring(url, 1, 60))), row("line", F.concat(head, F.substring(url, 61, 999), F.lit(" end"))), row("body", url, True))
    cut = F.array(row("line", F.concat(head, F.substring(url, 1, 70), F.lit(" "))))
    rows = F.when(n % 4 == 0, F.array(row("sent"))).when(n % 4 == 1, whole).when(n % 4 == 2, split).otherwise(cut)
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("device"), F.col("ts").cast("timestamp").alias("ts"), "event_id", F.posexplode(rows).alias("i", "r"))
    return events.select("device", "ts", (n * 4 + F.col("i")).alias("seq"), "r.*")
