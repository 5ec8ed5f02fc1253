"""URL filters: longest-match rules, then logistic regression on hashed character n-grams.

The model is trained from a small labelled URL table. Batch gradient descent from zero keeps
the weights a sum of the labelled rows' feature vectors, w = sum_i a_i x_i, so it is run on the
row coefficients a over the rows' Gram matrix, inside one ``aggregate`` expression; the weights
of the hash buckets follow from a. Pages are scored inside the scan: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.common import checkpoint, fresh

BUCKETS = 1 << 17
GRAMS = (3, 4, 5)
#: Most rows of a labelled table; its Gram matrix has the square of this.
MOST_LABELLED = 1000
#: Up to so many rules are part of the plan; more are joined by host suffix.
INLINE_RULES = 256

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Words of which the default labelled urls are made, by class. Unwanted: gambling,
# pills, adult pages, loans, fakes, adverts. Wanted: what public sites are about, in four languages.
UNWANTED_SITES = """casino poker jackpot slots roulette betting bookmaker lottery bingo viagra cialis pills pharmacy-discount steroids xxx porn sexcam escort adult-dating
nude payday-loan quick-cash forex-signal binary-options crypto-doubler replica-watch fake-rolex essay-writer warez keygen torrent-crack free-robux adserver clicktrack popunder
spam-mailer miracle-diet weight-loss-pill hot-singles win-prize""".split()
UNWANTED_PATHS = """casino/free-spins play/jackpot-bonus buy/cheap-viagra-online order/pills-no-prescription xxx/video adult/cams/live bet/odds-today loans/instant-cash
replica/rolex-sale click/track.gif ads/banner/redirect win/free-prize signup/bonus-code download/keygen-crack.exe porn/teen/hd slots/mega-win dating/hot-singles
crypto/double-your-bitcoin poker/real-money lottery/claim-winner""".split()
WANTED_SITES = """weather museum library university hospital school garden kitchen history science travel railway theatre orchestra gallery council parliament journal newspaper
observatory botany geology mathematics chemistry physics archive bookshop farmers football cycling hiking sailing photography carpentry bakery dentist architecture encyclopedia
bibliothek stadtwerke gemeinde verein schule krankenhaus zeitung wetter rathaus universitaet mairie musee ecole journal-local bibliotheque jardin cuisine meteo sante ville
biblioteca ayuntamiento escuela periodico hospital-general museo tiempo cocina universidad viajes""".split()
WANTED_PATHS = """about news/2021/opening-hours en/article/history-of-the-bridge research/publications courses/introduction blog/how-to-bake-bread events/summer-concert contact
products/garden-tools docs/manual/installation de/aktuelles/stadtfest fr/actualites/exposition es/noticias/exposicion recipes/vegetable-soup travel/mountain-walks
wiki/photosynthesis archive/1998/minutes sports/results/league services/library-card health/first-aid""".split()
_LIKE = ("https://www.{}.org/{}", "http://{}.net/{}", "https://{}.com/{}?id=7", "https://{}.co.uk/{}/", "https://my{}.info/{}", "http://m.{}.eu/{}#top")


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; then up
    to ``? #`` or the end. Both are empty for null or a url without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _buckets(host: Column, path: Column) -> Column:
    """Hash buckets of the character n-grams of ``^host path$``, each once; all digits are alike."""
    text = F.regexp_replace(F.concat(F.lit("^"), host, F.lit(" "), path, F.lit("$")), r"[0-9]+", "0")

    def grams(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.substring(text, i, F.lit(n)))

    return F.array_distinct(F.transform(F.flatten(F.array(*map(grams, GRAMS))), lambda g: F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int")))


def labelled_urls() -> list[tuple[str, int]]:
    """(url, unwanted): every site with some paths of its class, and with neutral ones; every path
    on neutral hosts. So either part can tell the classes, and neither has to. Wanted urls are
    about three in five, as most of the web is: what the n-grams don't know is let through."""
    rows = []
    for unwanted, sites, paths, times in ((1, UNWANTED_SITES, UNWANTED_PATHS, 3), (0, WANTED_SITES, WANTED_PATHS, 3)):
        for i, site in enumerate(sites):
            rows += [(_LIKE[(i + j) % len(_LIKE)].format(site, paths[(i + 7 * j) % len(paths)]), unwanted) for j in range(times)]
            rows.append((_LIKE[(i + 3) % len(_LIKE)].format(site, ("", "index.html", "en/", "p/12")[i % 4]), unwanted))
        rows += [(_LIKE[i % len(_LIKE)].format(host, path), unwanted) for i, path in enumerate(paths) for host in ("example", "site24", "mypage")]
    return rows


def default_labels(spark: SparkSession) -> DataFrame:
    """``labelled_urls`` as a table (url, unwanted)."""
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(url).alias("url"), F.lit(y).alias("unwanted")) for url, y in labelled_urls()])))


def train(labelled: DataFrame, epochs: int = 400, step: float = 6.0, decay: float = 0.01) -> DataFrame:
    """(url, unwanted 0/1) to one row: weights array<double> by bucket, and bias.

    The rate is ``step`` over the largest row sum of the Gram matrix, which bounds its largest
    eigenvalue; steps below 8 can't overshoot. Rows with a null label count as wanted; an empty table gives zero weights, that is a
    probability of one half and the verdict "allow". More than ``MOST_LABELLED`` rows are an
    error: the table is meant to be small.
    """
    host, path = split_url(F.col("url"))
    # one row beyond the bound is enough to tell that there are too many
    rows = labelled.limit(MOST_LABELLED + 1).select(_buckets(host, path).alias("x"), F.coalesce(F.col("unwanted"), F.lit(0)).cast("double").alias("y"))
    rows = rows.agg(F.sort_array(F.collect_list(F.struct("x", "y"))).alias("r"))
    small = F.when(F.size("r") > MOST_LABELLED, F.raise_error(F.lit(f"more than {MOST_LABELLED} labelled urls"))).otherwise(F.col("r"))
    rows = rows.select(small.alias("r"))
    # + 1: the bias is a feature that every row has
    gram = F.transform("r", lambda a: F.transform("r", lambda b: F.size(F.array_intersect(a["x"], b["x"])) + F.lit(1.0)))
    sums = F.transform("k", lambda row: F.aggregate(row, F.lit(0.0), lambda s, x: s + x))
    # kept, else each epoch would compute the matrix again
    rows = checkpoint(rows.select("r", gram.alias("k")).withColumn("rate", F.lit(step) / F.coalesce(F.array_max(sums), F.lit(1.0))))

    def dot(u: Column, v: Column) -> Column:
        return F.aggregate(F.zip_with(u, v, lambda a, b: a * b), F.lit(0.0), lambda s, t: s + t)

    def epoch(a: Column, _: Column) -> Column:
        def row(ai: Column, i: Column) -> Column:
            p = 1 / (1 + F.exp(-dot(a, F.get(F.col("k"), i))))
            return ai * (1 - F.col("rate") * decay) + F.col("rate") * (F.get(F.col("r"), i)["y"] - p)

        return F.transform(a, row)

    solved = rows.select("r", F.aggregate(F.sequence(F.lit(1), F.lit(epochs)), F.transform("r", lambda _: F.lit(0.0)), epoch).alias("a"))
    parts = solved.select(F.explode(F.arrays_zip("r", "a")).alias("z")).select(F.explode(F.concat("z.r.x", F.array(F.lit(BUCKETS)))).alias("b"), "z.a")
    summed = parts.groupBy("b").agg(F.sum("a").alias("w"))
    every = labelled.sparkSession.range(BUCKETS + 1).select(F.col("id").cast("int").alias("b")).join(summed, "b", "left")
    packed = every.agg(F.sort_array(F.collect_list(F.struct("b", F.coalesce("w", F.lit(0.0)).alias("w")))).alias("m"))
    return checkpoint(packed.select(F.transform("m", lambda x: x["w"]).alias("weights")))


def _rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as struct(rule, verdict); null if none fits."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1], r[2])):  # the longest is asked first
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))).otherwise(found)
    return found


def filter_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] | DataFrame = (),
    labelled: DataFrame | None = None,
    url_col: str = "url",
    threshold: float = 0.5,
) -> DataFrame:
    """``pages`` with host, path, rule, verdict and unwanted_probability added (or replaced).

    ``rules``: (host, path prefix, verdict), a list or a table of host, path, verdict. A rule
    fits its host and all subdomains if the path starts with its own; the longest host + path
    wins, ties by code points, then the greater verdict. Where none fits, the model decides: "block" if the probability is
    above ``threshold``. A null or malformed url has an empty host and path and is judged as
    such. Rows are neither lost nor repeated, repeated rows included; an empty table stays empty.
    """
    spark = pages.sparkSession
    weights = train(default_labels(spark) if labelled is None else labelled)
    host, path = split_url(F.col(url_col))
    out = pages.withColumns({"host": host, "path": path})
    weights, w = weights.select("weights").scalar(), fresh(pages, "_weights")
    z = F.aggregate(_buckets(F.col("host"), F.col("path")), F.lit(0.0), lambda s, b: s + F.get(F.col(w), b)) + F.get(F.col(w), F.lit(BUCKETS))
    name = fresh(out, "_rule")
    out = out.withColumn(w, weights).withColumn("unwanted_probability", 1 / (1 + F.exp(-z))).drop(w)
    if isinstance(rules, DataFrame):
        out = _join_rules(out, rules, name)
    elif len(rules) > INLINE_RULES:
        out = _join_rules(out, spark.createDataFrame(list(rules), "host string, path string, verdict string"), name)
    else:
        out = out.withColumn(name, _rule_of(F.col("host"), F.col("path"), list(rules)))
    by_model = F.when(F.col("unwanted_probability") > threshold, "block").otherwise("allow")
    return out.withColumns({"rule": F.col(f"{name}.rule"), "verdict": F.coalesce(F.col(f"{name}.verdict"), by_model)}).drop(name)


def _join_rules(pages: DataFrame, rules: DataFrame, name: str) -> DataFrame:
    """Rules of any number: join distinct (host, path) by every suffix of the host, keep the longest."""
    rules = rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
    pairs = pages.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    found = pairs.withColumn("r_host", F.explode(suffixes)).join(rules, "r_host").filter(F.col("path").startswith(F.col("r_path")))
    rule = F.concat("r_host", "r_path")
    best = found.groupBy("host", "path").agg(F.max(F.struct(F.length(rule), rule.alias("rule"), F.col("r_verdict").alias("verdict"))).alias("best"))
    best = best.select("host", "path", F.struct("best.rule", "best.verdict").alias(name))
    return pages.join(best, ["host", "path"], "left")
