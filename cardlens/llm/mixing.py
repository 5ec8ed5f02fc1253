"""Mixing sources to target weights by pivotal dependent rounding.

A source whose target is r times its size gives every document floor(r) copies and a fractional
copy with probability p = r - floor(r). The fractions are settled in pairs: words move from one
document of a pair to the other until one of the two probabilities is 0 or 1, in a random
direction whose odds keep every expectation, so the words of a source stay what they were.
Documents are dealt to blocks of about ``BLOCK``; each block folds its documents into decisions
and one residual, and residuals meet in blocks of ``BLOCK`` again, a reduction tree that ends in
one residual for each source. Everything is DataFrame functions; randomness is a hash of what is
paired, so that reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.llm.common import WORD, checkpoint, fresh, numbered, unit_hash

BLOCK = 64
#: Bounds the table of sources.
MOST_SOURCES = 1_000_000
_ITEM = "struct<h:bigint,id:bigint,dup:bigint,size:bigint,p:double>"


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size) to the same with a target.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` of all
    words. A target stops at ``cap`` times its source; the excess goes to the others by weight,
    again and again. That is a water level: with sources in the order of cap * size / weight,
    the ones below the level are those whose own limit comes first. An empty source gets 0.
    A row a source, so the windows over them run in one task; more than ``MOST_SOURCES`` are an error.
    """
    many = F.raise_error(F.lit(f"more than {MOST_SOURCES} sources"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("turn", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("turn", F.when(F.col("turn") < MOST_SOURCES, F.col("turn")).otherwise(many.cast("int")))
    weight = F.array(*[F.lit(float(w)) for w in weights])
    ranked = ranked.withColumn("weight", F.get(weight, F.col("turn") % len(weights))).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), "turn")
    before, after = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ranked = ranked.withColumn(
        "level",
        (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(after),
    )
    # the level of the first source that doesn't reach its limit; null if all do
    level = F.min(F.when(F.col("most") > F.col("level") * F.col("weight"), F.struct("turn_at_level", "level"))).over(everything)["level"]
    ranked = ranked.withColumn("turn_at_level", F.row_number().over(by_level))
    return ranked.withColumn("target", F.least("most", F.coalesce(level * F.col("weight"), F.col("most")))).select("source", "source_size", "target")


def _item(x: Column, p: Column | None = None) -> Column:
    fields = [x["h"].alias("h"), x["id"].alias("id"), x["dup"].alias("dup"), x["size"].alias("size"), (x["p"] if p is None else p).alias("p")]
    return F.struct(*fields)


def _snap(p: Column) -> Column:
    return F.when(p < 1e-9, 0.0).when(p > 1 - 1e-9, 1.0).otherwise(p)


def _settled(x: Column) -> Column:
    return (x["p"] <= 0.0) | (x["p"] >= 1.0)


def _fold(items: Column, seed: int) -> Column:
    """Fold an array of items into struct(carry, out): settled items and at most one that isn't."""
    nothing = F.lit(None).cast(_ITEM)
    none_out = F.array().cast(f"array<{_ITEM}>")

    def state(carry: Column, out: Column) -> Column:
        return F.struct(carry.alias("carry"), out.alias("out"))

    def pair(c: Column, x: Column) -> Column:
        """(new c, new x), of which one is settled at least."""
        into_c = F.least(c["size"] * (1 - c["p"]), x["size"] * x["p"])
        into_x = F.least(c["size"] * c["p"], x["size"] * (1 - x["p"]))
        u = unit_hash(c["h"], x["h"], F.lit(seed + 1))
        moved = F.when(u * (into_c + into_x) < into_x, into_c).otherwise(-into_x)
        return F.struct(_item(c, _snap(c["p"] + moved / c["size"])).alias("c"), _item(x, _snap(x["p"] - moved / x["size"])).alias("x"))

    def step(acc: Column, x: Column) -> Column:
        def settle(both: Column) -> Column:
            c, x = both["c"], both["x"]
            out = F.concat(acc["out"], F.filter(F.array(c, x), _settled))
            return state(F.when(~_settled(c), c).when(~_settled(x), x).otherwise(nothing), out)

        paired = F.get(F.transform(F.array(pair(acc["carry"], x)), settle), F.lit(0))
        return F.when(_settled(x), state(acc["carry"], F.concat(acc["out"], F.array(_item(x))))).when(acc["carry"].isNull(), state(_item(x), acc["out"])).otherwise(paired)

    return F.aggregate(items, state(nothing, none_out), step)


def _each(items: DataFrame, most: int = 4096) -> DataFrame:
    """Every item ``count`` times, numbered by ``dup`` from 1. Items of more than ``most`` rows are
    dealt out in parts of that size before they are written out, so that no task or array holds them."""
    few = items.filter(F.col("count") <= most).withColumn("dup", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"))))
    parts = items.filter(F.col("count") > most).withColumn("first", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count"), F.lit(most).cast("long"))))
    parts = parts.repartition("id", "source", "size", "first")
    many = parts.withColumn("dup", F.explode(F.sequence("first", F.least(F.col("first") + (most - 1), F.col("count"))))).drop("first")
    return few.unionByName(many)


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 0,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, copies, taken.

    Size is the number of words (runs of anything but ASCII white space), 0 for null; ``copies``
    is how often the mix takes the document, at most ceil(cap), and ``taken`` = size * copies.
    The words taken of a source differ from its target by less than its longest document. Rows
    that are alike in id, source and size count one by one. A null id or source is a value like
    any other; documents of size 0 get copies floor(r) and take nothing; an empty table gives an
    empty result. Other columns are ignored.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"), size.alias("size"))
    items = checkpoint(rows.groupBy("id", "source", "size").count())
    sizes = items.groupBy("source").agg(F.sum(F.col("size") * F.col("count")).alias("source_size"), F.sum("count").alias("n"))
    targets = source_targets(sizes.select("source", "source_size"), weights, share, cap)
    sources = targets.join(sizes.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = checkpoint(sources.withColumn("base", F.floor(rate)).withColumn("p", rate - F.floor(rate)))
    most = sources.agg(F.max("n")).first()[0] or 0

    source = F.struct("source", "source_size", "target", "base")
    level = (
        _each(items)
        .join(sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .withColumn("h", F.xxhash64("id", "dup", "size", F.lit(seed)))
        .withColumn("block", F.pmod("h", F.ceil(F.col("n") / BLOCK)))
        .select(source.alias("source"), "block", F.struct("h", "id", "dup", "size", F.when(F.col("size") > 0, F.col("p")).otherwise(0.0).alias("p")).alias("item"))
    )
    blocks, done = -(-most // BLOCK), []
    while True:
        folded = level.groupBy("source", "block").agg(_fold(F.array_sort(F.collect_list("item")), seed).alias("fold"))
        folded = checkpoint(folded.select("source", "block", "fold.carry", "fold.out"))
        done.append(folded.select("source", F.explode("out").alias("item")))
        rest = folded.filter("carry IS NOT NULL").select("source", "block", F.col("carry").alias("item"))
        if blocks <= 1:
            break
        blocks = -(-blocks // BLOCK)
        level = rest.withColumn("block", F.floor(F.col("block") / BLOCK))
    last = F.when(unit_hash("item.h", F.lit(seed + 2)) < F.col("item.p"), 1.0).otherwise(0.0)
    done.append(rest.select("source", _item(F.col("item"), last).alias("item")))
    settled = done[0]
    for more in done[1:]:
        settled = settled.unionByName(more)
    copies = F.col("source.base") + F.col("item.p").cast("long")
    return settled.select(
        "item.id", "source.source", "item.size", "source.source_size", "source.target", copies.alias("copies"), (F.col("item.size") * copies).alias("taken")
    )


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as often as the mix takes each, all columns kept; rows count one by one, whatever
    their identifiers."""
    rows, uid = numbered(docs)
    times = fresh(docs, "_copies")
    copies = mix_sources(rows, id_col=uid, **options).filter("copies > 0").select(F.col("id").alias(uid), F.array_repeat(F.lit(1), F.col("copies").cast("int")).alias(times))
    joined = rows.join(copies, uid).select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(times).alias(times))
    return joined.drop(times)
