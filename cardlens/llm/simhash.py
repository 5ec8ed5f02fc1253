"""SimHash near-dedup with covering locality-sensitive hashing.

A fingerprint bit is the majority over the XXH64 hashes of a text's word shingles. For links of
at most r differing bits, every bit gets a nonzero vector of F2^(r+1), and each nonzero v of
that space is a table whose mask holds the bits with an odd product with v. The vectors of any
r bits leave some v orthogonal to all of them, so each pair within the radius agrees on the
whole mask of at least one of the 2^(r+1) - 1 tables: nothing is missed.

Work is on distinct fingerprints. Buckets of two are compared in place. Larger ones are searched
breadth first with numpy, each reached fingerprint leaving the set that is still compared, and
give a spanning star of each group, never all pairs. Buckets over ``BUCKET`` are dealt out again
by a second covering whose masks leave few bits free, so that even then a bucket's size has a
bound (2 to the power of ``free_bits``). Components come from the stars (see components.py).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.llm.common import checkpoint, numbered, saved
from cardlens.llm.components import components

BITS = 64
BUCKET = 2048


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle, repeats included; A-Z is lower-cased."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(tokens), 42)], np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = np.r_[0, ends[:-1]]
    h = xxhash.xxh64_intdigest
    cuts = zip(starts[: len(tokens) - words + 1].tolist(), (ends[words - 1 :] - 1).tolist())
    return np.fromiter((h(joined[a:b], 42) for a, b in cuts), np.uint64, len(tokens) - words + 1)


def simhash(hashes: np.ndarray) -> int:
    """The bits that are set in over half of ``hashes``; 0 if there are none."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 14):  # bounded memory for texts of any length
        bits = np.unpackbits(hashes[i : i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row_uid, id, fp): ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([simhash(shingle_hashes(t.as_py(), words)) for t in batch.column("text")], np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("row_uid"), batch.column("id"), pa.array(fp)], ["row_uid", "id", "fp"])

    rows = docs.select(F.monotonically_increasing_id().alias("row_uid"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "row_uid long, id long, fp long")


def _vectors(radius: int, level: int) -> list[int]:
    """The vector of each bit; the levels' vectors are dealt apart from each other."""
    n = (1 << (radius + 1)) - 1
    step = 17 if radius < 5 else 19  # of the odd primes, those that leave the fewest bits free
    return [1 + i % n if level == 0 else 1 + (i * step + 5 * (i // n)) % n for i in range(BITS)]


def covering_masks(radius: int, level: int = 0) -> list[int]:
    """2^(radius + 1) - 1 masks; any two words within ``radius`` bits agree on one of them."""
    vectors = _vectors(radius, level)
    return [sum(1 << i for i in range(BITS) if (vectors[i] & v).bit_count() % 2) for v in range(1, 1 << (radius + 1))]


def free_bits(radius: int) -> int:
    """Most bits that a mask of level 0 and one of level 1 leave free: buckets of both hold at
    most 2 ** this many distinct fingerprints."""
    return max(BITS - (a | b).bit_count() for a in covering_masks(radius) for b in covering_masks(radius, 1))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _tables(radius: int, level: int) -> Column:
    masks = [F.struct(F.lit(t).alias("t"), F.lit(_signed(m)).alias("m")) for t, m in enumerate(covering_masks(radius, level))]
    return F.array(*masks)


def _stars(fp: np.ndarray, radius: int, direct: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(centre, member) links that connect just what links within ``radius`` connect; ``direct``:
    each member's link is to the fingerprint within the radius that reached it."""
    rest = np.unique(fp)
    while len(rest) > 1:
        centre, rest, frontier = rest[0], rest[1:], [rest[0]]
        while frontier and len(rest):
            at = frontier.pop()
            near = np.bitwise_count(rest ^ at) <= radius
            if near.any():
                found = rest[near]
                rest = rest[~near]
                frontier.extend(found)
                yield np.full(len(found), at if direct else centre), found


def _search(radius: int, direct: bool):
    """Links inside the buckets of a stream that is sorted by bucket; a bucket is held at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_g, held = None, []
        a_out, b_out = [], []

        def close() -> None:
            if held:
                for a, b in _stars(np.concatenate(held), radius, direct):
                    a_out.append(a)
                    b_out.append(b)

        for batch in batches:
            g, fp = batch.column("g").to_numpy(), batch.column("fp").to_numpy().astype(np.uint64)
            cuts = np.r_[0, np.flatnonzero(g[1:] != g[:-1]) + 1, len(g)]
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if e > s:
                    if held_g is not None and g[s] != held_g:
                        close()
                        held = []
                    held_g = g[s]
                    held.append(fp[s:e])
            if a_out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (a_out, b_out)], ["a", "b"])
                a_out, b_out = [], []
        close()
        if a_out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (a_out, b_out)], ["a", "b"])

    return run


def links(distinct: DataFrame, radius: int, bucket: int = BUCKET, direct: bool = False) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that connect whatever lies within
    ``radius``; if ``direct``, each link is itself within it."""
    masked = distinct.select("fp", F.explode(_tables(radius, 0)).alias("m")).select(F.col("m.t").alias("t"), F.col("fp").bitwiseAND(F.col("m.m")).alias("key"), "fp")
    filled = masked.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1")
    filled = checkpoint(filled)
    pairs = filled.filter((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b").distinct()
    # a bucket's rows meet its size in a join, which Spark may split where a bucket is hot
    members = masked.join(filled.filter("n > 2").select("t", "key", "n"), ["t", "key"])
    second = F.when(F.col("n") > bucket, _tables(radius, 1)).otherwise(F.array(F.struct(F.lit(-1).alias("t"), F.lit(0).cast("long").alias("m"))))
    members = members.withColumn("m", F.explode(second))
    members = members.select(F.xxhash64("t", "key", F.col("m.t"), F.col("fp").bitwiseAND(F.col("m.m"))).alias("g"), "fp")
    stars = members.repartition("g").sortWithinPartitions("g").mapInArrow(_search(radius, direct), "a long, b long")
    return pairs.unionByName(stars)


def near_dedup(docs: DataFrame, words: int = 3, radius: int = 3, bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: row_uid, id, fingerprint (16 hex digits), component_id,
    component_row, kept.

    Texts are lower-cased in A-Z and split at ASCII white space; fewer words than a shingle give
    one shingle, none give fingerprint zero, which links like any other. Null counts as empty.
    ``component_id`` is the smallest identifier that links of at most ``radius`` bits reach
    (null identifiers count only if there is no other); ``kept`` is true for one row of each
    component, the first row with that identifier. Rows that repeat an identifier count one by
    one. An empty table gives an empty result; other columns are ignored.
    """
    prints = checkpoint(fingerprints(docs, words, id_col, text_col))
    distinct = prints.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull(), "id", "row_uid")).alias("first"))
    distinct = checkpoint(distinct)
    found = components(links(distinct.select("fp"), radius, bucket), "a", "b")  # (node, root) of linked fingerprints
    rooted = distinct.join(found, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    best = rooted.groupBy("root").agg(F.min("first").alias("best"))
    rooted = rooted.join(best, "root").select("fp", "best")
    return prints.join(rooted, "fp").select(
        "row_uid",
        "id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("best.id").alias("component_id"),
        F.col("best.row_uid").alias("component_row"),
        (F.col("best.row_uid") == F.col("row_uid")).alias("kept"),
    )


def _remix(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th of several independent hashes that one hash gives; the first is the hash itself."""
    if not k:
        return h
    h = (h ^ np.uint64(0x9E3779B97F4A7C15 * k & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(30))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(shingle_hashes(text, words))


def set_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The Jaccard similarity of two sorted sets. Two empty ones are alike."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    union = len(a) + len(b) - common
    return common / union if union else 1.0


def _marked(keys: DataFrame) -> DataFrame:
    """(mark, bits): a bitmap of 2^23 bits, in 256 rows at most, of the hashes of ``keys.key``."""
    h = F.pmod(F.xxhash64("key"), F.lit(1 << 23))
    marks = keys.select(F.bitmap_bucket_number(h).alias("mark"), F.bitmap_bit_position(h).alias("at"))
    return marks.groupBy("mark").agg(F.bitmap_construct_agg("at").alias("bits"))


def bucket_sums(shingles: np.ndarray) -> np.ndarray:
    """How many of the distinct hashes fall in each of 2^n hash buckets, as bytes; there are more
    buckets than hashes, and even more where a byte would not do."""
    n = 1 << max(4, len(shingles).bit_length())
    while True:
        sums = np.bincount((shingles % np.uint64(n)).astype(np.int64), minlength=n)
        if not len(shingles) or sums.max() < 256:
            return sums.astype(np.uint8)
        n *= 2


def _shingle_sets(docs: DataFrame, wanted: DataFrame, words: int, text_col: str) -> DataFrame:
    """(node, size, sums, shingles) of the texts with the digests of ``wanted`` (node, key): sorted
    64-bit hashes as bytes, and their bucket sums. A bitmap of bounded size lets only their texts, and a few others that
    the join drops, out of the scan."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), words) for t in batch.column("text")]
            out = [batch.column("key"), pa.array([len(x) for x in sets], pa.int32())]
            out += [pa.array([bucket_sums(x).tobytes() for x in sets], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(out, ["key", "size", "sums", "shingles"])

    h = F.pmod(F.xxhash64("key"), F.lit(1 << 23))
    texts = docs.select(_digest(text_col).alias("key"), F.col(text_col).alias("text")).withColumn("mark", F.bitmap_bucket_number(h))
    at = F.bitmap_bit_position(h).cast("int")
    byte = F.conv(F.hex(F.col("bits").substr(F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    texts = texts.join(F.broadcast(_marked(wanted)), "mark").filter(F.get(F.array(*[F.shiftright(byte, i) for i in range(8)]), at % 8) % 2 == 1)
    sets = texts.select("key", "text").mapInArrow(run, "key binary, size int, sums binary, shingles binary")
    return sets.join(wanted, "key").groupBy("node").agg(*[F.first(c).alias(c) for c in ("size", "sums", "shingles")])


def _folded(sums: np.ndarray, n: int) -> np.ndarray:
    """Rows of bucket sums over ``n`` buckets, of rows over a multiple of that."""
    return sums.reshape(len(sums), -1, n).sum(axis=1, dtype=np.uint32)


def _unlinked(similarity: float, radius: int, times: int):
    """Candidate links between groups, inside the buckets of a stream that is sorted by bucket.

    Two nodes are candidates if they are within the radius and may be similar: sums over hash
    buckets bound from above what their sets have in common. The search goes breadth first from
    group to group, as if each candidate were a link, and a group is compared until it was found
    ``times`` times, so a bucket gives at most as many links for each of its groups. Pairs in
    ``no`` are known to fail.
    """

    def close(held: list[pa.RecordBatch]) -> Iterator[tuple[int, int]]:
        rows = pa.Table.from_batches(held)
        node, size, fp = rows.column("node").to_numpy(), rows.column("size").to_numpy(), rows.column("fp").to_numpy().astype(np.uint64)
        roots, root = np.unique(rows.column("root").to_numpy(), return_inverse=True)
        if len(roots) < 2:
            return
        failed = [set(x) if x else None for x in rows.column("no").to_pylist()]
        raw = [np.frombuffer(x.as_buffer(), np.uint8) for c in rows.column("sums").chunks for x in c]
        width = np.array([len(x) for x in raw])
        place = np.empty(len(raw), np.int64)
        tables = {}
        for n in np.unique(width).tolist():
            own = np.flatnonzero(width == n)
            place[own] = np.arange(len(own))
            tables[n] = np.array([raw[i] for i in own.tolist()]).reshape(-1, n)
        members = np.split(np.argsort(root, kind="stable"), np.cumsum(np.bincount(root))[:-1])

        def common(i: int, others: np.ndarray) -> np.ndarray:
            """An upper bound of the shingles that ``i`` shares with each of ``others``."""
            out = np.zeros(len(others), np.int64)
            for n, table in tables.items():
                at = np.flatnonzero(width[others] == n)
                if len(at):
                    m = min(n, int(width[i]))
                    own = _folded(raw[i][None], m)
                    out[at] = np.minimum(_folded(table[place[others[at]]], m), own).sum(axis=1)
            return out

        left = np.full(len(roots), times)
        reached = np.zeros(len(roots), bool)
        for start in range(len(roots)):
            if reached[start]:
                continue
            reached[start], left[start] = True, 0
            todo, frontier = np.flatnonzero(left[root] > 0), members[start].tolist()
            while frontier and len(todo):
                i = frontier.pop()
                least, most = np.minimum(size[todo], size[i]), np.maximum(size[todo], size[i])
                near = todo[(np.bitwise_count(fp[todo] ^ fp[i]) <= radius) & (least >= similarity * most - 1e-6) & (root[todo] != root[i])]
                if failed[i] and len(near):
                    near = near[[x not in failed[i] for x in node[near].tolist()]]
                if len(near):
                    shared = common(i, near)
                    union = size[i].astype(np.int64) + size[near] - shared
                    near = near[(shared >= similarity * union - 1e-6) | (union <= 0)]
                if not len(near):
                    continue
                found, first = np.unique(root[near], return_index=True)
                for r, j in zip(found.tolist(), near[first].tolist()):
                    yield (int(node[i]), int(node[j])) if node[i] > node[j] else (int(node[j]), int(node[i]))
                    left[r] -= 1
                    if not reached[r]:
                        reached[r] = True
                        frontier.extend(members[r].tolist())
                if not left[found].all():
                    todo = todo[left[root[todo]] > 0]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            found = np.array(list(close(held)), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

        held_g, held = None, []
        for batch in batches:
            g = batch.column("g").to_numpy()
            cuts = np.r_[0, np.flatnonzero(g[1:] != g[:-1]) + 1, len(g)]
            for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if e > s:
                    if held and g[s] != held_g:
                        yield out(held)
                        held = []
                    held_g = g[s]
                    held.append(batch.slice(s, e - s))
        if held:
            yield out(held)

    return run


#: Buckets of nodes with their bucket sums are dealt out again only beyond this: a search costs
#: seconds at this size, a second covering 2^(radius + 1) - 1 copies of each row.
WIDE_BUCKET = 1 << 15


def _candidates(nodes: DataFrame, names: list[str], similarity: float, radius: int, times: int) -> DataFrame:
    """(a, b): candidate links between the groups ``root`` of ``nodes`` (node, root, fingerprints,
    size, sums, no), such that if all of them hold, no candidate pair is left whose ends lie in
    different groups.

    The search of ``links`` once more, but of nodes, and only in buckets where groups meet.
    """
    fps = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(n).alias("fp")) for k, n in enumerate(names)])).alias("f")
    printed = nodes.select("node", "root", fps).select("node", "root", "f.k", "f.fp")
    masked = printed.withColumn("m", F.explode(_tables(radius, 0))).select("node", "root", "k", "fp", F.col("m.t").alias("t"), F.col("fp").bitwiseAND(F.col("m.m")).alias("key"))
    place = ["k", "t", "key"]
    bucket = Window.partitionBy(*place)
    wide = saved(masked.groupBy(*place).count().filter(F.col("count") > WIDE_BUCKET).select(*place))

    def dealt(rows: DataFrame, t: Column, m: Column) -> DataFrame:
        return rows.select(F.xxhash64(*place, t, F.col("fp").bitwiseAND(m)).alias("g"), "node", "root", "fp")

    no_wide = wide.isEmpty()
    narrow = masked if no_wide else masked.join(wide, place, "left_anti")  # at most WIDE_BUCKET rows a bucket from here on
    met = narrow.withColumns({"lo": F.min("root").over(bucket), "hi": F.max("root").over(bucket)}).filter("lo != hi")
    members = dealt(met, F.lit(-1), F.lit(0).cast("long"))
    if not no_wide:
        again = masked.join(wide, place).withColumn("m", F.explode(_tables(radius, 1)))
        members = members.unionByName(dealt(again, F.col("m.t"), F.col("m.m")))
    members = members.join(nodes.select("node", "size", "sums", "no"), "node").repartition("g").sortWithinPartitions("g", "node")
    return members.mapInArrow(_unlinked(similarity, radius, times), "a long, b long").distinct()


def _similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The rows of ``pairs`` (a, b) whose shingle sets, all of them, are similar."""

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("shingles_a"), batch.column("shingles_b"))
            alike = pa.array([set_similarity(_hashes(a), _hashes(b)) >= similarity for a, b in both], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(alike)

    ends = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("shingles_a")), "a")
    ends = ends.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("shingles_b")), "b")
    return ends.select("a", "b", "shingles_a", "shingles_b").mapInArrow(verify, "a long, b long")


def _settled(pairs: DataFrame, sets: DataFrame, rooted: DataFrame, similarity: float, radius: int, names: list[str]) -> DataFrame:
    """(node, root) of all nodes of ``rooted`` (node, fingerprints), grouped by their similar links.

    ``pairs`` are links of a spanning tree of what lies within the radius. They are checked
    first. Where some fail, the groups around them may have other links: a search gives
    candidates that would join all that may be joined, some for each group are checked, and again,
    eight times as many in each round, until no candidate is left. So every similar pair within
    the radius ends in one group.
    """
    verified = saved(_similar(pairs, sets, similarity))
    unproved, tested, times = pairs.join(verified, ["a", "b"], "left_anti"), None, 1
    groups = components(verified, "a", "b")
    rooted = saved(rooted.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node")))

    def between(links: DataFrame) -> DataFrame:
        """``links`` whose ends are in different groups, with the groups: a, b, hi, lo."""
        for end in ("a", "b"):
            links = links.join(rooted.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end)
        links = links.filter("root_a != root_b")
        return links.select("a", "b", F.greatest("root_a", "root_b").alias("hi"), F.least("root_a", "root_b").alias("lo"))

    while True:
        unproved = saved(between(unproved))
        if unproved.isEmpty():
            return rooted.select("node", "root")
        open_ = unproved.select(F.explode(F.array("hi", "lo")).alias("root")).distinct()
        members = rooted.join(open_, "root").join(sets.select("node", "size", "sums"), "node")
        nothing = F.array().cast("array<bigint>")
        if tested is None:
            members = members.withColumn("no", nothing)
        else:
            both = tested.unionByName(tested.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.collect_set("b").alias("no"))
            members = members.join(both.withColumnRenamed("a", "node"), "node", "left").withColumn("no", F.coalesce("no", nothing))
        found = saved(_candidates(saved(members), names, similarity, radius, times))
        # links of each group to the least of its neighbours
        by_group = Window.partitionBy("hi").orderBy("lo", "a", "b")
        picked = saved(between(found).withColumn("nth", F.row_number().over(by_group)).filter(F.col("nth") <= times).select("a", "b"))
        verified = saved(_similar(picked, sets, similarity))
        wrong = saved(picked.join(verified, ["a", "b"], "left_anti"))
        tested = wrong if tested is None else tested.unionByName(wrong)
        merged = components(between(verified), "hi", "lo").select(F.col("node").alias("root"), F.col("root").alias("to"))
        unproved = found.join(verified, ["a", "b"], "left_anti")
        rooted = saved(rooted.join(merged, "root", "left").withColumn("root", F.coalesce("to", "root")).drop("to"))
        times *= 8


def _digest(text_col: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def near_copies(
    docs: DataFrame, words: int = 5, similarity: float = 0.8, radius: int = 3, prints: int = 4, bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None
) -> DataFrame:
    """One row per row of ``docs``: row_uid (``row_col`` if given), id, component_row (its group), kept.

    For similar, not only all but equal, texts: there are ``prints`` independent fingerprints of
    the distinct words; links within ``radius`` bits of any of them come from the same covering
    hashing, and a link counts if the distinct shingles of both texts, all of them, have a Jaccard
    similarity of ``similarity`` or more. The tree of links that the search gives first is checked;
    where links of it fail, other pairs of its buckets are, until none is left that could join two
    groups (``_settled``). Several fingerprints of a small radius find far more such pairs than one
    of a larger radius, for as many tables. The row with the smallest identifier of each group stays (null identifiers last, then the first row).
    Null counts as the empty text; empty texts are alike. An empty table gives an empty result.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = []
            for text in batch.column("text"):
                each = set((text.as_py() or "").encode("utf-8", "surrogatepass").lower().split())
                h = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in each), np.uint64, len(each))
                fps.append([simhash(_remix(h, k)) for k in range(prints)])
            fp = np.array(fps, np.uint64).reshape(-1, prints).astype(np.int64)
            out = [batch.column("row_uid"), batch.column("id"), batch.column("key"), *[pa.array(fp[:, k]) for k in range(prints)]]
            yield pa.RecordBatch.from_arrays(out, ["row_uid", "id", "key", *names])

    names = [f"fp{k}" for k in range(prints)]

    uid = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.select(uid.alias("row_uid"), F.col(id_col).cast("long").alias("id"), _digest(text_col).alias("key"), F.col(text_col).alias("text"))
    table = checkpoint(rows.mapInArrow(run, f"row_uid long, id long, key binary, {', '.join(f'{n} long' for n in names)}"))
    # equal texts are one node
    nodes = checkpoint(table.groupBy("key").agg(F.min("row_uid").alias("node"), *[F.min(n).alias(n) for n in names]))
    pairs = None
    for name in names:
        printed = nodes.select("node", F.col(name).alias("fp"))
        distinct = checkpoint(printed.groupBy("fp").agg(F.min("node").alias("rep")))
        found = links(distinct.select("fp"), radius, bucket, direct=True).distinct()
        found = found.join(distinct.select(F.col("fp").alias("a"), F.col("rep").alias("rep_a")), "a").join(distinct.select(F.col("fp").alias("b"), F.col("rep").alias("rep_b")), "b")
        same = printed.join(distinct, "fp").filter("node != rep").select(F.col("node").alias("a"), F.col("rep").alias("b"))
        some = checkpoint(found.select(F.greatest("rep_a", "rep_b").alias("a"), F.least("rep_a", "rep_b").alias("b")).unionByName(same))
        pairs = some if pairs is None else pairs.unionByName(some)
    pairs = checkpoint(pairs.distinct())
    wanted = checkpoint(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes, "node"))
    sets = checkpoint(_shingle_sets(docs, wanted.select("node", "key"), words, text_col))
    groups = _settled(pairs, sets, wanted, similarity, radius, names)
    grouped = nodes.select("node", "key").join(groups.withColumnRenamed("node", "at"), F.col("node") == F.col("at"), "left").select("key", F.coalesce("root", "node").alias("root"))
    rooted = table.select("row_uid", "id", "key").join(grouped, "key").select("row_uid", "id", "root")
    best = rooted.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "row_uid")).alias("best"))
    return rooted.join(best, "root").select("row_uid", "id", F.col("best.row_uid").alias("component_row"), (F.col("best.row_uid") == F.col("row_uid")).alias("kept"))


def _hashes(x: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(x.as_buffer(), np.uint64)


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group of near copies, all columns kept: that with the smallest
    identifier, nulls last, of ties the first row. Null texts count as empty, and empty texts are alike."""
    rows, uid = numbered(docs)
    kept = near_copies(rows, row_col=uid, **options).filter("kept").select(F.col("row_uid").alias(uid))
    return rows.join(kept, uid, "left_semi").drop(uid)
