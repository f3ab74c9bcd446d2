"""Near-duplicates by MinHash with tensored banding, verified on full sets.

A document is its set of distinct word 5-grams. Two small collections of sub-keys, each sub-key of
two minimum hashes, are combined pairwise into ``side * side`` table keys: 144 tables from 48 hash
functions, where independent tables of the same width would take 576. With similarity 0.75 a sub-key
agrees with probability 0.5625, and a pair meets in no table with probability below 0.0001.

Documents with equal sets are one node. Sub-keys that no other node has are dropped before keys are
combined, so that unique documents cost 24 narrow rows each. In each table every node is compared
with the node of its bucket that meets the most others, usually what the copies were made from, which
joins groups of copies without listing their pairs. Then, in buckets that still hold nodes of different
components, nodes across components are compared, each pair in one bucket only. Shingles that no other
such node has bound what a pair can share, which rules out most of them exactly: a copy with too many
edits of its own has no partner, however large its group. Every link is confirmed on the full sets.

Cases: A-Z are lower-cased; a text of fewer than five words is one shingle of all its words; null and
empty texts have no shingles and are linked with nothing; null ids never name a component; rows that
repeat an id are in one component only if their texts are; repeated rows keep their row each; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from decisionlake.llm.graph import bitmap, components, in_bitmap
from decisionlake.llm.text import Words, giving_back, gram_hashes, mix, signed, slices
from decisionlake.sources.storage import cut

SHINGLE, SIDE, PER_KEY = 5, 12, 2
HASHES = 2 * SIDE * PER_KEY
#: Nodes of a block whose sets are compared with another block's in one task.
BLOCK_NODES = 256
#: Bits of the finer sketch, and how many of them must agree before a pair across components is
#: fetched: with similarity 0.75 seven eighths agree, and fewer than this with a probability near 0.00001.
SKETCH, SKETCH_AGREE = 1024, 850
#: Shingles of a set that are sketched at once.
SKETCH_SHINGLES = 1 << 14
_WORDS = [f"w{i}" for i in range(SKETCH // 64)]
_random = np.random.default_rng(7)
_FACTOR = _random.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = _random.integers(1, 2**63, HASHES, dtype=np.uint64)


def shingle_sets(column: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(column)
    grams = gram_hashes(words.hash, k)
    out = []
    for start, end in zip(words.at[:-1].tolist(), words.at[1:].tolist()):
        if end - start >= k:
            out.append(np.unique(grams[start : end - k + 1]))
        else:
            out.append(gram_hashes(words.hash[start:end], end - start) if end > start else grams[:0])
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """26 bits of each minimum hash, with its number in the low 6 bits; rows of empty sets are 0."""
    out = np.zeros((len(sets), HASHES), np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        flat = np.concatenate([sets[i] for i in full])
        starts = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
        for i in range(HASHES):
            low = np.minimum.reduceat(flat * _FACTOR[i] + _SHIFT[i], starts)
            out[full, i] = ((mix(low) >> np.uint64(38)) << np.uint64(6)).astype(np.uint32) | np.uint32(i)
    return out


_SIGNED = "doc_id bigint, digest bigint, n bigint, c1 bigint, c2 bigint, sig array<int>"


@giving_back
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch):
            sets = shingle_sets(rows.column("text"))
            sig = signatures(sets).view(np.int32).reshape(-1)
            width = np.arange(len(sets) + 1, dtype=np.int32) * HASHES
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"), rows.column("digest"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(signed(np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64))),
                    pa.array(signed(np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64))),
                    pa.ListArray.from_arrays(pa.array(width), pa.array(sig)),
                ],
                ["doc_id", "digest", "n", "c1", "c2", "sig"],
            )


def sketches(sets: list[np.ndarray]) -> list[pa.Array]:
    """A bit of each of ``SKETCH`` further minimum hashes of each set, packed into 64-bit numbers."""
    random = np.random.default_rng(17)
    factor = random.integers(1, 2**63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = random.integers(1, 2**63, SKETCH, dtype=np.uint64)
    out = np.zeros((len(sets), SKETCH), bool)
    for i, values in enumerate(sets):
        for j in range(0, SKETCH, 64) if len(values) else ():
            parts = (values[k : k + SKETCH_SHINGLES, None] for k in range(0, len(values), SKETCH_SHINGLES))
            low = np.min([(x * factor[j : j + 64] + shift[j : j + 64]).min(axis=0) for x in parts], axis=0)
            out[i, j : j + 64] = (mix(low) & np.uint64(1)).astype(bool)
    words = np.packbits(out, axis=1, bitorder="little").view(np.int64)
    return [pa.array(np.ascontiguousarray(w)) for w in words.T]


def _sets_task(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seek = batch.column("seek").to_numpy(zero_copy_only=False).view(np.uint64)
            batch = batch.filter(pa.array(in_bitmap(shared.value, seek)))
            for rows in slices(batch):
                sets = shingle_sets(rows.column("text"))
                at = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
                flat = np.concatenate([*sets, np.empty(0, np.uint64)])
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("digest"), pa.ListArray.from_arrays(pa.array(at), pa.array(signed(flat))), *sketches(sets)],
                    ["doc_id", "digest", "set", *_WORDS],
                )

    return giving_back(run)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest"), "text")


def sub_keys(nodes: DataFrame) -> DataFrame:
    """``node, us, vs``: the sub-keys of each collection that some other node has too."""
    sub = F.transform(
        F.sequence(F.lit(0), F.lit(2 * SIDE - 1)),
        lambda i: F.struct(i.alias("i"), F.xxhash64(*[F.element_at("sig", i * PER_KEY + j + 1) for j in range(PER_KEY)]).alias("h")),
    )
    rows = nodes.select("node", F.explode(sub).alias("s")).select("node", "s.i", "s.h")
    # a window deals them once, for the counts and for the rows that they admit; a join would deal them twice
    shared = rows.withColumn("c", F.count("*").over(Window.partitionBy("i", "h"))).filter("c > 1")
    sides = shared.groupBy("node").agg(
        F.collect_list(F.when(F.col("i") < SIDE, F.col("h"))).alias("us"), F.collect_list(F.when(F.col("i") >= SIDE, F.col("h"))).alias("vs")
    )
    return sides.filter("size(us) > 0 AND size(vs) > 0")


def tensor_keys(sides: DataFrame) -> DataFrame:
    """``key, u, v, node`` of every pair of sub-keys of a node."""
    keys = sides.select("node", F.explode("us").alias("u"), "vs").select("node", "u", F.explode("vs").alias("v"))
    return keys.select(F.xxhash64("u", "v").alias("key"), "u", "v", "node")


def _compare(similarity: int):
    def run(pairs: pa.Table, sets: pa.Table) -> pa.Table:
        of = dict(zip(sets.column("node").to_pylist(), range(sets.num_rows)))
        values = [v.values.to_numpy() for v in sets.column("set")]
        a, b = pairs.column("a").to_numpy(), pairs.column("b").to_numpy()
        keep = np.zeros(len(a), bool)
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            one, two = values[of[x]], values[of[y]]
            inter = len(one) + len(two) - len(np.union1d(one, two))
            keep[i] = 100 * inter >= similarity * (len(one) + len(two) - inter)
        return pa.Table.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    return run


def _dealt_stars(pairs: DataFrame) -> DataFrame:
    """``a, b, x, y``: pairs of few ``a`` with a ``b`` each that seldom has another, in blocks; those of one ``a`` stay together."""
    pairs = cut(pairs, "stars")
    blocks = max(1, pairs.count() // BLOCK_NODES)
    most = pairs.groupBy(F.col("a").alias("m")).agg(F.ceil(F.count("*") / BLOCK_NODES).alias("parts"))
    dealt = pairs.join(most, F.col("a") == F.col("m")).drop("m").withColumn("y", F.pmod(F.xxhash64("b"), "parts"))
    return cut(dealt.withColumn("x", F.pmod(F.xxhash64("a"), F.lit(blocks))).drop("parts"), "pairs")


def _dealt(pairs: DataFrame, nodes: int) -> DataFrame:
    """``a, b, x, y``: pairs of so many nodes, in pairs of blocks of nodes."""
    blocks = max(1, nodes // BLOCK_NODES)
    return cut(pairs.withColumn("x", F.pmod(F.xxhash64("a"), F.lit(blocks))).withColumn("y", F.pmod(F.xxhash64("b"), F.lit(blocks))), "pairs")


def _needed(dealt: DataFrame) -> DataFrame:
    """``x, y, node``: a set goes once to each pair of blocks in which it is compared."""
    sides = [dealt.select("x", "y", F.col(c).alias("node")).distinct() for c in ("a", "b")]
    return sides[0].union(sides[1]).distinct()


def _similar(dealt: DataFrame, held: DataFrame, similarity: int) -> DataFrame:
    """``a, b`` of the dealt pairs that are similar enough, by their full sets ``held`` (x, y, node, set)."""
    held = held.select(F.col("x").alias("x2"), F.col("y").alias("y2"), "node", "set")
    return dealt.groupBy("x", "y").cogroup(held.groupBy("x2", "y2")).applyInArrow(_compare(similarity), "a bigint, b bigint")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: int, stars: bool = False) -> DataFrame:
    """The ``pairs`` (a, b) that are similar enough, by the full ``sets`` (node, set); ``stars`` are pairs as of ``_dealt_stars``."""
    dealt = _dealt_stars(pairs) if stars else _dealt(pairs, sets.count())
    return _similar(dealt, _needed(dealt).join(sets.select("node", "set"), "node"), similarity)


def _shared_elsewhere(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, shared``: how many shingles some node of another component has; no partner shares more."""
    shingles = sets.join(placed.select("node", "root").distinct(), "node").select("node", "root", F.explode("set").alias("s"))
    same = Window.partitionBy("s")
    elsewhere = shingles.withColumns({"r1": F.min("root").over(same), "r2": F.max("root").over(same)}).filter("r1 <> r2")
    return elsewhere.groupBy("node").agg(F.count("*").alias("shared"))


def near_duplicates(docs: DataFrame, similarity: int = 75) -> DataFrame:
    """``doc_id, digest, n_shingles, component_id, kept`` per row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast
    rows = cut(_keyed(docs).mapInArrow(_sign, _SIGNED), "signed")
    nodes = rows.filter("n > 0").groupBy("c1", "c2", "n").agg(
        F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "digest")).alias("of"), F.first("sig").alias("sig")
    )
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    sides = cut(sub_keys(nodes.select("node", "sig")), "sides")
    bucket = Window.partitionBy("key")
    keys = cut(tensor_keys(sides).withColumn("c", F.count("*").over(bucket)).filter("c > 1"), "buckets")
    meets = keys.groupBy("node").agg(F.sum("c").alias("meets"))
    reps = keys.join(meets, "node").groupBy("key").agg(F.max(F.struct("meets", "node"))["node"].alias("rep"))

    size = nodes.select("node", "n")
    close = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * similarity
    pairs = keys.join(reps, "key").filter("node <> rep").select(F.col("rep").alias("a"), F.col("node").alias("b")).distinct()
    pairs = pairs.join(size.select(F.col("node").alias("a"), F.col("n").alias("na")), "a")
    pairs = pairs.join(size.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b").filter(close).select("a", "b")
    dealt = _dealt_stars(pairs)

    met = nodes.join(keys.select("node").distinct(), "node").select("node", "of.doc_id", "of.digest")
    met = cut(met.withColumn("seek", F.xxhash64("digest", "doc_id")), "met")
    held = shared(bitmap(met, "seek"))
    texts = _keyed(docs).withColumn("seek", F.xxhash64("digest", "doc_id"))
    texts = texts.mapInArrow(_sets_task(held), "doc_id bigint, digest bigint, set array<bigint>, " + ", ".join(f"{w} bigint" for w in _WORDS))
    # a text is known by its id, which may be null, and its digest; repeats are dropped where the join has dealt them
    row = {"id": F.coalesce("doc_id", F.lit(0)), "none": F.isnull("doc_id")}
    blocks = _needed(dealt).groupBy(F.col("node").alias("of")).agg(F.collect_list(F.struct("x", "y")).alias("blocks"))
    met = met.join(blocks, F.col("node") == F.col("of"), "left").withColumns(row).select(*row, "digest", "node", "blocks")
    sets = texts.withColumns(row).join(met, [*row, "digest"]).dropDuplicates([*row, "digest"])
    sets = cut(sets.select("node", "set", "blocks", *_WORDS), "sets")
    links = cut(_similar(dealt, sets.select("node", "set", F.explode("blocks").alias("in")).select("in.x", "in.y", "node", "set"), similarity), "links")
    roots = cut(components(links), "roots")

    about = size.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = keys.select("key", "u", "v", "node").join(about, "node")
    placed = placed.withColumns({"r1": F.min("root").over(bucket), "r2": F.max("root").over(bucket), "least": F.min("n").over(bucket)})
    placed = cut(placed.filter("r1 <> r2").drop("r1", "r2"), "mixed")
    more_about = _shared_elsewhere(placed, sets).join(sides, "node").join(sets.select("node", *_WORDS), "node")
    more_about = cut(more_about.select("node", "shared", "us", "vs", *_WORDS), "about")
    smallest = F.greatest("least", F.ceil(F.col("n") * similarity / 100))
    enough = F.col("shared") * (100 + similarity) >= (F.col("n") + smallest) * similarity
    placed = placed.join(more_about, "node").filter(enough).drop("least").repartition("key")
    # both sides have the same columns, and so are dealt once
    left, right = (placed.select("key", *[F.col(c).alias(side + c) for c in placed.columns if c != "key"]) for side in ("a_", "b_"))
    similar_size = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * similarity
    possible = F.least("a_shared", "b_shared") * (100 + similarity) >= (F.col("a_n") + F.col("b_n")) * similarity
    differ = sum((F.bit_count(F.col("a_" + w).bitwiseXOR(F.col("b_" + w))) for w in _WORDS), F.lit(0))
    # a pair may share many keys: it is taken at that of its least common sub-keys
    earliest = lambda c: F.array_min(F.array_intersect(f"a_{c}s", f"b_{c}s")) == F.least("a_" + c, "b_" + c)
    once = earliest("u") & earliest("v")
    met_across = (left["key"] == right["key"]) & (F.col("a_root") < F.col("b_root")) & similar_size & possible
    across = left.join(right, met_across & (differ <= SKETCH - SKETCH_AGREE) & once)
    across = across.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    more = _confirmed(across, sets, similarity)
    roots = components(links.unionByName(cut(more, "links")))

    own = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).select("c1", "c2", "n", "root", "least")
    own = cut(own, "components")
    named = own.groupBy("root").agg(F.min("least").alias("component"))
    classes = own.join(named, "root").select("c1", "c2", "n", "component")
    found = rows.drop("sig").join(classes, ["c1", "c2", "n"], "left")
    return found.select(
        "doc_id", "digest", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
