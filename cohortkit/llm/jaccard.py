"""Exact n-gram Jaccard join with a count-vector R-tree.

Two documents link when the Jaccard index of their sets of word shingles is
``threshold`` percent or more.  The steps:

1. Shingles get one global order: rare first, by counts in ``2 ** ORDER_BITS``
   hashed buckets (a table of fixed size), then by hash.  Linked sets must
   share a shingle among the first n - ceil(threshold n) + 1 of each, so a
   shared early shingle puts documents in one *group*; frequent passages stand late and
   bring nobody together.
2. Within a group, shingles hashed into ``GROUPS`` groups make each
   set a vector of counts.  An R-tree over these points finds who can link: the summed
   coordinate minima bound the overlap, for a node by the maxima of its points.  A group
   hands on a star for every part that such bounds leave connected, never its pairs.
   Groups of over ``GROUP_ROWS`` are handed on as one star without the tree.
3. Components of the stars are *blocks*; every link is inside one.  The texts
   of their distinct sets are read once more and links verified exactly, the R-tree choosing
   what to compare and a pair already connected left out.  Blocks over ``BLOCK_BYTES``
   are cut into chunks and every two chunks meet in a task of their own.
4. Components of the verified links, joined back to all copies.

Equal sets are one node throughout, so copies are never compared.  Nothing is
capped or sampled: sizes only decide how work is divided.  Memory per task is bounded by a
group of ``GROUP_ROWS`` points or by two chunks.

Defined cases: a null text or one without words has no shingles and links with nothing; a text
of fewer words than a shingle is one shingle; repeated rows are each returned; a row without
an id has its number of shingles, but links with nothing and has a null component; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, stored, text_slices
from .graph import components
from .shingles import hashed_words, shingle_hashes, signed

ORDER_BITS = 18
GROUPS = 256
GROUP_ROWS = 4096
BLOCK_BYTES = 48 << 20
SLOTS = 1 << 20
SLICE_BYTES = 1 << 20
LEAF = 32


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    return [np.unique(shingle_hashes(words, k)) for words in hashed_words(texts)]


def released() -> None:
    """Gives the memory that Arrow holds free back, so that a worker's next task starts without it."""
    pa.default_memory_pool().release_unused()


def count_vector(shingles: np.ndarray) -> np.ndarray:
    return np.bincount((shingles & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)


def packed_vector(shingles: np.ndarray) -> bytes:
    """The count vector in bytes; counts over 255 are divided, rounding up, by the first number, so they stay bounds."""
    v = count_vector(shingles)
    scale = max(1, -(-int(v.max(initial=0)) // 255))
    return np.uint32(scale).tobytes() + (-(-v // scale)).astype(np.uint8).tobytes()


def unpacked(rows: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), 4 + GROUPS)
    scale = raw[:, :4].copy().view("<u4").astype(np.int32)
    return raw[:, 4:].astype(np.int32) * scale


class CountTree:
    """Points (count vectors with sizes) in leaves of near points, each leaf with its maxima and size range,
    and leaves in nodes of the same kind."""

    def __init__(self, vectors: np.ndarray, sizes: np.ndarray, threshold: int):
        self.vectors, self.sizes, self.threshold = vectors, sizes, threshold
        slope = np.random.default_rng(5).choice(np.array([-1, 1]), vectors.shape[1])
        self.order = np.lexsort((vectors @ slope, sizes // max(1, int(sizes.max(initial=1)) // 50)))
        self.levels = []
        top, low, high = vectors[self.order], sizes[self.order], sizes[self.order]
        while not self.levels or len(top) > LEAF:
            cuts = np.arange(0, len(top), LEAF)
            top, low, high = np.maximum.reduceat(top, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts)
            self.levels.append((top, low, high))

    def _can(self, i: int, tops, lows, highs) -> np.ndarray:
        """Which of these nodes may hold a set with 100 * overlap >= threshold * union with set i."""
        n, t = self.sizes[i], self.threshold
        other = np.maximum(lows, -(-t * n // 100))
        ok = (highs * 100 >= t * n) & (lows * t <= 100 * n)
        ok[ok] = (100 + t) * np.minimum(tops[ok], self.vectors[i]).sum(1, dtype=np.int64) >= t * (n + other[ok])
        return ok

    def search(self, i: int, open_points: np.ndarray) -> np.ndarray:
        """The points that may link with point i, of those marked open."""
        nodes = np.arange(len(self.levels[-1][0]))
        for k in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[k]
            nodes = nodes[self._can(i, top[nodes], low[nodes], high[nodes])]
            width = len(self.levels[k - 1][0]) if k else len(self.order)
            nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
            nodes = nodes[nodes < width]
        points = self.order[nodes]
        points = points[open_points[points]]
        return points[self._can(i, self.vectors[points], self.sizes[points], self.sizes[points])]


def parts_of(vectors, sizes, threshold: int, link) -> np.ndarray:
    """The part (number of one of its points) of each point.  The tree names the points outside
    the part of i that may link with i; ``link(i, js)`` says, 64 at a time, which of them do, and
    what has joined the part meanwhile is not asked about."""
    part = np.arange(len(sizes))
    if len(sizes) < 2:
        return part
    tree = CountTree(vectors, sizes, threshold)
    for i in range(len(sizes)):
        near = tree.search(i, part != part[i])
        while len(near):
            hit, near = link(i, near[:64]), near[64:]
            if len(hit):
                part[np.isin(part, part[hit])] = part[i]
                near = near[part[near] != part[i]]
    return part


def _bucket_counts(docs: DataFrame, k: int) -> np.ndarray:
    """Documents per hashed bucket of shingles: at most 2 ** ORDER_BITS numbers."""

    def count(batches):
        total = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            for _, texts in text_slices(batch.column(0), SLICE_BYTES):
                found = [s >> np.uint64(64 - ORDER_BITS) for s in shingle_sets(texts, k)]
                total += np.bincount(np.concatenate(found).astype(np.int64), minlength=1 << ORDER_BITS)
        released()
        at = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})

    rows = docs.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << ORDER_BITS, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def _signatures(docs: DataFrame, k: int, threshold: int) -> DataFrame:
    """``id, text_key, n, digest, node, early, vector`` of every document; node is half of the digest."""
    order = docs.sparkSession.sparkContext.broadcast(_bucket_counts(docs, k).astype(np.uint64))

    def sign(batches):
        counts = np.minimum(order.value, np.uint64((1 << 24) - 1)) << np.uint64(40)
        for batch in batches:
            for begin, texts in text_slices(batch.column(1), SLICE_BYTES):
                n, digest, node, early, vector = [], [], [], [], []
                for s in shingle_sets(texts, k):
                    n.append(len(s))
                    if not len(s):
                        digest.append(None), node.append(None), early.append(None), vector.append(None)
                        continue
                    d = xxhash.xxh3_128_digest(s.tobytes())
                    digest.append(d.hex())
                    node.append(int.from_bytes(d[8:], "big", signed=True))
                    rank = counts[s >> np.uint64(64 - ORDER_BITS)] | (s & np.uint64((1 << 40) - 1))
                    p = len(s) - -(-threshold * len(s) // 100) + 1
                    early.append(signed(s[rank <= np.partition(rank, p - 1)[p - 1]]))  # ties all in: a superset
                    vector.append(packed_vector(s))
                yield pa.record_batch({"id": batch.column(0).slice(begin, len(texts)), "text_key": batch.column(2).slice(begin, len(texts)), "n": pa.array(n, pa.int64()), "digest": pa.array(digest, pa.string()),
                                       "node": pa.array(node, pa.int64()), "early": pa.array(early, pa.list_(pa.int64())), "vector": pa.array(vector, pa.binary())})
        released()

    return stored(docs.select("id", "text", F.xxhash64("text").alias("text_key")).mapInArrow(sign, "id bigint, text_key bigint, n bigint, digest string, node bigint, early array<bigint>, vector binary"), "jaccard-signatures")


def _stars(signs: DataFrame, threshold: int) -> DataFrame:
    """Edges (a, b) between nodes such that linked sets are in one component."""
    early = signs.select("node", F.explode("early").alias("s"))
    shared = stored(early.groupBy("s").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("s"), "jaccard-shared")
    members = stored(early.join(shared, "s").select("s", "node").distinct(), "jaccard-members")
    # Groups with the same members are one: known by size, least node and two hashes of the members.
    groups = members.groupBy("s").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("least"),
                                      F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    groups = stored(groups.filter("size > 1").groupBy("size", "least", "x", "y").agg(F.min("s").alias("s")).select("s", "size", "least"), "jaccard-groups")
    rows = stored(members.join(groups, "s"), "jaccard-group-rows")
    wide = rows.filter(F.col("size") > GROUP_ROWS).select(F.col("node").alias("a"), F.col("least").alias("b"))

    points = signs.select("node", "n", "vector").dropDuplicates(["node"])
    deal = F.pmod(F.xxhash64("s"), F.lit(max(1, rows.count() // 30_000)))
    tasks = rows.filter(F.col("size") <= GROUP_ROWS).select("s", "node").join(points, "node").withColumn("deal", deal)

    def stars(part: pa.Table) -> pa.Table:
        part = part.sort_by("s")
        s, node, n = (part[c].to_numpy() for c in ("s", "node", "n"))
        raw = part["vector"]
        a, b = [], []
        starts = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        for lo, hi in zip(starts, np.r_[starts[1:], len(s)]):
            if hi - lo < 2:
                continue
            own = parts_of(unpacked(raw[int(lo):int(hi)].to_pylist()), n[lo:hi], threshold, lambda i, js: js)
            here = node[lo:hi]
            far = own != np.arange(hi - lo)
            a.extend(here[far].tolist())
            b.extend(here[own[far]].tolist())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return stored(tasks.groupBy("deal").applyInArrow(stars, "a bigint, b bigint").unionByName(wide), "jaccard-stars")


def _verified(docs: DataFrame, signs: DataFrame, blocks: DataFrame, k: int, threshold: int) -> DataFrame:
    """Edges (a, b) of digests: a forest of exact links within each block or pair of chunks."""
    first = stored(signs.groupBy("node", "digest").agg(F.min("id").alias("id"), F.max("n").alias("n")).join(blocks, "node"), "jaccard-first")
    per_block = first.groupBy("label").agg(F.ceil(F.sum(F.col("n") * 8 + 600) / BLOCK_BYTES).cast("int").alias("chunks"))
    first = stored(first.join(per_block, "label").select("id", "digest", "label", "chunks"), "jaccard-to-read")
    # A table of at most SLOTS numbers keeps most of the other texts from the shuffle.
    slot = F.pmod(F.xxhash64("id"), F.lit(SLOTS))
    slots = first.select(slot.alias("slot")).distinct()
    texts = docs.withColumn("slot", slot).join(F.broadcast(slots), "slot", "left_semi").select("id", "text")
    read = texts.join(first.hint("shuffle_hash"), "id").select("text", "digest", "label", "chunks")

    def sets(batches):
        for batch in batches:
            for begin, part in text_slices(batch.column(0), SLICE_BYTES):
                got = shingle_sets(part, k)
                keep = [xxhash.xxh3_128_hexdigest(s.tobytes()) == d for s, d in zip(got, batch.column(1).slice(begin, len(part)).to_pylist())]
                out = pa.record_batch({"digest": batch.column(1).slice(begin, len(part)), "label": batch.column(2).slice(begin, len(part)),
                                       "chunks": batch.column(3).slice(begin, len(part)), "shingles": pa.array([s.tobytes() for s in got], pa.binary())})
                yield out.filter(pa.array(keep, pa.bool_()))
        released()

    have = read.mapInArrow(sets, "digest string, label bigint, chunks int, shingles binary")
    chunk = F.pmod(F.xxhash64("digest"), F.col("chunks")).cast("int")
    have = have.withColumn("c", chunk).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    have = have.select("label", F.least("c", "with").alias("i"), F.greatest("c", "with").alias("j"), "digest", "shingles")

    def links(part: pa.Table) -> pa.Table:
        digests = part["digest"].to_pylist()
        firsts: dict[str, int] = {}
        for x, d in enumerate(digests):
            firsts.setdefault(d, x)  # a repeated row has the same set
        at = list(firsts.values())
        digests = [digests[x] for x in at]
        sets_ = [np.frombuffer(part["shingles"][x].as_buffer(), np.uint64) for x in at]
        vectors = np.stack([count_vector(s) for s in sets_]).astype(np.int32)
        sizes = np.array([len(s) for s in sets_], np.int64)

        def link(i, js):
            hit = []
            for x in js:
                both = len(np.intersect1d(sets_[i], sets_[x], assume_unique=True))
                if 100 * both >= threshold * (sizes[i] + sizes[x] - both):
                    hit.append(x)
            return np.array(hit, int)

        own = parts_of(vectors, sizes, threshold, link)
        far = [x for x in range(len(own)) if own[x] != x]
        return pa.table({"a": pa.array([digests[x] for x in far], pa.string()), "b": pa.array([digests[own[x]] for x in far], pa.string())})

    return stored(have.groupBy("label", "i", "j").applyInArrow(links, "a string, b string"), "jaccard-links")


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: int = 80) -> DataFrame:
    """``id, n_shingles, component_id`` per row."""
    return _similar(docs, id_col, text_col, k, threshold).drop("text_key")


def _similar(docs: DataFrame, id_col: str, text_col: str, k: int, threshold: int) -> DataFrame:
    """``similar`` with a hash of each row's text."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    all_signs = _signatures(rows, k, threshold)
    signs = all_signs.filter("n > 0 AND id IS NOT NULL")
    blocks = components(_stars(signs, threshold))
    linked = components(_verified(rows, signs, blocks, k, threshold))
    least = signs.groupBy("digest").agg(F.min("id").alias("least"))
    classes = least.join(linked.withColumnRenamed("node", "digest"), "digest").select("digest", "label", "least")
    parts = classes.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = stored(least.join(linked.withColumnRenamed("node", "digest"), "digest", "left").join(parts, "label", "left")
                     .select("digest", F.coalesce("component_id", "least").alias("component_id")), "jaccard-classes")
    return all_signs.select("id", "text_key", "n", "digest").join(classes, "digest", "left").select(
        "id", "text_key", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: int = 80) -> DataFrame:
    """``docs`` with one document of each component, that with the smallest id.
    Repeated rows of it all stay, as do rows without an id.  Of different texts with one id each is judged on its own."""
    found = _similar(docs, id_col, text_col, k, threshold)
    gone_id, gone_key = free_name(docs, "_gone_id"), free_name(docs, "_gone_key")
    gone = found.filter("component_id <> id").select(F.col("id").alias(gone_id), F.col("text_key").alias(gone_key)).distinct()
    return docs.join(gone, (F.col(id_col).cast("bigint") == F.col(gone_id)) & (F.xxhash64(text_col) == F.col(gone_key)), "left_anti")
