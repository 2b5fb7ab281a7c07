"""Near duplicates by BagMinHash.

A text is the multiset of its runs of five words (all its words if it has fewer). Each element has a Poisson process on
weight times time. The weights, which are counts here, are cut into blocks [0, 1), [1, 2), [2, 4), [4, 8) and so on; a block
has a process of its own, and the place of a point inside its block, found by halving, says from which weight on the
point counts. Each point goes to one register, which keeps the earliest: two texts agree in a register with a probability that
is their weighted Jaccard similarity. A process is followed only as long as it can still lower a register.

Signatures are cut into bands. Equal texts (equal word sequences; texts without words: equal strings) are one node. Nodes
that share a band are candidates and are verified by the exact similarity of their multisets; linked nodes form classes.
In a band's bucket a star around one node is verified first, with another centre in each band; afterwards the pairs of the
bucket whose classes still differ are verified as well, so no candidate is lost, and pairs inside a class aren't made.
Of these, first those with the bucket's most central node are verified; nodes and pairs that share too few members with any other
node to be linked are passed over, which loses nothing.

Nodes are named by 64 bits of a cryptographic hash of the word sequence. Nulls count as empty texts. Rows without an id get the class of their copies, or null if none has an id.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_bytes, bounded_batches, fresh, materialise, record_batches
from .words import WORD, mix, occurrences, shingles, word_hashes

WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS = 30, 6
#: Nodes that occur in candidate pairs are broadcast (8 bytes each) up to this many to pick their multisets.
BROADCAST_NODES = 1_000_000
#: Groups of members whose counts bound what two nodes can have in common.
PARTS = 64
#: Places that a class's id goes to.
SALTS = 16
#: Bounds on whole numbers of members are lowered by this, for products that are rounded up.
SLACK = 1e-6

_G1, _G2, _G3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int) -> np.ndarray:
    """Registers (len(bags), m) of the bags, each (distinct hashes, counts). An empty bag's registers are infinite."""
    n = len(bags)
    reg = np.full(n * m, np.inf)
    sizes = [len(b[0]) for b in bags]
    if not sum(sizes):
        return reg.reshape(n, m)
    element = np.concatenate([b[0] for b in bags])
    weight = np.concatenate([b[1] for b in bags]).astype(np.int64)
    owner = np.repeat(np.arange(n), sizes)
    blocks = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    which = np.repeat(np.arange(len(element)), blocks)
    j = np.arange(len(which)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    low = np.where(j == 0, 0, np.left_shift(1, np.maximum(j - 1, 0)))
    size = np.where(j == 0, 1, low)
    seed = mix(element[which] + j.astype(np.uint64) * _G2)
    doc, w, rate, time = owner[which], weight[which], size.astype(float), np.zeros(len(which))
    k = 0
    while len(doc):
        k += 1
        r = mix(seed + np.uint64(k * int(_G1) & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(((r >> np.uint64(11)).astype(float) + 0.5) / 2.0**53) / rate
        r = mix(r ^ _G3)
        place = low + (((r & np.uint64(0xFFFFFFFF)) * size.astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        register = (((r >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
        inside = place < w
        np.minimum.at(reg, (doc * m + register)[inside], time[inside])
        if k <= 4 or k % 4 == 0:
            at, back = np.unique(doc, return_inverse=True)
            live = time < reg.reshape(n, m)[at].max(1)[back]
            if not live.all():
                seed, doc, w, rate, time, low, size = (x[live] for x in (seed, doc, w, rate, time, low, size))
    return reg.reshape(n, m)


def bands(reg: np.ndarray, n_bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit hash of each band, which tells the bands apart."""
    v = reg.view(np.uint64).reshape(len(reg), n_bands, rows)
    out = np.tile(np.arange(1, n_bands + 1, dtype=np.uint64) * _G2, (len(reg), 1))
    for i in range(rows):
        out = mix(out ^ v[:, :, i]) * _G1
    return mix(out).view(np.int64)


def bag(h: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Distinct shingles and counts of a text's word hashes, and its multiset as sorted 64-bit hashes of (shingle, occurrence)."""
    s = np.sort(shingles(h, width))
    if not len(s):
        return s, np.empty(0, np.int64), b""
    nth = occurrences(s)
    first = np.flatnonzero(nth == 0)
    members = np.sort(mix(s + nth.astype(np.uint64) * _G3))
    return s[first], np.diff(first, append=len(s)), members.tobytes()


def similarity(a: bytes, b: bytes) -> float:
    """Weighted Jaccard similarity of two multisets."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if not len(x) or not len(y):
        return 0.0
    both = np.sort(np.concatenate([x, y]), kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(both) - common)


def sketch(docs: DataFrame, id_col: str, text_col: str, n_bands: int, rows: int) -> DataFrame:
    """(id, node, size, bands, members) of each row."""
    kind = dict(docs.dtypes)[id_col]

    def run(it):
        for b in record_batches(it, 1 << 20):
            texts = as_bytes(b.column(1))
            nodes = []
            for t in texts:
                words = t.translate(WORD).split()
                nodes.append(int.from_bytes(hashlib.blake2b(b" ".join(words) if words else b"\0" + t, digest_size=8).digest(), "big", signed=True))
            h, offsets = word_hashes(texts)
            bags = [bag(h[i:j]) for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
            found = bands(signatures([x[:2] for x in bags], n_bands * rows), n_bands, rows)
            keys = [list(f) if len(x[0]) else [] for f, x in zip(found, bags, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(nodes, pa.int64()), pa.array([len(x[2]) // 8 for x in bags], pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array([x[2] for x in bags], pa.binary())], ["_id", "_node", "_size", "_bands", "_members"])

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, f"_id {kind}, _node long, _size int, _bands array<long>, _members binary")


def _verified(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Of the distinct pairs (a, b) those with at least this similarity. Only multisets of nodes in pairs are moved."""
    pairs = materialise(pairs, "pairs")
    nodes = materialise(pairs.select(F.explode(F.array("a", "b")).alias("_node")).distinct(), "paired")
    if nodes.count() <= BROADCAST_NODES:
        nodes = F.broadcast(nodes)
    members = materialise(sketches.select("_node", "_members").join(nodes, "_node", "left_semi").groupBy("_node").agg(F.first("_members").alias("_members")), "members")
    a = members.select(F.col("_node").alias("a"), F.col("_members").alias("_ma"))
    b = members.select(F.col("_node").alias("b"), F.col("_members").alias("_mb"))
    measure = F.arrow_udf(lambda x, y: pa.array([similarity(p, q) for p, q in zip(x.to_pylist(), y.to_pylist(), strict=True)], pa.float64()), "double")
    return pairs.join(a, "a").join(b, "b").select("a", "b", measure("_ma", "_mb").alias("_s")).where(F.col("_s") >= least).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in the links (a, b): root is the least node of its component. Alternates two steps that hang
    a node's larger, then its smaller neighbours onto the least of them, until nothing changes."""
    edges = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")

    def state(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(r)

    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select("a", F.least("a", "_m").alias("_m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("_m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(low.select("a", F.col("_m").alias("b"))).where("a <> b").distinct()
        edges = materialise(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("_node"), F.col("b").alias("_root"))


def _distinct_pairs(pairs: DataFrame, least: float) -> DataFrame:
    """Each pair once; pairs whose sizes rule the similarity out go."""
    fit = F.least("sa", "sb") >= F.greatest("sa", "sb") * F.lit(least) - SLACK
    return pairs.where(fit & (F.col("a") != F.col("b"))).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _between(shared: DataFrame, found: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """(_band, _node, _size, _common, _parts, _root, _centre) of the nodes in bands of several classes that can have a link to another class.
    _common is how many members a node shares with any other of these; a link takes least of the larger node's members, so nodes
    with fewer go; _parts counts them by PARTS groups of hashes. The bucket's centre is the node that shares the most of its members."""
    roots = shared.join(found, "_node", "left").select("_band", "_node", "_size", F.coalesce("_root", "_node").alias("_root"))
    mixed = roots.groupBy("_band").agg(F.min("_root").alias("_lo"), F.max("_root").alias("_hi")).where("_lo <> _hi").select("_band")
    rest = materialise(roots.join(mixed, "_band"), "rest")
    nodes = materialise(rest.select("_node").distinct(), "mixed")
    if nodes.count() <= BROADCAST_NODES:
        nodes = F.broadcast(nodes)
    bags = sketches.select("_node", "_members").join(nodes, "_node", "left_semi").groupBy("_node").agg(F.first("_members").alias("_members"))

    def members(it):
        for b in record_batches(it, 1 << 20):
            got = [np.frombuffer(x, np.uint64) >> np.uint64(32) for x in b.column(1).to_pylist()]  # fewer bits only loosen the bounds
            each = np.concatenate(got).astype(np.int64) if got else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.repeat(np.arange(len(got)), [len(g) for g in got]))), pa.array(each)], ["_node", "_member"])

    each = materialise(bags.mapInArrow(members, "_node long, _member long"), "members")
    often = each.groupBy("_member").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_member")
    group = F.col("_member") % PARTS
    parts = F.array(*[F.count_if(group == i).cast("int") for i in range(PARTS)])
    common = each.join(often, "_member").groupBy("_node").agg(F.count(F.lit(1)).alias("_common"), parts.alias("_parts"))
    left = rest.join(common, "_node").where(F.col("_common") >= F.col("_size") * F.lit(least) - SLACK)
    centre = left.groupBy("_band").agg(F.max(F.struct((F.col("_common") / F.col("_size")).alias("share"), F.col("_node").alias("node")))["node"].alias("_c"))
    return materialise(left.join(centre, "_band").withColumn("_centre", F.col("_node") == F.col("_c")).drop("_c"), "left")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY, n_bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, class_id) of each row: class_id is the least id of its near duplicates, its own if it has none."""
    bounded_batches(docs.sparkSession)
    sketches = materialise(sketch(docs, id_col, text_col, n_bands, rows), "bags")
    nodes = sketches.groupBy("_node").agg(F.min("_id").alias("_least"), F.first("_size").alias("_size"))
    once = sketches.where(F.size("_bands") > 0).select("_node", "_size", "_bands").dropDuplicates(["_node"])  # copies have equal bags
    in_band = once.select(F.explode("_bands").alias("_band"), "_node", "_size")
    order = F.xxhash64("_band", "_node")
    buckets = in_band.groupBy("_band").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(order.alias("o"), F.col("_node").alias("node"), F.col("_size").alias("size"))).alias("_c")).where("_n > 1")
    shared = materialise(in_band.join(buckets, "_band"), "buckets")  # only nodes that share a band with another
    star = shared.select(F.col("_c.node").alias("a"), F.col("_node").alias("b"), F.col("_c.size").alias("sa"), F.col("_size").alias("sb"))
    links = materialise(_verified(_distinct_pairs(star, least), sketches, least), "verified")
    found = components(links)
    for central in (True, False):  # what remains between classes: against a bucket's most central node, then all of it
        rest = _between(shared, found, sketches, least)
        x, y = (rest.select("_band", F.col("_node").alias(n), F.col("_size").alias(s), F.col("_common").alias(c), F.col("_parts").alias(p), F.col("_root").alias(r), F.col("_centre").alias(z)) for n, s, c, p, r, z in (("a", "sa", "ca", "pa", "ra", "za"), ("b", "sb", "cb", "pb", "rb", "zb")))
        needed = (F.col("sa") + F.col("sb")) * F.lit(least / (1 + least)) - SLACK  # members that a link has in common
        fit = (F.least("ca", "cb") >= needed) & (sum((F.least(F.col("pa")[i], F.col("pb")[i]) for i in range(PARTS)), F.lit(0)) >= needed)
        differ = (F.col("ra") != F.col("rb")) & F.col("za") if central else F.col("ra") > F.col("rb")
        pairs = x.hint("merge").join(y, (x["_band"] == y["_band"]) & differ & fit)
        links = materialise(links.unionByName(_verified(_distinct_pairs(pairs, least), sketches, least)), "verified")
        found = components(links)
    # A class's least id comes from its members' least ids and goes back to them. Only linked nodes move, and a class with many
    # members goes to SALTS places.
    linked = nodes.join(found, "_node").select("_node", "_least", "_root").unionByName(nodes.join(found.select(F.col("_root").alias("_node")).distinct(), "_node", "left_semi").select("_node", "_least", F.col("_node").alias("_root")))
    linked = materialise(linked.distinct(), "linked")
    ids = linked.groupBy("_root").agg(F.min("_least").alias("_class")).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = linked.withColumn("_salt", F.pmod(F.xxhash64("_node"), F.lit(SALTS)).cast("int")).join(ids, ["_root", "_salt"]).select("_node", "_class")
    by_node = nodes.select("_node", "_least").join(named, "_node", "left").select("_node", F.coalesce("_class", "_least").alias("_class"))
    return sketches.select("_id", "_node").join(by_node, "_node").select(F.col("_id").alias(id_col), F.col("_class").alias("class_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """docs without near duplicates: of each class one row stays, that with the least id (rows without an id come last), of
    rows with one id the first by their hash. Rows are told apart by id and hash, so rows of one id can be in different classes."""
    key, n, k = fresh(docs, "_key", "_nth", "_kept")
    own = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("hash"))
    keyed = docs.withColumn(key, own.cast(f"struct<none:boolean,id:{dict(docs.dtypes)[id_col]},hash:bigint>"))  # as read back, where all can be null: else the join casts
    kept = classes(keyed, key, text_col, least).where(F.col(key) == F.col("class_id")).select(F.col(key).alias(k)).distinct()
    one = keyed.join(kept, F.col(key) == F.col(k), "left_semi")  # by the column that rows are numbered by: texts move once
    return one.withColumn(n, F.row_number().over(Window.partitionBy(key).orderBy(key))).where(F.col(n) == 1).drop(n, key)
