"""Near-duplicate documents by DartMinHash signatures and banded joins.

A document is the weighted set of its shingles of five words. Hashed darts thrown
into each shingle's weight region give a short signature; documents that agree in
a band of it share a bucket. Links are verified by exact weighted Jaccard similarity:

1. equal texts are one node;
2. in each bucket all nodes are compared with the bucket's hub, and the links found
   are joined into components;
3. buckets still holding several components are compared exhaustively, except
   within their main component, in blocks of bounded size; a task compares two blocks in
   memory and returns at most a spanning forest of the links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestats.llm.common import fresh, materialize, mix64, release_memory, shingle_hashes, text_slices, tidy, word_codes, word_hashes
from homestats.llm.components import connected_components

WIDTH = 5
#: 24 bands of 5 coordinates: two documents of similarity 0.8 miss each other with probability 0.0001.
BANDS, BAND_ROWS = 24, 5
#: A node's elements are kept as 48 bits each.
ELEMENT_BYTES = 6
BLOCK_NODES, BLOCK_BYTES = 512, 4 << 20
#: Texts are signed in slices of about this many bytes.
SIGN_BYTES = 2 << 20
#: Darts of so many documents are in memory at a time.
DART_SETS = 512
#: Up to this many keys of 16 bytes are broadcast; more are joined by shuffle.
BROADCAST_NODES = 500_000


def plain_word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bounds, hashes)`` of each text's words in lower case without marks at their ends; bare marks are no words."""
    bounds, codes, words = word_codes(texts)
    plain = pc.replace_substring_regex(pc.utf8_lower(words), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    hashes = word_hashes(plain)
    real = pc.not_equal(plain, "").to_numpy(zero_copy_only=False)
    keep = real[codes] if len(codes) else np.zeros(0, bool)
    bounds = np.concatenate(([0], np.cumsum(keep)))[bounds]
    return bounds, hashes[codes[keep]]


def weighted_shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bounds, shingles, weights)``: each text's distinct shingles of five words and how often each occurs."""
    bounds, hashes = plain_word_codes(texts)
    shingles, bounds = shingle_hashes(hashes, bounds, WIDTH)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((shingles, doc))
    s, d = shingles[order], doc[order]
    new = np.concatenate(([True], (s[1:] != s[:-1]) | (d[1:] != d[:-1]))) if len(s) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    weights = np.diff(np.append(at, len(s)))
    sizes = np.bincount(d[at], minlength=len(bounds) - 1)
    return np.concatenate(([0], np.cumsum(sizes))), s[at], weights


def _uniform(h: np.ndarray) -> np.ndarray:
    """In (0, 1], from 53 bits of a hash."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def dart_minhash(bounds: np.ndarray, elements: np.ndarray, weights: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Signatures of ``k`` coordinates of weighted sets; sets without elements get zeros.

    The weight axis of an element is cut into regions [0, 1), [1, 2), [2, 4), ...
    In each, darts fall in order of rank, with exponential gaps in proportion to
    the region's width; a dart's weight, coordinate and name are hashes of the
    element, region and number, the same in whatever set the element occurs. A dart
    counts if its weight is below the element's, and each coordinate keeps the
    earliest. Two sets agree on a coordinate with the probability of their weighted
    Jaccard similarity. Only ranks up to a bound that nearly always fills all coordinates
    are looked at (``k ln k`` darts and some per set); a set left with an empty
    coordinate gets a bound four times as high.
    """
    n = len(bounds) - 1
    if n > DART_SETS:
        cuts = range(0, n, DART_SETS)
        parts = [(bounds[a : a + DART_SETS + 1] - bounds[a], slice(bounds[a], bounds[min(n, a + DART_SETS)])) for a in cuts]
        return np.concatenate([dart_minhash(b, elements[s], weights[s], k, seed) for b, s in parts])
    out = np.zeros((n, k), np.uint64)
    todo = np.flatnonzero(np.diff(bounds) > 0)
    mass = np.add.reduceat(weights, bounds[todo]) if len(todo) else np.empty(0)
    factor = 1.0
    while len(todo):
        limit = factor * k * (np.log(k) + 3) / mass
        sizes = bounds[todo + 1] - bounds[todo]
        owner = np.repeat(np.arange(len(todo)), sizes)
        at = np.repeat(bounds[todo] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        element, weight = elements[at], weights[at].astype(np.float64)
        best = np.zeros((len(todo), k), np.uint64)
        filled = np.zeros((len(todo), k), bool)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        low, region = 0.0, 0
        while len(element):
            width = 1.0 if region < 2 else float(1 << (region - 1))
            name = mix64(element ^ mix64(np.array([(seed << 32) + (region << 24)], np.uint64)))
            rank, who, w, dart = np.zeros(len(element)), owner, weight, 0
            while len(name):
                h = mix64(name + np.uint64(3 * dart + 1))
                rank = rank - np.log(_uniform(h)) / width
                near = rank <= limit[who]
                name, rank, who, w = name[near], rank[near], who[near], w[near]
                h = mix64(name + np.uint64(3 * dart + 2))
                hit = low + width * (1 - _uniform(h)) < w
                label = mix64(name + np.uint64(3 * dart + 3))
                found.append((who[hit], (label[hit] >> np.uint64(40)) % np.uint64(k), rank[hit], label[hit]))
                dart += 1
            low, region = low + width, region + 1
            more = weight > low
            element, weight, owner = element[more], weight[more], owner[more]
        who, place, rank, label = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(-rank, kind="stable")
        spot = who[order] * k + place[order].astype(np.int64)
        best.ravel()[spot] = label[order]  # of darts at one spot the earliest is written last
        filled.ravel()[spot] = True
        done = filled.all(1)
        out[todo[done]] = best[done]
        todo, mass = todo[~done], mass[~done]
        factor *= 4
    return out


# ---- tasks ----


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit key per band that tells bands apart too."""
    n = len(signatures)
    parts = signatures.reshape(n, BANDS, BAND_ROWS)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (n, BANDS)).copy()
    for i in range(BAND_ROWS):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys


@F.arrow_udf(T.ArrayType(T.LongType()))
@tidy
def bands_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Band keys of whole texts; null for a text without words."""
    for texts in batches:
        parts = []
        for a, b in text_slices(texts, SIGN_BYTES):
            bounds, shingles, weights = weighted_shingles(texts[a:b])
            keys = band_keys(dart_minhash(bounds, shingles, weights, BANDS * BAND_ROWS)).view(np.int64)
            none = pa.array(np.diff(bounds) == 0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
            parts.append(pc.if_else(none, pa.scalar(None, lists.type), lists))
        yield pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int64()))


@F.arrow_udf(T.BinaryType())
@tidy
def elements_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The weighted set of whole texts as sorted distinct elements: a shingle's i-th occurrence is one."""
    for texts in batches:
        out = []
        for a, b in text_slices(texts, SIGN_BYTES):
            bounds, shingles, weights = weighted_shingles(texts[a:b])
            first = np.cumsum(weights) - weights
            nth = (np.arange(int(weights.sum())) - np.repeat(first, weights)).astype(np.uint64)
            expanded = mix64(np.repeat(shingles, weights) + nth * np.uint64(0x9E3779B97F4A7C15))
            ends = np.concatenate(([0], np.cumsum(weights)))[bounds]
            for i in range(b - a):
                values = np.sort(expanded[ends[i] : ends[i + 1]] >> np.uint64(64 - 8 * ELEMENT_BYTES))
                out.append(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :ELEMENT_BYTES]).tobytes())
        yield pa.array(out, pa.binary())


def unpack(elements: bytes) -> np.ndarray:
    raw = np.frombuffer(elements, np.uint8).reshape(-1, ELEMENT_BYTES)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :ELEMENT_BYTES] = raw
    return out.view("<u8").ravel()


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted sets."""
    if not len(a) or not len(b):
        return 0.0
    common = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return common / (len(a) + len(b) - common)


def similarities(sets: list[np.ndarray]) -> np.ndarray:
    """Similarities of all pairs of some sets, by products of their incidence matrix a few columns at a time.

    Elements of a single set are left out of the products, so the diagonal has no meaning.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n, dtype=np.int32), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    del order
    new = np.concatenate(([True], flat[1:] != flat[:-1])) if len(flat) else np.zeros(0, bool)
    element = np.cumsum(new, dtype=np.int32) - 1
    del flat, new
    shared = np.bincount(element) > 1 if len(element) else np.zeros(0, bool)
    keep = shared[element] if len(element) else shared
    owner, element = owner[keep], (np.cumsum(shared) - 1)[element[keep]]
    common = np.zeros((n, n), np.float32)
    step = 4096
    edges = np.searchsorted(element, np.arange(0, (int(element[-1]) if len(element) else -1) + step + 1, step))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        if a == b:
            continue
        block = np.zeros((n, step), np.float32)
        block[owner[a:b], element[a:b] - k * step] = 1
        common += block @ block.T
    union = sizes[:, None] + sizes[None, :] - common
    return np.divide(common, union, out=np.zeros((n, n)), where=union > 0)


class Forest:
    """Union-find over the rows of a task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def links_in_blocks(roots: list[bytes], sides: np.ndarray, sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """A spanning forest of the links between rows of different components.

    Rows of both sides of a task are compared across; those of a block alone (all on
    side 0) with each other.
    """
    n = len(sets)
    number = {r: i for i, r in enumerate(dict.fromkeys(roots))}
    root = np.array([number[r] for r in roots])
    differ = root[:, None] != root[None, :]
    if sides.any():
        differ &= sides[:, None] != sides[None, :]
    a, b = np.nonzero(np.triu(differ, 1))
    if n <= 6:
        linked = [(int(i), int(j)) for i, j in zip(a, b, strict=True) if jaccard(sets[i], sets[j]) >= least]
    else:
        close = similarities(sets)[a, b] >= least - 1e-9
        linked = list(zip(a[close].tolist(), b[close].tolist(), strict=True))
    forest = Forest(len(number))
    return [(i, j) for i, j in linked if forest.join(int(root[i]), int(root[j]))]


# ---- Spark ----


def text_node(text: Column) -> Column:
    """Equal texts have equal nodes (16 bytes)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _of_nodes(df: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``node`` is in ``nodes``: by broadcast after counting them, else by shuffle."""
    few = nodes.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES
    return df.join(F.broadcast(nodes) if few else nodes, "node", "left_semi")


def near_duplicate_links(docs: DataFrame, least: float, text: str) -> tuple[DataFrame, DataFrame]:
    """``(node, root)`` of the nodes that have links, and the links used ``(a, b)``."""
    texts = docs.select(F.col(text).alias("text"))
    signed = materialize(texts.select(text_node(F.col("text")).alias("node"), bands_of(F.col("text")).alias("bands")), "dart-bands")
    nodes = signed.filter("bands IS NOT NULL").dropDuplicates(["node"])
    rows = nodes.select("node", F.posexplode("bands").alias("band", "key")).select("node", "key")

    # Buckets of two nodes or more. Each band has another order of hubs, so nodes meet different hubs.
    order = F.xxhash64("node", F.col("key"))
    buckets = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(order.alias("o"), "node")).alias("hub"))
    buckets = buckets.filter("n > 1").select("key", F.col("hub.node").alias("hub"))
    members = materialize(rows.join(buckets, "key"), "dart-buckets")
    involved = materialize(members.select("node").distinct(), "dart-nodes")
    with_text = _of_nodes(texts.withColumn("node", text_node(F.col("text"))), involved)
    elements = with_text.select("node", elements_of(F.col("text")).alias("elements")).dropDuplicates(["node"])
    elements = materialize(elements, "dart-elements")

    # 1. every node against the hubs of its buckets
    pairs = members.filter("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()

    @F.arrow_udf(T.BooleanType())
    def alike(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([jaccard(unpack(a.as_py()), unpack(b.as_py())) >= least for a, b in zip(x, y, strict=True)], pa.bool_())

    first = elements.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    second = elements.select(F.col("node").alias("b"), F.col("elements").alias("y"))
    checked = pairs.join(first, "a").join(second, "b").filter(alike("x", "y")).select("a", "b")
    hub_links = materialize(checked, "dart-links")
    roots = materialize(connected_components(hub_links), "dart-roots")

    # 2. buckets with several components
    placed = members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    sized = placed.join(elements.select("node", F.octet_length("elements").cast("long").alias("bytes")), "node")
    parts = sized.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    open_buckets = parts.groupBy("key").agg(
        F.count(F.lit(1)).alias("roots"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"),
        F.max(F.struct("n", "bytes", "root")).alias("main"),
    ).filter("roots > 1")

    def blocks(n: Column, size: Column) -> Column:
        return F.ceil(F.greatest(n / BLOCK_NODES, size / BLOCK_BYTES)).cast("int")

    split = open_buckets.select(
        "key", F.col("main.root").alias("main"),
        blocks(F.col("main.n"), F.col("main.bytes")).alias("main_blocks"),
        blocks(F.col("n") - F.col("main.n"), F.col("bytes") - F.col("main.bytes")).alias("other_blocks"),
        (blocks(F.col("n"), F.col("bytes")) == 1).alias("single"),
    )
    dealt = F.pmod(F.xxhash64("node"), F.when(F.col("root") == F.col("main"), F.col("main_blocks")).otherwise(F.col("other_blocks"))).cast("int")
    block = F.when(F.col("single"), 0).when(F.col("root") == F.col("main"), dealt).otherwise(F.col("main_blocks") + dealt)
    # a block of the main component meets all other blocks; any other block meets every block, itself included
    others = F.sequence(F.col("main_blocks"), F.col("main_blocks") + F.col("other_blocks") - 1)
    everything = F.sequence(F.lit(0), F.col("main_blocks") + F.col("other_blocks") - 1)
    meets = F.when(F.col("single"), F.array(F.lit(0))).when(F.col("block") < F.col("main_blocks"), others).otherwise(everything)
    tasks = (
        placed.join(split, "key").withColumn("block", block).withColumn("meets", F.explode(meets))
        .select(
            "key", "node", "root", F.least("block", "meets").alias("p"), F.greatest("block", "meets").alias("q"),
            (F.col("block") > F.col("meets")).cast("int").alias("side"),
        )
    )
    link = T.StructType([T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())])

    def compare(table: pa.Table) -> pa.Table:
        node = table["node"].to_pylist()
        sets = [unpack(e) for e in table["elements"].to_pylist()]
        found = links_in_blocks(table["root"].to_pylist(), table["side"].to_numpy(), sets, least)
        del sets
        release_memory()
        return pa.table({"a": pa.array([node[i] for i, _ in found], pa.binary()), "b": pa.array([node[j] for _, j in found], pa.binary())})

    block_links = tasks.join(elements, "node").groupBy("key", "p", "q").applyInArrow(compare, link)
    links = materialize(hub_links.unionByName(block_links), "dart-all-links")
    return connected_components(links), links


def near_duplicate_classes(docs: DataFrame, least: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, class_id, class_size)`` of every row: near-duplicates have the same class.

    Similarity is the weighted Jaccard similarity of the multisets of five-word
    shingles, words in lower case without marks at their ends; a text of one to four
    words is one shingle. Documents of similarity ``least`` or more are linked, and
    classes are the components of the links; equal texts are always in one class.
    ``class_id`` is the smallest id of the class (null if no row of it has an id).
    Null texts and texts without a word have no content to compare: each null, empty or
    blank text is a class by its text, so empty ones are together only with equal ones.
    Repeated rows are rows of one class. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    roots, _ = near_duplicate_links(docs, least, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_node(F.col(text)).alias("node"))
    classed = rows.join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("class"))
    classes = classed.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return classed.join(classes, "class").select("doc_id", "class_id", "class_size")


def keep_one_per_class(docs: DataFrame, least: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that represent their class, with their own columns.

    Of each class the row with the smallest id stays, of equal ids one with the
    smallest text digest; of rows with equal ids and texts a single one. Rows without an
    id rank last. Columns keep their names, as helper columns have names of their own; an empty table stays empty.
    """
    roots, _ = near_duplicate_links(docs, least, text)
    node, cls, rank = fresh("node"), fresh("class"), fresh("rank")
    id_rank = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(node).alias("node"))
    roots = roots.select(F.col("node").alias(node), F.col("root").alias(cls))
    nodes = docs.select(F.col(doc_id), text_node(F.col(text)).alias(node)).join(roots, node, "left")
    chosen = nodes.groupBy(F.coalesce(cls, node).alias(cls)).agg(F.min(id_rank).alias("kept"))
    chosen = chosen.select(F.col("kept.id").alias(cls), F.col("kept.node").alias(rank))
    # rows equal in id and text are several only in the chosen node's rows
    kept = docs.withColumn(node, text_node(F.col(text)))
    kept = kept.join(chosen, (F.col(node) == F.col(rank)) & F.col(doc_id).eqNullSafe(F.col(cls)), "left_semi")
    first = Window.partitionBy(node, doc_id).orderBy(F.lit(1))
    return kept.withColumn(rank, F.row_number().over(first)).filter(F.col(rank) == 1).drop(node, rank)
