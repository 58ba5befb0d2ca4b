"""SimHash near-dedup: fingerprints, BK-trees per shard, components of links."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierstone.llm.common import extended, free_name, scratch, texts

SHINGLE, SEED, RADIUS = 4, 42, 4
#: 64 bits in RADIUS + 2 blocks: fingerprints within RADIUS agree on two blocks at least.
BLOCKS = 6
SHARD_ROWS = 2048


def fingerprint(text: str | None) -> int:
    """Majority bits of the XXH64 of the word shingles, repeats included; 0 without words."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    joined, hash_of = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[SHINGLE - 1 :] if len(words) >= SHINGLE else ends[-1:]
    counts, step = np.zeros(64, np.int64), 1 << 15
    for at in range(0, n, step):
        pairs = zip(starts[at : min(at + step, n)].tolist(), last[at : at + step].tolist())
        hashes = np.array([hash_of(joined[a:b], SEED) for a, b in pairs], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist()))


def fingerprints(docs: DataFrame, name: str = "fp") -> DataFrame:
    """`docs` with one more column, the 64 bits as a signed long."""
    schema = extended(docs.schema, **{name: "long"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x) for x in texts(batch)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps, pa.int64())], schema.names)

    return docs.mapInArrow(run, schema)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """One BK-tree per group, built and searched in whole arrays.

    A child hangs on its parent by an integer edge, their Hamming distance; no two children
    of a node share an edge. Edges are kept sorted by (parent, edge).
    """

    def __init__(self, fps: np.ndarray, group: np.ndarray, member: np.ndarray):
        """`member` picks the rows to insert; rows of a group are adjacent."""
        self.fps, rows = fps, np.flatnonzero(member)
        first = np.ones(len(rows), bool)
        first[1:] = group[rows[1:]] != group[rows[:-1]]
        roots = rows[first]
        self.root_of_group = dict(zip(group[roots].tolist(), roots.tolist()))
        at = roots[np.cumsum(first) - 1][~first] if len(rows) else rows
        todo, keys, children = rows[~first], [], []
        while len(todo):
            key = at * 65 + distances(fps[todo], fps[at])
            order = np.argsort(key, kind="stable")
            key, todo = key[order], todo[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            keys.append(key[new])
            children.append(todo[new])
            at = todo[new][np.cumsum(new) - 1][~new]
            todo = todo[~new]
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        order = np.argsort(self.keys)
        self.keys = self.keys[order]
        self.children = (np.concatenate(children) if children else np.zeros(0, np.int64))[order]

    def search(self, rows: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, found) within the radius. From a node at distance d, only edges in d ± radius are followed."""
        while len(rows):
            d = distances(self.fps[rows], self.fps[roots])
            hit = d <= radius
            yield rows[hit], roots[hit]
            low = np.searchsorted(self.keys, roots * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.keys, roots * 65 + np.minimum(d + radius, 64), "right")
            n = high - low
            rows = np.repeat(rows, n)
            roots = self.children[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]


def smallest_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n places the smallest place reachable over the links a - b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def tree_links(fps: np.ndarray, group: np.ndarray, is_tree: np.ndarray, is_query: np.ndarray, radius: int, step: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that span the same components as all links within `radius` inside groups."""
    forest = Forest(fps, group, is_tree)
    queries = np.flatnonzero(is_query)
    roots = np.array([forest.root_of_group.get(g, -1) for g in group[queries].tolist()], np.int64).reshape(-1)
    queries, roots = queries[roots >= 0], roots[roots >= 0]
    label = np.arange(len(fps))
    for at in range(0, len(queries), step):
        found = [x for x in forest.search(queries[at : at + step], roots[at : at + step], radius)]
        a, b = (np.concatenate(x) for x in zip(*found))
        off = a != b
        # labels so far are links too, so that the result stays a forest
        label = smallest_linked(len(fps), np.concatenate((np.arange(len(fps)), a[off])), np.concatenate((label, b[off])))
    moved = np.flatnonzero(label != np.arange(len(fps)))
    return moved, label[moved]


def block_keys(fp: Column, blocks: int = BLOCKS, agree: int = BLOCKS - RADIUS) -> Column:
    """One key per choice of `agree` blocks: the fingerprint with all other bits cleared, and the choice."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    keys = []
    for n, chosen in enumerate(combinations(range(blocks), agree)):
        bits = sum(masks[i] for i in chosen)
        keys.append(F.struct(F.lit(n).alias("choice"), fp.bitwiseAND(F.lit(bits - (1 << 64) if bits >> 63 else bits)).alias("bits")))
    return F.array(*keys)


def links(fps: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b): pairs of distinct fingerprints spanning the components of all links within `radius`.

    `fps` has distinct `fp`. Fingerprints within the radius agree on two of radius + 2
    blocks, so every link lies inside the shard of some choice of two blocks, and shards
    stay small as rows grow. A shard over `shard_rows` is split by hash; each part's tree
    then also gets the other parts as queries. Trees are built and searched where a shard's
    rows meet; none passes the driver.
    """
    blocks = radius + 2
    keyed = fps.select("fp", F.explode(block_keys(F.col("fp"), blocks, 2)).alias("k")).select("fp", "k.choice", "k.bits")
    large = keyed.groupBy("choice", "bits").agg(F.count("*").alias("n")).filter(F.col("n") > shard_rows)
    large = large.withColumn("parts", F.ceil(F.col("n") / shard_rows).cast("int")).drop("n")
    sized = keyed.join(large, ["choice", "bits"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = sized.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    paired = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # the pair (i, j) holds the tree of part i and the rows of part j >= i as queries
    paired = paired.select("fp", "choice", "bits", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") <= F.col("other")).alias("tree"), (F.col("own") >= F.col("other")).alias("query"))
    shard = ["choice", "bits", "i", "j"]
    grouped = paired.repartition(*shard).sortWithinPartitions(*shard, "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["fp", *shard, "tree", "query"]
        rest = None

        def found(table: pa.Table) -> pa.RecordBatch:
            columns = {c: table.column(c).to_numpy() for c in names}
            new = np.zeros(table.num_rows, bool)
            for c in shard:
                new[1:] |= columns[c][1:] != columns[c][:-1]
            group = np.cumsum(new)
            several = np.bincount(group)[group] > 1
            group, tree, query, fps = group[several], columns["tree"][several], columns["query"][several], columns["fp"][several]
            a, b = tree_links(fps.view(np.uint64), group, tree, query, radius) if len(fps) else (np.zeros(0, int),) * 2
            return pa.RecordBatch.from_arrays([pa.array(fps[a], pa.int64()), pa.array(fps[b], pa.int64())], ["a", "b"])

        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            # whole shards only; the last may go on in the next batch
            last, cut = [table.column(c)[-1].as_py() for c in shard], np.ones(table.num_rows, bool)
            for c, v in zip(shard, last):
                cut &= table.column(c).to_numpy() == v
            done = int(cut.argmax())
            rest = table.slice(done)
            if done:
                yield found(table.slice(0, done))
        if rest is not None:
            yield found(rest)

    return grouped.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root): every node of an edge with the smallest node reachable.

    Alternates large-star and small-star steps until the edges are stars; each round is
    written to the shared folder. Only a count and a checksum reach the driver.
    """
    now = scratch(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    for _ in range(rounds):
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = scratch(small.union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components still change after {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select("b", "b").distinct())


def linked_roots(distinct: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """`distinct` (one row per fp) with `root`, one fingerprint of its component."""
    roots = components(links(distinct.select("fp"), radius, shard_rows))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, fingerprint, component_id, per document.

    Copies are reduced to one row per distinct fingerprint before links are sought, with the
    smallest doc_id of each. component_id is the smallest doc_id reachable over links of
    `radius` bits or fewer, null only if all reachable ids are null. Null or empty text has
    fingerprint 0; texts of any length are hashed whole. Repeated rows stay; of equal ids there is no order to tie; other
    columns are ignored; an empty table is fine.
    """
    each = scratch(fingerprints(docs.select("doc_id", "text")).drop("text"), "fingerprints")
    distinct = scratch(each.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct-fingerprints")
    rooted = linked_roots(distinct, radius, shard_rows)
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = scratch(rooted.select("fp", "root").join(lowest, "root").select("fp", "component_id"), "components")
    out = each.join(named, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """`docs` with one row of each component: the one with the smallest doc_id, null ids last.

    Rows are told apart by id and text hash, so that repeated ids with different texts are
    rows of their own; of rows equal in both one stays. The join that keeps the chosen rows is
    sorted at every size, as the list of them grows with the corpus. Null and empty texts are one component. All columns
    stay, whatever their names; an empty table gives no rows.
    """
    narrow = fingerprints(docs.select("doc_id", "text")).select("doc_id", F.xxhash64("text").alias("text_hash"), "fp")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    distinct = scratch(narrow.groupBy("fp").agg(F.min(first).alias("first")), "distinct-fingerprints")
    kept = linked_roots(distinct, radius, shard_rows).groupBy("root").agg(F.min("first").alias("first"))
    names = [free_name(docs, n) for n in ("kept_id", "kept_hash", "kept_key", "text_hash", "row_key", "place")]
    kept_id, kept_hash, kept_key, own, key, place = names
    row_key = lambda doc_id, text_hash: F.xxhash64(doc_id, text_hash, F.col(doc_id).isNull())
    kept = kept.select(F.col("first.doc_id").alias(kept_id), F.col("first.text_hash").alias(kept_hash))
    kept = scratch(kept.withColumn(kept_key, row_key(kept_id, kept_hash)), "kept-rows").hint("merge")
    # a count of equal columns is no join key: rows are dealt by one key, which the window below can use too
    equal = F.col("doc_id").eqNullSafe(F.col(kept_id)).cast("int") + (F.col(own) == F.col(kept_hash)).cast("int")
    rows = docs.withColumn(own, F.xxhash64("text")).withColumn(key, row_key("doc_id", own))
    copies = Window.partitionBy(key, "doc_id", own).orderBy(F.lit(0))
    chosen = rows.join(kept, (F.col(key) == F.col(kept_key)) & (equal == 2), "left_semi").withColumn(place, F.row_number().over(copies))
    return chosen.filter(F.col(place) == 1).select(*docs.columns)
