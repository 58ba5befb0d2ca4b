"""Ranked lexical search: exact inner products found by best-first search of sparse ball trees."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierstone.llm.common import scratch, texts
from tierstone.llm.decontamination import split_words

TOP = 50
#: Fixed numbers of the score: impact = UNIT * tf div (K * tf + 20 * m), m = 100 - B + (B * n * N) div L.
UNIT, K, B = 1_000_000_000, 1000, 50
#: A tree holds at most so many documents or terms of documents; leaves hold at most LEAF documents.
SHARD_ROWS, SHARD_ENTRIES, LEAF = 8192, 2_000_000, 32
#: Radii are kept for so many slices of the axes, since the sum over slices bounds closer than one radius.
SLICES = 256
#: Items are searched in blocks of about so many terms, which bounds what a task holds of them.
BLOCK_TERMS = 1 << 18
#: One document in so many is searched first: its best scores are lower bounds for all the others.
FIRST_SHARE = 64
_ROUND = 1e-9

#: Bytes to term bytes: A-Z in lower case, other ASCII but digits and letters to blanks.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


class BallTree:
    """Documents as sparse vectors of impacts, each axis scaled by the root of its term's weight.

    Scaled so, the score is the inner product with the item's roots of weights. A node knows its centroid c
    and, for each slice of the axes, the largest distance r of a document to c within the slice. No document below it
    scores more than q.c + sum over slices of |q| r (Cauchy-Schwarz). Both are rounded up: relative
    errors of doubles over any realistic number of terms are far under the margin of 1e-9.
    Leaves hold the integer impacts, which score exactly.
    """

    def __init__(self, ptr: np.ndarray, terms: np.ndarray, impacts: np.ndarray, weights: np.ndarray):
        self.weights = weights
        root, n_terms, n = np.sqrt(weights.astype(float)), len(weights), len(ptr) - 1
        values = impacts * root[terms]
        slice_of = np.arange(n_terms) % SLICES
        order = np.arange(n)
        self.low, self.high, self.children, radii, centres = [], [], [], [], []
        todo = [(0, n, -1)]
        while todo:
            low, high, parent = todo.pop()
            node, rows = len(self.low), order[low:high]
            if parent >= 0:
                self.children[parent].append(node)
            self.low.append(low)
            self.high.append(high)
            self.children.append([])
            m, lens = high - low, ptr[rows + 1] - ptr[rows]
            ends = np.cumsum(lens)
            flat = np.repeat(ptr[rows] - ends + lens, lens) + np.arange(ends[-1])
            t, x, d = terms[flat], values[flat], np.repeat(np.arange(m), lens)
            c = np.bincount(t, x, n_terms) / m
            centre = np.flatnonzero(c)
            centres.append((centre, c[centre]))
            by_slice = np.bincount(slice_of[centre], c[centre] ** 2, SLICES)
            square = np.bincount(d * SLICES + slice_of[t], x * x - 2 * x * c[t], m * SLICES).reshape(m, SLICES) + by_slice
            size = np.bincount(d, x * x, m)
            # the differences above cancel; what they may lose is small against the squares they were made of
            radii.append(np.sqrt(np.maximum(square.max(axis=0), 0) + _ROUND * (size.max() + by_slice.sum())))
            if m > LEAF:
                half = m // 2
                along = self._spread(t, x, d, c, int(square.sum(axis=1).argmax()), m)
                order[low:high] = rows[np.argpartition(along, half)]
                todo += [(low + half, high, node), (low, low + half, node)]
        lens = ptr[order + 1] - ptr[order]
        self.ptr = np.concatenate(([0], np.cumsum(lens)))
        flat = np.repeat(ptr[order] - self.ptr[:-1], lens) + np.arange(self.ptr[-1])
        self.order, self.terms, self.impacts = order, terms[flat], impacts[flat]
        self.radii = np.array(radii)
        # centroids by term: the nodes and values of a term lie between two neighbouring marks
        by_node = np.repeat(np.arange(len(centres)), [len(t) for t, _ in centres])
        all_terms, all_values = (np.concatenate(x) for x in zip(*centres))
        by_term = np.argsort(all_terms, kind="stable")
        self.nodes, self.centres = by_node[by_term], all_values[by_term]
        self.marks = np.concatenate(([0], np.cumsum(np.bincount(all_terms, minlength=n_terms))))
        self.dense = np.zeros(n_terms, np.int64)

    @staticmethod
    def _spread(t: np.ndarray, x: np.ndarray, d: np.ndarray, c: np.ndarray, far: int, m: int) -> np.ndarray:
        """Documents along the axis they spread most on, by power iteration from the one farthest from the centroid.

        Alike documents lie close there, so that halves at the median are tighter balls.
        """
        own = d == far
        axis = np.bincount(t[own], x[own], len(c)) - c
        for _ in range(3):
            along = np.bincount(d, x * axis[t], m) - c @ axis
            axis = np.bincount(t, x * along[d], len(c)) - c * along.sum()
            axis /= max(float(np.abs(axis).max()), 1.0)
        return np.bincount(d, x * axis[t], m)

    def bounds(self, item: np.ndarray) -> np.ndarray:
        """An upper bound of every node's scores for an item, given by its terms."""
        low, lens = self.marks[item], self.marks[item + 1] - self.marks[item]
        ends = np.cumsum(lens)
        at = np.repeat(low - ends + lens, lens) + np.arange(ends[-1])
        q = np.sqrt(self.weights[item].astype(float))
        dots = np.bincount(self.nodes[at], self.centres[at] * np.repeat(q, lens), len(self.low))
        sides = np.sqrt(np.bincount(item % SLICES, self.weights[item], SLICES))
        return (dots + self.radii @ sides) * (1 + _ROUND) + 1

    def leaf_scores(self, node: int) -> np.ndarray:
        """Exact scores of a leaf's documents for the item in `dense`."""
        ptr = self.ptr[self.low[node] : self.high[node] + 1]
        part = slice(ptr[0], ptr[-1])
        sums = np.concatenate(([0], np.cumsum(self.dense[self.terms[part]] * self.impacts[part])))
        return sums[ptr[1:] - ptr[0]] - sums[ptr[:-1] - ptr[0]]

    def search(self, item: np.ndarray, best: list[tuple[int, int]], ids: list[int], top: int, floor: int) -> int:
        """Put better documents into the heap `best` of (score, -id); returns the number of leaves scored.

        A subtree is left out only if its bound lies under the floor or under the worst of `top` scores, so
        that a document with an equal score and a smaller id is still found.
        """
        bound = self.bounds(item).tolist()
        self.dense[item] = self.weights[item]
        least = max(floor, best[0][0]) if len(best) >= top else floor
        queue, scored = [(-bound[0], 0)], 0
        while queue and -queue[0][0] >= least:
            reach, node = heapq.heappop(queue)
            for child in self.children[node]:
                if min(bound[child], -reach) >= least:
                    heapq.heappush(queue, (max(-bound[child], reach), child))
            if not self.children[node]:
                scored += 1
                scores = self.leaf_scores(node)
                for k in np.flatnonzero(scores >= least).tolist():
                    entry = (int(scores[k]), -ids[self.order[self.low[node] + k]])
                    if len(best) < top:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                least = max(floor, best[0][0]) if len(best) >= top else floor
        self.dense[item] = 0
        return scored


#: Stands for a null id, which comes after all others.
_NO_ID = 1 << 63


def search_shards(vectors: DataFrame, items: dict[int, np.ndarray], weights: np.ndarray, docs: int, length: int, floors: dict[int, int], top: int) -> DataFrame:
    """(item, doc_id, score): for each task the best of its documents, tree after tree.

    A tree is built of the rows of a task as they come, up to the shard's limits; nothing is shuffled. Scores under
    an item's floor are not returned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int]]] = {item: [] for item in items}
        ids, lens, terms, impacts = [], [], [], []

        def look() -> None:
            ptr = np.concatenate(([0], np.cumsum(lens))).astype(np.int64)
            tree = BallTree(ptr, np.concatenate(terms).astype(np.int64), np.concatenate(impacts), weights)
            for item, wanted in items.items():
                if len(wanted):
                    tree.search(wanted, best[item], ids, top, floors.get(item, 1))
            for held in (ids, lens, terms, impacts):
                held.clear()

        entries = 0
        for batch in batches:
            columns = [batch.column(c) for c in ("doc_id", "n", "terms", "tfs")]
            for doc_id, n, term, tf in zip(*columns):
                term, tf = np.frombuffer(term.as_py(), np.int32), np.frombuffer(tf.as_py(), np.int32).astype(np.int64)
                m = 100 - B + (B * n.as_py() * docs) // length
                ids.append(_NO_ID if doc_id.as_py() is None else doc_id.as_py())
                lens.append(len(term))
                terms.append(term)
                impacts.append((UNIT * tf) // (K * tf + 20 * m))
                entries += len(term)
                if len(ids) >= SHARD_ROWS or entries >= SHARD_ENTRIES:
                    look()
                    entries = 0
        if ids:
            look()
        rows = [(item, None if -key == _NO_ID else -key, score) for item, heap in best.items() for score, key in heap]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["item", "doc_id", "score"])

    return vectors.mapInArrow(run, "item long, doc_id long, score long")


def term_vectors(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """Stored (doc_id, n, terms, tfs) per document: its length and the items' terms it has, in packed int32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, terms, tfs = [], [], []
            for text in texts(batch):
                counts = Counter(terms_of(text))
                ns.append(counts.total())
                found = sorted((number[t], tf) for t, tf in counts.items() if t in number)
                terms.append(np.array([t for t, _ in found], np.int32).tobytes())
                tfs.append(np.array([tf for _, tf in found], np.int32).tobytes())
            arrays = [pa.array(ns, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return scratch(rows.mapInArrow(run, "doc_id long, n long, terms binary, tfs binary"), "term-vectors")


def document_counts(vectors: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each term: one number a term and task, summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            for terms in texts(batch, "terms"):
                df[np.frombuffer(terms, np.int32)] += 1
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(df[held], pa.int64())], ["term", "df"])

    found = vectors.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()  # a block's terms
    df = np.zeros(n_terms, np.int64)
    for r in found:
        df[r.term] = r.df
    return df


def ranked(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def item_terms(items: DataFrame) -> DataFrame:
    """Stored (item, item_id, terms): distinct terms; rows that share an id are one item."""
    terms = F.coalesce(F.filter(split_words(F.col("text")), lambda w: w != ""), F.array().cast("array<string>"))
    one = items.select("item_id", F.array_distinct(terms).alias("terms")).groupBy("item_id")
    one = one.agg(F.array_distinct(F.flatten(F.collect_list("terms"))).alias("terms"))
    return scratch(one.withColumn("item", F.monotonically_increasing_id()), "items")


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` best documents of each item with a score above 0.

    Terms are maximal runs of letters, digits and bytes of non-ASCII characters, A-Z in lower case. The score sums
    weight * impact over the item's distinct terms, in whole numbers; equal scores go by ascending
    id, null ids last. Every row is a document of its own, so repeated rows hold ranks of their own. Null and blank
    texts have no terms and no rank. Items that share an id (null too) are one item with all their terms. Empty tables
    give no rows. Texts are read whole. Other columns are ignored; doc_id is a whole number.

    Items go in blocks of about BLOCK_TERMS terms. For a block every document is reduced to its counts of the block's
    terms, stored once; document frequencies come from there. A first search of one document in FIRST_SHARE
    gives every item a floor its 50th score cannot fall under; then all documents are searched, and a task returns only
    what reaches the floor: some FIRST_SHARE * top rows an item, however many tasks there are.
    """
    spark = docs.sparkSession
    known = item_terms(items)
    total = known.agg(F.sum(F.size("terms"))).first()[0] or 0  # one number
    blocks = 1 + total // BLOCK_TERMS
    found = spark.createDataFrame([], "item long, doc_id long, score long, rank int")
    for b in range(blocks):
        chosen = known.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).select("item", "terms").collect()  # a block's items
        names = sorted({t.encode() for r in chosen for t in r.terms})
        if not names:
            continue
        number = {t: i for i, t in enumerate(names)}
        vectors = term_vectors(docs, number)
        sums = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()  # two numbers
        if not sums.length:
            continue
        df = document_counts(vectors, len(names))
        weights = np.array([math.floor(1000 * math.log((2 * sums.docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        queries = {r.item: np.array(sorted(number[t.encode()] for t in r.terms), np.int64) for r in chosen}
        queries = {item: terms[(df[terms] > 0) & (weights[terms] > 0)] for item, terms in queries.items()}
        holding = vectors.filter(F.octet_length("terms") > 0)
        first = holding.filter(F.pmod(F.xxhash64("doc_id"), F.lit(FIRST_SHARE)) == 0)
        seen = ranked(search_shards(first, queries, weights, sums.docs, sums.length, {}, top), top).filter(F.col("rank") == top)
        floors = {r.item: r.score for r in seen.collect()}  # one row an item at most
        scored = search_shards(holding, queries, weights, sums.docs, sums.length, floors, top)
        found = found.unionByName(ranked(scored, top))
    return known.select("item", "item_id").join(found, "item").select("item_id", "rank", "doc_id", "score")
