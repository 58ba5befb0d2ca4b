"""Substring dedup: anchors at difference-cover places find candidates, whole windows decide."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tierstone.llm.common import extended, free_name, scratch, slices, texts
from tierstone.llm.rolling import BASES, WordValues, mixed, prefix_sums, window_hashes

WINDOW = 35
#: Period -> places. Any difference modulo the period is one of two places, so two texts at any
#: offset to each other have a place of the cover in common within one period.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16)}
#: Entries a task holds at once; documents are dealt into chunks of about so many.
CHUNK_ENTRIES, CHUNK_DOCUMENTS = 1_000_000, 20_000
#: Bytes of text behind one bucket of hashes: 2.5 million anchors, some 30 MB in one task.
BUCKET_BYTES = 64 << 20


SPANS = ArrayType(StructType([StructField(name, LongType()) for name in ("start", "stop")]))


def cover_of(window: int) -> tuple[int, tuple[int, ...], int]:
    """(period, places, anchor width): the longest period of at most two thirds of the window.

    An anchor of window - period + 1 words that starts within the window's first period lies inside it.
    """
    period = max(p for p in COVERS if 3 * p <= max(2 * window, 3))
    return period, COVERS[period], window - period + 1


def anchor_places(n: int, window: int) -> np.ndarray:
    period, places, width = cover_of(window)
    if n < window:
        return np.zeros(0, np.int64)
    at = (np.arange(0, n, period)[:, None] + np.array(places)).ravel()
    return at[at <= n - width]


def window_starts(n: int, anchors: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows whose first period holds one of the anchors."""
    period = cover_of(window)[0]
    n_starts = n - window + 1
    low, high = np.clip(anchors - period + 1, 0, n_starts), np.clip(anchors + 1, 0, n_starts)
    edge = np.bincount(low, minlength=n_starts + 1) - np.bincount(high, minlength=n_starts + 1)
    return np.flatnonzero(np.cumsum(edge[:-1]) > 0)


def anchor_hashes(values: np.ndarray, window: int) -> np.ndarray:
    """One column: equal anchors have equal hashes; a chance collision costs a look at windows, no more."""
    places = anchor_places(len(values), window)
    return window_hashes(prefix_sums(values), places, cover_of(window)[2]).reshape(-1, 1)


def full_hashes(values: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Two columns, 128 bits, of the whole windows."""
    sides = (values, mixed(values))
    return np.stack([window_hashes(prefix_sums(v, b), starts, window, b) for v, b in zip(sides, BASES)], axis=1)


def covered_words(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    edge[starts] += 1
    edge[starts + window] -= 1
    return np.cumsum(edge[:-1]) > 0


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes: ASCII white space only


def grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): rows sorted by hash, and where a new hash begins in that order."""
    order = np.lexsort(hashes.T)
    rows = hashes[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return order, first


def to_steps(numbers: np.ndarray) -> bytes:
    """Ascending numbers as steps in uint32: mostly zero bytes, which compress away."""
    return np.diff(numbers, prepend=0).astype(np.uint32).tobytes()


def from_steps(steps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps, np.uint32), dtype=np.int64)


def repeated(first: np.ndarray) -> np.ndarray:
    """Of sorted rows, those whose hash another row has too."""
    last = np.concatenate((first[1:], [True]))[: len(first)]
    return ~(first & last)


def packed(rows: DataFrame, look: Callable, looked: dict[str, str], carried: list[str], buckets: int, name: str) -> DataFrame:
    """Stored table of three kinds of rows, from one pass over `rows`.

    `look(row of all columns) -> (values of the looked columns, hashes)`. Documents are numbered into chunks:
    a document row has its chunk, the number `first` of its first entry there and their number `n`.
    Entries whose hash occurs twice in a chunk are known to be repeated at once (a row with `entries` and no
    bucket). Of each distinct hash of a chunk one entry goes to the hash's bucket, packed in binary
    columns, so a hash that every document has costs one entry a chunk, wherever it is counted.
    """
    schema = StructType([rows.schema[c] for c in carried])
    schema = extended(schema, **looked, chunk="long", first="long", n="long", bucket="integer", hashes="binary", entries="binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        wire = to_arrow_schema(schema)
        chunk, docs, parts, total = TaskContext.get().partitionId() << 32, [], [], 0

        def table(records: list[dict]) -> pa.RecordBatch:
            columns = [pa.array([r.get(f.name) for r in records], f.type) for f in wire]
            return pa.RecordBatch.from_arrays(columns, schema=wire)

        def flush() -> Iterator[pa.RecordBatch]:
            yield table(docs)
            if not total:
                return
            hashes = np.concatenate(parts)
            order, first = grouped(hashes)
            twice = np.sort(order[repeated(first)])
            if len(twice):
                yield table([{"chunk": chunk, "entries": to_steps(twice)}])
            one = np.sort(order[first])
            bucket = (mixed(hashes[one, 0]) % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            one, bucket = one[by], bucket[by]
            edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))).tolist()
            records = [
                {"chunk": chunk, "bucket": int(bucket[a]), "hashes": hashes[one[a:b]].tobytes(), "entries": to_steps(one[a:b])}
                for a, b in zip(edges[:-1], edges[1:])
            ]
            for at in range(0, len(records), 1000):
                yield table(records[at : at + 1000])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                found, hashes = look(row)
                docs.append({**{c: row[c] for c in carried}, **dict(zip(looked, found)), "chunk": chunk, "first": total, "n": len(hashes)})
                if len(hashes):
                    parts.append(hashes)
                    total += len(hashes)
                if total >= CHUNK_ENTRIES or len(docs) >= CHUNK_DOCUMENTS:
                    yield from flush()
                    chunk, docs, parts, total = chunk + 1, [], [], 0
        if docs:
            yield from flush()

    return scratch(rows.mapInArrow(run, schema), name)


def repeated_entries(index: DataFrame, key: str, width: int) -> DataFrame:
    """(key, places): per key the numbers, as steps, of its entries whose hash occurs elsewhere too.

    Buckets hold one entry a hash and chunk; what they find goes back to the chunks, where
    document rows turn numbers into places. Documents under one key have the same entries.
    """

    def match(group: pa.Table) -> pa.Table:
        chunks = [np.int64(c) for c in group.column("chunk").to_pylist()]
        entries = [from_steps(e) for e in group.column("entries").to_pylist()]
        hashes = np.concatenate([np.frombuffer(h, np.uint64).reshape(-1, width) for h in group.column("hashes").to_pylist()])
        owner = np.repeat(chunks, [len(e) for e in entries])
        order, first = grouped(hashes)
        hit = order[repeated(first)]
        owner, entry = owner[hit], np.concatenate(entries)[hit]
        by = np.lexsort((entry, owner))
        owner, entry = owner[by], entry[by]
        edges = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1], [True]))).tolist() if len(owner) else []
        spans = list(zip(edges[:-1], edges[1:]))
        out = [pa.array([int(owner[a]) for a, _ in spans], pa.int64()), pa.array([to_steps(entry[a:b]) for a, b in spans], pa.binary())]
        return pa.table(out, names=["chunk", "entries"])

    def assign(group: pa.Table) -> pa.Table:
        said = [e for e in group.column("entries").to_pylist() if e is not None]
        entries = np.unique(np.concatenate([from_steps(e) for e in said])) if said else np.zeros(0, np.int64)
        keys, places = [], []
        for k, first, n in zip(*(group.column(c).to_pylist() for c in (key, "first", "n"))):
            if n:
                a, b = np.searchsorted(entries, (first, first + n))
                if a < b:
                    keys.append(k)
                    places.append(to_steps(entries[a:b] - first))
        return pa.table([pa.array(keys, pa.binary()), pa.array(places, pa.binary())], names=[key, "places"])

    met = index.filter("bucket is not null").select("bucket", "chunk", "hashes", "entries")
    met = met.groupBy("bucket").applyInArrow(match, "chunk long, entries binary")
    near = index.filter("bucket is null and entries is not null").select("chunk", "entries")
    none = F.lit(None)
    docs = index.filter("n > 0").select("chunk", key, "first", "n", none.cast("binary").alias("entries"))
    said = met.unionByName(near).select("chunk", none.cast("binary").alias(key), none.cast("long").alias("first"), none.cast("long").alias("n"), "entries")
    per_row = docs.unionByName(said).groupBy("chunk").applyInArrow(assign, f"{key} binary, places binary")
    return per_row.groupBy(key).agg(F.any_value("places").alias("places"))


def find_repeated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, n_words, spans, kept_text, words_sha256) per row of `docs`.

    A window is `window` consecutive words `[^\\x20\\x09-\\x0D]+` of one document. Words covered by a window
    whose words also start anywhere else, in the same document too, are repeated; `spans` lists
    them as [start, stop) word numbers. `kept_text` is the rest joined by one space, null where nothing
    is repeated: the text stays as it is then. `words_sha256` is the digest of all words so joined,
    `text_key` the MD5 of the text (null counts as empty).

    First anchors at places of a difference cover are hashed, a quarter of all places: two equal windows
    share one at the same offset. Then the windows around anchors that occur twice are hashed whole, in
    128 bits. Texts meet their anchors by one join on the key; nothing else moves them. Documents
    shorter than a window, blank and null texts have no spans. Equal rows stay and repeat each other if long enough. Texts
    are read whole, some 100 bytes a word of the longest. An empty table gives no rows. Columns other than doc_id and text
    are ignored.
    """
    rows = docs.select("doc_id", "text", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("text_key"))
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0  # one number
    buckets = 1 + size // BUCKET_BYTES

    values = WordValues()

    def anchors(row: dict) -> tuple[tuple, np.ndarray]:
        words = split(row["text"])
        hashes = anchor_hashes(values.of(words), window) if len(words) >= window else np.zeros((0, 1), np.uint64)
        return (len(words), digest(words)), hashes

    index = packed(rows, anchors, {"n_words": "long", "words_sha256": "string"}, ["doc_id", "text_key"], buckets, "anchors")
    marked = scratch(repeated_entries(index, "text_key", 1), "repeated-anchors")
    candidates = scratch(rows.join(marked, "text_key"), "candidate-texts")

    def starts_of(words: list[bytes], places: bytes) -> np.ndarray:
        chosen = anchor_places(len(words), window)[from_steps(places)]
        return window_starts(len(words), chosen, window)

    def windows(row: dict) -> tuple[tuple, np.ndarray]:
        words = split(row["text"])
        return (), full_hashes(values.of(words), starts_of(words, row["places"]), window)

    whole = packed(candidates, windows, {}, ["text_key"], buckets, "windows")
    covered = repeated_entries(whole, "text_key", 2).withColumnRenamed("places", "windows")
    covered = scratch(covered, "repeated-windows")

    schema = extended(StructType([rows.schema["doc_id"], rows.schema["text_key"]]), n_words="long", spans=SPANS, kept_text="string", words_sha256="string")
    wire = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made: list[tuple] = []
            for text, places, numbers in zip(texts(batch), texts(batch, "places"), texts(batch, "windows")):
                words = split(text)
                starts = starts_of(words, places)[from_steps(numbers)]
                gone = covered_words(len(words), starts, window)
                edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))).tolist()
                spans = [{"start": a, "stop": b} for a, b in zip(edges[::2], edges[1::2])]
                kept = b" ".join([words[k] for k in np.flatnonzero(~gone).tolist()]).decode()
                made.append((len(words), spans, kept, digest(words)))
            columns = [pa.array([m[k] for m in made], wire.field(2 + k).type) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), *columns], schema=wire)

    changed = candidates.join(covered, "text_key").mapInArrow(cut, schema)
    whole_rows = index.filter("n_words is not null").join(covered, "text_key", "left_anti")
    same = whole_rows.select("doc_id", "text_key", "n_words", F.array().cast(SPANS).alias("spans"), F.lit(None).cast("string").alias("kept_text"), "words_sha256")
    return same.unionByName(changed)


def remove_repeated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` with the text of changed documents replaced by its kept words; all rows and columns stay.

    Other columns keep their values, whatever their names; see `find_repeated` for nulls, ties and repeats.
    """
    found = find_repeated(docs, window).filter("kept_text is not null").select("text_key", "kept_text")
    names = free_name(docs, "text_key"), free_name(docs, "kept_text")
    kept = scratch(found.groupBy("text_key").agg(F.any_value("kept_text")).toDF(*names), "kept-texts")
    joined = docs.withColumn("text", F.col("text")).join(kept, F.unhex(F.md5("text")) == F.col(names[0]), "left")
    return joined.withColumn("text", F.coalesce(names[1], "text")).select(*docs.columns)
