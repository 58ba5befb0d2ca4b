"""Token counts without ids: pieces once per distinct pre-token, joined to frequencies."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import scratch, texts

TOKENIZER = "piece_bpe_32k.model"
#: Pre-tokens whose counts every task holds: the most frequent of the corpus, others are joined.
COMMON_PRE_TOKENS = 100_000
# Vocabulary pieces have the space mark at their start only, so no merge crosses from a
# character to the space after it: texts may be cut before each run of spaces.
PRE_TOKEN = re.compile("[ ▁]+[^ ▁]*|[^ ▁]+")
FLUSH = 200_000


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def load(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def check_cut(path: str) -> None:
    """Raise if a piece of the vocabulary could span a cut."""
    model = load(path)
    crossing = [p for p in map(model.id_to_piece, range(model.get_piece_size())) if re.search("[^▁]▁", p)]
    if crossing:
        raise ValueError(f"pieces cross pre-token borders: {crossing[:3]}")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, each without the space that the library puts first itself."""
    if not text:
        return []
    return [x[1:] for x in PRE_TOKEN.findall(" " + text)]


def count_pieces(words: list[str], model) -> list[int]:
    """An empty one is a single space at the end of a text: the library's own first space would
    make it the mark alone, which is one piece, but it gives nothing for an empty text."""
    return [len(ids) if word else 1 for word, ids in zip(words, model.encode(words, num_threads=1))] if words else []


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter = Counter()

    def flushed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["pre_token", "n"])
        found.clear()
        return out

    for batch in batches:
        for text in texts(batch):
            found.update(pre_tokens(text or ""))
            if len(found) > FLUSH:
                yield flushed()
    if found:
        yield flushed()


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 4096, common: int = COMMON_PRE_TOKENS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit per document, as the sentencepiece model counts.

    One pass counts each distinct pre-token of the corpus; the model runs once on each.
    A second pass sums the `common` most frequent from a table of that size and leaves the
    rest as (pre-token, frequency) per document, to be joined with the piece counts and
    summed. No ids are formed, and the texts' pre-tokens are stored nowhere but in that shuffle.

    Null text counts as empty: no bytes, no tokens. Repeated rows stay. Empty tables and
    other columns are fine. A text is handled as a whole in one task, however long.
    """
    path = path or default_tokenizer_path()
    check_cut(path)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                part = batch.slice(at, 20_000)
                counted = count_pieces(part.column("pre_token").to_pylist(), model)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(counted, pa.int64())], ["pre_token", "n", "pieces"])

    text = docs.select("doc_id", "text")
    seen = text.select("text").mapInArrow(_frequencies, "pre_token string, n long").groupBy("pre_token").agg(F.sum("n").alias("n"))
    counted = scratch(seen.mapInArrow(pieces, "pre_token string, n long, pieces long"), "piece-counts")
    top = counted.orderBy(F.desc("n"), "pre_token").limit(common).select("pre_token", "pieces")
    known = {r["pre_token"]: r["pieces"] for r in top.toLocalIterator()}  # at most `common` rows
    shared = docs.sparkSession.sparkContext.broadcast(known)
    rare_type = pa.list_(pa.struct([("pre_token", pa.string()), ("n", pa.int64())]))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            n_bytes, n_known, rare = [], [], []
            for text in texts(batch):
                total, rest = 0, {}
                for word, n in Counter(pre_tokens(text or "")).items():
                    if (own := known.get(word)) is not None:
                        total += own * n
                    else:
                        rest[word] = n
                n_bytes.append(len((text or "").encode()))
                n_known.append(total)
                rare.append([{"pre_token": w, "n": n} for w, n in rest.items()])
            columns = [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(n_known, pa.int64()), pa.array(rare, rare_type)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_known", "rare"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    summed = text.mapInArrow(sums, f"doc_id {id_type}, n_bytes long, n_known long, rare array<struct<pre_token:string,n:long>>")
    summed = summed.withColumn("row", F.monotonically_increasing_id())
    # each document gives one line with what is known, and one per pre-token to be looked up; the
    # former looks up a key of its own, so that these lines spread, and zero times what it may find
    head = F.struct(F.concat(F.lit("\x00"), F.col("row").cast("string")).alias("pre_token"), F.lit(0).cast("long").alias("n"))
    lines = summed.select("row", "doc_id", "n_bytes", "n_known", F.posexplode(F.concat(F.array(head), "rare")).alias("at", "r"))
    once = [F.when(F.col("at") == 0, F.col(c)).alias(c) for c in ("doc_id", "n_bytes", "n_known")]
    lines = lines.select("row", *once, F.col("r.pre_token").alias("pre_token"), F.col("r.n").alias("times"))
    joined = lines.join(counted.select("pre_token", "pieces"), "pre_token", "left")
    tokens = F.coalesce("n_known", F.lit(0)) + F.col("times") * F.coalesce("pieces", F.lit(0))
    out = joined.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(tokens).alias("n_tokens"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
