"""Language ID: n-gram presence kernels, Nyström landmarks, kernel ridge regression."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierstone.llm.common import crc_fold, extended, free_name, scratch, texts

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
UNKNOWN = "und"
#: A language's candidates for the training sample: so many times the rows wanted.
CANDIDATES = 4
# Odd multipliers of the n-gram hash, one per place.
PLACES = np.array([2654435761, 2246822519, 3266489917, 668265263], np.uint32)


def has_letter(text: str) -> bool:
    """Whether some character is of a Unicode letter category; digits, fractions and letter-like numerals are not."""
    return any(map(str.isalpha, text))


def presence(text: str | None) -> np.ndarray:
    """Which buckets the n-grams of the lower-cased text fall in: the blended spectrum, as presence."""
    row = np.zeros(BUCKETS, bool)
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    for order in ORDERS:
        if len(codes) >= order:
            mixed = np.full(len(codes) - order + 1, order * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
            for k in range(order):
                mixed += codes[k : len(codes) - order + 1 + k] * PLACES[k]
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(2246822519)
            row[mixed >> shift] = True
    return row


@dataclass
class Model:
    """Columns of `weights` belong to `languages`; landmarks are scaled presence rows."""

    languages: list[str]
    landmarks: np.ndarray  # bucket x landmark
    weights: np.ndarray  # landmark x language

    def scores(self, rows: np.ndarray) -> np.ndarray:
        kernel = (rows.astype(np.float32) @ self.landmarks) / np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))
        outputs = 4 * (kernel @ self.weights)
        e = np.exp(outputs - outputs.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def sample(docs: DataFrame, per_language: int, seed: int = 11) -> DataFrame:
    """doc_id, lang, bits: at most `per_language` training rows of each language, by seeded order.

    Ids are chosen on narrow columns; only the chosen rows' texts are read into features. The order is that of a
    hash of the id, so a first limit on the hash itself leaves some CANDIDATES * `per_language` ids a language
    where they are read, and no task ranks more, however many rows or scan tasks there are. Ties are rows of one id.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & (crc_fold(F.col("doc_id")) != 0))
    place = F.xxhash64("doc_id", F.lit(seed))
    sizes = labelled.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")).collect()  # one row a language
    if not sizes:
        return docs.sparkSession.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang string, bits binary")
    # hashes are uniform: below this share of them lie about CANDIDATES * per_language ids of a language, however many rows it has
    shares = {r["lang"]: min(1.0, CANDIDATES * per_language / max(r["n"], 1)) for r in sizes}
    limits = F.create_map(*[F.lit(x) for lang, share in shares.items() for x in (lang, min(int(share * (1 << 64)), (1 << 64) - 1) - (1 << 63))])
    near = labelled.select("doc_id", "lang").filter(place <= limits[F.col("lang")]).distinct()
    order = Window.partitionBy("lang").orderBy(place, "doc_id")
    ids = near.withColumn("place", F.row_number().over(order))
    ids = scratch(ids.filter(F.col("place") <= per_language).select("doc_id", "lang"), "training-ids")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [np.packbits(presence(x)).tobytes() for x in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(bits, pa.binary())], ["doc_id", "lang", "bits"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = labelled.filter(F.col("text").isNotNull()).select("doc_id", "lang", "text").join(ids, ["doc_id", "lang"], "left_semi")
    rows = rows.mapInArrow(features, f"doc_id {id_type}, lang string, bits binary")
    return rows.groupBy("doc_id", "lang").agg(F.min("bits").alias("bits"))  # one row per id, though ids repeat


def train(docs: DataFrame, per_language: int = 400, landmarks: int = 64, ridge: float = 1e-2) -> Model | None:
    """One-versus-rest kernel ridge regression in the Nyström features of the landmarks.

    Fitted on at most `per_language` rows of each language, the first `landmarks` of which
    are landmarks. Only hashed presence bits reach the driver, 2 KB a row, 0.8 MB a language; the model that is
    broadcast has 4 MB a language. `lang` is meant for up to some hundred languages. An empty table, or
    one without labels, gives no model.
    """
    rows = sample(docs, per_language).orderBy("lang", "doc_id").collect()
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    x = np.stack([np.unpackbits(np.frombuffer(r["bits"], np.uint8)) for r in rows]).astype(np.float32)
    y = np.array([[1.0 if r["lang"] == name else -1.0 for name in languages] for r in rows])
    x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    places: dict[str, int] = {}
    chosen = []
    for i, r in enumerate(rows):
        places[r["lang"]] = places.get(r["lang"], 0) + 1
        if places[r["lang"]] <= landmarks:
            chosen.append(i)
    base = x[chosen]
    value, vector = np.linalg.eigh((base @ base.T).astype(float))
    keep = value > 1e-6
    root = vector[:, keep] / np.sqrt(value[keep])  # K_mm ** -1/2, up to a rotation
    features = (x @ base.T) @ root
    # languages of few rows weigh as much as those of many
    n_of = y.clip(0).sum(axis=0)
    row_weight = (y.clip(0) / n_of).sum(axis=1, keepdims=True)
    row_weight *= len(rows) / row_weight.sum()
    gram = features.T @ (features * row_weight) + ridge * len(rows) / max(len(chosen), 1) * np.eye(features.shape[1])
    solved = np.linalg.solve(gram, features.T @ (y * row_weight))
    return Model(languages, np.ascontiguousarray(base.T), (root @ solved).astype(np.float32))


def predict(docs: DataFrame, model: Model | None, names: tuple[str, str] = ("lang_pred", "score"), batch_rows: int = 256) -> DataFrame:
    """Language and score (columns `names`) for every row, by batched products of presence rows and landmarks.

    Only the text is an input. Null text, text without a letter, or no model: `und`, score 0. Of equally scored
    languages the first by name is taken. Whole texts of any length count; repeated rows stay; an empty table gives
    no rows. All columns of `docs` stay; `names` get underscores before them where they are taken.
    """
    names = tuple(free_name(docs, n) for n in names)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, batch_rows):
                part = batch.slice(at, batch_rows)
                langs, best = [UNKNOWN] * part.num_rows, [0.0] * part.num_rows
                rows, places = np.zeros((part.num_rows, BUCKETS), bool), []
                for i, text in enumerate(texts(part)):
                    if model and text and has_letter(text):
                        rows[len(places)] = presence(text)
                        places.append(i)
                if places:
                    scores = model.scores(rows[: len(places)])
                    for i, own in zip(places, scores):
                        langs[i], best[i] = model.languages[int(own.argmax())], float(own.max())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(best, pa.float64())], schema.names)

    schema = extended(docs.schema, **{names[0]: "string", names[1]: "double"})
    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, **training) -> DataFrame:
    """doc_id, held_out, lang_pred, score per document.

    Rows whose crc32(doc_id) mod 5 is 0 are held out of training. Null ids are neither
    trained on nor held out. Repeated rows stay; an empty table gives no rows.
    """
    model = train(docs, **training)
    held_out = F.coalesce(crc_fold(F.col("doc_id")) == 0, F.lit(False))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
