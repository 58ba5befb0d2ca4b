"""Quality rules under weak supervision: rules vote or abstain, EM weighs them."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import scratch, texts

#: Characters that count as symbols, and the length of windows for repeated words.
SYMBOLS, WINDOW = b"#*$%&|<>", 5
#: Function words of common languages: running text holds many of them.
FUNCTION_WORDS = frozenset(
    b"the of and to in a is that for it with as be on by der die das und von den ist im zu ein mit le la les de des et en un une du que qui "
    b"el los las y del una por con se al".split()
)
STATS = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_function", "n_upper", "n_letters", "n_distinct", "n_wordy")
GOOD, BAD, ABSTAIN = "g", "b", "-"


def repeated_words(codes: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of `window` codes that occur twice or more, the first included."""
    n = len(codes) - window + 1
    if n < 2:
        return 0
    # number the windows exactly, one word longer at a time
    ids = codes[:n]
    for k in range(1, window):
        ids = np.unique(ids * (int(codes.max()) + 1) + codes[k : k + n], return_inverse=True)[1]
    covered = np.zeros(len(codes) + 1, np.int64)
    twice = np.flatnonzero(np.bincount(ids)[ids] > 1)
    np.add.at(covered, twice, 1)
    np.add.at(covered, twice + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def text_stats(text: str | None) -> tuple[int, ...]:
    """n_words, then the counts named in STATS."""
    raw = (text or "").encode()
    words = raw.split()  # of bytes: splits at the six ASCII white space characters only
    if not words:
        return (0,) * (len(STATS) + 1)
    numbers: dict[bytes, int] = {}
    codes = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    repeated = repeated_words(codes) if len(numbers) < len(words) else 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\f\r")]
    lowered = raw.lower()
    function = sum(int(n) for w, n in zip(numbers, np.bincount(codes)) if w.lower() in FUNCTION_WORDS)
    chars = np.frombuffer(raw, np.uint8)
    upper = int(((chars >= 65) & (chars <= 90)).sum())
    letters = upper + int(((chars >= 97) & (chars <= 122)).sum())
    is_word = np.frombuffer(lowered, np.uint8)
    # words that end in a letter or plain punctuation, unlike `word$$$` or a lone `|`
    last = np.fromiter((w[-1] for w in words), np.uint8, len(words))
    wordy = int(np.isin(last, np.frombuffer(b".,;:?)\"'", np.uint8)).sum() + ((last | 32 >= 97) & (last | 32 <= 122)).sum() + (last >= 128).sum())
    # code points: bytes that do not continue a character
    points = int(((is_word & 0xC0) != 0x80).sum()) - sum(raw.count(bytes([c])) for c in b" \t\n\x0b\f\r")
    symbols = sum(raw.count(bytes([c])) for c in SYMBOLS)
    return (len(words), points, symbols, len(lines) - len(set(lines)), repeated, len(lines), function, upper, letters, len(numbers), wordy)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, n_words and STATS for each whole text; null text has no words."""
    names = ["n_words", *STATS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_stats(x) for x in texts(batch)]
            columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{n} long" for n in names))


def share(top: str, bottom: str) -> Column:
    return F.col(top) / F.greatest(F.col(bottom), F.lit(1))


def rules() -> dict[str, tuple[Column, Column]]:
    """name -> (votes bad, votes good); neither: abstains."""
    symbols, repeats, duplicates = share("n_symbols", "n_words"), share("n_repeat_words", "n_words"), share("n_dup_lines", "n_lines")
    upper, function, length = share("n_upper", "n_letters"), share("n_function", "n_words"), share("word_chars", "n_words")
    # distinct words grow as a power of all words; the exponent means the same at any length
    variety = F.log(F.greatest("n_distinct", F.lit(1))) / F.log(F.greatest("n_words", F.lit(2)))
    wordy = share("n_wordy", "n_words")
    long_enough = F.col("n_words") >= 50
    return {
        "length": (F.col("n_words") < 5, long_enough),
        "symbols": (symbols > 0.1, symbols < 0.02),
        "repeated_words": (repeats > 0.2, repeats < 0.05),
        "repeated_lines": ((duplicates > 0.3) & (F.col("n_lines") > 2), (duplicates == 0) & (F.col("n_lines") > 2)),
        "capitals": (upper > 0.4, upper < 0.15),
        "function_words": ((function < 0.02) & long_enough, function > 0.08),
        "word_length": ((length < 2.5) | (length > 14), (length > 3) & (length < 11)),
        "distinct_words": ((variety < 0.6) & long_enough, (variety > 0.75) & long_enough),
        "word_ends": (wordy < 0.5, wordy > 0.85),
    }


def vote_pattern() -> Column:
    return F.concat(*[F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN) for bad, good in rules().values()])


def fit(patterns: Mapping[str, int], rounds: int = 200) -> tuple[float, np.ndarray]:
    """Prior of good and accuracies [rule, (on bad, on good)] by EM over vote patterns.

    A vote is right with a probability that depends on the rule and the class; whether a
    rule votes at all says nothing. Every rule stays a little better than chance (its two
    accuracies sum to over one), which fixes which class is which; a rule for one fault may
    call most bad texts good, so the accuracy on bad has no floor of its own.
    """
    keys = list(patterns)
    n = np.array([patterns[k] for k in keys], float)
    votes = np.array([[(c == GOOD) - (c == BAD) for c in k] for k in keys], float).reshape(len(keys), -1)
    prior, right = 0.8, np.tile([0.4, 0.95], (votes.shape[1], 1))
    for _ in range(rounds):
        p = posterior(votes, prior, right)
        mass = np.stack([(1 - p) * n, p * n])
        prior = float(np.clip(mass[1].sum() / max(n.sum(), 1), 0.5, 0.99))
        for side, vote, hits, cast in ((1, 1, 4.5, 5), (0, -1, 1, 2)):
            hits = hits + mass[side] @ (votes == vote)
            cast = cast + mass[side] @ (votes != 0)
            right[:, side] = np.clip(hits / cast, 0.01, 0.995)
        right[:, 0] = np.maximum(right[:, 0], 1 - right[:, 1] + 0.01)
    return prior, right


def posterior(votes: np.ndarray, prior: float, right: np.ndarray) -> np.ndarray:
    """Probability of good for rows of votes in {-1, 0, 1}."""
    on_bad, on_good = right[:, 0], right[:, 1]
    odds = np.log(prior / (1 - prior)) + (votes == 1) @ np.log(on_good / (1 - on_bad)) + (votes == -1) @ np.log((1 - on_good) / on_bad)
    return 1 / (1 + np.exp(-odds))


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Counts, base_failed, votes, quality (posterior of good) and kept, per document.

    Documents are reduced to vote patterns, of which there are at most 3 ** rules, and EM
    runs on the pattern counts. Null and empty texts have no words and fail the base rules. Texts are measured whole, of any
    length; a quality equal to the threshold keeps. Repeated rows stay; other columns are ignored; an empty table gives no rows.
    """
    measured = scratch(measure(docs).withColumn("votes", vote_pattern()), "quality-stats")
    counts = {r["votes"]: r["n"] for r in measured.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()}
    prior, right = fit(counts) if counts else (0.5, np.full((len(rules()), 2), 0.75))
    table = [(k, float(posterior(np.array([[(c == GOOD) - (c == BAD) for c in k]], float), prior, right)[0])) for k in counts]
    scores = docs.sparkSession.createDataFrame(table, "votes string, quality double")
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    judged = measured.join(F.broadcast(scores), "votes")  # bounded by the number of patterns
    judged = judged.withColumn("base_failed", base_failed)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
