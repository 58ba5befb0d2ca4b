"""Benchmark decontamination by a positional inverted index, in DataFrame operations only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierstone.llm.common import ascii_lower, free_name, scratch

#: Everything below 0x80 that is neither a digit nor a lower-case letter separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
#: A near match has this share of a window's words, each at most so many places from where the window has it,
#: and as many of its pairs of neighbours as that leaves (`near_occurrences`).
NEAR_SHARE, NEAR_SLOP = 0.8, 1
#: So many of a window's pairs, the commonest, give no candidates; the others suffice to find every match.
SPARED_PAIRS = 2


def split_words(text: Column) -> Column:
    """Words by place; an empty part at either end is no word but keeps the places consistent."""
    return F.split(ascii_lower(text), SEPARATORS)


def word_total(parts: Column) -> Column:
    edges = (F.element_at(parts, 1) == "").cast("long") + (F.element_at(parts, -1) == "").cast("long")
    return F.coalesce(F.greatest(F.size(parts) - edges, F.lit(0)), F.lit(0)).cast("long")


@dataclass
class Phrases:
    """Windows of the benchmark, each distinct one once.

    terms: (term, term_id). windows: (win, off, term_id). pairs: (win, off, pair_id), of neighbouring
    words. owners: (win, item_id). runs: (run, at, pair_id), the pairs of whole items, each distinct one once;
    places: (run, at, win), where its windows begin.
    """

    terms: DataFrame
    windows: DataFrame
    pairs: DataFrame
    owners: DataFrame
    runs: DataFrame
    places: DataFrame
    window: int


def phrases(benchmark: DataFrame, window: int = WINDOW) -> Phrases:
    """Windows of `window` consecutive words; a shorter item with a word is one window.

    Null texts have none. Items that repeat an id count as one item. A null id is ''. Terms go by
    their 64-bit hash, so nothing is numbered in one task.
    """
    parts = F.filter(split_words(F.col("text")), lambda w: w != "")
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), parts.alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    cut = items.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("words", s, F.lit(window)))).alias("words"))
    owners = scratch(cut.distinct(), "windows")
    terms = owners.select(F.explode("words").alias("term")).distinct()
    terms = scratch(terms.withColumn("term_id", F.xxhash64("term")), "terms")
    windows = owners.select("words").distinct().withColumn("win", F.xxhash64(F.array_join("words", " "), F.lit(1)))
    each = windows.select("win", F.posexplode("words").alias("off", "term")).join(terms, "term")
    windows = scratch(each.select("win", "off", "term_id"), "window-terms")
    name = lambda words: F.xxhash64(F.array_join(words, " "), F.lit(1))
    named = owners.select(name("words").alias("win"), "item_id", "words")
    pairs = scratch(named.select("win", "words").distinct().select("win", F.posexplode(neighbours("words")).alias("off", "pair_id")), "window-pairs")
    owners = scratch(named.select("win", "item_id").distinct(), "window-owners")
    whole = items.select("words").distinct().withColumn("run", name("words"))
    runs = scratch(whole.select("run", F.posexplode(neighbours("words")).alias("at", "pair_id")), "item-pairs")
    at = F.transform(starts, lambda s: F.struct((s - 1).alias("at"), name(F.slice("words", s, F.lit(window))).alias("win")))
    places = scratch(whole.select("run", F.explode(at).alias("w")).select("run", "w.*"), "window-places")
    return Phrases(terms, windows, pairs, owners, runs, places, window)


def neighbours(words: str) -> Column:
    """One hash per word and its follower."""
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.xxhash64(w, F.get(words, i + 1)))


def build_index(docs: DataFrame, terms: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Stored postings (doc, doc_id, text_hash, n_words, pos, term_id, pair_id) of every occurrence of the terms.

    One pass over the texts. Each document also keeps a row of its first place, with a null
    term if that word is not sought, so that documents without postings are not lost. `doc`
    numbers rows, as ids may repeat or be null. Where the word and its follower are one of `pairs`, `pair_id` says so.
    """
    rows = docs.select("doc_id", "text").withColumn("doc", F.monotonically_increasing_id())
    parts = rows.select("doc", "doc_id", F.xxhash64("text").alias("text_hash"), split_words(F.col("text")).alias("parts"))
    head = ("doc", "doc_id", "text_hash", word_total(F.col("parts")).alias("n_words"))
    if pairs is None:
        tokens = parts.select(*head, F.posexplode_outer("parts").alias("pos", "term")).join(terms, "term", "left").withColumn("pair_id", F.lit(None).cast("long"))
    else:
        followed = F.arrays_zip(F.col("parts").alias("term"), F.slice("parts", F.lit(2), F.greatest(F.size("parts"), F.lit(1))).alias("next"))
        tokens = parts.select(*head, F.posexplode_outer(followed).alias("pos", "t")).select("doc", "doc_id", "text_hash", "n_words", "pos", "t.term", "t.next")
        tokens = tokens.join(terms, "term", "left").withColumn("pair", F.when(F.col("term_id").isNotNull() & F.col("next").isNotNull(), F.xxhash64("term", "next")))
        tokens = tokens.join(pairs.select(F.col("pair_id").alias("pair"), F.col("pair_id")).distinct(), "pair", "left")
    found = tokens.filter("term_id is not null or pos = 0 or pos is null")
    return scratch(found.select("doc", "doc_id", "text_hash", "n_words", "pos", "term_id", "pair_id"), "postings")


def ranked_windows(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(win, len, terms): each window's (n, off, term_id), rarest first; windows with an absent term are gone.

    Occurrences are counted over the whole index.
    """
    counts = index.filter("term_id is not null").groupBy("term_id").agg(F.count("*").alias("n"))
    each = windows.join(counts, "term_id", "left")
    by_window = each.groupBy("win").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "term_id"))).alias("terms"))
    return scratch(by_window.filter(F.col("terms")[0]["n"] > 0).withColumn("len", F.size("terms")), "ranked-windows")


def occurrences(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(doc, win, start, len): where windows occur word for word.

    The two rarest terms come first: postings of the rarest give a start each (place minus
    offset), kept if the second rarest has a posting that fits the same start. Only then are
    the other terms' lists looked up.
    """
    postings = index.filter("term_id is not null").select("doc", "pos", "term_id")
    ranked = ranked_windows(index, windows)
    first, second = F.col("terms")[0], F.when(F.col("len") > 1, F.col("terms")[1])
    pairs = ranked.select("win", "len", first["term_id"].alias("term_id"), first["off"].alias("off"), second["term_id"].alias("term_2"), second["off"].alias("off_2"))
    # the list of rarest terms is narrow, so that postings of other terms seldom need a shuffle to be left out
    rare_one = scratch(pairs.select("term_id").distinct(), "rarest-terms")
    begun = postings.join(rare_one, "term_id", "left_semi").join(pairs, "term_id").withColumn("start", F.col("pos") - F.col("off")).filter("start >= 0")
    begun = begun.select("doc", "win", "len", "start", F.col("term_2").alias("term_id"), (F.col("start") + F.col("off_2")).alias("at"))
    alone = begun.filter("len = 1").select("doc", "win", "len", "start")
    second_terms = scratch(pairs.select(F.col("term_2").alias("term_id")).distinct(), "second-terms")
    rare_two = postings.join(second_terms, "term_id", "left_semi")
    both = fitting(begun.filter("len > 1"), rare_two, 0).select("doc", "win", "len", "start")
    kept = scratch(both.union(alone).distinct(), "candidate-starts")
    # the rest of the lists, of documents that still have a candidate
    there = fitting(wanted_terms(kept, ranked), open_postings(postings, kept), 0)
    found = there.groupBy("doc", "win", "len", "start").agg(F.count_distinct("off").alias("n_found"))
    return found.filter("n_found = len").drop("n_found")


def near_occurrences(index: DataFrame, sought: Phrases, slop: int = NEAR_SLOP, min_share: float = NEAR_SHARE) -> DataFrame:
    """(doc, win, start, len, n_found): proximity matches, exact ones among them; the index has `sought.pairs`.

    A window of n words matches at a start if need = ceil(min_share * n) or more of its words have a place at most `slop` from
    start + offset, and of its n - 1 pairs of neighbours so many still are neighbours there as n - need changed
    words leave at least: n - 1 - 2 (n - need), and one in any case. Changed, missing and new words may be any, the
    rarest too, and absent from the corpus. A window of one word matches exactly. A start may lie up to `slop` before the text.

    Nothing is missed: all pairs of a match lie within 2 slop + 1 neighbouring diagonals (place in the text less
    place in the item), and so in one of the stretches of diagonals that are counted, each place in two of them. A window's
    commonest pairs are left out of the count and of what it needs. Where an item has enough pairs on a stretch, its windows'
    pairs and words are looked up at each start the stretch allows.
    """
    postings = index.filter("term_id is not null").select("doc", "pos", "term_id")
    pair_postings = index.filter("pair_id is not null").select("doc", "pos", F.col("pair_id").alias("term_id"))
    whole = listed(sought.windows, "term_id", "terms").withColumn("len", F.size("terms"))
    pairs = listed(sought.pairs, "pair_id", "pairs").withColumnRenamed("win", "pair_win")
    asked = whole.join(pairs, F.col("win") == F.col("pair_win"), "left").drop("pair_win").withColumn("need", F.ceil(F.col("len") * F.lit(min_share)).cast("int"))
    left = F.col("len") - 1 - 2 * (F.col("len") - F.col("need"))
    asked = scratch(asked.withColumn("intact", F.when(F.col("len") == 1, 0).otherwise(F.greatest(left, F.lit(1)))), "near-windows")
    windows_of = sought.places.join(asked.select("win", "len", "intact"), "win")
    # a window's commonest pairs need not be counted: of the others a match still has so many
    counts = index.filter("pair_id is not null").groupBy("pair_id").agg(F.count("*").alias("n"))
    ranked = sought.pairs.join(counts, "pair_id", "left").join(asked.select("win", "intact"), "win")
    spared = F.least(F.lit(SPARED_PAIRS), F.col("intact") - 1)
    common = F.row_number().over(Window.partitionBy("win").orderBy(F.desc_nulls_last("n"), "off"))
    voting = ranked.withColumn("common", common).filter(F.col("common") > spared).select("win", "off", "pair_id")
    voting = voting.join(sought.places, "win").select("run", (F.col("at") + F.col("off")).alias("at"), F.col("pair_id").alias("term_id"))
    voting = scratch(voting.distinct(), "voting-pairs")
    least = scratch(windows_of.groupBy("run").agg(F.min(F.col("intact") - spared).alias("least")), "item-needs")
    width = 2 * slop + 1
    stretch = F.floor((F.col("pos") - F.col("at")) / width)
    met = pair_postings.join(voting, "term_id").select("doc", "run", "at", F.explode(F.array(stretch, stretch + 1)).alias("stretch"))
    # places in the item as marks in a long: those of a window, which has at most 64 words, never share one
    marks = F.bit_count(F.bit_or(F.expr("shiftleft(1L, at % 64)"))) if sought.window <= 64 else F.count_distinct("at")
    heard = met.groupBy("doc", "run", "stretch").agg(marks.alias("heard")).join(least, "run").filter("heard >= least")
    heard = scratch(heard.select("doc", "run", "stretch"), "near-stretches")
    first = (F.col("stretch") - 1) * width + slop
    starts = heard.select("doc", "run", F.explode(F.array(*[first + e for e in range(width)])).alias("diagonal"))
    begun = starts.join(windows_of.filter("len > 1"), "run").select("doc", "win", "len", (F.col("diagonal") + F.col("at")).alias("start"))
    alone = asked.filter("len = 1").select("win", "len", F.col("terms")[0]["term_id"].alias("term_id"))
    kept = scratch(begun.union(postings.join(alone, "term_id").select("doc", "win", "len", F.col("pos").alias("start"))).distinct(), "near-starts")
    as_terms = asked.select("win", F.transform("pairs", lambda t: F.struct(t["off"].alias("off"), t["pair_id"].alias("term_id"))).alias("terms"))

    def found_at(starts: DataFrame, of_window: DataFrame, lists: DataFrame, name: str) -> DataFrame:
        there = fitting(wanted_terms(starts, of_window), open_postings(lists, starts), slop)
        return there.groupBy("doc", "win", "len", "start").agg(F.count_distinct("off").alias(name))

    joined = found_at(kept.filter("len > 1"), as_terms, pair_postings, "n_pairs").join(asked.select("win", "intact"), "win").filter("n_pairs >= intact")
    close = joined.select("doc", "win", "len", "start").unionByName(kept.filter("len = 1"))
    found = found_at(scratch(close, "near-pairs"), asked, postings, "n_found").join(asked.select("win", "need"), "win")
    return found.filter("n_found >= need").select("doc", "win", "start", "len", "n_found")


def listed(windows: DataFrame, key: str, name: str) -> DataFrame:
    return windows.groupBy("win").agg(F.array_sort(F.collect_list(F.struct("off", key))).alias(name))


def wanted_terms(starts: DataFrame, ranked: DataFrame) -> DataFrame:
    """(doc, win, len, start, off, term_id, at): every term of the windows at candidate starts, with its place."""
    each = starts.select("doc", "win", "len", "start").join(ranked.select("win", F.explode("terms").alias("t")), "win")
    return each.select("doc", "win", "len", "start", "t.off", "t.term_id", (F.col("start") + F.col("t.off")).alias("at"))


def open_postings(postings: DataFrame, starts: DataFrame) -> DataFrame:
    return postings.join(scratch(starts.select("doc").distinct(), "candidate-documents"), "doc", "left_semi")


def fitting(wanted: DataFrame, postings: DataFrame, slop: int) -> DataFrame:
    """Rows of `wanted` (doc, term_id, at) with a posting at most `slop` places away; a row may repeat.

    Within a slop, places are cut into stretches of slop + 1, and the own and both neighbour
    stretches are looked up, so that the join stays on equal keys.
    """
    if slop == 0:
        return wanted.join(postings.withColumnRenamed("pos", "at"), ["doc", "term_id", "at"])
    width = slop + 1
    near = wanted.withColumn("stretch", F.explode(F.array(*[F.floor(F.col("at") / width) + d for d in (-1, 0, 1)])))
    cut = postings.withColumn("stretch", F.floor(F.col("pos") / width))
    return near.join(cut, ["doc", "term_id", "stretch"]).filter(F.abs(F.col("pos") - F.col("at")) <= slop)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, near: bool = False) -> DataFrame:
    """doc, doc_id, text_hash (XXH64), n_words, n_hit, n_items, item_ids (sorted strings), contaminated, per document.

    A word inside any occurrence of a window is hit. With `near`, near_items lists the items (sorted strings) of which
    a window occurs exactly or in proximity (`near_occurrences`). Null and empty texts have no words; texts
    of any length are read whole. Repeated rows stay, ties are rows alike, columns other than doc_id, text, item_id are ignored, and empty
    tables give no rows or no hits.
    """
    sought = phrases(benchmark, window)
    index = build_index(docs, sought.terms, sought.pairs if near else None)
    matched = scratch(occurrences(index, sought.windows), "matches")
    places = matched.select("doc", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("len") - 1)).alias("pos"))
    hits = places.distinct().groupBy("doc").agg(F.count("*").alias("n_hit"))

    def items_of(matches: DataFrame, name: str) -> DataFrame:
        items = matches.select("doc", "win").distinct().join(sought.owners, "win").select("doc", "item_id").distinct()
        return items.groupBy("doc").agg(F.array_sort(F.collect_list("item_id")).alias(name))

    per_doc = hits.join(items_of(matched, "item_ids"), "doc")
    if near:
        per_doc = per_doc.join(items_of(near_occurrences(index, sought), "near_items"), "doc", "full")
    per_doc = scratch(per_doc, "contaminated")
    listed = index.filter("pos = 0 or pos is null").select("doc", "doc_id", "text_hash", "n_words")
    out = listed.join(per_doc, "doc", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    none = F.array().cast("array<string>")
    ids = F.coalesce("item_ids", none)
    more = [F.coalesce("near_items", none).alias("near_items")] if near else []
    return out.select(
        "doc", "doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"), (n_hit > 0).alias("contaminated"), *more
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """`docs` without the contaminated ones, told apart by id and text.

    Rows with null or empty texts stay; of repeated rows all stay or all go; all columns stay, whatever their names;
    an empty table gives no rows, an empty benchmark all of them.
    """
    found = contamination(docs, benchmark, window).filter("contaminated")
    names = free_name(docs, "dirty_id"), free_name(docs, "dirty_text")
    dirty = scratch(found.select("doc_id", "text_hash").distinct().toDF(*names), "dirty")
    same = F.col("doc_id").eqNullSafe(F.col(names[0])) & (F.xxhash64("text") == F.col(names[1]))
    return docs.join(dirty, same, "left_anti")
