"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierstone.llm.common import count_words, free_name, scratch

BLOCK_TOKENS = 32
#: A stream, which one task sorts, holds about so many words and so many documents at most.
SHARD_TOKENS, SHARD_DOCUMENTS = 20_000_000, 1_000_000


def source_targets(sources: DataFrame, weights: Sequence[int], share: tuple[int, int], limit: int) -> DataFrame:
    """Target of each source: `share` of all sizes by weight, none above `limit` times its size.

    `sources` has (source, source_size), one row per source. Sources in code point order,
    null last, take the weights in turn; they are numbered and summed in one task, one row a source,
    which is meant for up to some millions of sources. Filling in the order of limit/weight gives the
    level at which the excess of stopped sources has been reshared until none is above.
    Everything stays integral up to one division.
    """
    numbered = sources.withColumn("n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("n") % len(weights) + 1).cast("int")).cast("long")
    cap = F.col("source_size") * limit
    weighted = numbered.withColumn("weight", weight).withColumn("cap", cap)
    order = Window.orderBy((F.col("cap") / F.col("weight")).asc(), "n")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    filled = (
        weighted.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("weight_all", F.sum("weight").over(every))
        .withColumn("wanted", F.sum("source_size").over(every) * share[0])
    )
    # level = (wanted - cap_before) / (weight_all - weight_before), as a fraction over share[1]
    rest = F.col("wanted") - F.col("cap_before") * share[1]
    over = (F.col("weight_all") - F.col("weight_before")) * share[1]
    stopped = rest * F.col("weight") >= F.col("cap") * over
    first_open = F.min(F.when(~stopped, F.struct(F.col("cap") / F.col("weight"), F.col("n"), rest, over))).over(every)
    level = first_open.getField("col3").cast("double") * F.col("weight") / first_open.getField("col4").cast("double")
    target = F.when(stopped | first_open.isNull(), F.col("cap").cast("double")).otherwise(level)
    return filled.select("source", "source_size", "weight", target.alias("target"))


def highest_quotients(votes: DataFrame, group: Sequence[str], key: Sequence[str], vote: str, seats: str) -> DataFrame:
    """Sainte-Laguë seats: within each group the `seats` highest quotients vote / (2k + 1) win.

    A party's seats lie within half the number of parties, times its share, of its exact
    quota. Only the quotients in that band are formed (about three per party); seats below
    the band are certain. Equal quotients go to the key that sorts first.
    """
    whole = Window.partitionBy(*group)
    quota = F.col(vote) / F.col("_all")
    low = F.greatest(F.lit(0.0), F.floor(quota * (F.col(seats) - F.col("_parties") / 2) - 1)).cast("long")
    high = F.ceil(quota * (F.col(seats) + F.col("_parties") / 2) + 1).cast("long")
    banded = (
        votes.withColumn("_all", F.sum(vote).over(whole))
        .withColumn("_parties", F.count(F.lit(1)).over(whole))
        .withColumn("_low", F.when(F.col("_all") > 0, low).otherwise(F.lit(0).cast("long")))
        .withColumn("_high", F.when(F.col("_all") > 0, high).otherwise(F.lit(0).cast("long")))
        .withColumn("_certain", F.sum("_low").over(whole))
    )
    quotients = banded.select("*", F.explode(F.sequence("_low", "_high")).alias("_k"))
    by_quotient = whole.orderBy((F.col(vote) / (2 * F.col("_k") + 1)).desc(), *[F.col(c).asc_nulls_last() for c in key], "_k")
    won = (F.row_number().over(by_quotient) <= F.col(seats) - F.col("_certain")) & (F.col(vote) > 0)
    ranked = quotients.withColumn("_won", won.cast("long"))
    kept = [c for c in votes.columns]
    return ranked.groupBy(*kept).agg((F.first("_low") + F.sum("_won")).alias("blocks"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: tuple[int, int] = (3, 2),
    limit: int = 2,
    block_tokens: int = BLOCK_TOKENS,
    shard_tokens: int = SHARD_TOKENS,
    shard_documents: int = SHARD_DOCUMENTS,
    seed: int = 7,
) -> DataFrame:
    """doc_id, size, source_size, target, taken, plus source, text_hash and shard, per document.

    Rows equal in id, source and text are counted first. Each (source, shard) is a stream of documents in seeded
    order, cut into blocks of `block_tokens` words. Integer quotas of blocks are allotted to sources, then within a
    source to its shards, both by highest quotients. A quota of more blocks than the stream
    has takes whole rounds first; the rest are blocks picked by a seeded rule (`picked`).
    A document's `taken` is what its words have in taken blocks.
    Rounds end at `limit`, so no document exceeds `limit` times its size.

    Null text has size 0 and is taken 0 times; null is a source of its own (last); repeated
    rows are separate documents; texts are counted whole. An empty table gives an empty result. Columns other than
    doc_id, text and source are not read. Shards are dealt by id and text, and equal rows over as many shards as they
    need, so no stream grows with the corpus, however hot its source, id or text. Streams are
    ordered by all that tells documents apart, so neither the order nor the partitioning of rows has a bearing.
    """
    return _mix(_counted(docs), weights, share, limit, block_tokens, shard_tokens, shard_documents, seed)


def _counted(docs: DataFrame, *by: Column) -> DataFrame:
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), count_words(F.col("text")).alias("size"), *by)
    return scratch(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")), "mix-sizes")


def _mix(sizes: DataFrame, weights: Sequence[int], share: tuple[int, int], limit: int, block_tokens: int, shard_tokens: int, shard_documents: int, seed: int) -> DataFrame:
    all_of = sizes.agg(F.sum(F.col("size") * F.col("copies")).alias("words"), F.sum("copies").alias("documents")).first()  # two numbers
    n_shards = F.lit(max((all_of.words or 0) // shard_tokens, (all_of.documents or 0) // shard_documents) + 1)
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.least("copies", n_shards) - 1))
    dealt = sizes.withColumn("part", part)
    held = F.floor(F.col("copies") / n_shards) + (F.col("part") < F.col("copies") % n_shards).cast("long")
    shard = F.pmod(F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed)), n_shards) + F.col("part"), n_shards)
    dealt = dealt.withColumn("held", held).withColumn("shard", shard)
    words = F.col("size") * F.col("held")
    per_shard = scratch(dealt.groupBy("source", "shard").agg(F.sum(words).alias("stream")), "mix-shards")
    per_source = per_shard.groupBy("source").agg(F.sum("stream").alias("source_size"))
    targets = source_targets(per_source, weights, share, limit)
    whole = Window.partitionBy()
    whole_mix = F.sum("source_size").over(whole) * F.least(F.lit(share[0] / share[1]), F.lit(float(limit)))
    all_blocks = F.round(whole_mix / block_tokens).cast("long")
    by_source = highest_quotients(targets.withColumn("all_blocks", all_blocks), [], ["source"], "target", "all_blocks")
    by_source = scratch(by_source.select(F.col("source").alias("s"), "source_size", "target", F.col("blocks").alias("source_blocks")), "mix-sources")
    votes = per_shard.join(by_source, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    quotas = scratch(highest_quotients(votes, ["source"], ["shard"], "stream", "source_blocks"), "mix-quotas")
    quotas = quotas.select(F.col("source").alias("s"), F.col("shard").alias("h"), "stream", "source_size", "target", "blocks")

    # One sort per (source, shard), a stream of bounded length.
    stream = Window.partitionBy("source", "shard").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id", "text_hash", "size")
    placed = dealt.withColumn("ends", F.sum(words).over(stream.rowsBetween(Window.unboundedPreceding, 0)))
    with_quota = placed.join(quotas, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("h")))
    # copies lie side by side, each with its own words
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("held")))
    each = with_quota.withColumn("copy", copy).withColumn("ends", F.col("ends") - F.col("size") * (F.col("held") - F.col("copy")))
    b = F.lit(block_tokens).cast("long")
    n_blocks = F.greatest(F.ceil(F.col("stream") / b), F.lit(1)).cast("long")
    rounds = F.least(F.floor(F.col("blocks") / n_blocks), F.lit(limit)).cast("long")
    rest = F.when(F.col("rounds") >= limit, F.lit(0)).otherwise(F.col("blocks") - F.col("rounds") * F.col("n_blocks"))
    ready = each.withColumn("n_blocks", n_blocks).withColumn("rounds", rounds).withColumn("rest", rest.cast("long"))
    starts, ends = F.col("ends") - F.col("size"), F.col("ends")

    def in_block(k: Column) -> Column:
        inside = F.least(ends, (k + 1) * b) - F.greatest(starts, k * b)
        return F.when(picked(k, F.col("rest"), F.col("n_blocks"), F.xxhash64("source", "shard", F.lit(seed))), inside).otherwise(F.lit(0).cast("long"))

    blocks = F.sequence(F.floor(starts / b).cast("long"), F.floor((ends - 1) / b).cast("long"))
    extra = F.when((F.col("size") > 0) & (F.col("rest") > 0), F.aggregate(blocks, F.lit(0).cast("long"), lambda acc, k: acc + in_block(k))).otherwise(F.lit(0))
    taken = (F.col("rounds") * F.col("size") + extra).cast("long")
    return ready.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source", "text_hash", "shard")


def picked(k: Column, rest: Column, n: Column, seed: Column) -> Column:
    """Whether block k is among the `rest` of n that are taken: systematic sampling from a seeded start.

    Of any stretch of the stream the rule takes its share to within one block, and `rest` blocks in all. The stream's
    own order is random, so the blocks are a random choice of documents.
    """
    return (k * rest + F.pmod(seed, n)) % n >= n - rest


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: tuple[int, int] = (3, 2), limit: int = 2, block_tokens: int = BLOCK_TOKENS, seed: int = 7) -> DataFrame:
    """`docs` in the mix, with size, source_size, target and taken (over 0).

    Rows meet their share by id, source, text hash and the scan partition they come from. The copies of a row are counted
    per partition, so each partition knows which of the copies' shares are its own, and hands
    them out by number: a row with millions of copies is spread over as many tasks as it has partitions, and texts are shuffled
    once. `docs` is read twice in the same partitions: give it a stored table. Which of several equal rows
    gets which share has no bearing on the result. Null texts, and empty ones, are not in the mix. All columns stay; the new ones
    get underscores before their names where those are taken.
    """
    from_part = F.spark_partition_id()
    counted = _counted(docs, from_part.alias("scan"))
    keys = ["doc_id", "source", "text_hash"]
    sizes = counted.groupBy(*keys, "size").agg(F.sum("copies").alias("copies"))
    shares = _mix(sizes, weights, share, limit, block_tokens, SHARD_TOKENS, SHARD_DOCUMENTS, seed)
    shares = shares.groupBy(*keys, "size", "source_size", "target", "taken").agg(F.count(F.lit(1)).alias("n"))
    downward = Window.partitionBy(*keys).orderBy(F.desc("taken"))
    shares = shares.withColumn("upto", F.sum("n").over(downward.rowsBetween(Window.unboundedPreceding, 0)))
    added = ("size", "source_size", "target", "taken")
    listed = shares.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("upto", *added))).alias("shares"))
    earlier = Window.partitionBy(*keys).orderBy("scan").rowsBetween(Window.unboundedPreceding, -1)
    parts = counted.withColumn("before", F.coalesce(F.sum("copies").over(earlier), F.lit(0)))
    marks = [F.col(k).isNull() for k in keys[:2]]
    known = [F.xxhash64(*keys, *marks).alias("key"), *keys]
    of_part = parts.select(*known, "scan", "before").join(listed.select(F.xxhash64(*keys, *marks).alias("key"), *[F.col(k).alias(f"l_{k}") for k in keys], "shares"), "key")
    exact = [F.col(k).eqNullSafe(F.col(f"l_{k}")) for k in keys]
    of_part = of_part.filter(exact[0] & exact[1] & exact[2]).drop(*[f"l_{k}" for k in keys])
    # names that no column of the documents has
    names = {c: free_name(docs, f"mix_{c}") for c in ("key", *keys, "scan", "before", "shares", "number", "own_hash", "own_key", "own_scan", "share")}
    of_part = of_part.select(*[F.col(c).alias(names[c]) for c in ("key", *keys, "scan", "before", "shares")])
    rows = docs.withColumn(names["own_hash"], F.xxhash64("text")).withColumn(names["own_scan"], from_part)
    own = ["doc_id", "source", names["own_hash"]]
    rows = rows.withColumn(names["own_key"], F.xxhash64(*own, *[F.col(k).isNull() for k in own[:2]]))
    # a count of equal columns is no join key: rows are dealt by key and scan alone, which the window below can use too
    equal = [F.col(mine).eqNullSafe(F.col(names[theirs])).cast("int") for mine, theirs in zip(own, keys)]
    same = (F.col(names["own_key"]) == F.col(names["key"])) & (F.col(names["own_scan"]) == F.col(names["scan"])) & (equal[0] + equal[1] + equal[2] == 3)
    copies = Window.partitionBy(names["own_key"], names["own_scan"], *own).orderBy(F.lit(0))
    joined = rows.join(of_part, same).withColumn(names["number"], F.row_number().over(copies) + F.col(names["before"]))
    given = joined.withColumn(names["share"], F.filter(names["shares"], lambda s: s["upto"] >= F.col(names["number"]))[0])
    out = {c: free_name(docs, c) for c in added}
    return given.select(*docs.columns, *[F.col(f"{names['share']}.{c}").alias(out[c]) for c in added]).filter(F.col(out["taken"]) > 0)
