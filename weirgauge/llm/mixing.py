"""Mixing sources to target weights, by DataFrame and SQL functions only.

A source is a stream of words: its documents in a seeded order, cut into blocks of a length of its own, small beside its
size and target whatever the size of the corpus. Its target gives an exact quota of block draws: whole passes over the stream and, without replacement, the rest. The quotas of all sources
are split among output shards by a tree: each node divides its quotas between two halves of its shards by a
multivariate hypergeometric draw, as a uniform shuffle of all draws would. A source's draws are numbered by a seeded
permutation of its blocks, each shard takes its range of numbers, so shards draw disjoint blocks and need no global
shuffle; within a shard, rows are shuffled locally.

Sources are ordered by code point, null last, and the weights repeat along that order. A target stops at ``most`` times
its source's size; the excess goes to the others by weight. Documents without words take no part (taken 0); null ids
and repeated rows are documents like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgauge.llm.common import numbered, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Words in a block; fewer in a source whose size or target is under so many blocks; more in one that would have more
#: than so many, which bounds the work of the tree whatever the size of the corpus.
BLOCK_WORDS = 64
FEWEST_BLOCKS, MOST_BLOCKS = 128, 1 << 22
SHARDS = 16
#: Primes above 2 ** 32: none divides a smaller number of blocks, so each steps through all blocks.
PRIMES = (4294967311, 4294967357, 4294967371, 4294967377)


def n_words(text: str = "text") -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """One row per source of (source, size) rows: source, source_size, target.

    Sources are a catalogue (a row each, names and sums only), so they are ranked in one task.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    by_ratio = Window.orderBy("_ratio", F.col("source").isNull(), "source")
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sums.select("*", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")).alias("_weight"))
    ranked = ranked.withColumn("_ratio", F.lit(most) * F.col("source_size") / F.col("_weight"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # the level that the rest would reach if this source and those with larger ratios shared what the smaller ones leave
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum(F.lit(most) * F.col("source_size")).over(before), F.lit(0))) / F.sum("_weight").over(after)
    levels = ranked.withColumn("_level", level).withColumn("_full", F.col("_ratio") <= F.col("_level")).withColumn("_rank", F.row_number().over(by_ratio))
    # the first source that is not full shares with all after it; those of the same ratio that follow would see a lower level
    reached = F.min(F.when(~F.col("_full"), F.struct("_rank", "_level"))).over(everything)["_level"]
    target = F.when(F.col("_full"), (F.lit(most) * F.col("source_size")).cast("double")).otherwise(F.col("_weight") * reached)
    return levels.select("source", "source_size", target.alias("target"))


def _let(name: str, value: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _hypergeometric(q: str, n: str, c: str, u: str) -> str:
    """SQL: how many of q marked among n are drawn when c are drawn, by inversion of the distribution at u.

    The sum runs over eight standard deviations around the mean, beyond which less than 1e-14 lies.
    """
    weight = "t.w * ((q - k) * cast(c - k as double)) / ((k + 1) * cast(n - q - c + k + 1 as double))"
    total = f"aggregate(sequence(a, b), named_struct('w', 1D, 's', 0D), (t, k) -> named_struct('w', {weight}, 's', t.s + t.w), t -> t.s)"
    pick = (
        "aggregate(sequence(a, b), named_struct('w', 1D, 's', 0D, 'x', -1L), (t, k) -> named_struct("
        f"'w', {weight}, 's', t.s + t.w, 'x', if(t.x < 0 and t.s + t.w >= u * total, k, t.x)), t -> if(t.x < 0, b, t.x))"
    )
    body = _let("total", total, pick)
    body = _let("b", "least(least(q, c), cast(ceil(mean + 8 * sd) + 1 as bigint))", body)
    body = _let("a", "greatest(greatest(0L, c - (n - q)), cast(floor(mean - 8 * sd) - 1 as bigint))", body)
    body = _let("sd", "sqrt(greatest(0D, mean * (1 - q / cast(greatest(n, 1L) as double)) * (n - c) / greatest(n - 1, 1L)))", body)
    body = _let("mean", "cast(c as double) * q / greatest(n, 1L)", body)
    for name, value in (("u", u), ("c", c), ("n", n), ("q", q)):
        body = _let(name, value, body)
    return body


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """Rows (shard, quotas) from one row ``quotas``: array of exact quotas by source. Shard sizes differ by one at most."""
    total = "aggregate(quotas, 0L, (s, q) -> s + q)"
    nodes = quotas.selectExpr("quotas", f"{total} as _all", "0L as lo", f"{shards}L as hi")
    for _ in range(math.ceil(math.log2(shards))):

        def capacity(a: str, b: str) -> str:
            return f"(({b} - {a}) * (_all div {shards}) + least({b}, _all % {shards}) - least({a}, _all % {shards}))"

        uniform = f"(pmod(xxhash64({seed}, lo, hi, e.i), 9007199254740992L) + 0.5D) / 9007199254740992D"
        drawn = _let("x", _hypergeometric("e.q", "s.n", "s.c", uniform), "named_struct('n', s.n - e.q, 'c', s.c - x, 'out', concat(s.out, array(x)))")
        left = (
            "aggregate(transform(quotas, (q, i) -> named_struct('q', q, 'i', i)), "
            f"named_struct('n', {capacity('lo', 'hi')}, 'c', {capacity('lo', 'mid')}, 'out', cast(array() as array<bigint>)), "
            f"(s, e) -> {drawn}, s -> s.out)"
        )
        halves = nodes.selectExpr("*", "(lo + hi) div 2 as mid").selectExpr("*", f"if(hi - lo > 1, {left}, quotas) as first")
        nodes = halves.selectExpr(
            "_all",
            "inline(if(hi - lo > 1, array(named_struct('lo', lo, 'hi', mid, 'quotas', first), "
            "named_struct('lo', mid, 'hi', hi, 'quotas', zip_with(quotas, first, (q, x) -> q - x))), "
            "array(named_struct('lo', lo, 'hi', hi, 'quotas', quotas))))",
        )
    return nodes.select(F.col("lo").alias("shard"), "quotas")


def plan(sizes: DataFrame, shards: int = SHARDS, seed: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: source, source_size, target, block (words in one), blocks, ends (array: draws up to each shard's end)."""
    short = F.floor(F.least(F.col("source_size").cast("double"), F.col("target")) / FEWEST_BLOCKS)
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), short), F.ceil(F.col("source_size") / MOST_BLOCKS)).cast("long")
    sources = targets(sizes).select("*", block.alias("block"))
    sources = sources.select("*", F.ceil(F.col("source_size") / F.col("block")).cast("long").alias("blocks"))
    passes = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    rest = F.round((F.col("target") - passes * F.col("source_size")) / F.col("block"))
    sources = sources.select("*", (passes * F.col("blocks") + F.least(rest, F.col("blocks"))).cast("long").alias("_quota"))
    sources = stored(sources, "mixing-sources")
    order = F.sort_array(F.collect_list(F.struct(F.col("source").isNull().alias("none"), "source", "_quota")))
    listed = sources.agg(order.alias("all"))
    tree = split_quotas(listed.select(F.col("all._quota").alias("quotas")), shards, seed)
    by_source = tree.select("shard", F.posexplode("quotas").alias("place", "_drawn"))
    ends = by_source.groupBy("place").agg(F.sort_array(F.collect_list(F.struct("shard", "_drawn"))).alias("_shards"))
    ends = ends.select("place", F.expr("transform(_shards, (x, i) -> aggregate(slice(_shards, 1, i + 1), 0L, (s, y) -> s + y._drawn))").alias("ends"))
    named = listed.select(F.posexplode("all").alias("place", "_source")).join(ends, "place")
    named = named.select(F.col("_source.source").alias("_name"), "ends")
    return stored(sources.join(named, F.col("source").eqNullSafe(F.col("_name"))).drop("_name", "_quota"), "mixing-plan")


def draws(docs: DataFrame, shards: int = SHARDS, seed: int = 0, block_words: int = BLOCK_WORDS, keep: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, draws: array of (pass, shard, from, to, place).

    ``from`` and ``to`` are words of the document, counted from 0; ``place`` is the draw's number in its source. The
    columns ``keep`` are passed on as well.
    """
    order = F.xxhash64(F.lit(seed), "doc_id", "source")
    rows = stored(docs.select(F.col("doc_id"), F.col("source"), n_words().alias("size"), order.alias("_order"), F.xxhash64("text").alias("_form"), *keep), "mixing-sizes")
    count = rows.count()
    # about as many buckets as documents in a bucket, so that neither the sums nor a bucket grow with the whole corpus
    buckets = 1 << round(math.log2(max(count, 1)) / 2)
    rows = rows.withColumn("_bucket", F.pmod("_order", F.lit(buckets)))
    sums = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    starts = sums.select("source", "_bucket", F.coalesce(F.sum("_sum").over(Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    inner = Window.partitionBy("source", "_bucket").orderBy("_order", "doc_id", "size", "_form", *keep).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_inner", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    starts = starts.select(F.col("source").alias("_s"), F.col("_bucket").alias("_b"), "_offset")
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    placed = placed.withColumn("_start", F.col("_offset") + F.col("_inner")).drop("_s", "_b")
    sources = plan(rows.select("source", "size"), shards, seed, block_words).withColumnRenamed("source", "_s")
    placed = placed.join(sources, F.col("source").eqNullSafe(F.col("_s")))
    steps = ", ".join(f"{p}L" for p in PRIMES)
    number = f"t * blocks + pmod((element_at(array({steps}), cast(t % {len(PRIMES)} + 1 as int)) % blocks) * b + pmod(xxhash64({seed}, t), blocks), blocks)"
    drawn = (
        "filter(flatten(transform(sequence(0L, ends[cardinality(ends) - 1] div blocks), t -> "
        "transform(sequence(_start div block, (_start + size - 1) div block), b -> named_struct('pass', t, 'place', "
        f"{number}, 'from', greatest(0L, b * block - _start), 'to', least(size, (b + 1) * block - _start))))), "
        "d -> d.place < ends[cardinality(ends) - 1])"
    )
    whole = f"if(size > 0, transform({drawn}, d -> named_struct('pass', d.pass, 'shard', cardinality(filter(ends, e -> e <= d.place)), 'from', d.from, 'to', d.to, 'place', d.place)), array())"
    return placed.select("doc_id", "source", "size", "source_size", "target", F.expr(whole).alias("draws"), *keep)


def taken(drawn: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: words of each document in the mix, repeats counted."""
    return drawn.select("doc_id", "size", "source_size", "target", F.expr("aggregate(draws, 0L, (s, d) -> s + d.to - d.from)").alias("taken"))


def _words(text: str, start: str, end: str) -> str:
    words = f"filter(split({text}, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w != '')"
    return f"array_join(slice({words}, cast({start} + 1 as int), cast({end} - {start} as int)), ' ')"


def _numbered_draws(docs: DataFrame, shards: int, seed: int, block_words: int) -> tuple[DataFrame, DataFrame]:
    """The documents as ``doc`` and ``row``, and (row, size, d) for each of their draws."""
    rows = numbered(docs, "mixing-documents")
    drawn = draws(rows.select("doc.doc_id", "doc.source", "doc.text", "row"), shards, seed, block_words, ["row"])
    return rows, drawn.select(F.col("row").alias("at"), "size", F.explode("draws").alias("d"))


def shuffled_shards(docs: DataFrame, shards: int = SHARDS, seed: int = 0, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix: shard, doc_id, source, text (words of one drawn block, joined by spaces); rows of a shard in random order.

    Each task sorts its shards' rows by a seeded number, nothing else moves.
    """
    rows, drawn = _numbered_draws(docs, shards, seed, block_words)
    parts = drawn.join(rows, F.col("at") == F.col("row"))
    parts = parts.select("d.shard", "doc.doc_id", "doc.source", F.expr(_words("doc.text", "d.from", "d.to")).alias("text"), F.xxhash64(F.lit(seed), "doc.source", "d.place").alias("_turn"))
    return parts.repartition("shard").sortWithinPartitions("shard", "_turn").drop("_turn")


def mixed_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix as documents: for each pass, the document with its drawn words; the whole text where all are drawn.

    Columns as in ``docs``; n_chars, if there, is counted anew. Documents of which nothing is drawn are not in the mix.
    """
    rows, drawn = _numbered_draws(docs, SHARDS, seed, BLOCK_WORDS)
    per_pass = drawn.groupBy("at", "size", "d.pass").agg(F.sort_array(F.collect_list(F.struct("d.from", "d.to"))).alias("parts"))
    joined = rows.join(per_pass, F.col("row") == F.col("at"))
    some = "array_join(transform(parts, p -> " + _words("doc.text", "p.from", "p.to") + "), ' ')"
    text = F.when(F.expr("aggregate(parts, 0L, (s, p) -> s + p.to - p.from) = size"), F.col("doc.text")).otherwise(F.expr(some))
    joined = joined.select("doc", text.alias("mixed"))
    changed = {"text": F.col("mixed")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("mixed").cast(docs.schema["n_chars"].dataType)
    return joined.select(*(changed.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns))
