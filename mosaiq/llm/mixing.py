"""Mixing sources to target weights: Sainte-Laguë seats for equal blocks of tokens, then a seeded choice of blocks.

Each source's documents stand in a seeded order and form one stream of words, cut into blocks of equal length, which are
dealt to the shards in turn. The seats say how many words of each source the mix takes: whole rounds of the stream first;
what remains are blocks, of which each shard has an integer quota and takes the first of its own in the seeded order.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mosaiq.llm.common import WORD, cut, text_of

BLOCK_TOKENS = 64
MAX_ROUNDS = 3
#: Mixing is set up by source; a table of more sources than this is refused rather than gathered on the driver.
MAX_SOURCES = 1_000_000
BUCKETS = 4096


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], rounds: int = MAX_ROUNDS) -> list[float]:
    """Shares of the sum of all sizes by weight; none is above `rounds` times its size, the excess goes to the others by weight."""
    out, free, left = [0.0] * len(sizes), [*range(len(sizes))], float(sum(sizes))
    while free:
        total = sum(weights[i] for i in free)
        full = [i for i in free if left * weights[i] / total > rounds * sizes[i]]
        if not full:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(rounds * sizes[i])
        left -= sum(rounds * sizes[i] for i in full)
        gone = set(full)
        free = [i for i in free if i not in gone]
    return out


def sainte_lague(seats: int, votes: Sequence[float], most: Sequence[int] | None = None) -> list[int]:
    """Seats by the highest quotients vote / (2 seat + 1); ties go to the first. `most` bounds the seats of each.

    The start is what every divisor a little too large gives; at most a seat for each is then left to the quotients.
    """
    n, whole = len(votes), float(sum(votes))
    most = [seats] * n if most is None else most
    if not n or whole <= 0 or seats <= 0:
        return [0] * n
    rate = max(0.0, seats - n / 2 - 1) / whole
    given = [min(most[i], max(0, int(votes[i] * rate + 0.5 - 1e-9 * (1 + votes[i] * rate)))) for i in range(n)]
    heap = [(-votes[i] / (2 * given[i] + 1), i) for i in range(n) if votes[i] > 0 and given[i] < most[i]]
    heapq.heapify(heap)
    left = seats - sum(given)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        given[i] += 1
        left -= 1
        if given[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * given[i] + 1), i))
    return given


def shard_quotas(blocks: int, own: Sequence[int]) -> list[int]:
    """The blocks of one source by shard, given how many each shard has of it: by the highest quotients again, none above its own."""
    return sainte_lague(blocks, own, own)


def plan_mix(sizes: Sequence[int], block_tokens: int = BLOCK_TOKENS, weights: Sequence[float] | None = None, n_shards: int = 16) -> list[dict]:
    """For each source, in order: source_size, target, words to take, whole rounds, and of what remains the quotas by shard,
    the last block that they reach and how many words of it are taken. Weights 1, 2, 3 repeat by default."""
    weights = [1 + i % 3 for i in range(len(sizes))] if weights is None else weights
    goal, block = targets(sizes, weights), max(1, block_tokens)
    seats = sainte_lague(-(-sum(sizes) // block), goal, [-(-MAX_ROUNDS * s // block) for s in sizes])
    out = []
    for size, target, given in zip(sizes, goal, seats, strict=True):
        words = min(given * block, MAX_ROUNDS * size)
        rounds, rest = divmod(words, size) if size else (0, 0)
        blocks, every = -(-rest // block), -(-size // block)
        quotas = shard_quotas(blocks, [every // n_shards + (s < every % n_shards) for s in range(n_shards)])
        last = max((s + n_shards * (q - 1) for s, q in enumerate(quotas) if q), default=-1)
        out.append({"source_size": size, "target": target, "words": words, "rounds": rounds, "quotas": quotas, "last": last, "cut": rest - block * (blocks - 1) if blocks else 0})
    return out


def mix_sources(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, seed: int = 17, n_shards: int = 16, buckets: int = BUCKETS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, shard: one row per input row.

    `taken` counts the words that the mix takes of the document, repeats included: three times its size at most. `shard`
    is that of the document's first block; null if nothing is taken.

    Nulls: a null text has no words; rows without a source form a source of their own, ordered last. Documents without
    words take nothing. Equal rows stand beside each other in the seeded order. An empty table gives an empty one. Other
    columns are left aside. A source may hold any share of the rows: its order is cut into buckets by hash, and only sums
    of buckets are ordered across them.
    """
    return _mixed(docs, block_tokens, seed, n_shards, buckets).drop("place")


def _place(docs: DataFrame, seed: int) -> Column:
    """The place in the seeded order: 60 bits of a digest, which any engine can work out."""
    known = F.concat_ws(":", F.lit(str(seed)), F.coalesce(docs["doc_id"].cast("string"), F.lit("")), text_of(docs))
    return F.conv(F.substring(F.md5(F.encode(known, "UTF-8")), 1, 15), 16, 10).cast("long")


def _mixed(docs: DataFrame, block_tokens: int, seed: int, n_shards: int, buckets: int) -> DataFrame:
    text, spark = text_of(docs), docs.sparkSession
    sized = docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words(text).alias("size"), _place(docs, seed).alias("place"))
    sized = cut(sized.withColumn("bucket", F.floor(F.col("place") / F.lit(-(-(1 << 60) // buckets))).cast("int")))
    sums = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(sums) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sums.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    plan = plan_mix([r["size"] for r in sums], block_tokens, n_shards=n_shards)
    rows = [(r["source"], p["source_size"], round(p["target"], 6), p["rounds"], p["quotas"], p["last"], p["cut"]) for r, p in zip(sums, plan, strict=True)]
    by_source = spark.createDataFrame(rows, "of string, source_size long, target double, rounds long, quotas array<int>, last long, cut int")
    by_source = F.broadcast(by_source) if len(rows) <= 100_000 else by_source  # beyond that Spark chooses
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sized.groupBy("source", "bucket").agg(F.sum("size").alias("sum")).select(F.col("source").alias("of_source"), F.col("bucket").alias("of_bucket"), F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias("base"))
    within = Window.partitionBy("source", "bucket").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = placed.join(offsets, placed["source"].eqNullSafe(offsets["of_source"]) & (placed["bucket"] == offsets["of_bucket"]))
    placed = placed.join(by_source, placed["source"].eqNullSafe(by_source["of"])).withColumn("start", F.col("base") + F.col("inner"))
    # The words of the document in each block that its shard takes beyond the rounds.
    end, block = F.col("start") + F.col("size"), F.lit(block_tokens)
    turn = lambda j: (j / n_shards).cast("long") < F.get("quotas", F.pmod(j, F.lit(n_shards)).cast("int"))
    stop = lambda j: j * block + F.when(j == F.col("last"), F.col("cut")).otherwise(block)
    inside = lambda j: F.greatest(F.lit(0), F.least(end, stop(j)) - F.greatest(F.col("start"), j * block))
    first, after = F.floor(F.col("start") / block), F.floor((end - 1) / block)
    more = F.aggregate(F.sequence(first, after), F.lit(0).cast("long"), lambda n, j: n + F.when(turn(j), inside(j)).otherwise(F.lit(0)))
    taken = F.when(F.col("size") > 0, F.col("rounds") * F.col("size") + F.when(first > F.col("last"), F.lit(0)).otherwise(more)).otherwise(F.lit(0))
    placed = placed.withColumn("taken", taken.cast("long"))
    return placed.select("doc_id", "source", "size", "source_size", "target", "taken", F.when(F.col("taken") > 0, F.pmod(first, F.lit(n_shards))).cast("int").alias("shard"), "place")


def mixed_documents(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, seed: int = 17, n_shards: int = 16, buckets: int = BUCKETS) -> DataFrame:
    """The documents that the mix takes, with the columns of docs. One is repeated as often as its words are taken, a part counting as a whole.

    Rows are told apart by doc_id, source and text; of equal rows each stands as often as the one that is taken most.
    """
    takes = _mixed(docs, block_tokens, seed, n_shards, buckets).where("taken > 0").select(F.col("source").alias("__source"), F.col("place").alias("__place"), F.ceil(F.col("taken") / F.col("size")).cast("int").alias("__n"))
    takes = takes.groupBy("__source", "__place").agg(F.max("__n").alias("__n"))
    joined = docs.join(takes, docs["source"].cast("string").eqNullSafe(takes["__source"]) & (_place(docs, seed) == takes["__place"]))
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*[docs[c] for c in docs.columns])
