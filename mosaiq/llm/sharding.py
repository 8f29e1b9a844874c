"""Consistent hashing with virtual nodes and bounded loads, in DataFrame functions only.

The ring is cut into a fixed number of cells. Virtual nodes sit on cell borders, so a cell belongs to one node, and all
that the walk around the ring needs is the load of each cell: a table whose size is a parameter, however many rows there
are. The walk is done on the driver over that table; rows then find their shard by their rank within their cell.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mosaiq.llm.common import cut, text_of

CELL_BITS = 14
VIRTUAL_NODES = 64


def ring(n_shards: int, virtual_nodes: int = VIRTUAL_NODES, cell_bits: int = CELL_BITS) -> list[int]:
    """The shard that owns each cell: the one whose virtual node comes next clockwise, that is at this cell or after it.

    A shard's nodes depend on its number alone, so one more shard takes cells over and moves none between the others.
    """
    cells = 1 << cell_bits
    at = {}
    for shard in range(n_shards):
        for k in range(virtual_nodes):
            place = int.from_bytes(hashlib.sha256(f"{shard}/{k}".encode()).digest()[:8], "big") >> (64 - cell_bits)
            at[place] = max(shard, at.get(place, -1))  # a later shard takes over a shared place, and only that
    places = sorted(at)
    return [at[places[bisect_left(places, cell) % len(places)]] for cell in range(cells)]


def walk(loads: list[int], owner: list[int], capacity: list[int]) -> list[list[tuple[int, int, int]]]:
    """For each cell its pieces (from, to, shard) over 0 to its load.

    First each shard takes its own cells clockwise until it is full. What overflows continues clockwise from its cell to
    the next nodes' shards that have room. A capacity for all loads must be given.
    """
    n, free = len(loads), list(capacity)
    pieces: list[list[tuple[int, int, int]]] = [[] for _ in loads]
    over: list[tuple[int, int]] = []
    for cell, load in enumerate(loads):
        if take := min(load, free[owner[cell]]):
            pieces[cell].append((0, take, owner[cell]))
            free[owner[cell]] -= take
        if take < load:
            over.append((cell, take))
    following = [0] * n  # the next cell that another shard owns
    following[n - 1] = n
    for cell in range(n - 2, -1, -1):
        following[cell] = cell + 1 if owner[cell + 1] != owner[cell] else following[cell + 1]
    for cell, done in over:
        at = cell
        for _ in range(2 * n):
            if done == loads[cell]:
                break
            at = following[at]
            if at >= n:
                at = 0
            if take := min(loads[cell] - done, free[owner[at]]):
                pieces[cell].append((done, done + take, owner[at]))
                free[owner[at]] -= take
                done += take
        if done < loads[cell]:
            raise ValueError("the shards have no room for all rows")
    return pieces


def capacities(total: int, n_shards: int, slack: float) -> list[int]:
    """Near equal shares of (1 + slack) times the total. Without slack they are equal but for one, and all become full."""
    whole = total + int(total * slack)
    return [whole // n_shards + (s < whole % n_shards) for s in range(n_shards)]


def shard_documents(docs: DataFrame, n_shards: int = 16, law: str = "rows", slack: float = 0.0, virtual_nodes: int = VIRTUAL_NODES, cell_bits: int = CELL_BITS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per input row.

    `law`: `rows` bounds the rows of a shard by (1 + slack) times the mean, and with no slack counts differ by one at most;
    `bytes` bounds the bytes likewise, but for the row that crosses the end of a piece of the ring; `key` sets no bound: doc_id and the number of shards
    decide, and grown_shard is the shard with one more. Only then is grown_shard not null.

    A row's place on the ring is a hash of doc_id, and under the bounded laws of its size and text checksum too, so that
    rows without a doc_id spread. Nulls: a null doc_id is a key like another, a null text is an empty one. Equal rows take
    neighbouring slots in any order, which gives the same table. An empty table gives an empty one. Other columns are
    left aside, whatever their names. Long texts count only by their bytes.
    """
    if law not in ("rows", "bytes", "key"):
        raise ValueError(f"unknown law {law!r}")
    text, cells = text_of(docs), 1 << cell_bits
    keys = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    place = F.xxhash64("doc_id") if law == "key" else F.xxhash64("doc_id", "size", "text_crc32")
    load = F.col("size") if law == "bytes" else F.lit(1).cast("long")
    keys = keys.withColumns({"place": place, "load": load}).withColumn("cell", F.shiftrightunsigned("place", 64 - cell_bits).cast("int"))
    # One small row for each document: written once, since both the loads and the rows themselves are needed.
    keys = cut(keys)
    by_cell = {r["cell"]: r for r in keys.groupBy("cell").agg(F.sum("load").alias("load"), F.count("*").alias("n")).collect()}  # at most 2 ** cell_bits rows
    loads = [by_cell[c]["load"] if c in by_cell else 0 for c in range(cells)]
    owner = ring(n_shards, virtual_nodes, cell_bits)
    if law == "key":
        grown = ring(n_shards + 1, virtual_nodes, cell_bits)
        pieces = [[(0, x, s)] if x else [] for x, s in zip(loads, owner, strict=True)]
    else:
        grown = [None] * cells
        pieces = walk(loads, owner, capacities(sum(loads), n_shards, slack))
    # The pieces: at most one for each cell and one more for each shard that became full.
    spark = docs.sparkSession
    table = [(c, lo, hi, s, g) for c, (own, g) in enumerate(zip(pieces, grown, strict=True)) for lo, hi, s in own]
    bounds = F.broadcast(spark.createDataFrame(table, "cell int, lo long, hi long, shard int, grown_shard int"))
    order = Window.partitionBy("cell").orderBy("place", "doc_id", "size", "text_crc32")
    before = F.coalesce(F.sum("load").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = keys.withColumns({"before": before}).join(bounds, "cell").where("before >= lo AND before < hi")
    return _slots(cut(ranked.select("doc_id", "size", "text_crc32", "cell", "place", "lo", "shard", "grown_shard")), law)


def _slots(placed: DataFrame, law: str) -> DataFrame:
    """Slots in ring order within each shard: rank within the piece, plus the rows of the shard's pieces before it."""
    sizes = placed.groupBy("shard", "cell", "lo").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("cell", "lo").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("shard", "cell", "lo", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base"))  # at most as many rows as pieces
    own = Window.partitionBy("cell", "lo", "shard").orderBy("place", "doc_id", "size", "text_crc32")
    ranked = placed.withColumn("rank", F.row_number().over(own) - 1)
    return ranked.join(F.broadcast(base), ["shard", "cell", "lo"]).select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", (F.col("base") + F.col("rank")).cast("long").alias("slot"), F.col("grown_shard").cast("int").alias("grown_shard"))
