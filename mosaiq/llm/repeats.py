"""Repeated windows of a corpus: which windows of each document also stand elsewhere, at any place, whoever wrote them.

1. Each document is cut into stretches (see `windows`): one short row each, with the hash of its anchor and of its content.
2. Only stretches whose anchor occurs twice or more go on. Those of equal content form a class; what is known of a class
   is its count and its first place, so copies are summed up before they meet.
3. Classes of one anchor that differ can still share windows. Their first members are the reference: they are dealt out by
   anchor into shards, and an index over each shard tells which windows repeat. Shards have a bound; an anchor whose
   classes exceed it is resolved by its single windows instead, by counts, without a limit.
4. What was found goes back to the documents as runs of windows.

The data that move are hashes and places, and once the texts for the shards and once for the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaiq.llm import windows as W
from mosaiq.llm.common import arrow_map, cut, discard, text_of

#: Bytes of text that a task looks at at once.
SLICE = 1 << 20
#: Rows from which a class is hot, and how many such classes are broadcast.
HOT, MOST_HOT = 4096, 500_000
_ROOM = 1024  # a stretch's start and its windows share a number


@dataclass(frozen=True)
class Kind:
    """What repeats are made of.

    lengths are the windows that are looked for, the shortest first: stretches are made of those, and each goes on far
    enough to hold the longest window that begins in it. index(bodies, counts) gives, for each length, which of the first
    `count` windows of each body of one shard are repeated, as masks. With `copies` the index is asked for all classes:
    copies(bodies) gives the masks of index, and those of a further copy of each body.
    """

    lengths: tuple[int, ...]
    gram: int
    stretches: Callable[[W.Bytes, int, int, int], W.Stretches]
    units: Callable[[bytes], list | bytes]
    join: Callable[[list | bytes], bytes]
    index: Callable[[list[bytes], list[int]], list[list[np.ndarray]]] | None
    #: Only windows with an equal one before them count, not the first.
    earlier: bool
    copies: Callable[[list[bytes], list[bool]], tuple[list[np.ndarray], list[np.ndarray]]] | None
    #: A shard takes anchors until it has so many bytes.
    shard_bytes: int
    #: The units of an anchor's classes that are indexed as one; beyond them its windows are counted one by one.
    anchor_units: int


def identified(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, texts): `doc`, `tie` and `text` of every row, and of every document.

    A document is what has one doc_id and text: rows that repeat both are one document, whose repeats with itself do not
    count. A null doc_id comes before all others. The tie is a hash of the text, or 0 where each doc_id stands once.
    """
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    once = ids.limit(1).count() == 0
    text = text_of(docs)
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), (F.lit(0).cast("long") if once else F.xxhash64(text)).alias("tie"), text.alias("text"))
    return rows, rows if once else rows.dropDuplicates(["doc", "tie"])


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _stretch_rows(texts: DataFrame, kind: Kind) -> DataFrame:
    def per_slice(batch: pa.RecordBatch):
        found = kind.stretches(W.bytes_of(batch.column(2)), kind.lengths[0], kind.gram, kind.lengths[-1])
        doc, tie = batch.column(0).to_numpy()[found.text], batch.column(1).to_numpy()[found.text]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (_signed(found.anchor), _signed(found.content), doc, tie, found.start * _ROOM + found.windows)], names=["h", "sh", "doc", "tie", "at"])

    return arrow_map(texts.select("doc", "tie", "text"), per_slice, "h long, sh long, doc long, tie long, at long", SLICE)


def _bodies(texts: DataFrame, wanted: DataFrame, kind: Kind) -> DataFrame:
    """The content of the wanted stretches: of large anchors a key for each window of each length, of others the body under the anchor's key, with the length 0."""

    def per_slice(batch: pa.RecordBatch):
        out = [[], [], [], [], [], [], [], []]
        for doc, tie, text, want in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            units = kind.units(text.encode())
            for x in want:
                start, count = divmod(x["at"], _ROOM)
                if x["large"]:
                    rows = [(n, hashlib.blake2b(kind.join(units[s : s + n]), digest_size=16).digest(), s * _ROOM + 1, None) for n in kind.lengths for s in range(start, min(start + count, len(units) - n + 1))]
                else:
                    rows = [(0, x["h"].to_bytes(8, "big", signed=True), x["at"], kind.join(units[start : start + count + kind.lengths[-1] - 1]))]
                for length, key, at, body in rows:
                    for column, value in zip(out, (length, key, doc, tie, at, body, x["sh"], x["n"]), strict=True):
                        column.append(value)
        types = (pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["length", "key", "doc", "tie", "at", "body", "sh", "n"])

    joined = texts.join(wanted, ["doc", "tie"]).select("doc", "tie", "text", "want")
    return arrow_map(joined, per_slice, "length int, key binary, doc long, tie long, at long, body binary, sh long, n long", SLICE)


def runs(mask: np.ndarray) -> Iterator[tuple[int, int]]:
    """(start, length) of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    yield from zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist(), strict=True)


_FOUND = "doc long, tie long, start long, windows long, length long, key binary, sh long, n long, at long"


def _indexed(bodies: DataFrame, kind: Kind) -> DataFrame:
    """The repeated windows of the bodies: anchors are dealt out whole, and a task indexes one shard of them after another.

    Where the index is asked for copies, rows with a key say which windows of a class (key, sh) its further copies repeat.
    """

    def run(batches):
        shard: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != last and size >= kind.shard_bytes:
                    yield close(shard)
                    shard, size = [], 0
                last = row[0]
                shard.append(row)
                size += len(row[4])
        if shard:
            yield close(shard)

    def close(shard: list[tuple]) -> pa.RecordBatch:
        out = [[], [], [], [], [], [], [], [], []]

        def put(*row) -> None:
            for column, value in zip(out, row, strict=True):
                column.append(value)

        begin = 0
        while begin < len(shard):  # a kind that counts only earlier windows has one automaton for each anchor
            end = begin + 1
            while end < len(shard) and (not kind.earlier or shard[end][0] == shard[begin][0]):
                end += 1
            rows = shard[begin:end]
            if kind.copies is None:
                found = kind.index([r[4] for r in rows], [r[3] % _ROOM for r in rows])
            else:
                masks, again = kind.copies([r[4] for r in rows], [r[6] > 1 for r in rows])
                found = [masks]
                for (key, doc, tie, at, _, sh, n), mask in zip(rows, again, strict=True):
                    for start, count in runs(mask):
                        put(doc, tie, start, count, kind.lengths[0], key, sh, n, at)
            for length, masks in zip(kind.lengths, found, strict=True):
                for (_, doc, tie, at, *_), mask in zip(rows, masks, strict=True):
                    for start, count in runs(mask):
                        put(doc, tie, at // _ROOM + start, count, length, None, None, None, None)
            begin = end
        types = [pa.binary() if k == 5 else pa.int64() for k in range(9)]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=[x.split(" ")[0] for x in _FOUND.split(", ")])

    dealt = bodies.repartition("key").sortWithinPartitions("key", "doc", "tie", "at")
    return dealt.mapInArrow(run, _FOUND)


def _in_classes(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of the classes (h, sh, n, first). Classes of very many rows are few, so they are sent to the rows; a task never gets all rows of one."""
    hot = classes.where(F.col("n") > HOT)
    many = hot.count()
    if not 0 < many <= MOST_HOT:  # beyond that Spark joins by shuffling, and splits what is skewed
        return rows.join(classes, ["h", "sh"])
    cold = rows.join(F.broadcast(hot.select("h", "sh")), ["h", "sh"], "left_anti").join(classes.where(F.col("n") <= HOT), ["h", "sh"])
    return rows.join(F.broadcast(hot), ["h", "sh"]).unionByName(cold)


def repeated_windows(texts: DataFrame, kind: Kind) -> DataFrame:
    """doc, tie and found: an array of (start, windows, length), of every document with a repeated window."""
    place = F.struct("doc", "tie", "at")
    rows = _stretch_rows(texts, kind)
    # Written first: a join whose sides come straight from their shuffles lets Spark split the hot anchors.
    twice = cut(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    kept = cut(rows.join(twice, "h", "left_semi").sortWithinPartitions("h", "sh"))
    discard(twice)
    classes = cut(kept.groupBy("h", "sh").agg(F.count("*").alias("n"), F.min(place).alias("first")))
    units = F.sum(F.col("first.at") % _ROOM + (kind.lengths[-1] - 1))
    # Where all classes are repeated anyway, and the first too, there is nothing to look for, unless the index is to say so.
    open_ = F.lit(True) if kind.copies else (F.count("*") > 1) & (F.min("n") == 1)
    groups = classes.groupBy("h").agg(open_.alias("open"), (units > kind.anchor_units).alias("large")).where("open").select("h", "large")
    wanted = classes.join(groups, "h").select("first.*", "h", "sh", "n", "large").groupBy("doc", "tie").agg(F.collect_list(F.struct("h", "sh", "n", "at", "large")).alias("want"))  # of one document
    bodies = cut(_bodies(texts, wanted, kind))
    asked = bodies.where("length = 0").select("key", "doc", "tie", "at", "body", "sh", "n")
    inner = cut(_indexed(asked, kind)) if kind.copies else _indexed(asked, kind)
    single = bodies.where("length > 0").select("key", "length", "doc", "tie", "at")
    counted = single.groupBy("key", "length").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1")
    split = lambda df: df.select("doc", "tie", F.floor(F.col("at") / _ROOM).alias("start"), (F.col("at") % _ROOM).alias("windows"), F.col("length").cast("long").alias("length"))
    other = (place != F.col("first")) if kind.earlier else F.lit(True)
    by_window = split(single.join(counted, ["key", "length"]).where(other))
    every = F.explode(F.array(*map(F.lit, kind.lengths)))
    if kind.copies:
        # What the index says of a class's copies; classes of large anchors go by their counts.
        said = inner.where("key IS NOT NULL").select(F.conv(F.hex("key"), 16, -10).cast("long").alias("h"), "sh", "n", F.struct("doc", "tie", "at").alias("first"), F.col("start").alias("from"), F.col("windows").alias("count"))
        rest = classes.where("n > 1").join(groups.where("large"), "h", "left_semi").select("h", "sh", "n", "first", F.lit(0).cast("long").alias("from"), (F.col("first.at") % _ROOM).alias("count"))
        copies = _in_classes(kept, said.unionByName(rest)).where(other)
        whole = copies.select("doc", "tie", (F.floor(F.col("at") / _ROOM) + F.col("from")).alias("start"), F.col("count").alias("windows"), F.lit(kind.lengths[0]).cast("long").alias("length"))
    else:
        whole = split(_in_classes(kept, classes.where("n > 1")).where(other).withColumn("length", every))
    inside = inner.where("key IS NULL").select("doc", "tie", "start", "windows", "length")
    found = cut(whole.unionByName(by_window).unionByName(inside).groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "windows", "length")).alias("found")))
    discard(kept, classes, bodies, *([inner] if kind.copies else []))
    return found


Found = tuple[np.ndarray, np.ndarray, np.ndarray]


def found_rows(column: pa.Array) -> Iterator[Found]:
    """For each row of a column `found` its starts, windows and lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    at, values = column.offsets.to_numpy(), column.values
    start, windows, length = (values.field(k).to_numpy(zero_copy_only=False) for k in range(3))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield start[a:b], windows[a:b], length[a:b]


def removed_mask(n: int, length: int, found: Found) -> np.ndarray | None:
    """Which of n units the found windows of a length cover; None if none. Windows that would reach beyond the text are none."""
    start, windows, lengths = found
    own = (lengths == length) & (start + length <= n)
    if not own.any():
        return None
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, start[own], 1)
    np.add.at(change, np.minimum(start[own] + windows[own] + length - 1, n), -1)
    return np.cumsum(change[:n]) > 0


__all__ = ["Kind", "found_rows", "identified", "removed_mask", "repeated_windows", "runs"]
