"""Suffix-array dedup over bytes by a run-length index.

Over each shard of reference stretches the Burrows-Wheeler transform is built and cut into runs. Suffixes are sampled only
at the ends of runs, and only there common prefixes are measured: within a run the match of the next place in the text is
that of the place before, less one. Streaming along the text from sample to sample gives the matching statistics of all
places, and those of the threshold or longer mark repeats. In repetitive corpora the runs are few.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaiq.llm import windows as W
from mosaiq.llm.common import arrow_map
from mosaiq.llm.repeats import SLICE, Kind, found_rows, identified, removed_mask, repeated_windows, runs

#: Removed are windows of WINDOW bytes. Those of PASSAGE bytes, some forty words, are marked: passages that repeat.
WINDOW, PASSAGE, GRAM = 400, 240, 48
#: A shard takes anchors until it has so many bytes; an anchor of more bytes than this is not indexed (see repeats).
SHARD_BYTES, ANCHOR_BYTES = 1 << 17, 1 << 21


def suffix_order(text: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """The suffix array by prefix doubling, and the ranks of the prefixes of each depth on the way.

    A rank is the first slot of those who share it, so a round sorts only what still shares one, in its own slots.
    """
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = key << np.uint64(8) | padded[i : i + n]
    order = np.argsort(key).astype(np.int32)  # a shard is far smaller than 2 ** 31
    head = np.ones(n + 1, bool)
    key = key[order]
    head[1:n] = key[1:] != key[:-1]
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(head[:n], np.arange(n, dtype=np.int32), 0))
    depth, levels = 8, [(8, rank)]
    while depth < n:
        slots = np.flatnonzero(~(head[:n] & head[1:]))  # what shares its rank
        if not len(slots):
            break
        part = order[slots]
        after = np.zeros(len(part), np.uint64)
        inside = part + depth < n
        after[inside] = rank[part[inside] + depth].astype(np.uint64) + np.uint64(1)
        key = rank[part].astype(np.uint64) << np.uint64(32) | after
        by = np.argsort(key)
        part, key = part[by], key[by]
        new = np.ones(len(part), bool)
        new[1:] = key[1:] != key[:-1]
        order[slots], head[slots[new]] = part, True
        rank = rank.copy()
        rank[part] = np.maximum.accumulate(np.where(new, slots, 0))
        depth *= 2
        levels.append((depth, rank))
    return order, levels


def common_prefix(text: np.ndarray, levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The lengths of the common prefixes of the suffixes at a and b, different places: the ranks halve the way."""
    n, a, b = len(text), a.copy(), b.copy()
    size = np.zeros(len(a), np.int32)
    for depth, rank in reversed(levels):
        more = np.flatnonzero((a + depth <= n) & (b + depth <= n))
        more = more[rank[a[more]] == rank[b[more]]]
        size[more] += depth
        a[more] += depth
        b[more] += depth
    for _ in range(8):
        more = np.flatnonzero((a < n) & (b < n))
        more = more[text[a[more]] == text[b[more]]]
        size[more] += 1
        a[more] += 1
        b[more] += 1
    return size


class RunLengthIndex:
    """The runs of the transform, with the places of the suffixes at their ends and the matches across each border.

    heads and tails are the suffixes at the first and last slot of each run; only they are compared with their neighbours.
    match has for each place of the text the length of its longest match with another place.
    """

    def __init__(self, text: np.ndarray):
        order, self.levels = suffix_order(text)
        before = text[order - 1].astype(np.int16)
        before[order == 0] = -1  # nothing stands before the first place: a run of its own
        border = np.flatnonzero(before[1:] != before[:-1]) + 1
        self.n, self.runs = len(text), len(border) + 1
        self.heads, self.tails = order[np.append(0, border)], order[np.append(border, self.n) - 1]
        across = common_prefix(text, self.levels, self.heads[1:], self.tails[:-1])
        down = self._along(self.heads, np.concatenate([[0], across]))
        self.match = np.maximum(down, self._along(self.tails, np.concatenate([across, [0]])))

    def _along(self, samples: np.ndarray, match: np.ndarray) -> np.ndarray:
        """The matches of all places with their neighbour on one side: from sample to sample each is that before, less one."""
        reach = np.zeros(self.n, np.int64)
        reach[samples] = match + samples
        return np.maximum(np.maximum.accumulate(reach) - np.arange(self.n), 0)

    def named(self, at: np.ndarray, length: int) -> np.ndarray:
        """A number for each place: equal where the next `length` bytes are. The two ranks of overlapping prefixes name them."""
        depth, rank = max((x for x in self.levels if x[0] <= length), key=lambda x: x[0])
        return rank[at].astype(np.uint64) << np.uint64(32) | rank[at + (length - depth)].astype(np.uint64)


def index(bodies: list[bytes], counts: list[int], lengths: tuple[int, ...]) -> list[list[np.ndarray]]:
    """For each length, which of the first `count` windows of each body stand at another place.

    A body goes on beyond the windows that begin in it, and where a document's stretches of one anchor overlap, the same
    place is in two bodies. So a window of less than the greatest length is confirmed by an equal one that begins in its body.
    """
    text = np.frombuffer(b"".join(x + b"\xff" for x in bodies), np.uint8)
    found = RunLengthIndex(text)
    begin = np.cumsum([0, *(len(x) + 1 for x in bodies)])
    size = np.repeat([len(x) for x in bodies], [len(x) + 1 for x in bodies])
    place = np.arange(len(text)) - np.repeat(begin[:-1], [len(x) + 1 for x in bodies])
    own = place < np.repeat(counts, [len(x) + 1 for x in bodies])
    out = []
    for length in lengths:
        long = own & (place + length <= size) & (found.match >= length)
        if length < max(lengths):
            at = np.flatnonzero(long)
            _, same, n = np.unique(found.named(at, length), return_inverse=True, return_counts=True)
            long[at] = n[same] > 1
        out.append([long[b : b + count] for b, count in zip(begin[:-1].tolist(), counts, strict=True)])
    return out


def kind(window: int = WINDOW, passage: int | None = None, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, anchor_bytes: int = ANCHOR_BYTES) -> Kind:
    lengths = (window,) if passage in (None, window) else (passage, window)
    return Kind(lengths, gram, W.byte_stretches, lambda text: text, lambda units: units, lambda bodies, counts: index(bodies, counts, lengths), False, None, shard_bytes, anchor_bytes)


def remove_repeats(docs: DataFrame, window: int = WINDOW, passage: int | None = PASSAGE, shard_bytes: int = SHARD_BYTES, anchor_bytes: int = ANCHOR_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans, passages and kept: one row per input row.

    Removed is each byte of the UTF-8 text that lies in a run of `window` bytes which also stands anywhere else, in the same
    document or another, overlaps included. spans are the maximal removed runs as (start, end) in bytes; kept are the other
    bytes, which may cut a letter. passages are the runs of bytes that lie in strings of `passage` bytes which stand
    elsewhere: they hold the spans, and shorter repeats that are left in place. Its length is at most that of a window.

    Nulls: a null text is an empty one; rows that share a doc_id, or have none, are told apart by a hash of their texts.
    Equal rows are one document, no repeat of itself, and give equal results. Texts shorter than a window are kept. An
    empty table gives an empty one; other columns are left aside. Texts of any length are taken whole.
    """
    passage = window if passage is None else min(passage, window)
    rows, texts = identified(docs)
    found = repeated_windows(texts, kind(window, passage, max(1, min(GRAM, passage // 2)), shard_bytes, anchor_bytes))
    listed = lambda mask: [] if mask is None else [{"start": a, "end": a + k} for a, k in runs(mask)]

    def per_slice(batch: pa.RecordBatch):
        n, gone, spans, passages, kept = [], [], [], [], []
        for text, have in zip(batch.column(1).to_pylist(), found_rows(batch.column(2)), strict=True):
            data = text.encode()
            mask = removed_mask(len(data), window, have)
            n.append(len(data))
            gone.append(0 if mask is None else int(mask.sum()))
            spans.append(listed(mask))
            passages.append(listed(removed_mask(len(data), passage, have)))
            kept.append(data if mask is None else np.frombuffer(data, np.uint8)[~mask].tobytes())
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        columns = [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span), pa.array(passages, span), pa.array(kept, pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_bytes", "n_removed", "spans", "passages", "kept"])

    joined = rows.join(found, ["doc", "tie"], "left").select("doc_id", "text", "found")
    id_kind, span = docs.schema["doc_id"].dataType.simpleString(), "array<struct<start:bigint,end:bigint>>"
    return arrow_map(joined, per_slice, f"doc_id {id_kind}, n_bytes long, n_removed long, spans {span}, passages {span}, kept binary", SLICE)


def digest(docs: DataFrame) -> DataFrame:
    """The registered columns, and the number of passages with the bytes in them."""
    size = F.aggregate("passages", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2(F.col("kept"), 256).alias("kept_sha256"),
        F.size("passages").cast("long").alias("n_passages"), size.alias("n_passage_bytes"),
    )
