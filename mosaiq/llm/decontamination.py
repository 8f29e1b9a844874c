"""Benchmark decontamination by pigeonhole edit matching over words.

An item of m words with a budget of e edits is split into e + 1 pieces: whatever the edits, one piece stays whole. An
automaton finds whole pieces in the documents; only there the item is compared, by Myers' bit-parallel distance with
words as its letters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaiq.llm.common import arrow_map, text_of

ERROR_RATE = 0.2
#: Items with fewer words are looked for without edits: a few words with one changed say too little to be a leak.
LEAST_WORDS = 8
#: Letters of items that one pass over the documents takes: it bounds what is broadcast.
BLOCK_CHARS = 16 << 20
_TOKEN = re.compile(r"[^\W_]+")


class Item(NamedTuple):
    item_id: object
    words: tuple[str, ...]
    budget: int


class Hit(NamedTuple):
    item_id: object
    start: int
    end: int
    distance: int


def tokens(text: str) -> list[re.Match]:
    """Words in lower case, without punctuation: marks between words hide no leak."""
    return list(_TOKEN.finditer(text.lower() if len(text.lower()) == len(text) else text))


def pieces(item: Item) -> Iterator[tuple[int, tuple[str, ...]]]:
    """Budget + 1 runs of nearly equal length with their offsets, which together are the item."""
    n, k = len(item.words), item.budget + 1
    for i in range(k):
        lo, hi = i * n // k, (i + 1) * n // k
        yield lo, item.words[lo:hi]


def search(masks: dict[str, int], m: int, text: list[str], most: int) -> tuple[int, int] | None:
    """The least distance of the pattern to any stretch of text, and where it first ends; None if beyond most.

    masks has for each word of the pattern the bits of its places. One step handles all m places of a column.
    """
    top, full = 1 << (m - 1), (1 << m) - 1
    pv, mv, score, best = full, 0, m, None
    for j, word in enumerate(text):
        eq = masks.get(word, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (full & ~(xh | pv)), pv & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = (ph << 1) & full, (mh << 1) & full  # a stretch may begin anywhere: no cost comes in from above
        pv, mv = mh | (full & ~(xv | ph)), ph & xv
        if score <= most and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


def masks_of(words: tuple[str, ...] | list[str]) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


class Matcher:
    """Finds the items of one block in a text."""

    def __init__(self, items: list[Item]):
        self.items = items
        self.masks = [(masks_of(x.words), masks_of(x.words[::-1])) for x in items]
        places: dict[str, list[tuple[int, int]]] = {}
        for i, item in enumerate(items):
            for offset, piece in pieces(item):
                places.setdefault(f" {' '.join(piece)} ", []).append((i, offset))
        self.automaton = ahocorasick.Automaton()
        for key, value in places.items():
            self.automaton.add_word(key, (value, key.count(" ") - 1))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[Hit]:
        if not text or not self.items:
            return []
        found = tokens(text)
        words = [m.group().lower() for m in found]
        line, begin, at = " " + " ".join(words) + " ", {}, 0
        for k, w in enumerate(words):
            begin[at] = k
            at += len(w) + 1
        hits: dict[tuple[int, int], Hit] = {}
        done: dict[int, int] = {}  # by item: up to which start its alignments are settled
        for end, (value, n) in self.automaton.iter(line):
            last = begin_at(begin, line, end, n)
            for i, offset in value:
                item, m = self.items[i], len(self.items[i].words)
                start = last - offset
                if start <= done.get(i, -1):
                    continue
                lo, hi = max(0, start - item.budget), min(len(words), start + m + item.budget)
                if (got := search(self.masks[i][0], m, words[lo:hi], item.budget)) is None:
                    continue
                stop = lo + got[1]
                back = search(self.masks[i][1], m, words[max(lo, stop - m - item.budget) : stop][::-1], got[0])
                first = stop - back[1] if back else lo
                hits[i, first] = Hit(item.item_id, found[first].start(), found[stop - 1].end(), got[0])
                done[i] = max(start, first + item.budget)  # its other pieces; another copy starts later
        return sorted(hits.values(), key=lambda h: (h.start, h.end, str(h.item_id)))


def begin_at(begin: dict[int, int], line: str, end: int, n: int) -> int:
    """The number of the word at which the piece of n words begins that ends with the blank at `end`."""
    at = end
    for _ in range(n):
        at = line.rindex(" ", 0, at)
    return begin[at]


def item_blocks(benchmark: DataFrame, error_rate: float, least_words: int, block_chars: int = BLOCK_CHARS) -> Iterator[list[Item]]:
    """The distinct items in blocks of bounded size, streamed from the benchmark."""
    block, size = [], 0
    for row in benchmark.select("item_id", text_of(benchmark).alias("text")).toLocalIterator():
        words = tuple(m.group().lower() for m in tokens(row["text"]))
        if not words:
            continue
        if size and size + len(row["text"]) > block_chars:
            yield block
            block, size = [], 0
        block.append(Item(row["item_id"], words, int(error_rate * len(words)) if len(words) >= least_words else 0))
        size += len(row["text"])
    yield block


def _row(docs: DataFrame) -> Column:
    """What tells rows apart that share a doc_id, or have none: leaks depend on the text alone."""
    return F.xxhash64(text_of(docs))


def find_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, least_words: int = LEAST_WORDS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id and leaks: an array of (item_id, start, end, distance) in order, one row per input row and block of items.

    A leak is a stretch of the text's words within error_rate * (words of the item) word edits of the item: words inserted,
    left out or replaced. Case, punctuation and marks between words do not count. Offsets count code points; the stretch is
    the first of least distance about a whole piece.

    Items below `least_words` words are looked for as they are, without edits.

    Nulls: a null text has no leaks, a null item and items without words are not looked for. Equal items each
    give a leak; equal rows give equal rows. With no items, or no documents, there are no leaks or rows. Other columns are
    left aside. Benchmarks beyond block_chars are taken in several passes, so that what each task holds is bounded.
    """
    return _found(docs, benchmark, error_rate, least_words, block_chars).drop("of")


def _found(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, least_words: int = LEAST_WORDS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    kind = benchmark.schema["item_id"].dataType.simpleString()
    out = None
    for block in item_blocks(benchmark, error_rate, least_words, block_chars):
        one = _pass(docs, block, kind)
        out = one if out is None else out.unionByName(one)
    return out


def _pass(docs: DataFrame, items: list[Item], kind: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    keep: dict[str, Matcher] = {}

    def per_slice(batch: pa.RecordBatch):
        matcher = keep.get("m") or keep.setdefault("m", Matcher(shared.value))
        rows = [[x._asdict() for x in matcher.find(t)] for t in batch.column(1).to_pylist()]
        item = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}.get(kind, pa.string())
        leak = pa.list_(pa.struct([("item_id", item), ("start", pa.int64()), ("end", pa.int64()), ("distance", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(rows, leak)], names=["doc_id", "of", "leaks"])

    doc = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", text_of(docs).alias("text"), _row(docs).alias("of")), per_slice, f"doc_id {doc}, of long, leaks array<struct<item_id:{kind},start:bigint,end:bigint,distance:bigint>>")


def leak_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document with a leak: doc_id, item_ids in order, the number of leaks, the least distance, the spans.

    A document is known by doc_id and text: rows that share a doc_id, or have none, are told apart by their texts, and equal
    ones have one row.
    """
    leak = _found(docs, benchmark, **options).where(F.size("leaks") > 0).select("doc_id", "of", F.explode("leaks").alias("x"))
    spans = F.array_sort(F.collect_set(F.struct("x.start", "x.end", "x.item_id", "x.distance")))
    out = leak.groupBy("doc_id", "of").agg(F.array_sort(F.collect_set("x.item_id")).alias("item_ids"), spans.alias("s"), F.min("x.distance").alias("least_distance"))  # of one document
    text = F.array_join(F.transform("s", lambda x: F.concat_ws(":", x["item_id"].cast("string"), x["start"].cast("string"), x["end"].cast("string"), x["distance"].cast("string"))), ",")
    return out.select("doc_id", "item_ids", F.size("s").cast("long").alias("n_leaks"), "least_distance", text.alias("spans"))


def drop_leaked(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of docs without a leak, with their columns. A row goes by its own text, also where rows share a doc_id or have none."""
    bad = _found(docs, benchmark, **options).where(F.size("leaks") > 0).select(F.col("doc_id").alias("__id"), F.col("of").alias("__of"))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__id"]) & (_row(docs) == bad["__of"]), "left_anti")
