"""Substring dedup over words: suffix automata of reference shards, and matching statistics of what is streamed through them.

A shard's automaton is built from the reference stretches that share an anchor, and stretches are streamed only through
the shard that can hold a match. Sending every shard to every document, as a broadcast would, costs documents times shards;
this sends each stretch once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mosaiq.llm import windows as W
from mosaiq.llm.common import arrow_map
from mosaiq.llm.repeats import SLICE, Kind, found_rows, identified, removed_mask, repeated_windows, runs

WINDOW, GRAM = 20, 5
#: A shard takes anchors until it has so many bytes; an anchor of more words than this is not indexed (see repeats).
SHARD_BYTES, ANCHOR_WORDS = 1 << 17, 1 << 17


class SuffixAutomaton:
    """The least automaton of all substrings of the texts added to it; no substring spans two texts."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, text: list) -> None:
        step, link, length = self.next, self.link, self.length
        last = 0
        for x in text:
            p = last
            if (q := step[p].get(x)) is not None:  # there from an earlier text
                if length[q] == length[p] + 1:
                    last = q
                    continue
                last = self._split(p, q, x)
                continue
            last = len(step)
            step.append({})
            length.append(length[p] + 1)
            link.append(0)
            while p >= 0 and x not in step[p]:
                step[p][x] = last
                p = link[p]
            if p >= 0:
                q = step[p][x]
                link[last] = q if length[q] == length[p] + 1 else self._split(p, q, x)

    def _split(self, p: int, q: int, x) -> int:
        step, link, length = self.next, self.link, self.length
        copy = len(step)
        step.append(dict(step[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and step[p].get(x) == q:
            step[p][x] = copy
            p = link[p]
        return copy

    def statistics(self, text: list) -> list[int]:
        """For each place the length of the longest substring that ends there and is in the automaton."""
        step, link, length = self.next, self.link, self.length
        state, size, out = 0, 0, []
        for x in text:
            while state and x not in step[state]:
                state = link[state]
                size = length[state]
            if (to := step[state].get(x)) is not None:
                state, size = to, size + 1
            out.append(size)
        return out


def index(bodies: list[bytes], again: list[bool], length: int = WINDOW) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Which windows of each body stand in one before it, and which of a further copy of it; none where there is no copy."""
    automaton, first, later = SuffixAutomaton(), [], []
    for i, (body, copied) in enumerate(zip(bodies, again, strict=True)):
        words = body.split()
        size = max(0, len(words) - length + 1)
        long = lambda words=words: np.array(automaton.statistics(words)[length - 1 :]) >= length
        first.append(long() if i and size else np.zeros(size, bool))
        if copied or i + 1 < len(bodies):
            automaton.add(words)
        later.append(long() if copied and size else np.zeros(0, bool))
    return first, later


def kind(window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, anchor_words: int = ANCHOR_WORDS) -> Kind:
    cut = lambda texts, length, gram, wide: W.word_stretches(W.words_of(texts), length, gram, wide)
    return Kind((window,), gram, cut, lambda text: text.split(), lambda units: b" ".join(units), None, True, lambda bodies, again: index(bodies, again, window), shard_bytes, anchor_words)


def remove_repeats(docs: DataFrame, window: int = WINDOW, shard_bytes: int = SHARD_BYTES, anchor_words: int = ANCHOR_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed, spans and text: one row per input row.

    Removed are the words of each run of `window` words that also starts earlier: in a document of smaller doc_id, or
    earlier in the same one. spans are the removed runs as (start, end) in words, text the other words joined by a blank.

    Nulls: a null text has no words; a null doc_id comes before all others, and rows that share a doc_id are told apart,
    and ordered, by a hash of their texts. Equal rows are one document and give equal results. Texts shorter than a window
    keep all words. An empty table gives an empty one; other columns are left aside. Texts of any length are taken whole.
    """
    rows, texts = identified(docs)
    found = repeated_windows(texts, kind(window, min(GRAM, window), shard_bytes, anchor_words))

    def per_slice(batch: pa.RecordBatch):
        n, gone, spans, kept = [], [], [], []
        for text, have in zip(batch.column(1).to_pylist(), found_rows(batch.column(2)), strict=True):
            words = text.encode().split()
            mask = removed_mask(len(words), window, have)
            n.append(len(words))
            gone.append(0 if mask is None else int(mask.sum()))
            spans.append([] if mask is None else [{"start": a, "end": a + k} for a, k in runs(mask)])
            kept.append(b" ".join(words if mask is None else [w for w, m in zip(words, mask.tolist(), strict=True) if not m]).decode())
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "spans", "text"])

    joined = rows.join(found, ["doc", "tie"], "left").select("doc_id", "text", "found")
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(joined, per_slice, f"doc_id {id_kind}, n_words long, n_removed long, spans array<struct<start:bigint,end:bigint>>, text string", SLICE)


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))
