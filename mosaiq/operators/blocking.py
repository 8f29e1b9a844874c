"""Candidate search: character n-grams weighted by TF-IDF, dense vectors, and the union of channels."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  as pa.compute
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mosaiq.functions.text import let
from mosaiq.sources.tables import kept, passing

GRAM = 3
MAX_FEATURES = 100_000


def grams(text: Column, n: int = GRAM) -> Column:
    """All runs of n characters, blanks included; none for a shorter text. The text is cut into characters once."""
    runs = lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - n), lambda i: F.concat(*[F.get(c, i + k) for k in range(n)]))
    return F.when(F.length(text) >= n, let(F.split(text, ""), runs)).otherwise(F.array().cast("array<string>"))


def spread(df: DataFrame) -> DataFrame:
    """df, dealt out anew if its scan has fewer splits than there are cores: before costly work, small tables only."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def dealt(df: DataFrame) -> DataFrame:
    """df of short rows, dealt out to all cores: a file has splits by its bytes, but rows only where a row group begins."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


# ---- Grams as numbers: GRAM letters of 21 bits each, in the order of the texts.
def _gram_codes(text: str, n: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The distinct grams of a text and how often each is there."""
    letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if len(letters) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = letters[: len(letters) - n + 1].copy()
    for k in range(1, n):
        codes = codes << 21 | letters[k : len(letters) - n + 1 + k]
    return np.unique(codes, return_counts=True)


#: Rows whose grams or scores are held at once, and letters whose grams are summed up at once.
SLICE, LETTERS = 1024, 1 << 20


def _lots(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in lots of about LETTERS letters."""
    lot, size = [], 0
    for text in texts:
        lot.append(text.as_py() or "")
        size += len(lot[-1])
        if size >= LETTERS:
            yield lot
            lot, size = [], 0
    if lot:
        yield lot


@dataclass
class Weights:
    """The vocabulary in order, and its weights: at most MAX_FEATURES, so that each task can hold them."""

    grams: np.ndarray
    idf: np.ndarray

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Places in the vocabulary and tf * idf there, of unit length."""
        grams, tf = _gram_codes(text)
        at = np.minimum(np.searchsorted(self.grams, grams), max(0, len(self.grams) - 1))
        known = self.grams[at] == grams if len(self.grams) else np.zeros(len(grams), bool)
        w = tf[known] * self.idf[at[known]]
        size = np.sqrt(w @ w)
        return at[known], w / size if size else w


def vocabulary(catalog: DataFrame, text_col: str, max_features: int | None = MAX_FEATURES) -> Weights:
    """The grams that are most frequent in the catalog, ties by the gram, and idf = ln((1 + n) / (1 + df)) + 1 of each.

    Each task sums up its own texts, so that a gram leaves it once. The texts are counted in the same pass: code -1, which
    is ahead of every gram in the order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, df, tf, n = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        for lot in (lot for batch in batches for lot in _lots(batch.column(0))):
            found = [_gram_codes(t) for t in lot]
            n += len(lot)
            every = np.concatenate([grams, *(g for g, _ in found)])
            grams, at = np.unique(every, return_inverse=True)
            df = np.bincount(at, np.concatenate([df, np.ones(len(every) - len(df))]), len(grams)).astype(np.int64)
            tf = np.bincount(at, np.concatenate([tf, *(c for _, c in found)]), len(grams)).astype(np.int64)
            if len(grams) > 1 << 20:  # what has been summed up so far may go: sums add up
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (grams, df, tf)], names=["gram", "df", "tf"])
                grams, df, tf = (np.zeros(0, np.int64),) * 3
        # Code -1 counts the texts.
        columns = (np.append(grams, -1), np.append(df, n), np.append(tf, 1 << 62 if n else 0))
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], names=["gram", "df", "tf"])

    summed = catalog.select(F.col(text_col).cast("string")).mapInArrow(run, "gram long, df long, tf long")
    stats = summed.groupBy("gram").agg(F.sum("df").alias("df"), F.sum(F.col("tf").cast("decimal(38,0)")).alias("total"))
    if max_features:
        stats = stats.orderBy(F.desc("total"), "gram").limit(max_features + 1)
    found = stats.select("gram", "df").toArrow()
    grams, df = (found.column(i).to_numpy() for i in range(2))
    at = np.argsort(grams)[1:]  # without the count of texts
    return Weights(grams[at], np.log((df[grams == -1].sum() + 1) / (df[at] + 1)) + 1)


class _Best:
    """Which scores may be among the k best of each column of all that has been seen; ties with the last of them may."""

    def __init__(self, k: int, columns: int, slack: float = 0.0) -> None:
        self.top, self.slack = np.full((k, columns), -np.inf), slack

    def among(self, scores: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Of rows of scores those that are marked and may be. NaN is the largest."""
        some &= ~(scores < self.top[0] - self.slack)
        hit = np.flatnonzero(some.any(0))
        if len(hit):
            both = np.concatenate([self.top[:, hit], np.where(some[:, hit], scores[:, hit], -np.inf)])
            k = len(self.top)
            self.top[:, hit] = np.partition(both, len(both) - k, 0)[len(both) - k :]
            some &= ~(scores < self.top[0] - self.slack)
        return some


def top_k(scored: DataFrame, k: int, query: str = "query_id", candidate: str = "candidate_id", score: str = "score") -> DataFrame:
    """The k best candidates of each query with their rank; ties go by the candidate's id."""
    order = Window.partitionBy(query).orderBy(F.desc(score), candidate)
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


#: Queries that one pass over the catalog scores, and how many passes are worth it before packs of both sides meet instead.
TFIDF_BLOCK, TFIDF_PASSES = 256, 16


def tfidf_candidates(queries: DataFrame, catalog: DataFrame, k: int, id_col: str = "entity_id", text_col: str = "text", max_features: int | None = MAX_FEATURES, digits: int = 9, block: int = TFIDF_BLOCK, passes: int = TFIDF_PASSES) -> DataFrame:
    """query_id, candidate_id, score, rank: the k catalog rows of highest cosine for each query; none share no gram.

    The vocabulary and its weights are those of the catalog. Scores are rounded before they are ranked, so that the order
    of additions decides no tie. A few queries are scored in blocks against each catalog row where it lies, and each task
    gives its own k best; the texts are worked out once for the vocabulary and all blocks, and what is found is kept. Beyond
    block * passes queries both sides are packed, and every pack of queries meets every pack of the catalog. No row is made
    for a pair that is not among the best.
    """
    few = queries.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).limit(block * passes + 1).collect()
    kinds = (queries.schema[id_col].dataType.simpleString(), catalog.schema[id_col].dataType.simpleString())
    if len(few) <= block * passes:
        with passing(catalog.select(id_col, F.col(text_col).cast("string").alias(text_col))) as texts:
            weights, scored = vocabulary(texts, text_col, max_features), None
            for at in range(0, max(1, len(few)), block):
                one = _scored_block(texts, few[at : at + block], weights, k, digits, kinds)
                scored = one if scored is None else scored.unionByName(one)
            return kept(top_k(scored, k))  # k rows of a query
    weights = vocabulary(catalog, text_col, max_features)
    shared = catalog.sparkSession.sparkContext.broadcast(weights)
    q, c = (_packed(x.select(id_col, text_col), shared, size, kind) for x, size, kind in ((queries, block, kinds[0]), (catalog, 4 * SLICE, kinds[1])))
    return top_k(_scored_packs(q, c, k, digits, kinds), k)


def _packed(df: DataFrame, weights: Broadcast, size: int, kind: str) -> DataFrame:
    """The vectors of id and text in packs of that size: pack, ids, and how long, where and what they are."""

    def pack(number: int, ids: list[pa.Array], vectors: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        ids = pa.concat_arrays(ids)
        parts = np.array([len(at) for at, _ in vectors], np.int32), np.concatenate([at for at, _ in vectors]).astype(np.int32), np.concatenate([w for _, w in vectors])
        columns = [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), *[pa.array([x.tobytes()]) for x in parts]]
        return pa.RecordBatch.from_arrays(columns, names=["pack", "ids", "sizes", "places", "weights"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, number = [], [], TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                ids.append(batch.column(0).slice(i, 1))
                vectors.append(weights.value.vector(text.as_py() or ""))
                if len(ids) == size:
                    yield pack(number, ids, vectors)
                    ids, vectors, number = [], [], number + 1
        if ids:
            yield pack(number, ids, vectors)

    return df.mapInArrow(run, f"pack long, ids array<{kind}>, sizes binary, places binary, weights binary")


def _scored_packs(queries: DataFrame, catalog: DataFrame, k: int, digits: int, kinds: tuple[str, str]) -> DataFrame:
    """As _scored_block, of packs. Both sides are dealt out once, and every part of one meets every part of the other."""
    parts = max(8, math.isqrt(8 * catalog.sparkSession.sparkContext.defaultParallelism))
    q = queries.withColumnsRenamed({n: f"q_{n}" for n in queries.columns}).repartition(parts)

    def read(batch: pa.RecordBatch, i: int, at: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        kinds = (np.int32, np.int32, np.float64)
        return batch.column(at)[i].values, *[np.frombuffer(batch.column(at + 1 + j)[i].as_py(), kind) for j, kind in enumerate(kinds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column(0)[i].as_py() != now:
                    now = batch.column(0)[i].as_py()
                    names, sizes, places, w = read(batch, i, 1)
                    used, row = np.unique(places, return_inverse=True)
                    table = np.zeros((len(used) + 1, len(names)))  # the last row is of grams that no query has
                    table[row, np.repeat(np.arange(len(names)), sizes)] = w
                    best.setdefault(now, _Best(k, len(names)))
                ids, sizes, places, w = read(batch, i, 6)
                met = np.searchsorted(used, places)
                if len(used):
                    met[used[np.minimum(met, len(used) - 1)] != places] = len(used)
                ends = np.cumsum(sizes)
                for at in range(0, len(ids), SLICE):
                    scores = np.zeros((min(SLICE, len(ids) - at), len(names)))
                    for j in range(len(scores)):
                        own = slice(ends[at + j] - sizes[at + j], ends[at + j])
                        np.matmul(w[own], table[met[own]], out=scores[j])
                    some, scores = scores > 0, np.round(scores, digits)
                    doc, query = np.nonzero(best[now].among(scores, some))
                    if len(doc):
                        yield pa.RecordBatch.from_arrays([names.take(pa.array(query)), ids.take(pa.array(at + doc)), pa.array(scores[doc, query])], names=["query_id", "candidate_id", "score"])

    return q.crossJoin(catalog.repartition(parts)).mapInArrow(run, f"query_id {kinds[0]}, candidate_id {kinds[1]}, score double")


def _scored_block(catalog: DataFrame, queries: list, weights: Weights, k: int, digits: int, kinds: tuple[str, str]) -> DataFrame:
    """query_id, candidate_id, score: of each task's part of the catalog the rows that are among its k best for a query."""
    vectors = [weights.vector(q["text"] or "") for q in queries]
    used = np.unique(np.concatenate([at for at, _ in vectors])) if vectors else np.zeros(0, np.int64)
    table = np.zeros((len(used), len(vectors)))
    for i, (at, w) in enumerate(vectors):
        table[np.searchsorted(used, at), i] = w
    row = np.full(len(weights.grams) + 1, -1, np.int64)
    row[used] = np.arange(len(used))
    shared = catalog.sparkSession.sparkContext.broadcast((weights, table, row, [q["id"] for q in queries]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, table, row, names = shared.value
        best = _Best(k, table.shape[1])
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, b.num_rows, SLICE)):
            scores = np.zeros((batch.num_rows, table.shape[1]))
            for i, text in enumerate(batch.column(1)):
                at, w = weights.vector(text.as_py() or "")
                met = row[at] >= 0
                scores[i] = w[met] @ table[row[at[met]]]
            some, scores = scores > 0, np.round(scores, digits)
            doc, query = np.nonzero(best.among(scores, some))
            yield pa.RecordBatch.from_arrays([pa.array(names).take(pa.array(query)), batch.column(0).take(pa.array(doc)), pa.array(scores[doc, query])], names=["query_id", "candidate_id", "score"])

    return catalog.mapInArrow(run, f"query_id {kinds[0]}, candidate_id {kinds[1]}, score double")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def hashed_vector(text: Column, dim: int = 64, n: int = GRAM) -> Column:
    """A unit vector of hashed character grams: the default where no encoder's vectors are given."""
    hashes = F.transform(grams(text, n), lambda g: F.xxhash64(g))
    sign = lambda h: F.when(F.pmod(F.shiftright(h, 8), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    places = F.transform(hashes, lambda h: F.pmod(h, F.lit(dim)))
    signs = F.transform(hashes, sign)
    # Each place is looked at by its own grams only: a map from places that occur to the sums of their signs.
    summed = lambda x: F.map_from_arrays(F.array_distinct(x["p"]), F.transform(F.array_distinct(x["p"]), lambda i: F.aggregate(F.arrays_zip(x["p"].alias("p"), x["s"].alias("s")), F.lit(0.0), lambda t, g: t + F.when(g["p"] == i, g["s"]).otherwise(0.0))))
    counts = let(let(F.struct(places.alias("p"), signs.alias("s")), summed), lambda m: F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.coalesce(F.try_element_at(m, i.cast("bigint")), F.lit(0.0))))
    unit = lambda v: let(F.struct(v.alias("v"), F.sqrt(dot(v, v)).alias("n")), lambda x: F.transform(x["v"], lambda y: F.when(x["n"] > 0, y / x["n"]).otherwise(0.0)))
    return let(counts, unit)


#: Vectors of a pack of queries and of the catalog: what is multiplied at once.
QUERY_PACK, CATALOG_PACK = 2048, 4096
#: More than sums in another order, and rounded scores that are equal, can differ by.
SLACK = 1e-7


def dense_candidates(queries: DataFrame, catalog: DataFrame, k: int, min_sim: float | None = 0.5, id_col: str = "vec_id", vec_col: str = "embedding", digits: int = 9, block: int = QUERY_PACK) -> DataFrame:
    """query_id, candidate_id, score, rank: the k catalog rows of highest cosine of unit vectors, at least min_sim.

    Both sides are packed, and every pack of queries meets every pack of the catalog in a matrix product of short numbers.
    What may be among a task's k best by more than its error is summed up anew in the order of the vector, so that no other
    order of additions decides, and a task gives k rows of a query. Rows without a vector are no candidates.
    """
    kinds = (queries.schema[id_col].dataType.simpleString(), catalog.schema[id_col].dataType.simpleString())
    q, c = (_vector_packs(spread(x.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("v IS NOT NULL")), size, kind) for x, size, kind in ((queries, min(block, QUERY_PACK), kinds[0]), (catalog, CATALOG_PACK, kinds[1])))
    out = _multiplied(q, c, k, min_sim, kinds).withColumn("score", F.round("score", digits))
    return top_k(out if min_sim is None else out.where(F.col("score") >= min_sim), k)


def _vector_packs(df: DataFrame, size: int, kind: str) -> DataFrame:
    """id and v in packs of that size: pack, ids, and the numbers of all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 32, [], 0

        def pack() -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            ids, vectors = (whole.column(i).combine_chunks() for i in range(2))
            numbers = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([numbers], pa.binary())], names=["pack", "ids", "numbers"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, size - n))
                at, n = at + held[-1].num_rows, n + held[-1].num_rows
                if n == size:
                    yield pack()
                    number, held, n = number + 1, [], 0
        if n:
            yield pack()

    return df.mapInArrow(run, f"pack long, ids array<{kind}>, numbers binary")


class _Nearest:
    """The k best rows of each of a pack of queries, of all packs that it has met."""

    def __init__(self, ids: pa.Array, numbers: bytes, k: int, least: float | None) -> None:
        self.ids, self.k, self.least = ids, k, least
        self.vectors = np.frombuffer(numbers, np.float64).reshape(len(ids), -1)
        self.bound = np.full(len(ids), -np.inf if least is None else least)  # the least score that still counts
        self.full = np.zeros(len(ids), bool)
        self.names = pa.compute.unique(ids)
        self.own = pd.Series(np.arange(len(ids))).groupby(pa.compute.index_in(ids, self.names).to_numpy(zero_copy_only=False)).indices
        self.found = None

    def meet(self, ids: pa.Array, numbers: bytes) -> None:
        rows = np.frombuffer(numbers, np.float64).reshape(len(ids), -1)
        sizes = [np.sqrt(np.einsum("ij,ij->i", x, x)) for x in (self.vectors, rows)]
        most = [s[np.isfinite(s)].max(initial=0.0) for s in sizes]
        kind = np.float32 if all(np.isfinite(s).all() for s in sizes) and max(most) < 1e15 else np.float64
        slack = SLACK + (rows.shape[1] + 4) * np.finfo(kind).eps * most[0] * most[1]
        with np.errstate(invalid="ignore", over="ignore"):
            scores = self.vectors.astype(kind) @ rows.astype(kind).T
        met = pa.compute.index_in(ids, self.names)
        for doc in np.flatnonzero(met.is_valid()):  # a row that is the query itself is no candidate
            scores[self.own[met[int(doc)].as_py()], doc] = -np.inf
        hit = np.flatnonzero(~(scores.max(1) < self.bound - slack))  # NaN is the largest
        if not len(hit):
            return
        scores, bound, new = scores if len(hit) == len(scores) else scores[hit], self.bound[hit] - slack, np.flatnonzero(~self.full[hit])
        first = scores[new, : max(512, 2 * self.k)]  # a first bound, of some rows
        if len(new) and first.shape[1] > self.k:
            bound[new] = np.fmax(bound[new], np.partition(first, -self.k, 1)[:, -self.k] - 2 * slack)
        less = np.less(scores, bound[:, None].astype(kind))
        some = np.flatnonzero(np.logical_not(less, out=less))
        query, doc = np.divmod(some[scores.ravel()[some] != -np.inf], len(ids))
        for at in range(0, len(query), 1 << 16):
            i, j = hit[query[at : at + (1 << 16)]], doc[at : at + (1 << 16)]
            with np.errstate(invalid="ignore", over="ignore"):
                exact = np.cumsum(rows[j] * self.vectors[i], 1)[:, -1] if rows.shape[1] else np.zeros(len(i))
            self._keep(pa.table([pa.array(i), pa.array(np.isnan(exact)), pa.array(exact), ids.take(pa.array(j))], names=["query", "nan", "exact", "id"]))

    def _keep(self, more: pa.Table) -> None:
        """Of what was found and more: of each query k rows by score and id, and as many of every score that may be rounded to the k-th."""
        every = more if self.found is None else pa.concat_tables([self.found, more])
        every = every.take(pa.compute.sort_indices(every, [("query", "ascending"), ("nan", "descending"), ("exact", "descending"), ("id", "ascending")]))
        query, nan, exact = (every.column(i).to_numpy() for i in range(3))
        place = np.arange(len(query))
        first = np.maximum.accumulate(np.where(np.append(True, query[1:] != query[:-1]), place, 0)) if len(query) else place
        kth = first + self.k - 1
        full = (kth < len(query)) & (query[np.minimum(kth, len(query) - 1)] == query)
        least = np.where(full, exact[np.minimum(kth, len(query) - 1)], -np.inf)
        same = np.append(False, (query[1:] == query[:-1]) & ((exact[1:] == exact[:-1]) | (nan[1:] & nan[:-1])))
        nth = place - np.maximum.accumulate(np.where(same, 0, place))  # among those of one score
        keep = (nth < self.k) & ((place - first < self.k) | ~(exact < least - SLACK))
        np.fmax.at(self.bound, query[full], least[full])
        self.full[query[full]] = True
        self.found = every.filter(pa.array(keep))

    def batch(self) -> pa.RecordBatch:
        table = self.found.combine_chunks()
        query, exact, ids = (table.column(i).combine_chunks() for i in (0, 2, 3))
        return pa.RecordBatch.from_arrays([self.ids.take(query), ids, exact], names=["query_id", "candidate_id", "score"])


def _multiplied(queries: DataFrame, catalog: DataFrame, k: int, least: float | None, kinds: tuple[str, str]) -> DataFrame:
    """query_id, candidate_id, score, not rounded: of each task's packs of the catalog the k best of its queries, as _scored_packs."""
    parts = max(8, math.isqrt(8 * catalog.sparkSession.sparkContext.defaultParallelism))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column(0)[i].as_py() != now:
                    if best is not None and best.found is not None:
                        yield best.batch()
                    now = batch.column(0)[i].as_py()
                    best = _Nearest(batch.column(1)[i].values, batch.column(2)[i].as_py(), k, least)
                best.meet(batch.column(4)[i].values, batch.column(5)[i].as_py())
        if best is not None and best.found is not None:
            yield best.batch()

    q = queries.withColumnsRenamed({n: f"q_{n}" for n in queries.columns}).repartition(parts)
    return q.crossJoin(catalog.repartition(parts)).mapInArrow(run, f"query_id {kinds[0]}, candidate_id {kinds[1]}, score double")


def merge_candidates(*channels: DataFrame) -> DataFrame:
    """query_id and candidate_id of any channel, each once; ids that are empty are dropped."""
    out = None
    for c in channels:
        one = c.select(F.col("query_id").cast("string").alias("query_id"), F.col("candidate_id").cast("string").alias("candidate_id"))
        out = one if out is None else out.unionByName(one)
    return out.where("candidate_id <> ''").distinct()


def candidate_lists(candidates: DataFrame, queries: DataFrame | None = None, id_col: str = "entity_id") -> DataFrame:
    """source1_entity_id and candidate_entity_ids in rank order; with the queries given also those without candidates."""
    lists = candidates.groupBy(F.col("query_id").alias("source1_entity_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.col("candidate_id").cast("string").alias("id")))), lambda x: x["id"]), ",").alias("candidate_entity_ids"))  # k of a query
    if queries is None:
        return lists
    every = queries.select(F.col(id_col).alias("source1_entity_id"))
    return every.join(lists, "source1_entity_id", "left").select("source1_entity_id", F.coalesce("candidate_entity_ids", F.lit("")).alias("candidate_entity_ids"))
