"""N-gram Jaccard join by parity sketches.

A document is the set of its word shingles. Its sketch for a size band has one slot for each piece of the hash space; each
shingle toggles its slot by XOR with its hash. Sets that differ by d shingles differ in at most d slots, so the distance of
sketches never exceeds that of the sets. The similarity bounds d by the sizes: of the first d + 1 slots in use one must be
the same in both, so it is enough to join on that many slots, each with its number and band, and to verify what meets.

Shingles that a sample finds in many documents have slots of their own at the end of the sketch. Any choice of them gives
the same links; this one keeps common passages from being the slots that documents meet by.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaiq.llm import windows as W
from mosaiq.llm.common import WORD, arrow_map, cut, discard, settled, text_of
from mosaiq.llm.components import components
from mosaiq.llm.repeats import SLICE

SHINGLE = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Documents from which common shingles are learnt: a bound. What is common changes no result.
SAMPLE = 20_000
COMMON = 5
#: Up to this many ids are broadcast; beyond it Spark joins by shuffling.
BROADCAST_IDS = 2_000_000
#: About so many members of a slot's group are compared in one round, each time with about as many of the others in a task.
GROUP = 4096
#: A slot key that more of the sample have than one document in so many is dealt to several tasks.
HOT_SHARE = 1000
HOT_LEAST = 8
#: Bits of the sketch that rules pairs out before their texts are fetched.
SKETCH_BITS = 1024
_BAND_BITS, _ALONE = 2, 64
_SLOT = np.uint64(0xA24BAED4963EE407)


def shingle_sets(texts: W.Bytes, n: int = SHINGLE) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles. With fewer than n words all of them are one shingle."""
    words = W.words_of(texts, lower=True)
    sums = W.Sums(words.hash, W._WORD_BASE)
    count = len(words.hash)
    at = np.arange(max(0, count - n + 1))
    grams = sums.hash(at, at + n)
    out = []
    for lo, hi in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True):
        out.append(np.unique(grams[lo : hi - n + 1]) if hi - lo >= n else sums.hash(np.array([lo] * (hi > lo), np.int64), np.array([hi] * (hi > lo), np.int64)))
    return out


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def slot_keys(shingles: np.ndarray, common: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The keys of the slots that a set must be met by: in its own band, and in the next if a partner may lie there."""
    size = len(shingles)
    if not size:
        return np.zeros(0, np.uint64)
    band = (size.bit_length() - 1) // _BAND_BITS
    top = 100 * size // percent
    often = np.zeros(size, bool)
    if len(common):
        where = np.searchsorted(common, shingles)
        often = common[np.minimum(where, len(common) - 1)] == shingles
    out = []
    while True:
        end = 1 << _BAND_BITS * (band + 1)  # the first size beyond the band
        partner = min(top, end - 1)
        differ = (size + partner) * (100 - percent) // (100 + percent)
        if end <= _ALONE:  # few shingles: each has a slot of its own, in the order of its hash
            order = np.lexsort((shingles, often))[: differ + 1]
            slots, values = shingles[order], shingles[order]
        else:
            width = np.uint64(end * 3 // 5)
            slot = shingles % width + np.where(often, width, np.uint64(0))
            order = np.argsort(slot, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], np.diff(slot[order]) != 0]))
            values = np.bitwise_xor.reduceat(shingles[order], first)[: differ + 1]
            slots = slot[order][first][: differ + 1]
            if len(first) < differ + 1:  # too few slots in use to be sure of a meeting: meet all of the band
                slots, values = np.append(slots, _SLOT), np.append(values, np.uint64(0))
        out.append(W.mix(values ^ W.mix(slots + np.uint64(int(_SLOT) * (band + 1) % (1 << 64)))))
        if top < end:
            return np.concatenate(out)
        band += 1


def fingerprints(sets: list[np.ndarray]) -> list[pa.Array]:
    """For each set its size, 128 bits that name it, and its parity sketch, of whose bits each shingle toggles one.

    A sketch has SKETCH_BITS, doubled until there is a bit for each shingle. Its halves laid on each other by XOR are the
    sketch of half the length, so sets of different lengths compare.
    """
    p = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
    q = np.array([np.bitwise_xor.reduce(W.mix(s ^ _SLOT)) if len(s) else 0 for s in sets], np.uint64)
    length = [SKETCH_BITS << max(0, (len(s) - 1) // SKETCH_BITS).bit_length() for s in sets]
    bits = [np.bincount((s >> np.uint64(17)) % np.uint64(m), minlength=m).astype(np.uint8) & 1 for s, m in zip(sets, length, strict=True)]
    words = np.packbits(np.concatenate(bits)).view(np.int64) if bits else np.zeros(0, np.int64)
    sketch = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]) // 64, pa.int32()), pa.array(words))
    return [pa.array([len(s) for s in sets], pa.int64()), pa.array(p.view(np.int64)), pa.array(q.view(np.int64)), sketch]


def _sets_table(docs: DataFrame) -> DataFrame:
    """doc_id, of (a hash of the text), and the fingerprints n, p, q, sketch of each row's set."""

    def per_slice(batch: pa.RecordBatch):
        found = fingerprints(shingle_sets(W.bytes_of(batch.column(1))))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *found], names=["doc_id", "of", "n", "p", "q", "sketch"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", text_of(docs).alias("text"), F.xxhash64(text_of(docs)).alias("of")), per_slice, f"doc_id {kind}, of long, n long, p long, q long, sketch array<bigint>", SLICE)


def _sample(texts: DataFrame, n_texts: int) -> DataFrame:
    """node and text of at most about SAMPLE texts, written."""
    part = max(1, -(-n_texts // SAMPLE))
    return cut(texts.where(F.pmod(F.xxhash64("node"), F.lit(part)) == 0).select("node", "text"))


def _common_shingles(sample: DataFrame) -> np.ndarray:
    """Shingles of at least COMMON texts of the sample; at most a COMMONth of the sample's shingles are."""

    def per_slice(batch: pa.RecordBatch):
        sets = shingle_sets(W.bytes_of(batch.column(1)))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], names=["h"])

    rows = arrow_map(sample.select("node", "text"), per_slice, "h long", SLICE).groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    return np.sort(np.array([r["h"] for r in rows.select("h").toLocalIterator()], np.int64).view(np.uint64))


def _keyed(batch: pa.RecordBatch, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slot keys of a batch (node, text), and the node of each."""
    keys = [slot_keys(s, common) for s in shingle_sets(W.bytes_of(batch.column(1)))]
    return np.concatenate(keys), np.repeat(batch.column(0).to_numpy(), [len(k) for k in keys])


def _hot_keys(sample: DataFrame, common) -> tuple[np.ndarray, np.ndarray]:
    """The slot keys that many of the sample have, sorted, and among how many parts the members of each are dealt.

    The parts of all keys together are at most twice the sample's keys over the least count of a hot one.
    """
    least = max(HOT_LEAST, sample.count() // HOT_SHARE)

    def per_slice(batch: pa.RecordBatch):
        yield pa.RecordBatch.from_arrays([pa.array(_keyed(batch, common.value)[0].view(np.int64))], names=["key"])

    rows = arrow_map(sample.select("node", "text"), per_slice, "key long", SLICE).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > least)
    found = [*rows.toLocalIterator()]
    keys = np.array([r["key"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([-(-r["n"] // least) for r in found], np.uint64)[order]


def _part_key(key: np.ndarray, part: np.ndarray) -> np.ndarray:
    return W.mix(key ^ W.mix(part + _SLOT))


def _groups(texts: DataFrame, common, hot) -> DataFrame:
    """key, leader, node: the members of every slot key that two nodes or more have; the leader is the least of them.

    The members of a hot key are dealt to tasks by keys of its parts, which each find a leader; the least of these is the key's.
    """
    keys, parts = hot.value
    spark = texts.sparkSession
    whole, at = np.repeat(keys, parts.astype(np.int64)), np.concatenate([np.zeros(0, np.uint64), *[np.arange(n, dtype=np.uint64) for n in parts]])
    part = _part_key(whole, at).view(np.int64)
    dealt = spark.sparkContext.broadcast(np.sort(part))

    def per_slice(batch: pa.RecordBatch):
        key, node = _keyed(batch, common.value)
        keys, parts = hot.value
        if len(keys):
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            own = np.flatnonzero(keys[at] == key)
            key[own] = _part_key(key[own], W.mix(node[own].view(np.uint64)) % parts[at[own]])
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(node)], names=["key", "node"])

    def run(batches):
        held, leader = None, None  # the last row, if its run may go on; the leader of that run if it has been given out
        single = dealt.value
        for batch in batches:
            key, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if held is not None:
                key, node = np.append(held[0], key), np.append(held[1], node)
            if not len(key):
                continue
            first = np.concatenate([[True], key[1:] != key[:-1]])
            lead = node[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
            if leader is not None:
                lead[key == key[0]] = leader
            many = ~first | np.concatenate([~first[1:], [False]])
            if len(single):  # a part of a hot key may have one member only
                many |= single[np.minimum(np.searchsorted(single, key), len(single) - 1)] == key
            many[0] |= leader is not None
            if leader is not None:
                many[0] = False  # was given out with the batch before
            again = leader is not None and key[-1] == key[0]
            held = (key[-1:], node[-1:])
            leader = lead[-1] if many[-1] or again else None
            yield pa.RecordBatch.from_arrays([pa.array(x[many]) for x in (key, lead, node)], names=["key", "leader", "node"])

    rows = arrow_map(texts.select("node", "text"), per_slice, "key long, node long", SLICE)
    rows = rows.repartition("key").sortWithinPartitions("key", "node").mapInArrow(run, "key long, leader long, node long")
    if not len(part):
        return rows
    table = spark.createDataFrame(pa.table({"part": part, "whole": whole.view(np.int64)}))
    rows = cut(rows.join(F.broadcast(table), F.col("key") == F.col("part"), "left"))
    least = rows.where("whole IS NOT NULL").groupBy("whole").agg(F.min("leader").alias("least"))  # at most a row for each hot key
    rows = rows.join(F.broadcast(least), "whole", "left")
    return rows.select(F.coalesce("whole", "key").alias("key"), F.coalesce("least", "leader").alias("leader"), "node")


def _near(percent: int) -> Column:
    """What sizes and sketches do not rule out: sketches differ in no more bits than the sets in shingles. Over nu, nv, su, sv.

    Sets of near sizes have sketches of one length, or one is twice as long and is folded.
    """
    xor = lambda a, b: a.bitwiseXOR(b)
    short = F.least(F.size("su"), F.size("sv"))
    fold = lambda s: F.when(F.size(s) > short, F.zip_with(F.slice(s, 1, short), F.slice(s, short + 1, short), xor)).otherwise(F.col(s))
    apart = F.aggregate(F.zip_with(fold("su"), fold("sv"), lambda a, b: F.bit_count(xor(a, b))), F.lit(0), lambda a, x: a + x)
    sizes = 100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv")
    # With a percent below 50 lengths can differ more; then only sizes rule out.
    comparable = F.greatest(F.size("su"), F.size("sv")) <= 2 * short
    return F.when(~sizes, F.lit(False)).when(comparable, apart * (100 + percent) <= (F.col("nu") + F.col("nv")) * (100 - percent)).otherwise(F.lit(True))


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that may be links."""
    of = lambda side: classes.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col("sketch").alias(f"s{side}"))
    return pairs.join(of("u"), "u").join(of("v"), "v").where(_near(percent)).select("u", "v")


def _pool(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """node, size and packed text of all nodes of the pairs. Texts are packed before they move."""

    def pack(batch: pa.RecordBatch):
        packed = [pa.compress(t.encode(), codec="zstd", asbytes=True) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t.encode()) for t in batch.column(1).to_pylist()], pa.int64()), pa.array(packed, pa.binary())], names=["node", "size", "packed"])

    nodes = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return arrow_map(texts.select("node", "text"), pack, "node long, size long, packed binary", SLICE).join(nodes, "node", "left_semi")


def _unpacked(batch: pa.RecordBatch):
    """The rows of a batch (u, part, node, size, packed) with their sets, so many at once as SLICE bytes of text."""
    rows = [*zip(*(c.to_pylist() for c in batch.columns), strict=True)]
    at = 0
    while at < len(rows):
        end, size = at, 0
        while end < len(rows) and (end == at or size + rows[end][3] <= SLICE):
            size += rows[end][3]
            end += 1
        texts = [pa.decompress(r[4], r[3], codec="zstd", asbytes=True) for r in rows[at:end]]
        for row, found in zip(rows[at:end], shingle_sets(W.bytes_of(pa.array(texts, pa.binary()))), strict=True):
            yield *row[:3], found
        at = end


def _verified(pool: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The links (u, v) among the pairs (u, v). Members go to their leader u, in parts of bounded size that each get the leader too."""
    counts = cut(pairs.groupBy("u").agg(F.ceil(F.count("*") / 256).cast("int").alias("parts")))
    parted = pairs.join(counts, "u").select("u", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int").alias("part"), F.col("v").alias("node"))
    leaders = counts.select("u", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("u").alias("node"))

    def verify(batches):
        at, own = None, None
        for batch in batches:
            us, vs = [], []
            for u, part, node, found in _unpacked(batch):
                if (u, part) != at:  # the leader comes first
                    at, own = (u, part), found
                elif linked(own, found, percent):
                    us.append(u)
                    vs.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    sent = parted.unionByName(leaders).join(pool, "node").select("u", "part", "node", "size", "packed")
    first = F.when(F.col("node") == F.col("u"), 0).otherwise(1)
    return sent.repartition("u", "part").sortWithinPartitions("u", "part", first, "node").mapInArrow(verify, "u long, v long")


def join_documents(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per input row.

    Two documents are linked when 100 * intersection >= percent * union of their sets of 5-word shingles, A-Z lower-cased.
    component_id is the least doc_id that links lead to, that of the document included.

    Rows of one set are one node, so copies are never paired. Nulls: a null text is empty; an empty document has no
    shingles and is linked with nothing, its component is itself; a null doc_id is passed over for the least one. Rows that
    repeat a doc_id are told apart by their sets. Documents of under five words have one shingle, of all their words. An
    empty table gives an empty one; other columns are left aside. Texts of any length are taken whole.
    """
    return _joined(docs, percent)[0].select("doc_id", "n_shingles", "component_id")


def _joined(docs: DataFrame, percent: int) -> tuple[DataFrame, bool]:
    """The result with of and group, which is equal for the rows of one component; and whether each doc_id stands once."""
    sets = cut(_sets_table(docs))
    once = sets.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1 OR doc_id IS NULL").limit(1).count() == 0
    classes = sets.where("n > 0").groupBy("p", "q", "n").agg(F.min("doc_id").cast("long").alias("least"), F.first("sketch").alias("sketch"))
    classes = cut(classes.withColumn("node", F.col("least") if once else F.xxhash64("p", "q", "n")))
    return _result(sets, classes, settled(lambda: _labels(docs, sets, classes, once, percent)), once), once


def _labels(docs: DataFrame, sets: DataFrame, classes: DataFrame, once: bool, percent: int) -> DataFrame:
    """node and label of the nodes with links."""
    share = docs.sparkSession.sparkContext.broadcast
    texts = _node_texts(docs, sets, classes, once)
    sample = _sample(texts, classes.count())
    common = share(_common_shingles(sample))
    hot = share(_hot_keys(sample, common))
    return _links(texts, cut(_groups(texts, common, hot)), classes, percent)[1]


def _node_texts(docs: DataFrame, sets: DataFrame, classes: DataFrame, once: bool) -> DataFrame:
    """node and text, one row for each class of equal sets."""
    if once:
        others = sets.select("doc_id", "p", "q", "n").join(classes.select("p", "q", "n", "least"), ["p", "q", "n"], "left").where("least IS NULL OR doc_id <> least").select("doc_id")
        others = cut(others)
        others = F.broadcast(others) if others.count() <= BROADCAST_IDS else others
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs).alias("text")).join(others, "doc_id", "left_anti").select(F.col("doc_id").alias("node"), "text")

    def per_slice(batch: pa.RecordBatch):
        n, p, q, _ = fingerprints(shingle_sets(W.bytes_of(batch.column(0))))
        yield pa.RecordBatch.from_arrays([p, q, n, batch.column(0)], names=["p", "q", "n", "text"])

    keyed = arrow_map(docs.select(text_of(docs).alias("text")), per_slice, "p long, q long, n long, text string", SLICE)
    return cut(keyed.where("n > 0").select(F.xxhash64("p", "q", "n").alias("node"), "text").dropDuplicates(["node"]))


def _links(texts: DataFrame, groups: DataFrame, classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """All that the groups (key, leader, node) of the slots link, and the components' labels.

    First each member is compared with the group's leader: a row for each member, however large the group. That leaves
    groups whose members are in several components. Of each set of members one group then compares those outside its
    largest component with all members of other components, about GROUP of them a round, until each has had its turn. The
    others are dealt into parts of about GROUP, and those whose turn it is go to every part, so a task has a part of a
    group only. Sizes and sketches are looked at within the join, so that only what may be a link becomes a row.
    """
    links, labels = None, None

    def add(pairs: DataFrame) -> None:
        nonlocal links, labels
        pairs = cut(pairs)
        new = settled(lambda: _verified(cut(_pool(texts, pairs)), pairs, percent)) if links is None or pairs.limit(1).count() else None
        if links is None or new is not None and new.limit(1).count():
            links = new if links is None else cut(links.unionByName(new))
            labels = settled(lambda: components(links))
        discard(pairs)

    add(_possible(groups.where("leader <> node").select(F.col("leader").alias("u"), F.col("node").alias("v")).distinct(), classes, percent))
    labelled = lambda df: df.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = cut(labelled(groups.select("key", "node")))
    by_key = named.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count("*").alias("size"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("sum"))
    # Two members were compared already, one of them being the leader.
    open_ = cut(by_key.where("a <> b AND size > 2").groupBy("size", "sum").agg(F.min("key").alias("key")).select("key"))
    inside = cut(named.join(open_, "key"))
    by_label = inside.groupBy("key", "label").agg(F.count("*").alias("c"))
    main = by_label.groupBy("key").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.max("c").alias("most"), F.sum("c").alias("size"))
    main = main.select("key", "main", F.ceil((F.col("size") - F.col("most")) / GROUP).alias("turns"), F.ceil(F.col("size") / GROUP).alias("parts"))
    turn = F.when(F.col("label") != F.col("main"), F.pmod(F.xxhash64("node", F.lit(1)), F.col("turns")))
    dealt = cut(inside.join(main, "key").select("key", "node", "turns", "parts", turn.alias("turn"), F.pmod(F.xxhash64("node"), F.col("parts")).alias("part")))
    last = dealt.agg(F.max("turns")).first()[0] or 0
    described = classes.select("node", "n", "sketch")
    for now in range(last):
        v = labelled(dealt.where(F.col("turns") > now).select("key", "part", "node")).join(described, "node")
        u = labelled(dealt.where(F.col("turn") == now).select("key", "parts", "node")).join(described, "node")
        u = u.select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("node").alias("u"), F.col("label").alias("lu"), F.col("n").alias("nu"), F.col("sketch").alias("su"))
        v = v.select(F.col("key").alias("k"), F.col("part").alias("p"), F.col("node").alias("v"), F.col("label").alias("lv"), F.col("n").alias("nv"), F.col("sketch").alias("sv"))
        met = u.join(v, (F.col("key") == F.col("k")) & (F.col("part") == F.col("p")) & (F.col("lu") != F.col("lv")) & _near(percent))
        add(met.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    return links, labels


def _result(sets: DataFrame, classes: DataFrame, labels: DataFrame, once: bool) -> DataFrame:
    named = classes.join(labels, "node", "left").select("p", "q", "n", "least", F.coalesce("label", "node").alias("label"))
    if once:
        named = named.withColumn("component", F.col("label"))
    else:
        named = named.join(named.groupBy("label").agg(F.min("least").alias("component")), "label")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id").cast("long"))
    return sets.join(named.select("p", "q", "n", "component", F.col("label").alias("group")), ["p", "q", "n"], "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "of", "group")


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of each component one row, that of the least doc_id, with the columns of docs; all documents without words stay.

    A null doc_id comes after all others. Of rows that share the least doc_id the one of least text hash stays, and of rows
    equal in doc_id and text any one.
    """
    found, once = _joined(docs, percent)
    if once:
        kept = found.where("doc_id = component_id").select(F.col("doc_id").alias("__id"))
        return docs.join(kept, docs["doc_id"] == kept["__id"], "left_semi")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "of")
    first = found.where("n_shingles > 0").groupBy("group").agg(F.min(order).alias("x")).select(F.col("x.doc_id").alias("__id"), F.col("x.of").alias("__of"))
    told = docs.withColumns({"__text": F.xxhash64(text_of(docs)), "__key": F.col("doc_id")})
    one = told.join(cut(first), told["doc_id"].eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__of")), "left_semi").dropDuplicates(["__key", "__text"])
    empty = docs.where(~text_of(docs).rlike(WORD))
    return one.select(*[one[c] for c in docs.columns]).unionByName(empty)
