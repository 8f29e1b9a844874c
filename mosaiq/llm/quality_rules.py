"""Quality rules: per language and source a robust estimate of what documents look like, and rejection of what lies far from it.

DataFrame functions only. Each document becomes a vector of transformed statistics. Per group of language and source the
centre and scatter are the regularised minimum-covariance-determinant estimate: from three deterministic starts,
concentration steps go on over the half of the documents that lies nearest to the last estimate; the start whose scatter
has the least determinant goes on until it no longer falls. Distances are Mahalanobis distances by a Cholesky factor that is
written out as columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mosaiq.llm.common import SPACE, cut, text_of

SYMBOLS = r"[#*$%&|<>]"
#: The statistics of the vector, each a function of the columns of `statistics`.
FEATURES: dict[str, Callable[[], Column]] = {
    "f_symbols": lambda: F.log1p(20 * F.col("n_symbols") / F.greatest(F.col("n_words"), F.lit(1))),
    "f_repeats": lambda: F.log1p(10 * F.col("n_repeat_words") / F.greatest(F.col("n_words"), F.lit(1))),
    "f_lines": lambda: F.log1p(10 * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
    "f_twice": lambda: F.log1p(10 * F.col("n_twice") / F.greatest(F.col("n_words"), F.lit(1))),
    "f_length": lambda: F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
    "f_upper": lambda: F.log1p(20 * F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1))),
}
#: The regularisation: what is added to each variance, as a deviation. Most statistics are constant among good documents, so
#: the plain scatter of the nearer half is singular, and its determinant tells nothing.
FLOOR = {"f_symbols": 0.18, "f_repeats": 0.35, "f_lines": 0.35, "f_twice": 0.25, "f_length": 0.15, "f_upper": 0.25}
#: The covariance of the nearer half times this is that of all, for six normal statistics.
CONSISTENCY = 1.79
#: Groups below this size are pooled.
LEAST_GROUP = 50
#: Concentration steps of every start, and at most of the best one, which stops once no group's log determinant moves by this.
FIRST_STEPS, STEPS, STILL = 2, 8, 1e-3
STARTS = ("scale", "sign", "tanh")
#: Of the rank of a median, the largest error is one part in so many.
ACCURACY = 10_000
#: Up to this many groups, of some thirty numbers each, are broadcast.
BROADCAST_GROUPS = 50_000
#: The squared distance beyond which a document is rejected, before scaling by the half's consistency: chi-square of six degrees, about 0.999999.
CUTOFF = 40.0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body over a value that is computed once: within a higher-order function an outer expression would run for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column, n: int = 5) -> Column:
    """How many words lie in windows of n words that are found twice or more in the array.

    Windows are sorted with their places; those equal to a neighbour count. Taken in order, each then adds n words, or
    fewer where it overlaps the one before.
    """

    def of(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.struct(F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]).alias("g"), i.alias("i")))
        return let(F.sort_array(grams), lambda s: let(places(s), covered))

    def places(s: Column) -> Column:
        like = lambda x, j: F.coalesce(F.get(s, j)["g"] == x["g"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, j: like(x, j - 1) | like(x, j + 1)), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        begin = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(-n).alias("last"))
        return F.aggregate(p, begin, lambda a, i: F.struct((a["sum"] + F.least(F.lit(n), i - a["last"])).cast("long").alias("sum"), i.alias("last")), lambda a: a["sum"])

    return F.when(F.size(words) > n, let(words, of)).otherwise(F.lit(0).cast("long"))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, of (see _row), lang, source and the counts of each document's whole text; a null text has none."""
    text = F.col("__text")
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_replace(x, f"[{SPACE}]+", "") != "")
    out = docs.select("doc_id", _row(docs).alias("of"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), text_of(docs).alias("__text"))
    out = out.withColumns({"__words": F.filter(F.split(text, f"[{SPACE}]+"), lambda x: x != ""), "__lines": lines})
    plain = F.regexp_replace(text, f"[{SPACE}]+", "")
    count = lambda pattern: F.regexp_count(text, F.lit(pattern)).cast("long")
    return out.select(
        "doc_id", "of", "lang", "source",
        F.size("__words").cast("long").alias("n_words"),
        F.length(plain).cast("long").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("__words")).alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        let(F.col("__words"), lambda w: F.size(F.filter(w, lambda x, i: F.coalesce(F.get(w, i - 1) == x, F.lit(False))))).cast("long").alias("n_twice"),
        count(r"\p{Lu}|!").alias("n_upper"),
    )


def _grouped(stats: DataFrame, least_group: int) -> DataFrame:
    """With the key of each row's group: language and source; too small groups are pooled by language, too small pools together."""
    groups = stats.groupBy("lang", "source").agg(F.count("*").alias("n"))
    pools = groups.where(F.col("n") < least_group).groupBy("lang").agg(F.sum("n").alias("pool"))
    sized = groups.join(pools.withColumnRenamed("lang", "p_lang"), F.col("lang").eqNullSafe(F.col("p_lang")), "left")
    name = lambda *xs: F.to_json(F.array(*xs))  # noqa: E731  a null differs from every text
    key = F.when(F.col("n") >= least_group, name("lang", "source")).when(F.col("pool") >= least_group, name("lang")).otherwise(F.lit(""))
    keys = _few(sized.select(F.col("lang").alias("k_lang"), F.col("source").alias("k_source"), key.alias("key")))
    same = stats["lang"].eqNullSafe(keys["k_lang"]) & stats["source"].eqNullSafe(keys["k_source"])
    return stats.join(keys, same).drop("k_lang", "k_source")


def _few(groups: DataFrame) -> DataFrame:
    """groups, to be broadcast if their number is small; beyond that Spark joins by shuffling, and splits the hot ones."""
    groups = cut(groups)
    return F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups


def _pairs() -> list[tuple[str, str]]:
    names = list(FEATURES)
    return [(a, b) for i, a in enumerate(names) for b in names[: i + 1]]


def _moments(rows: DataFrame, by: list[str]) -> DataFrame:
    """Means and regularised covariances: sums of differences to the last centre, of which each task sends one row a group."""
    off = lambda a: F.col(a) - F.col(f"c_{a}")
    sums = [F.count("*").alias("m"), *[F.first(f"c_{a}").alias(f"c_{a}") for a in FEATURES], *[F.sum(off(a)).alias(f"s_{a}") for a in FEATURES], *[F.sum(off(a) * off(b)).alias(f"p_{a}_{b}") for a, b in _pairs()]]
    mean = lambda a: F.col(f"s_{a}") / F.col("m")
    cov = lambda a, b: CONSISTENCY * (F.col(f"p_{a}_{b}") / F.col("m") - mean(a) * mean(b)) + F.lit(FLOOR[a] ** 2 if a == b else 0.0)
    return rows.groupBy(*by).agg(*sums).select(*by, *[(F.col(f"c_{a}") + mean(a)).alias(f"c_{a}") for a in FEATURES], *[cov(a, b).alias(f"v_{a}_{b}") for a, b in _pairs()])


def _factor(estimate: DataFrame, by: list[str]) -> DataFrame:
    """The Cholesky factor l of the scatter v, as columns, and logdet. The floors keep the scatter positive definite."""
    names = list(FEATURES)
    for j, b in enumerate(names):
        rest = lambda a, j=j, b=b: F.col(f"v_{a}_{b}") - sum((F.col(f"l_{a}_{c}") * F.col(f"l_{b}_{c}") for c in names[:j]), F.lit(0.0))
        estimate = estimate.withColumn(f"l_{b}_{b}", F.sqrt(F.greatest(rest(b), F.lit(1e-9))))
        for a in names[j + 1 :]:
            estimate = estimate.withColumn(f"l_{a}_{b}", rest(a) / F.col(f"l_{b}_{b}"))
    return estimate.select(*by, *[f"c_{a}" for a in names], *[f"l_{a}_{b}" for a, b in _pairs()], (2 * sum((F.log(f"l_{a}_{a}") for a in names), F.lit(0.0))).alias("logdet"))


def _with_distance(rows: DataFrame) -> DataFrame:
    """With d2, the squared length of the z that solves l z = x - c."""
    names, z = list(FEATURES), []
    for a in names:
        off = F.col(a) - F.col(f"c_{a}")
        rows = rows.withColumn(f"z_{a}", (off - sum((F.col(f"l_{a}_{b}") * F.col(f"z_{b}") for b in z), F.lit(0.0))) / F.col(f"l_{a}_{a}"))
        z.append(a)
    return rows.withColumn("d2", sum((F.col(f"z_{a}") * F.col(f"z_{a}") for a in names), F.lit(0.0)))


def _median(x: Column | str) -> Column:
    return F.percentile_approx(x, 0.5, ACCURACY)


def _starts(rows: DataFrame) -> DataFrame:
    """key, start, centre and factor: medians with, as scatter, the scales alone, and the scales with the correlations of the
    rows' signs (each row at length one) and of their tanh."""
    middle = _few(rows.groupBy("key").agg(*[_median(a).alias(f"c_{a}") for a in FEATURES]))
    spread = rows.join(middle, "key").groupBy("key").agg(*[F.first(f"c_{a}").alias(f"c_{a}") for a in FEATURES], *[_median(F.abs(F.col(a) - F.col(f"c_{a}"))).alias(f"d_{a}") for a in FEATURES])
    scaled = _few(spread.select("key", *[f"c_{a}" for a in FEATURES], *[F.sqrt((1.4826 * F.col(f"d_{a}")) ** 2 + FLOOR[a] ** 2).alias(f"d_{a}") for a in FEATURES]))
    z = {a: (F.col(a) - F.col(f"c_{a}")) / F.col(f"d_{a}") for a in FEATURES}
    length = F.sqrt(sum((F.col(f"z_{a}") * F.col(f"z_{a}") for a in FEATURES), F.lit(1e-12)))
    one = rows.join(scaled, "key").withColumns({f"z_{a}": x for a, x in z.items()}).withColumn("length", length)
    kinds = {"sign": lambda a: F.col(f"z_{a}") / F.col("length"), "tanh": lambda a: F.tanh(F.col(f"z_{a}"))}
    products = one.groupBy("key").agg(*[F.avg(f(a) * f(b)).alias(f"{k}_{a}_{b}") for k, f in kinds.items() for a, b in _pairs()])
    known = products.join(scaled, "key")

    def scatter(k: str, a: str, b: str) -> Column:
        if k == "scale" or a == b:
            return F.col(f"d_{a}") * F.col(f"d_{b}") if a == b else F.lit(0.0)
        size = F.sqrt((F.col(f"{k}_{a}_{a}") + 1e-6) * (F.col(f"{k}_{b}_{b}") + 1e-6))
        return 0.9 * F.col(f"{k}_{a}_{b}") / size * F.col(f"d_{a}") * F.col(f"d_{b}")  # a tenth less: never singular

    each = F.explode(F.array(*[F.struct(F.lit(k).alias("start"), *[scatter(k, a, b).alias(f"v_{a}_{b}") for a, b in _pairs()]) for k in STARTS])).alias("x")
    return _factor(known.select("key", *[f"c_{a}" for a in FEATURES], each).select("key", *[f"c_{a}" for a in FEATURES], "x.*"), ["key", "start"])


def _concentrated(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """The estimate over the half of each group's rows that is nearest to the last one. The bound of that half is the median of
    the distances, for which a group costs a sketch for each task, however many rows it has."""
    by = [c for c in ("key", "start") if c in estimate.columns]
    near = _with_distance(rows.join(estimate, "key"))
    half = _few(near.groupBy(*by).agg(_median("d2").alias("bound")))
    return _few(_factor(_moments(near.join(half, by).where("d2 <= bound"), by), by))


def estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Centre and Cholesky factor per key."""
    estimate = _few(_starts(rows))
    for _ in range(FIRST_STEPS):
        estimate = _concentrated(rows, estimate)
    columns = [c for c in estimate.columns if c not in ("key", "start")]
    # Of equal determinants the first start by name counts.
    best = estimate.groupBy("key").agg(F.min(F.struct("logdet", "start", *[c for c in columns if c != "logdet"])).alias("x"))
    estimate = _few(best.select("key", *[F.col(f"x.{c}").alias(c) for c in columns]))
    for _ in range(steps):
        last, estimate = estimate.select("key", F.col("logdet").alias("before")), _concentrated(rows, estimate)
        moved = last.join(estimate, "key").agg(F.max(F.abs(F.col("logdet") - F.col("before")))).first()[0]
        if moved is None or moved < STILL:
            break
    return estimate.drop("logdet")


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, cutoff: float = CUTOFF, least_group: int = LEAST_GROUP, steps: int = STEPS) -> DataFrame:
    """doc_id, the counts, base_failed, distance2 and kept: one row per input row.

    Rejected are documents of fewer than ten words or with over a fifth of their words in repeated windows, and those that
    lie beyond the cutoff from their group's centre, by Mahalanobis distance. Documents that fail the base rules take no part
    in the estimates.

    Nulls: a null text has no words and fails; null languages and sources form groups like others. Groups below
    `least_group` rows do not fix a scatter of six statistics: they are pooled by language, then together. Ties fall on the
    kept side. Equal rows are judged alike. An empty table gives an empty one; other columns are left aside. Texts of any
    length are counted whole.
    """
    return _judged(docs, cutoff, least_group, steps).drop("of")


def _row(docs: DataFrame) -> Column:
    """What tells rows apart that share a doc_id, or have none: rows equal in this and doc_id are judged alike."""
    return F.xxhash64(text_of(docs), F.coalesce(docs["lang"].cast("string"), F.lit("\0")), F.coalesce(docs["source"].cast("string"), F.lit("\0")))


def _judged(docs: DataFrame, cutoff: float, least_group: int, steps: int) -> DataFrame:
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    stats = cut(statistics(docs).withColumn("base_failed", failed).withColumns({k: f() for k, f in FEATURES.items()}).select("doc_id", "of", "lang", "source", *COUNTS, "base_failed", *FEATURES))
    grouped = cut(_grouped(stats.where("NOT base_failed"), least_group).select("doc_id", "of", "key", *COUNTS, *FEATURES))
    found = estimates(grouped.select("key", *FEATURES), steps)
    near = _with_distance(grouped.join(found, "key"))
    passed = near.select("doc_id", "of", *COUNTS, F.lit(False).alias("base_failed"), F.col("d2").alias("distance2"), (F.col("d2") <= cutoff).alias("kept"))
    fails = stats.where("base_failed").select("doc_id", "of", *COUNTS, F.lit(True).alias("base_failed"), F.lit(None).cast("double").alias("distance2"), F.lit(False).alias("kept"))
    return passed.unionByName(fails)


def keep_good(docs: DataFrame, cutoff: float = CUTOFF, least_group: int = LEAST_GROUP, steps: int = STEPS) -> DataFrame:
    """The rows of docs that judge keeps, with their columns: each by its own verdict, also where rows share a doc_id or have none."""
    kept = _judged(docs, cutoff, least_group, steps).where("kept").select(F.col("doc_id").alias("__id"), F.col("of").alias("__of"))
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["__id"]) & (_row(docs) == kept["__of"]), "left_semi")
