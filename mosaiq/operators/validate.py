"""Checks of match and candidate lists. Findings are rows: severity, rule, n offenders and up to five of them in order."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mosaiq.sources.tables import exists, with_position

EXAMPLES = 5
#: Each rule, and whether it is an error or a warning.
RULES = {
    "duplicate_row": "error", "duplicate_id": "error", "self_match": "error", "wrong_prefix": "error", "unknown_id": "error", "missing_s1": "error", "unexpected_s1": "error",
    "no_tab": "error", "bad_header": "error", "not_utf8": "error", "no_file": "error", "empty_file": "error", "comma_header": "error", "not_in_candidates": "warning", "id_check_off": "warning", "no_candidates": "warning", "no_source": "warning",
}


def _finding(rule: str, offenders: DataFrame) -> DataFrame:
    """offenders: one column. One row if there are any. Only the first few are ever gathered."""
    own = offenders.toDF("x").distinct()
    few = own.orderBy("x").limit(EXAMPLES).agg(F.array_join(F.array_sort(F.collect_list("x")), ",").alias("examples"))
    count = own.agg(F.count("*").alias("n"))
    return count.crossJoin(few).where("n > 0").select(F.lit(RULES[rule]).alias("severity"), F.lit(rule).alias("rule"), "n", "examples")  # one row each


def raw_ids(text: Column) -> Column:
    """The ids of a list as they stand: untrimmed, an empty one after a last comma included. A blank list has none."""
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))


def check_lists(lists: DataFrame, required: DataFrame, valid_ids: DataFrame | None = None) -> DataFrame:
    """Findings of (s1_id, ids_text) against the required s1_id, and the ids that may be listed if they are given."""
    rows = lists.select("s1_id", raw_ids(F.col("ids_text")).alias("ids"))
    each = rows.select(F.explode("ids").alias("id")).distinct()
    good = each.where(F.col("id").startswith("S2-") | F.col("id").startswith("S3-"))
    seen, need = rows.select("s1_id").distinct(), required.select("s1_id").distinct()
    found = [
        _finding("duplicate_row", rows.groupBy("s1_id").count().where("count > 1").select("s1_id")),
        _finding("duplicate_id", rows.where(F.size("ids") != F.size(F.array_distinct("ids"))).select("s1_id")),
        _finding("self_match", each.where(F.col("id").startswith("S1-"))),
        _finding("wrong_prefix", each.where(~F.col("id").rlike("^S[123]-"))),
        _finding("missing_s1", need.join(seen, "s1_id", "left_anti")),
        _finding("unexpected_s1", seen.join(need, "s1_id", "left_anti")),
    ]
    if valid_ids is not None:
        found.append(_finding("unknown_id", good.join(valid_ids.select(F.col("entity_id").alias("id")).distinct(), "id", "left_anti")))
    return reduce(DataFrame.unionByName, found)


def check_subset(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """The warning for entities with matches that are none of their candidates."""
    pairs = lambda df: df.select("s1_id", F.explode(raw_ids(F.col("ids_text"))).alias("id")).distinct()
    return _finding("not_in_candidates", pairs(matches).join(pairs(candidates), ["s1_id", "id"], "left_anti").select("s1_id"))


def check_lines(lines: DataFrame, header: tuple[str, str]) -> DataFrame:
    """Findings of a file's lines (n, value), the header being line 1: its names, lines without a tab, bytes that are no UTF-8."""
    names = F.transform(F.split("value", "\t"), lambda c: F.lower(F.trim(c)))
    commas = F.col("value").contains(",") & ~F.col("value").contains("\t")  # the commonest mistake
    first, rest = lines.where("n = 1"), lines.where("n > 1")
    at = F.col("n").cast("string")
    return reduce(DataFrame.unionByName, [
        _finding("comma_header", first.where(commas).select("value")),
        _finding("bad_header", first.where(~commas & (names != F.array(*[F.lit(h) for h in header]))).select("value")),
        _finding("no_tab", rest.where((F.trim("value") != "") & ~F.col("value").contains("\t")).select(at)),
        _finding("not_utf8", lines.where(~F.is_valid_utf8("value")).select(at)),
    ])


def note(spark: SparkSession, rule: str, example: str) -> DataFrame:
    """A finding about a whole file or check."""
    return spark.createDataFrame([(RULES[rule], rule, 1, example)], "severity string, rule string, n long, examples string")


def read_lines(spark: SparkSession, path: str) -> DataFrame | None:
    """n and value of a file's lines; None without a file."""
    try:
        return with_position(spark.read.text(path), "n").select("n", "value")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def validate_files(spark: SparkSession, matching: str, candidates: str | None, required: DataFrame, valid_ids: DataFrame | None = None, sources: tuple[str, ...] = ()) -> DataFrame:
    """All findings about a matching file and, if there is one, its candidate file, against the required s1_id.

    A fault of a file's header ends the checks of that file. Without valid_ids a warning says that ids were not looked up.
    `sources` are the files that the ids come from: a warning names each one that is missing.
    """
    found = [] if valid_ids is not None else [note(spark, "id_check_off", "")]
    found += [note(spark, "no_source", path) for path in sources if not exists(spark, path)]
    lists = {}
    for name, path, header in (("matched", matching, ("source1_entity_id", "matched_entity_ids")), ("candidates", candidates, ("source1_entity_id", "candidate_entity_ids"))):
        lines = read_lines(spark, path) if path else None
        if lines is None:
            if name == "matched" or path:
                found.append(note(spark, "no_file" if name == "matched" else "no_candidates", path or ""))
            continue
        if not lines.limit(1).count():
            found.append(note(spark, "empty_file", path))
            continue
        faults = check_lines(lines, header)
        broken = faults.where(F.col("rule").isin("comma_header", "bad_header"))
        if broken.limit(1).count():
            found.append(broken)
            continue
        found.append(faults)
        rows = lines.where((F.col("n") > 1) & F.col("value").contains("\t"))
        cut = F.locate("\t", F.col("value"))
        lists[name] = rows.select(F.substring(F.col("value"), F.lit(1), cut - 1).alias("s1_id"), F.substring(F.col("value"), cut + 1, F.length("value")).alias("ids_text"))
        found.append(check_lists(lists[name], required, valid_ids))
    if len(lists) == 2:
        found.append(check_subset(lists["matched"], lists["candidates"]))
    nothing = note(spark, "no_file", "").limit(0)
    return reduce(DataFrame.unionByName, found, nothing)


def list_counts(lists: DataFrame) -> DataFrame:
    """One row: rows, empty and non-empty lists."""
    empty = F.size(raw_ids(F.col("ids_text"))) == 0
    return lists.agg(F.count("*").alias("n_rows"), F.count_if(empty).alias("n_empty"), F.count_if(~empty).alias("n_non_empty"))


def numbered(findings: DataFrame) -> DataFrame:
    """Errors first, numbered; a report is a few rows."""
    order = Window.orderBy("severity", "rule", "examples")
    return findings.withColumn("issue", F.row_number().over(order))


def exit_code(findings: DataFrame) -> int:
    return int(findings.where("severity = 'error'").limit(1).count() > 0)
