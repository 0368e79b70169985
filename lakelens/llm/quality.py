"""Quality rules: a threshold table compiled into one Spark projection.

Every metric is a built-in expression over the whole text, and the verdict is
one boolean expression made from ``RULES``; there is no user function, no
explode and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, words

SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Common function words of English, French, Spanish and German (fixed values).
STOP_WORDS = ("the", "be", "to", "of", "and", "that", "with", "in", "is", "for",
              "de", "la", "le", "et", "les", "des", "en", "un", "une", "du",
              "que", "el", "y", "los", "las", "no", "por", "con", "se", "del",
              "der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "sich")

# name -> (numerator, denominator, least, most); None leaves a side open.
RULES: dict[str, tuple[str, str, float | None, float | None]] = {
    "mean_word_length": ("word_chars", "n_words", 2.0, 12.0),
    "symbol_ratio": ("n_symbols", "n_words", None, 0.1),
    "exclamation_ratio": ("n_exclaims", "n_words", None, 0.5),
    "upper_ratio": ("n_upper", "word_chars", None, 0.4),
    "stop_word_ratio": ("n_stop_words", "n_words", 0.02, None),
    "duplicate_line_ratio": ("n_dup_lines", "n_lines", None, 0.4),
    "bullet_line_ratio": ("n_bullet_lines", "n_lines", None, 0.9),
    "ellipsis_line_ratio": ("n_ellipsis_lines", "n_lines", None, 0.3),
}


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def verdict(rules: dict = RULES) -> Column:
    """The threshold table as one boolean expression over the metric columns.
    A ratio without a denominator (a text without words) is left out."""
    ok = F.lit(True)
    for num, den, least, most in rules.values():
        ratio = F.col(num) / F.nullif(F.col(den), F.lit(0))
        if least is not None:
            ok = ok & F.coalesce(ratio >= least, F.lit(True))
        if most is not None:
            ok = ok & F.coalesce(ratio <= most, F.lit(True))
    return ok


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            rules: dict = RULES) -> DataFrame:
    """Metrics and verdict of every row: the id, the metric counts,
    ``base_failed`` and ``kept``.

    NULL and empty texts have zero counts and fail the base rule (too few
    words).  Windows are compared by a 64-bit hash of their five words.
    """
    d = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    d = d.withColumn("_w", words(F.col("_t")))
    d = d.withColumn("_lines", F.filter(F.split("_t", "\n"), lambda x: _without(x, SPACES) != ""))
    d = d.withColumn("_h", F.when(F.size("_w") >= 5, F.transform(
        F.sequence(F.lit(0), F.size("_w") - 5),
        lambda i: F.xxhash64(*[F.get("_w", i + j) for j in range(5)])))
        .otherwise(F.array().cast("array<bigint>")))
    # texts without an equal pair of windows (most) skip the sort
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.array_sort(
        F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    d = d.withColumn("_p", F.when(F.col("_s").isNotNull(), F.array_sort(F.transform(F.filter(
        F.sequence(F.lit(0), F.size("_s") - 1),
        lambda k: F.coalesce(F.get("_s", k)["h"] == F.get("_s", k - 1)["h"], F.lit(False))
        | F.coalesce(F.get("_s", k)["h"] == F.get("_s", k + 1)["h"], F.lit(False))),
        lambda k: F.get("_s", k)["i"]))))
    covered = F.aggregate(
        F.transform("_p", lambda p, k: F.least(F.lit(5), F.coalesce(F.get("_p", k + 1) - p, F.lit(5)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    n = F.length("_t")
    d = d.select(
        "_id",
        F.size("_w").cast("long").alias("n_words"),
        F.length(_without(F.col("_t"), SPACES)).cast("long").alias("word_chars"),
        (n - F.length(_without(F.col("_t"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (n - F.length(_without(F.col("_t"), UPPER))).cast("long").alias("n_upper"),
        (n - F.length(_without(F.col("_t"), "!"))).cast("long").alias("n_exclaims"),
        F.size(F.filter("_w", lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter("_lines", lambda x: F.ltrim(x).rlike("^[-*•] "))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter("_lines", lambda x: F.rtrim(x).endswith("..."))).cast("long").alias("n_ellipsis_lines"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (d.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & verdict(rules))
            .withColumnRenamed("_id", id_col))


def oracle_sql() -> str:
    """The same table in DuckDB SQL."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    checks = []
    for num, den, least, most in RULES.values():
        ratio = f"{num}::DOUBLE / nullif({den}, 0)"
        if least is not None:
            checks.append(f"coalesce({ratio} >= {least}, true)")
        if most is not None:
            checks.append(f"coalesce({ratio} <= {most}, true)")
    space = "[\\x20\\x09-\\x0D]"
    return rf"""
WITH t AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, t,
    list_filter(regexp_split_to_array(t, '{space}+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{space}+', '', 'g') <> '') AS ls
  FROM t),
win AS (
  SELECT rid, i, [w[i], w[i+1], w[i+2], w[i+3], w[i+4]] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
cov AS (
  SELECT rid, sum(least(5, coalesce(nxt - i, 5)))::BIGINT AS n_repeat_words
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM rep) GROUP BY rid),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '{space}+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    len(ls)::BIGINT AS n_lines,
    (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_upper,
    (length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclaims,
    len(list_filter(w, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words,
    len(list_filter(ls, lambda x: regexp_matches(ltrim(x, ' '), '^[-*•] ')))::BIGINT AS n_bullet_lines,
    len(list_filter(ls, lambda x: ends_with(rtrim(x, ' '), '...')))::BIGINT AS n_ellipsis_lines
  FROM w LEFT JOIN cov USING (rid)),
b AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND {' AND '.join(checks)} AS kept FROM b"""
