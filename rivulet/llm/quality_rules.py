"""Quality rules: a threshold table compiled into one Spark projection.

The measures (lengths, symbols, stop words, lines, repeated windows) are
built-in expressions over the text, so every document is judged where it is
read: no shuffle, no Python.

Defined results: a null or empty text has no word, so all counts are 0 and
the base rule rejects it. Every row is judged on its own (ties and repeated
rows give repeated results). Other columns of the input are not looked at;
an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import SPACES, WORD, text_or_empty, words

# The symbols of the contract, frequent short words of four languages.
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "with", "as", "was", "on",
    "be", "by", "at", "this", "from", "or", "an", "are", "not", "have", "had", "but",
    "de", "la", "le", "et", "les", "des", "en", "un", "une", "du", "que", "est", "dans", "qui",
    "par", "pour", "au", "sur", "pas", "plus", "avec", "ce", "il", "se", "être",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "auf", "für", "ist", "im",
    "dem", "nicht", "ein", "eine", "auch", "es", "werden", "aus", "bei", "hat", "dass",
    "el", "y", "los", "del", "las", "por", "con", "no", "su", "para", "al", "lo", "como",
    "más", "o", "pero", "sus", "una",
)
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``low <= 100 * part / whole <= high`` (a missing bound always holds)
    for texts of at least ``from_words`` words.

    ``part`` and ``whole`` name measures; integers only, so the SQL oracle
    and Spark agree on every border case."""

    name: str
    part: str
    whole: str
    low: int | None = None
    high: int | None = None
    from_words: int = 0

    def holds(self) -> Column:
        part, whole = F.col(self.part) * 100, F.col(self.whole)
        tests = [part >= whole * self.low] if self.low is not None else []
        tests += [part <= whole * self.high] if self.high is not None else []
        out = F.lit(True)
        for t in tests:
            out = out & t
        return out | (F.col("n_words") < self.from_words)

    def sql(self) -> str:
        tests = [f"100 * {self.part} >= {self.low} * {self.whole}"] if self.low is not None else []
        tests += [f"100 * {self.part} <= {self.high} * {self.whole}"] if self.high is not None else []
        return f"(({' AND '.join(tests or ['TRUE'])}) OR n_words < {self.from_words})"


RULES = (
    Rule("mean word length from 2 to 14", "word_chars", "n_words", low=200, high=1400),
    Rule("symbols for at most 1 word in 4", "n_symbols", "n_words", high=25),
    # A short text may well have no stop word by chance.
    Rule("stop words at least 4%", "n_stop_words", "n_words", low=4, from_words=40),
    Rule("repeated lines at most half", "n_dup_lines", "n_lines", high=50),
)


def repeated_words(w: Column, grams: Column) -> Column:
    """Words covered by windows that occur twice or more, from the sorted
    (window, position) pairs: keep the positions of equal neighbours, then
    add up the union of their spans in position order."""
    same = F.filter(grams, lambda e, k: (
        ((k > 0) & (e["g"] == F.get(grams, k - 1)["g"]))
        | F.coalesce(e["g"] == F.get(grams, k + 1)["g"], F.lit(False))))
    starts = F.sort_array(F.transform(same, lambda e: e["p"]))
    return F.aggregate(
        starts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("covered")),
        lambda acc, p: F.struct(
            (p + WINDOW).alias("end"),
            (acc["covered"] + p + WINDOW - F.greatest(p, acc["end"])).alias("covered")),
        lambda acc: acc["covered"])


def measures(df: DataFrame, text: str, keep: Column) -> DataFrame:
    """``keep`` plus the measures of ``text``.

    Hashes of all 5-word windows first tell whether any window can occur
    twice; only texts where one can build and sort the windows themselves,
    so the count is exact.

    The measures pass through ``explode``: a filter on them stops there.
    Pushed below the projections, it would carry copies of their expressions
    and measure each text many times."""
    t = df.select(keep, text_or_empty(text).alias("t"))
    w = t.select("__row", "t", words(F.col("t")).alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    at = F.sequence(F.lit(0), F.size("w") - WINDOW)
    hashes = F.when(F.size("w") > WINDOW, F.transform(
        at, lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)])))
    h = w.select("__row", "t", "w", "lines", hashes.alias("h"))
    twice = F.size(F.array_distinct("h")) < F.size("h")
    grams = F.when(twice, F.sort_array(F.transform(at, lambda i: F.struct(
        F.array_join(F.slice("w", i + 1, WINDOW), " ").alias("g"), i.alias("p")))))
    g = h.select("__row", "t", "w", "lines", grams.alias("grams"))

    def count(c: Column, name: str) -> Column:
        return c.cast("long").alias(name)

    measured = F.struct(
        count(F.size("w"), "n_words"),
        count(F.length(F.translate("t", WHITE, "")), "word_chars"),
        count(F.length("t") - F.length(F.translate("t", SYMBOLS, "")), "n_symbols"),
        count(F.size("lines"), "n_lines"),
        count(F.size("lines") - F.size(F.array_distinct("lines")), "n_dup_lines"),
        count(F.size(F.filter("w", lambda x: F.lower(x).isin(*STOP_WORDS))), "n_stop_words"),
        count(F.when(F.col("grams").isNull(), 0).otherwise(
            repeated_words(F.col("w"), F.col("grams"))), "n_repeat_words"),
    )
    return g.select("__row", F.explode(F.array(measured)).alias("m")).select("__row", "m.*")


def judged(df: DataFrame, text: str, keep: Column, rules: tuple[Rule, ...]) -> DataFrame:
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    kept = ~F.col("base_failed")
    for rule in rules:
        kept = kept & rule.holds()
    return (measures(df, text, keep)
            .withColumn("base_failed", failed)
            .withColumn("kept", kept))


def quality_rules(docs: DataFrame, text: str = "text", id_col: str = "doc_id",
                  rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row of ``docs``: its id, the measures, ``base_failed``, ``kept``."""
    out = judged(docs, text, F.struct(id_col).alias("__row"), rules)
    return out.select(F.col(f"__row.{id_col}"), "n_words", "word_chars", "n_symbols",
                      "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words",
                      "base_failed", "kept")


def keep_quality(docs: DataFrame, text: str = "text",
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs``, all their columns, that the rules keep."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    return judged(docs, text, row, rules).filter("kept").select("__row.*")


def rules_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL of ``quality_rules`` over ``documents``."""
    stops = ", ".join("'" + w + "'" for w in STOP_WORDS)
    word = r"[^\x20\x09-\x0D]+"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '{word}') AS w,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines FROM d),
g AS (SELECT r, p, list_aggregate(w[p : p + {WINDOW - 1}], 'string_agg', ' ') AS g
      FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS p FROM w)),
twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
cover AS (SELECT r, sum(least({WINDOW}, next_p - p)) AS n FROM
          (SELECT r, p, coalesce(lead(p) OVER (PARTITION BY r ORDER BY p), p + {WINDOW}) AS next_p
           FROM twice) GROUP BY r),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
      CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
      CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
      CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words,
      CAST(len(lines) AS BIGINT) AS n_lines,
      CAST(len(list_filter(w, lambda x: lower(x) IN ({stops}))) AS BIGINT) AS n_stop_words
      FROM w LEFT JOIN cover USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND {" AND ".join(r.sql() for r in rules)} AS kept FROM b"""
