"""Quality rules: a threshold table compiled into one Spark projection.

Words are runs of ``[^\\x20\\x09-\\x0D]``, lines are split at ``\\n``.  Each
:class:`Rule` names a metric of the projection and the closed range in which
a document passes; ``compile_rules`` turns the table into one expression.  No
user function runs, nothing is shuffled.

Defined results: null text counts as empty; an empty text has no words and
fails the base rule (fewer than ten words); very long texts are measured
whole; repeated rows and repeated ids give one row each; a null id stays null;
an empty table gives an empty table; a rule with languages is skipped where the
table has no ``lang`` column or the document's is null or another; columns other
than id, text and ``lang`` are not read, so clashing names do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
_TRIM = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class Rule:
    """A document passes if ``low <= metric <= high`` (None: open), or if it
    has fewer than ``min_words`` words (ratios of short texts say little), or
    if ``langs`` are named and it is in none of them."""
    name: str
    metric: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0
    langs: tuple[str, ...] = ()


#: Languages of ``STOP_WORDS``.
STOP_LANGS = ("en", "de", "fr", "es")
#: Production thresholds: wide enough for plain prose of any language.
RULES = (
    Rule("mean_word_length", "mean_word_chars", 2.0, 14.0, 20),
    Rule("symbols_per_word", "symbol_ratio", None, 0.25, 10),
    Rule("repeated_lines", "dup_line_ratio", None, 0.3, 20),
    Rule("bullet_lines", "bullet_line_ratio", None, 0.9, 50),
    Rule("letters", "alpha_word_ratio", 0.6, None, 20),
    Rule("stop_words", "stop_word_ratio", 0.02, None, 50, STOP_LANGS),
)
#: Frequent function words of English, German, French, Spanish.
STOP_WORDS = ("the", "be", "to", "of", "and", "that", "have", "with", "der", "die", "und", "ist", "von",
              "le", "la", "les", "des", "et", "est", "el", "los", "que", "y", "por")


def _repeat_words(h: str) -> Column:
    """Words inside 5-word windows that occur twice or more, from the array
    of window hashes: windows sorted by (hash, place), equal neighbours kept,
    and each kept start covers up to five words until the next kept start."""
    s = f"array_sort(transform({h}, (x, i) -> struct(x AS h, i AS i)))"
    return F.expr(f"""
      CASE WHEN size({h}) = size(array_distinct({h})) THEN 0L ELSE
      aggregate(array({s}), 0L, (z, a) ->
        z + aggregate(array(array_sort(transform(filter(a, (e, k) ->
              coalesce(get(a, k - 1).h = e.h, false) OR coalesce(get(a, k + 1).h = e.h, false)), e -> e.i))),
          0L, (y, st) -> y + aggregate(transform(st, (p, k) ->
              least(5, coalesce(get(st, k + 1) - p, 5))), 0L, (t, v) -> t + v))) END""")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang: Column | None = None) -> DataFrame:
    """One row per document: its id, main language tag and the metrics the rules use."""
    lang = F.lit(None) if lang is None else lang
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"),
                       F.regexp_extract(F.lower(lang.cast("string")), "^[a-z]*", 0).alias("lang"))
    trimmed = F.btrim(F.col("_t"), F.lit(_TRIM))
    d = base.withColumn("_w", F.when(trimmed == "", F.array().cast("array<string>"))
                        .otherwise(F.split(trimmed, SPACE + "+")))
    d = d.select("doc_id", "lang", "_t", "_w", F.size("_w").cast("long").alias("n_words"),
                 F.expr("""CASE WHEN size(_w) < 5 THEN array() ELSE transform(sequence(0, size(_w) - 5), i ->
                     xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2), get(_w, i + 3), get(_w, i + 4))) END""")
                 .alias("_h"),
                 F.expr(r"filter(split(_t, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')").alias("_lines"))
    lines = F.size("_lines").cast("long")
    return d.select(
        "doc_id", "lang", "n_words",
        F.length(F.regexp_replace("_t", SPACE + "+", "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.regexp_replace("_t", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        lines.alias("n_lines"),
        (lines - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(r"cast(size(filter(_lines, l -> l rlike '^[\\x20\\t]*[-*\\u2022]\\x20')) as long)").alias("n_bullets"),
        F.expr(r"cast(size(filter(_w, x -> x rlike '\\p{L}')) as long)").alias("n_alpha_words"),
        # The letters of a word decide: "and," and "the***" are stop words.
        F.expr(r"cast(size(filter(_w, x -> lower(regexp_replace(x, '\\P{L}+', '')) IN (%s))) as long)"
               % ", ".join(f"'{w}'" for w in STOP_WORDS)).alias("n_stop_words"),
        _repeat_words("_h").alias("n_repeat_words"))


def _ratios() -> dict[str, Column]:
    per = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {"mean_word_chars": per("word_chars", "n_words"), "symbol_ratio": per("n_symbols", "n_words"),
            "dup_line_ratio": per("n_dup_lines", "n_lines"), "bullet_line_ratio": per("n_bullets", "n_lines"),
            "alpha_word_ratio": per("n_alpha_words", "n_words"), "stop_word_ratio": per("n_stop_words", "n_words"),
            "repeat_ratio": per("n_repeat_words", "n_words")}


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """Names of the failed rules as one array expression."""
    def fails(r: Rule) -> Column:
        bad = F.lit(False)
        if r.low is not None:
            bad = bad | (F.col(r.metric) < r.low)
        if r.high is not None:
            bad = bad | (F.col(r.metric) > r.high)
        if r.langs:
            bad = bad & F.coalesce(F.col("lang").isin(*r.langs), F.lit(False))
        return F.when(bad & (F.col("n_words") >= r.min_words), F.lit(r.name))
    if not rules:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[fails(r) for r in rules]))


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                text_col: str = "text", lang: Column | None = None) -> DataFrame:
    """Metrics, ``base_failed``, ``failed_rules`` and ``kept`` per document."""
    m = measure(docs, id_col, text_col, F.col("lang") if lang is None and "lang" in docs.columns else lang)
    m = m.select("*", *[c.alias(n) for n, c in _ratios().items()])
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    m = m.select("*", base.alias("base_failed"), compile_rules(rules).alias("failed_rules"))
    return m.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """``docs`` without the rejected documents, columns untouched (the verdict
    is computed beside each row; nothing is joined).  The one-element explode
    keeps the optimiser from pushing the verdict, with all word arrays written
    out again at each use, down into the scan's filter."""
    row, doc = "_doc", docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    judged = apply_rules(doc, rules, row, f"{row}.{text_col}", F.col(f"{row}.lang") if "lang" in docs.columns else None)
    return judged.select("doc_id", F.explode(F.array("kept")).alias("kept")).where("kept").select("doc_id.*")
