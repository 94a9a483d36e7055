"""Quality rules, line first.

Rules look at single lines; lines that fail are removed, and a document that
loses more than ``max_loss`` of its words with them is rejected. Before that come
document measures with a base verdict. Everything is built from array functions
on one row; there is no shuffle.

A line with at least one word fails when
* punctuation: no word ends a sentence, or a third of its words shout with
  repeated exclamation marks,
* navigation: a fifth of its words are separators (bars, angle marks, bullets), or
  it is a bare menu entry,
* boilerplate: licence, copyright, cookie or script notices, or symbols in place of
  prose (one per four words), or the line has stood in the document before.

Edge cases: NULL and empty texts have no words, all measures 0, and fail the base
rule. Lines without a word are neither judged nor counted; cleaning drops them.
Ties do not arise. Window hashes have 64 bits, so two different windows of one
text are taken for equal with a chance below 1e-9 for texts of 100,000 words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keytide.llm.text import WORD, step, words

MAX_LOSS = 0.5
WINDOW = 8

# The patterns of the line rules (no look-around, so that SQL engines agree on them).
SENTENCE_END = r"[.!?…][\"'”»)\]]*([\x20\x09-\x0D]|\z)"
SHOUT = r"!!+([\x20\x09-\x0D]|\z)"
SEPARATOR = r"(^|[\x20\x09-\x0D])[|»›>•·]+"
MENU = (
    r"(?i)^[\x20\x09-\x0D]*(home|menu|login|log in|sign in|sign up|register|next|previous|back|share|print|search"
    r"|contact us|about us|site ?map|read more|click here|skip to content)[\x20\x09-\x0D.!:»›>]*\z"
)
# without the first letter, which may be a capital
BOILERPLATE = (
    "icensed under", "eleased under", "ights reserved", "opyright", "erms of use", "erms of service", "rivacy policy",
    "ookie policy", "ses cookies", "nable javascript", "nable JavaScript", "ubscribe to our",
)
SYMBOL = r"[#*$%&|<>]"


def _count(line: Column, pattern: str) -> Column:
    return F.regexp_count(line, F.lit(pattern))


def line_passes(x: Column) -> Column:
    """The line rules for a struct of the line and about its number of words, cheap tests first."""
    line, n = x["line"], x["n"]
    notice = F.exists(F.array(*map(F.lit, BOILERPLATE)), lambda phrase: F.contains(line, phrase))
    return (
        line.rlike(SENTENCE_END)
        & (~line.contains("!!") | (_count(line, SHOUT) * 3 < n))
        & (~line.rlike("[|»›>•·]") | (_count(line, SEPARATOR) * 5 < n))
        & (_count(line, SYMBOL) * 4 < n)
        & ((n > 4) | ~line.rlike(MENU))
        & ~notice
    )


def _paired(h: str, gap: int) -> Column:
    """Hashes of pairs ``gap`` places apart; the array must be longer than ``gap``."""
    n = F.size(h) - gap
    return F.zip_with(F.slice(h, F.lit(1), n), F.slice(h, F.lit(gap + 1), n), lambda a, b: F.xxhash64(a, b))


def _repeated(ranked: str) -> Column:
    """Places of windows with an equal one beside them in the sorted array, in order."""
    n = F.size(ranked) - 1
    left = F.zip_with(F.slice(ranked, F.lit(1), n), F.slice(ranked, F.lit(2), n),
                      lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    return F.array_sort(F.array_distinct(F.flatten(F.filter(left, lambda x: x.isNotNull()))))


def _covered(at: str) -> Column:
    """Words below windows that begin at these places."""
    step = F.zip_with(F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, F.lit(2), F.size(at) - 1), lambda a, b: b - a)
    return F.aggregate(step, F.lit(WINDOW), lambda s, x: s + F.least(x, F.lit(WINDOW)))


def measures(df: DataFrame, text: str = "text", max_loss: float = MAX_LOSS) -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, cleaned (the text without failed lines), n_clean_words and kept."""
    t = F.coalesce(F.col(text), F.lit(""))
    # each of these columns is named at least twice below, so the optimizer keeps it as a step of its own
    out = df.withColumns({"__w": words(t), "__l": F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))})
    out = out.withColumn("__u", F.array_distinct("__l"))
    rated = F.transform("__u", lambda x: F.struct(x.alias("line"), F.size(F.split(x, " ")).alias("n")))
    out = out.withColumns({
        "__n": F.transform(F.filter(rated, line_passes), lambda x: x["line"]),
        "__h2": F.when(F.size("__w") > WINDOW, _paired("__w", 1)),
        "n_words": F.size("__w").cast("long"),
        "word_chars": F.length(F.array_join("__w", "")).cast("long"),
        "n_symbols": _count(t, SYMBOL).cast("long"),
        "n_dup_lines": (F.size("__l") - F.size("__u")).cast("long"),
    })
    # hashes of 2, 4 and 8 words; a window of 8 cannot repeat where no window of 4 does
    out = out.withColumn("__h4", _paired("__h2", 2))
    out = out.withColumn("__h8", F.when(F.size(F.array_distinct("__h4")) < F.size("__h4"), _paired("__h4", 4)))
    out = out.withColumn("__r", F.when(
        F.size(F.array_distinct("__h8")) < F.size("__h8"),
        F.array_sort(F.transform("__h8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ))
    out = out.withColumn("__at", F.when(F.col("__r").isNotNull(), _repeated("__r")))
    out = out.withColumns({
        "n_repeat_words": F.coalesce(F.when(F.col("__at").isNotNull(), _covered("__at")), F.lit(0)).cast("long"),
        "cleaned": F.array_join("__n", "\n"),
    })
    out = out.withColumn("n_clean_words", F.when(F.size("__n") == F.size("__l"), F.col("n_words")).otherwise(
        F.size(words(F.col("cleaned"))).cast("long")
    ))
    out = out.withColumn(
        "base_failed", (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    ).drop("__l", "__w", "__u", "__n", "__h2", "__h4", "__h8", "__r", "__at")
    lost = F.col("n_words") - F.col("n_clean_words")
    return step(out, kept=~F.col("base_failed") & (lost <= F.col("n_words") * max_loss))


def clean(df: DataFrame, max_loss: float = MAX_LOSS) -> DataFrame:
    """Documents that pass, without the lines that fail; columns as they came,
    ``n_chars`` counted anew where it exists."""
    names = {"text": F.col("cleaned")} | ({"n_chars": F.length("cleaned").cast("long")} if "n_chars" in df.columns else {})
    return measures(df, max_loss=max_loss).filter("kept").select(
        *(names[c].alias(c) if c in names else F.col(c) for c in df.columns)
    )
