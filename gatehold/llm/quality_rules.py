"""Line-first cleaning with built-in functions only.

Every line is judged by itself: punctuation, navigation and boilerplate rules. Failing lines are removed; a document
that loses too much of its text with them is rejected, as is one that breaks the base rules on length and repetition.
All work is inside a row, so there is no shuffle and no group that could grow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehold.llm.columns import SPACE, SPACE_CHARS, fresh, quoted

WINDOW = 8  # words of a window that may repeat
MIN_WORDS = 20
MAX_REPEATED = 30  # per cent of the words inside repeated windows
SYMBOLS = r"[#*$%&|<>]"
MIN_KEPT = 50  # per cent of the words that must be left after the lines are cleaned
MIN_LINE = 4  # words of a line without a sentence end that is not a heading or menu entry
MAX_SYMBOLS = 20  # symbols for each 100 words of a line
MAX_SHOUTS = 30  # exclamation marks for each 100 words of a line
# Phrases of page furniture, in lower case.
BOILERPLATE = (
    "all rights reserved", "click here", "cookie policy", "enable javascript", "privacy policy", "sign up for",
    "subscribe to our", "terms of service", "terms of use",
)
SENTENCE_END = r"""[.!?:;…"'”’»)\]][\x20\x09-\x0D]*$"""


def _words(text: Column) -> Column:
    """The words of a text that starts and ends with one; an empty text has none."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, f"[{SPACE}]+"))


def _line_words(line: Column) -> Column:
    """Number of words: white space runs become one space, which is then counted."""
    return F.size(_words(F.btrim(line, F.lit(SPACE_CHARS))))


def line_fails(line: Column, words: Column) -> Column:
    """Whether a line with so many words is navigation, shouting, symbols or boilerplate."""
    symbols = F.length(line) - F.length(F.regexp_replace(line, SYMBOLS, ""))
    shouts = F.length(line) - F.length(F.replace(line, F.lit("!"), F.lit("")))
    return (
        (symbols * 100 > words * MAX_SYMBOLS)
        | (shouts * 100 > words * MAX_SHOUTS)
        | (~F.rlike(line, F.lit(SENTENCE_END)) & (words < MIN_LINE))
        | F.rlike(F.lower(line), F.lit("|".join(BOILERPLATE)))
    )


def line_first(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """All rows and columns of `docs` and the measures of each text, each under `prefix` + its name:

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept (boolean) and clean_text, the
    lines that pass. A null text counts as empty: no words, base_failed, not kept, clean_text empty. Repeated rows are
    judged one by one. Where a column of `docs` has such a name already, underscores are added to the new one.
    """
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text")
    out = dict(zip(names, fresh(docs, *(prefix + n for n in names))))
    text, words, lines, grams, sorted_grams, kept_lines = fresh(docs, *("__" + n for n in ("t", "w", "l", "g", "s", "k")))
    col = quoted
    base = docs.withColumn(text, F.coalesce(quoted(text_col).cast("string"), F.lit("")))
    base = base.withColumns(
        {
            words: _words(F.btrim(col(text), F.lit(SPACE_CHARS))),
            lines: F.transform(
                F.filter(F.split(col(text), "\n"), lambda x: F.rlike(x, F.lit(f"[^{SPACE}]"))),
                lambda x: F.struct(x.alias("line"), _line_words(x).alias("n")),
            ),
        }
    )
    n = F.size(col(words))
    window = F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(col(words), i, F.lit(WINDOW)))
    )
    base = base.withColumns(
        {
            grams: F.when(n > WINDOW, window).otherwise(F.array().cast("array<bigint>")),
            kept_lines: F.filter(col(lines), lambda x: ~line_fails(x["line"], x["n"])),
        }
    )
    # Only a text with a repeated window pays for sorting its windows.
    numbered = F.array_sort(F.transform(col(grams), lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    repeats = F.size(F.array_distinct(col(grams))) < F.size(col(grams))
    base = base.withColumn(sorted_grams, F.when(repeats, numbered))
    s = col(sorted_grams)
    again = F.filter(
        s,
        lambda x, i: F.coalesce(F.get(s, i + 1)["g"] == x["g"], F.lit(False))
        | F.coalesce(F.get(s, i - 1)["g"] == x["g"], F.lit(False)),
    )
    at = F.array_sort(F.transform(again, lambda x: x["i"]))
    covered = F.aggregate(
        at,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + i + WINDOW - F.greatest(a["end"], i)).alias("n"), (i + WINDOW).alias("end")),
        lambda a: a["n"],
    )
    length = F.length(col(text))
    base = base.withColumns(
        {
            out["n_words"]: n.cast("long"),
            out["word_chars"]: F.length(F.array_join(col(words), "")).cast("long"),
            out["n_symbols"]: (length - F.length(F.regexp_replace(col(text), SYMBOLS, ""))).cast("long"),
            out["n_dup_lines"]: (
                F.size(col(lines)) - F.size(F.array_distinct(F.transform(col(lines), lambda x: x["line"])))
            ).cast("long"),
            out["n_repeat_words"]: F.coalesce(F.when(s.isNotNull(), covered), F.lit(0)).cast("long"),
        }
    )
    words_kept = F.aggregate(col(kept_lines), F.lit(0), lambda a, x: a + x["n"])
    failed = (col(out["n_words"]) < MIN_WORDS) | (
        100 * col(out["n_repeat_words"]) > MAX_REPEATED * col(out["n_words"])
    )
    base = base.withColumns(
        {
            out["base_failed"]: failed,
            out["kept"]: ~failed & (100 * words_kept >= MIN_KEPT * n),
            out["clean_text"]: F.array_join(F.transform(col(kept_lines), lambda x: x["line"]), "\n"),
        }
    )
    return base.select(*(quoted(c) for c in docs.columns), *(col(out[x]) for x in names))
