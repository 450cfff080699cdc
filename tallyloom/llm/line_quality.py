"""Quality rules, line first, with DataFrame functions only.

Every line that holds a word is judged by itself: punctuation (a third or more
of its words end in a run of symbols or exclamation marks), navigation (items
between bars or breadcrumb signs, on average at most four words each) and
boilerplate (a short line with a licence, cookie or sign-in phrase, or a bare
link).
Failing lines are removed; then a document is rejected when the removed lines
held more than ``max_lost`` percent of its word characters.

Null and empty texts have zero counts and fail the base rule (fewer than
``min_words`` words). Repeated rows get equal results; other columns pass
through, and columns named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import WORD_GAP, free_name

MIN_WORDS = 50
MAX_REPEAT = 50
MAX_LOST = 40
SYMBOLS = "#*$%&|<>"
#: A word that ends in two or more symbols or exclamation marks.
NOISE_WORD = r"[#*$%&<>!]{2,}(?=[\x20\x09-\x0D]|$)"
BOILERPLATE = (r"(?i)\b(all rights reserved|released under the .{1,40} licen[cs]e|licensed under|cookie policy"
               r"|privacy policy|terms of (use|service)|subscribe to our newsletter|click here|javascript"
               r"|sign in|log in to)\b")
BARE_LINK = r"^\s*(https?://|www\.)\S+\s*$"


def _chars(c: Column) -> Column:
    return F.length(F.regexp_replace(c, WORD_GAP, ""))


def _words(c: Column) -> Column:
    inner = F.btrim(c, F.lit(" \t\n\x0b\x0c\r"))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WORD_GAP))


def _line_fails(line: Column) -> Column:
    """Does this line break a rule? Lines without a word never do."""
    words = F.size(_words(line))
    noise = F.regexp_count(line, F.lit(NOISE_WORD))
    punctuation = noise * 3 >= words
    bars = F.length(line) - F.length(F.translate(line, "|»›·", ""))
    navigation = (bars >= 2) & (bars * 4 >= words)
    boilerplate = ((words <= 12) & line.rlike(BOILERPLATE)) | line.rlike(BARE_LINK)
    return (words > 0) & (punctuation | navigation | boilerplate)


def _with_repeat_words(df: DataFrame, words: str, packed: str, pairs: str, spots: str) -> DataFrame:
    """Add n_repeat_words: words in 3-word windows found twice or more in the text.

    First each window's position is packed below 40 bits of its hash and the
    numbers sorted: positions whose 40 bits occur twice are the candidates.
    Those, few in most texts, are compared by the whole 64-bit hash. Both steps
    cost n log n for any text. Each step is a column of its own: a lambda must
    refer to a finished array, not to the expression that builds it.
    """
    w, q, p = F.col(words), F.col(packed), F.col(pairs)
    n = F.size(w)
    spot_bits = 24

    def window(i: Column) -> Column:
        return F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    every = F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0)))
    df = df.withColumn(packed, F.when(n >= 4, F.sort_array(F.transform(
        every, lambda i: F.shiftleft(window(i), spot_bits).bitwiseOR(i.cast("long"))))))
    alike = F.transform(F.filter(q, lambda x, i: (F.shiftright(F.get(q, i + 1), spot_bits) == F.shiftright(x, spot_bits))
                                 | (F.shiftright(F.get(q, i - 1), spot_bits) == F.shiftright(x, spot_bits))),
                        lambda x: x.bitwiseAND(F.lit((1 << spot_bits) - 1)).cast("int"))
    some = F.when(n < (1 << spot_bits), alike).otherwise(every)
    df = df.withColumn(pairs, F.sort_array(F.transform(some, lambda i: F.struct(window(i).alias("h"), i.alias("i")))))
    df = df.withColumn(spots, F.sort_array(F.transform(F.filter(
        p, lambda x, i: (F.get(p, i + 1)["h"] == x["h"]) | (F.get(p, i - 1)["h"] == x["h"])), lambda x: x["i"])))
    total = F.aggregate(
        F.col(spots), F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long")))


def measure(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT,
            max_lost: int = MAX_LOST) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, lost_chars, kept and clean_text (the lines that pass)."""
    own = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
           "lost_chars", "kept", "clean_text"]
    tmp = {k: free_name(docs, f"_q_{k}") for k in ("t", "w", "l", "b", "packed", "pairs", "spots")}
    t, w, lines, bad = (F.col(tmp[k]) for k in ("t", "w", "l", "b"))
    df = docs.withColumn(tmp["t"], F.coalesce(F.col(text), F.lit("")))
    df = df.drop(*[c for c in own if c != text])
    df = df.withColumn(tmp["w"], _words(t))
    df = df.withColumn(tmp["l"], F.split(t, "\n"))
    df = df.withColumn(tmp["b"], F.filter(lines, _line_fails))
    df = _with_repeat_words(df, tmp["w"], tmp["packed"], tmp["pairs"], tmp["spots"])
    live = F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        "*",
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.size(live) - F.size(F.array_distinct(live))).cast("long").alias("n_dup_lines"),
        F.aggregate(bad, F.lit(0).cast("long"), lambda a, x: a + _chars(x)).alias("lost_chars"),
        F.when(F.size(bad) == 0, t)
         .otherwise(F.array_join(F.filter(lines, lambda x: ~_line_fails(x)), "\n")).alias("clean_text"))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    df = df.withColumn("base_failed", base)
    df = df.withColumn("kept", ~base & (100 * F.col("lost_chars") <= max_lost * F.col("word_chars")))
    return df.drop(*tmp.values())


def clean(docs: DataFrame, text: str = "text", **rules) -> DataFrame:
    """The kept documents, their failing lines removed; columns as in docs."""
    # A filter on kept would be pushed below the columns it is made of and work them out again inside lambdas;
    # a filter on a generated column stays where it is.
    safe = {c: f"_q_{i}" for i, c in enumerate(docs.columns)}
    done = measure(docs.withColumnsRenamed(safe), safe[text], **rules)
    out = done.select("*", F.explode_outer(F.when(F.col("kept"), F.array("clean_text"))).alias("_q_text"))
    out = out.filter(F.col("_q_text").isNotNull())
    new = F.col("_q_text")
    return out.select(*[(new if c == text else F.length(new).cast(docs.schema[c].dataType) if c == "n_chars"
                         else F.col(safe[c])).alias(c) for c in docs.columns])
