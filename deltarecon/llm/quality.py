"""Quality rules, line first (DataFrame functions only).

Every line with a word is held against three rules:

* punctuation: some sentence ends in it (closing quotes and brackets may follow
  the mark), and symbols and runs of exclamation or question marks are at
  most ``MAX_NOISE`` of its characters;
* navigation: no menu separators, breadcrumbs or bare links, nor a line that is one of
  the usual English labels;
* boilerplate: none of the fixed phrases of site furniture. Phrases and labels are
  English, the other rules hold for any language.

Failing lines are removed. A document is rejected if the base rules fail, or if
more than ``MAX_LOST`` of the characters in its lines were removed.

Repeated three-word windows are found within the row: the hashes of all
windows are counted as distinct first, and only where some repeat are they sorted
with their places. No row is exploded and nothing is shuffled.

Cases: null, empty and blank texts have no words and fail the base rules (fewer
than ``MIN_WORDS`` words), and their cleaned text is empty; repeated rows and
ids are judged on their own; an empty table gives no rows; other columns don't
matter; a very long text is one row's work, in time near linear.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deltarecon.llm.common import SPACE, free_name, let, run_lengths, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST = 0.5
MAX_NOISE = 0.05

# Fixed values of the rules. RE2 and Java read these patterns alike.
SYMBOLS = r"[#*$%&|<>]"
NOISE = r"[#*$%&|<>]|[!?]{2,}"
SENTENCE_END = r"[.!?…:;。！？]['\"”’»)\]]*(?:[\x20\x09-\x0D]|$)"
NAVIGATION = (
    r"\|[^|]*\||(?:^|[^»›])[»›][^»›]*[»›]|^[\x20\x09-\x0D]*(?:https?://|www\.)[^\x20\x09-\x0D]+[\x20\x09-\x0D]*$"
    r"|^[\x20\x09-\x0D]*(?i:home|menu|log ?in|sign (?:in|up)|register|search|next|previous|back to top|skip to content|"
    r"read more|load more|show more|share|print|contact us|about us|site ?map)[\x20\x09-\x0D.:!]*$")
BOILERPLATE = (
    r"(?i)all rights reserved|terms of (?:use|service)|privacy policy|cookie policy|uses? cookies|accept (?:all )?cookies"
    r"|subscribe to our newsletter|enable javascript|click here|lorem ipsum|powered by|©|copyright \(c\)")


def lines_of(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def line_passes(line: Column) -> Column:
    noise = F.char_length(line) - F.char_length(F.regexp_replace(line, NOISE, ""))
    return (line.rlike(SENTENCE_END) & (noise <= F.char_length(line) * MAX_NOISE)
            & ~line.rlike(NAVIGATION) & ~line.rlike(BOILERPLATE))


def repeated_words(windows: Column) -> Column:
    """Words inside three-word windows whose hash occurs again; ``windows`` has the hashes in order."""

    def places(pairs: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            before = pairs[F.greatest(i - 1, F.lit(0))]["h"] == x["h"]
            after = pairs[F.least(i + 1, F.size(pairs) - 1)]["h"] == x["h"]
            return ((i > 0) & before) | ((i + 1 < F.size(pairs)) & after)

        return F.transform(F.filter(pairs, again), lambda x: F.struct(x["i"].alias("s"), (x["i"] + 3).alias("e")))

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = run_lengths(let(pairs, places))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(some)


def quality_measures(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct column ``quality``: the counts, ``base_failed``,
    ``lost`` (share of characters in removed lines), ``kept`` and ``cleaned`` (the
    lines that passed). A column of that name is replaced."""
    text = F.coalesce(F.col("text"), F.lit(""))
    ws, lines, windows, good, measured = (free_name(docs, n) for n in ("ws", "lines", "windows", "good", "measured"))
    df = docs.withColumns({ws: words(text), lines: lines_of(text)})
    df = df.withColumns({
        windows: F.transform(F.slice(ws, 1, F.greatest(F.size(ws) - 2, F.lit(0))),
                             lambda w, i: F.xxhash64(w, F.col(ws)[i + 1], F.col(ws)[i + 2])),
        good: F.filter(lines, line_passes),
    })

    def chars(column: str) -> Column:
        return F.char_length(F.array_join(column, ""))

    n_words = F.size(ws).cast("long")
    n_repeat = repeated_words(F.col(windows))
    n_lines = F.size(lines)
    lost = F.when(chars(lines) > 0, 1 - chars(good) / chars(lines)).otherwise(F.lit(0.0))
    df = df.withColumn(measured, F.struct(
        n_words.alias("n_words"),
        F.char_length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        n_repeat.alias("n_repeat_words"), lost.alias("lost"), F.array_join(good, "\n").alias("cleaned")))
    m = F.col(measured)
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    return df.withColumn("quality", F.struct(
        f"{measured}.*", failed.alias("base_failed"), (~failed & (m["lost"] <= MAX_LOST)).alias("kept"))
    ).drop(ws, lines, windows, good, measured)


def quality_report(docs: DataFrame) -> DataFrame:
    """The digest columns per document."""
    q = quality_measures(docs.select("doc_id", "text"))
    return q.select("doc_id", *(f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


def clean(docs: DataFrame) -> DataFrame:
    """The kept documents with their failing lines removed; the columns of
    ``docs``, ``n_chars`` (where present) as the cleaned text has it."""
    # A filter on a computed column is pushed below it, where the expressions behind it
    # would be written out in place, once for every use; not past a row number.
    row, was = free_name(docs, "row_nr"), free_name(docs, "quality_was")
    measured = quality_measures(docs.withColumnsRenamed({c: was for c in docs.columns if c.lower() == "quality"}))
    kept = measured.withColumn(row, F.monotonically_increasing_id()).filter(F.col("quality.kept") & (F.col(row) >= 0))
    new = {"text": F.col("quality.cleaned")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.char_length("quality.cleaned").cast(docs.schema["n_chars"].dataType)
    kept = kept.withColumns(new).drop("quality")
    return kept.withColumnsRenamed({was: c for c in docs.columns if c.lower() == "quality"}).select(*docs.columns)
