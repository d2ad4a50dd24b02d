"""Line-first cleaning with SQL functions only: lines are judged first, then documents by what the lines leave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ramparts.llm.shared import free_name

BLANKS = r"[\x20\x09-\x0D]+"
WORD_IN_BLANKS = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+"
NO_SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 3
# Base rules of a document.
LEAST_WORDS, MOST_REPEATED = 50, 50
# Rules of a line. A line that breaks one is removed.
SENTENCE_END = r"[.!?…。！？]"
SEPARATORS = r"[\x20\x09-\x0D][|»›>·•/][\x20\x09-\x0D]|::"
IN_SEPARATORS = r"[|»›>·•/:]"  # no separator is without one of these
MOST_SYMBOLS = 10  # per cent of a line's characters that are no blanks
MOST_CAPITALS = 60  # per cent of a line's letters, from CAPITAL_WORDS words on
CAPITAL_WORDS = 5
SEGMENT_WORDS = 4  # a line cut by separators into pieces of so few words is navigation
BOILERPLATE = (
    "all rights reserved|privacy policy|terms of (use|service)|cookie|enable javascript|click here|read more|"
    "sign (in|up)|log ?in|subscribe|share (this|on)|skip to (main )?content|back to top|lorem ipsum"
)
BOILERPLATE_WORDS = 12  # a longer line that only mentions such a phrase stays
# A document that keeps less than this share of its word characters is rejected.
LEAST_KEPT = 50


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of a text; a null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def count_outside(text: Column, others: str) -> Column:
    """Characters of ``text`` that are not in runs of ``others``: no array of single characters is made to count them."""
    return F.length(F.regexp_replace(text, others, ""))


def repeated_words(words: Column) -> Column:
    """Words that lie in windows of three words that the text has twice or more.

    Windows of one sum are looked for first, as equal windows have equal sums; the others are compared themselves.
    """

    def covered(windows: Column) -> Column:
        def twice(s: Column, j: Column) -> Column:
            before = F.when(j > 0, F.get(windows, j - 1)["w"])
            return F.coalesce((s["w"] == before) | (s["w"] == F.get(windows, j + 1)["w"]), F.lit(False)) | F.coalesce(
                s["w"] == before, F.lit(False)
            )

        places = F.sort_array(F.transform(F.filter(windows, twice), lambda s: s["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            places,
            start,
            lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
            lambda a: a["n"],
        )

    def of(w: Column) -> Column:
        def compared(sums: Column) -> Column:
            window = lambda i: F.struct(
                F.concat_ws(" ", *[F.get(w, i + k) for k in range(WINDOW)]).alias("w"), i.alias("i")
            )
            ordered = F.sort_array(F.transform(sums, lambda s, i: F.struct(s.alias("s"), i.alias("i"))))

            def alike(o: Column) -> Column:
                beside = lambda s, j: F.coalesce(s["s"] == F.get(o, j)["s"], F.lit(False))
                return F.filter(o, lambda s, j: beside(s, F.when(j > 0, j - 1)) | beside(s, j + 1))

            return let(F.sort_array(F.transform(let(ordered, alike), lambda s: window(s["i"]))), covered)

        sums = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
        distinct = lambda s: F.size(F.array_distinct(s)) == F.size(s)
        return F.when(F.size(w) < WINDOW, 0).otherwise(let(sums, lambda s: F.when(distinct(s), 0).otherwise(compared(s))))

    return let(words, of)


def line_fails(line: Column) -> Column:
    """Whether a line with a word breaks a punctuation, symbol, capitals, navigation or boilerplate rule."""

    def judged(n_words: Column) -> Column:
        capitals, letters = count_outside(line, r"[^\p{Lu}]+"), count_outside(line, r"[^\p{L}]+")
        separators = F.regexp_count(line, F.lit(SEPARATORS))
        return (
            ~line.rlike(SENTENCE_END)
            | (100 * count_outside(line, NO_SYMBOLS) > MOST_SYMBOLS * count_outside(line, BLANKS))
            | ((n_words >= CAPITAL_WORDS) & (100 * capitals > MOST_CAPITALS * letters))
            | (line.rlike(IN_SEPARATORS) & (separators >= 1) & (n_words - separators <= SEGMENT_WORDS * (separators + 1)))
            | ((n_words <= BOILERPLATE_WORDS) & F.lower(line).rlike(BOILERPLATE))
        )

    return let(F.length(F.regexp_replace(line, WORD_IN_BLANKS, "w")), judged)


def cleaned_lines(lines: Column) -> Column:
    """Lines that pass every rule, in order. A line seen before is boilerplate and goes; lines without a word go too."""
    return F.filter(F.array_distinct(lines), lambda line: ~line_fails(line))


def judged(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``quality`` (under a free name, the last column) of counts, verdicts and ``clean_text``.

    Null text counts as no words: base_failed. An empty table gives no rows; repeated rows come out repeated.
    """
    name, work = free_name(docs.columns, "quality"), free_name(docs.columns, "work")
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    spoken = F.filter(F.split(value, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    parts = docs.withColumn(work, F.struct(words_of(value).alias("words"), spoken.alias("lines")))
    words, lines = F.col(f"`{work}`.words"), F.col(f"`{work}`.lines")
    n_words = F.size(words)
    counted = parts.withColumn(
        work,
        F.struct(
            n_words.cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            count_outside(value, NO_SYMBOLS).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
            F.array_join(cleaned_lines(lines), "\n").alias("clean_text"),
        ),
    )
    w = F.col(f"`{work}`")
    failed = (w["n_words"] < LEAST_WORDS) | (100 * w["n_repeat_words"] > MOST_REPEATED * w["n_words"])
    kept_chars = F.length(F.regexp_replace(w["clean_text"], BLANKS, "")).cast("long")
    enough = 100 * kept_chars >= LEAST_KEPT * w["word_chars"]
    verdict = w.withField("base_failed", failed).withField("kept_chars", kept_chars).withField("kept", ~failed & enough)
    return counted.select(*[F.col(f"`{c}`") for c in docs.columns], verdict.alias(name))


def quality_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and verdicts, a row for each row of ``docs``."""
    base = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = judged(base)
    fields = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept kept_chars".split()
    return found.select("doc_id", *[F.col(f"quality.{f}").alias(f) for f in fields])


def clean_documents(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Documents that pass, with their cleaned text; ``n_chars``, where it exists, follows the text."""
    found = judged(docs, text)
    name = found.columns[-1]
    # Unpacked from an array of one, the verdict counts as a stored value: the filter on it is not rewritten into one
    # that reads and judges the text once more.
    kept = found.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.array(f"`{name}`")).alias(name))
    quality = F.col(f"`{name}`")
    new = {text: quality["clean_text"]}
    if n_chars in docs.columns:
        new[n_chars] = F.length(quality["clean_text"]).cast(docs.schema[n_chars].dataType)
    return kept.filter(quality["kept"]).select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
