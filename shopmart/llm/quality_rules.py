"""Quality rules: counts of a document and its divergence from the references of its language.

A reference has two histograms, both taken over every document of the language: the shares of
the classes of characters, and the shares of its most common words (the rest is one more bin). A
document is kept if the Jensen-Shannon distance of both of its own histograms to the
reference stays below a limit that falls with its length, as the sampling noise of a histogram does:

    limit = floor + slope / sqrt(words)

Guards: a histogram is compared only from a minimum number of words on, and only in a language with
``MIN_LANGUAGE_WORDS`` words, whatever the rest of the corpus holds; fewer make no reference, and the documents of such a
language are judged by the base rule. The languages are counted: up to ``BROADCAST_LANGUAGES``
references are broadcast, beyond they are dealt in ``SALTS`` copies, so a frequent language stays spread.
Common words may have any length.

Everything is a JVM expression; arrays that a lambda reads more than once are bound to a lambda
variable first (:func:`bound`), or they would be computed again for each element.

Defined cases: null text has no words; a document without words fails the base rule; null
language is a language of its own; an empty table gives no rows and needs no reference.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopmart.llm.storage import discard, store
from shopmart.llm.words import WHITE, WHITE_RUN, n_words, words_of

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
COMMON_WORDS = 32
#: A common word holds 1 in 2000 words: with fewer, a word that stands once would be common.
MIN_LANGUAGE_WORDS = 2000
BROADCAST_LANGUAGES, SALTS = 500, 32
#: Histogram: least words, floor and slope of the limit.
CLASS_LIMIT = (20, 0.13, 1.3)
WORD_LIMIT = (50, 0.16, 1.9)
SYMBOLS = "#*$%&|<>"
#: Classes of characters; what none of them holds is the last class.
CLASSES = (r"[\x20\x09-\x0D]", "[a-z]", "[A-Z]", "[0-9]", r"[#*$%&|<>]", r"[\x21-\x7E]")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def symbol_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(WHITE)) != "")
    return bound(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("long")


def _window_hashes(hashes: Column) -> Column:
    whole = F.transform(hashes, lambda first, i: F.xxhash64(first, *[F.get(hashes, i + n) for n in range(1, WINDOW)]))
    return F.slice(whole, 1, F.size(hashes) - (WINDOW - 1))


def _repeat_starts(ordered: Column) -> Column:
    """Places of the windows that equal a neighbour in the order of their words."""

    def same(window: Column, i: Column) -> Column:
        before, after = F.get(ordered, i - 1)["words"], F.get(ordered, i + 1)["words"]
        return before.eqNullSafe(window["words"]) | after.eqNullSafe(window["words"])

    return F.array_sort(F.transform(F.filter(ordered, same), lambda window: window["at"]))


def _covered(starts: Column) -> Column:
    """Words inside the windows that begin at the given places in rising order."""
    new = F.transform(
        starts, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - at, F.lit(WINDOW)))
    )
    return F.aggregate(new, F.lit(0), lambda total, one: total + one)


def repeated_words(words: Column) -> Column:
    """Words inside windows of eight words that occur twice or more in the text.

    Hashes of all windows show the few texts that may repeat one; only those sort and compare
    their windows in full.
    """
    hashes = F.transform(words, lambda word: F.xxhash64(word))
    may_repeat = bound(
        hashes, lambda h: bound(_window_hashes(h), lambda w: F.size(F.array_distinct(w)) < F.size(w))
    )
    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
        lambda at: F.struct(F.array_join(F.slice(words, at, WINDOW), " ").alias("words"), at.alias("at")),
    )
    count = bound(F.array_sort(windows), lambda ordered: bound(_repeat_starts(ordered), _covered))
    return F.when(F.size(words) <= WINDOW, 0).when(may_repeat, count).otherwise(0).cast("long")


def class_counts(text: Column) -> Column:
    """How many characters of each class a text has."""
    rest, lengths = text, [F.length(text)]
    for pattern in CLASSES:
        rest = F.regexp_replace(rest, f"{pattern}+", "")
        lengths.append(F.length(rest))
    counts = [longer - shorter for longer, shorter in zip(lengths, lengths[1:], strict=False)]
    return F.array(*[count.cast("double") for count in [*counts, lengths[-1]]])


def shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return bound(total, lambda t: F.transform(counts, lambda n: F.when(t > 0, n / t).otherwise(F.lit(0.0))))


def distance(mine: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms of shares: 0 if equal, 1 if they share no bin."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(mine, reference, lambda a, b: (part(a, b) + part(b, a)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)))


def common_shares(words: Column, common: Column, known: list[str] | None) -> Column:
    """Shares of the common words among the words, and of all others together.

    ``known``: the common words of all languages, if these are few.
    """
    own = F.transform(common, lambda c: c["word"])
    hits = F.filter(words, lambda word: F.array_contains(own, word) if known is None else word.isin(known))
    counted = bound(
        hits,
        lambda found: F.transform(
            common, lambda c: (F.size(found) - F.size(F.array_remove(found, c["word"]))) / F.size(words)
        ),
    )
    return bound(counted, lambda parts: F.concat(parts, F.array(_rest(parts))))


def _rest(parts: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - F.aggregate(parts, F.lit(0.0), lambda a, b: a + b))


def _with_language(rows: DataFrame, languages: DataFrame, few: bool, how: str, salt: Column) -> DataFrame:
    """Rows with the row of their language, whose key is ``of``; ``salt`` deals the rows of a language."""
    same = F.col("language").eqNullSafe(F.col("of"))
    if few:
        return rows.join(F.broadcast(languages), same, how)
    dealt = languages.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("salt", F.pmod(salt, F.lit(SALTS)).cast("int"))
    # A hint of its own keeps Spark from a broadcast that its estimate of the size allows.
    return salted.join(dealt.hint("merge"), same & (F.col("salt") == F.col("of_salt")), how).drop("salt", "of_salt")


def references(texts: DataFrame) -> DataFrame:
    """The reference of each language that has enough words: class_reference and common.

    ``texts`` has the columns language and text.
    """
    words = texts.select("language", F.explode(F.split("text", WHITE_RUN)).alias("word"))
    counts = store(words.filter(F.col("word") != "").groupBy("language", "word").count(), "word-counts")
    totals = counts.groupBy(F.col("language").alias("of")).agg(F.sum("count").alias("n_words"))
    sums = [F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(len(CLASSES) + 1)]
    classed = texts.select("language", class_counts(F.col("text")).alias("classes")).groupBy("language").agg(*sums)
    languages = store(classed.join(totals, F.col("language").eqNullSafe(F.col("of"))).drop("of"), "languages")
    large = languages.filter(F.col("n_words") >= MIN_LANGUAGE_WORDS)
    few = large.count() <= BROADCAST_LANGUAGES

    # A word holds at least 1 in 2000 words to be common, so at most 2000 a language are ranked.
    frequent = (
        _with_language(counts, large.withColumnRenamed("language", "of"), few, "inner", F.xxhash64("word"))
        .filter((F.col("count") * 2000 >= F.col("n_words")) & F.col("word").rlike(r"\p{L}"))
        .select("language", "word", (F.col("count") / F.col("n_words")).alias("share"))
    )
    rank = F.row_number().over(Window.partitionBy("language").orderBy(F.desc("share"), "word"))
    common = (
        frequent.withColumn("rank", rank)
        .filter(F.col("rank") <= COMMON_WORDS)
        .groupBy(F.col("language").alias("of"))
        .agg(F.array_sort(F.collect_list(F.struct("rank", "word", "share"))).alias("common"))
    )
    classes = F.array(*[F.col(f"c{i}") for i in range(len(CLASSES) + 1)])
    found = large.join(common, F.col("language").eqNullSafe(F.col("of")), "left").select(
        F.col("language").alias("of"), shares(classes).alias("class_reference"), "common"
    )
    known = store(found, "language-references")
    discard(counts, languages)
    return known


def assess(
    documents: DataFrame, *, text: str = "text", language: str = "lang", carry: list[str] | None = None
) -> DataFrame:
    """``row`` (the carried columns, by default all), the counts, both distances, ``base_failed`` and ``kept``."""
    texts = documents.select(F.col(language).alias("language"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = references(texts)
    few = known.count() <= BROADCAST_LANGUAGES
    names = [row[0] for row in known.select(F.explode("common.word")).distinct().collect()] if few else None

    columns = documents.columns if carry is None else carry
    rows = documents.select(
        F.struct(*[F.col(f"`{name}`") for name in columns]).alias("row"),
        F.col(language).alias("language"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).select("row", "language", "text", words_of(F.col("text")).alias("words"))
    measured = (
        _with_language(rows, known, few, "left", F.monotonically_increasing_id())
        .select(
            "row",
            "words",
            "common",
            F.size("words").cast("long").alias("n_words"),
            symbol_count(F.col("text")).alias("n_symbols"),
            duplicate_lines(F.col("text")).alias("n_dup_lines"),
            repeated_words(F.col("words")).alias("n_repeat_words"),
            class_counts(F.col("text")).alias("classes"),
            "class_reference",
        )
        .withColumn("word_chars", F.aggregate(F.slice("classes", 2, len(CLASSES)), F.lit(0.0), lambda a, b: a + b))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")),
        )
    )
    counted = [F.col("n_words"), F.col("word_chars").cast("long").alias("word_chars")]
    counted += [F.col(name) for name in ("n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]
    word_reference = F.concat(
        F.transform("common", lambda c: c["share"]), F.array(_rest(F.transform("common", lambda c: c["share"])))
    )
    far = measured.select(
        "row",
        *counted,
        F.when(
            (F.col("n_words") >= CLASS_LIMIT[0]) & ~F.col("base_failed") & F.col("class_reference").isNotNull(),
            distance(shares(F.col("classes")), F.col("class_reference")),
        ).alias("class_distance"),
        F.when(
            (F.col("n_words") >= WORD_LIMIT[0]) & ~F.col("base_failed") & F.col("common").isNotNull(),
            distance(common_shares(F.col("words"), F.col("common"), names), word_reference),
        ).alias("word_distance"),
    )

    def near(column: str, limit: tuple[int, float, float]) -> Column:
        _, floor, slope = limit
        return F.coalesce(F.col(column) <= floor + slope / F.sqrt("n_words"), F.lit(True))

    verdict = ~F.col("base_failed") & near("class_distance", CLASS_LIMIT) & near("word_distance", WORD_LIMIT)
    return far.withColumn("kept", verdict)


def good_documents(documents: DataFrame, **options) -> DataFrame:
    """The documents that are kept, with their columns."""
    judged = assess(documents, **options)
    # A filter would be pushed below the measures and compute them once per use; it cannot pass a generator.
    kept = judged.select(F.explode(F.array(F.struct("row", "kept"))).alias("one")).filter("one.kept").select("one.row")
    return kept.select(*[F.col("row").getField(name).alias(name) for name in documents.columns])
