"""Exact duplicates by content sort.

Sampled splitters deal the rows out by a sort key made of the first characters of the
normalised text and its digest; an external sort by that key and the whole text puts equal texts
next to each other, and a window over neighbours compares them in full. The splitters hold the
short key instead of whole texts, so sampling them brings no long text to the driver.

A text with a great many copies would fill one range. Digests of such texts are counted first
(map-side combined, 40 bytes a row) and their rows get one of several salts in the sort key; the
salted parts are then joined by comparing one row of each part in full. There are at most
``4 * shuffle partitions`` such digests, because each holds that share of all rows, so their
list is broadcast.

Defined cases: null text counts as empty, and empty texts equal each other; of rows that tie on
the identifier one is kept; a null identifier loses against any other; an empty table gives no
rows. Input columns of any name are carried in one struct and cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopmart.llm.storage import shuffle_partitions, store

PREFIX_CHARS = 16
#: A digest with more than 1 / (SHARES * shuffle partitions) of all rows is salted.
SHARES = 4


def mark_copies(
    documents: DataFrame,
    *,
    identifier: str = "doc_id",
    text: Column | None = None,
    keep: str = "min",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per input row: ``id``, ``keep_id``, ``group_size``, ``kept``, ``sha256`` and the struct ``row`` of carried columns.

    ``text`` is the normalised text and defaults to the column ``text``; ``keep`` is "min" or "max".
    """
    raw = F.col("text") if text is None else text
    # Text that is compared as it is travels once, as the content; the flag tells null from empty.
    once = text is None and "text" in carry
    others = [name for name in carry if not (once and name == "text")]
    carried = F.struct(*[F.col(f"`{name}`") for name in others]) if others else F.lit(None).cast("string")
    rows = documents.select(
        F.col(identifier).alias("id"),
        F.coalesce(raw, F.lit("")).alias("content"),
        raw.isNull().alias("missing"),
        carried.alias("row"),
    ).withColumn("sha256", F.sha2(F.col("content").cast("binary"), 256))

    partitions = shuffle_partitions(documents)
    counts = store(rows.groupBy("sha256").agg(F.count(F.lit(1)).alias("copies")), "digest-counts")
    total = counts.agg(F.sum("copies")).first()[0] or 0
    share = max(2, total // (SHARES * partitions))
    frequent = counts.filter(F.col("copies") > share).select(
        "sha256", F.ceil(F.col("copies") / share).cast("int").alias("salts")
    )
    dealt = (
        rows.join(F.broadcast(frequent), "sha256", "left")
        .withColumn("prefix", F.substring("content", 1, PREFIX_CHARS))
        .withColumn("digest", F.substring("sha256", 1, 16))
        .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"), F.lit(-1)))
        .drop("salts")
    )

    key = ["prefix", "digest", "salt"]
    better = F.col("id").asc_nulls_last() if keep == "min" else F.col("id").desc_nulls_last()
    best = F.min if keep == "min" else F.max
    neighbours = Window.partitionBy(*key, "content")
    marked = (
        dealt.repartitionByRange(*key)
        .sortWithinPartitions(*key, "content", better)
        .select(
            "id",
            "sha256",
            "salt",
            "missing",
            "row",
            F.row_number().over(neighbours.orderBy(better)).alias("place"),
            best("id").over(neighbours).alias("best"),
            F.count(F.lit(1)).over(neighbours).alias("copies"),
            "content",
        )
    )
    first_of_part = (F.col("salt") >= 0) & (F.col("place") == 1)
    if not once:
        marked = marked.withColumn("content", F.when(first_of_part, F.col("content")))
    marked = store(marked, "marked-copies")

    whole = (
        marked.filter(first_of_part)
        .groupBy("content")
        .agg(best("best").alias("all_best"), F.sum("copies").alias("all_copies"), F.first("sha256").alias("sha256"))
        .drop("content")
    )
    keep_id = F.when(F.col("all_copies").isNull(), F.col("best")).otherwise(F.col("all_best"))
    # Equal identifiers share a salt, so the first row of a part that has the best identifier is one of a kind,
    # unless no row of the group has an identifier: those share a salt as well.
    fields = {name: F.col("row").getField(name) for name in others}
    if once:
        fields["text"] = F.when(~F.col("missing"), F.col("content"))
    full_row = F.struct(*[fields[name].alias(name) for name in carry]) if carry else F.col("row")
    return marked.join(F.broadcast(whole), "sha256", "left").select(
        "id",
        keep_id.alias("keep_id"),
        F.coalesce("all_copies", "copies").alias("group_size"),
        ((F.col("place") == 1) & F.col("id").eqNullSafe(keep_id)).alias("kept"),
        "sha256",
        full_row.alias("row"),
    )


def distinct_documents(documents: DataFrame, **options) -> DataFrame:
    """The rows that stay, with the columns of ``documents``."""
    marked = mark_copies(documents, carry=documents.columns, **options)
    return marked.filter("kept").select(*[F.col("row").getField(name).alias(name) for name in documents.columns])
