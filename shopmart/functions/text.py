"""Null tokens, quoting, prompts, replies and UTF-8 repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from shopmart.schemas import CATEGORY_CODES, NULL_TOKENS

# Fixed value: a reply carries its statement in a fenced block tagged sql.
FENCED_BLOCK = "(?s)```sql\n(.*?)```"

# Fixed value: one ('brand', 'code') pair; an apostrophe inside a value is doubled.
VALUE_PAIR = r"\(\s*'([^']*(?:''[^']*)*)'\s*,\s*'([^']*(?:''[^']*)*)'\s*\)"

# Fixed value: characters stripped around a block (Unicode white space).
WHITE_SPACE = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)

PROMPT_HEAD = (
    "Sort shop brands into product categories.\n"
    "Allowed category codes: {codes}.\n"
    "A brand may belong to several codes. Look up what each brand sells; when nothing is"
    " known about it, choose the codes that fit best.\n"
    "Brands: "
)
PROMPT_TAIL = (
    "\nReply with one fenced sql block that holds an INSERT statement for the columns"
    " brand and category_index, one ('brand', 'code') pair per brand and code.\n"
)


def null_token(value: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Null when the cell is one of the missing-value tokens, else the cell."""
    return F.when(~value.isin(list(tokens)), value)


def quoted(value: Column) -> Column:
    """SQL string literal of a value; apostrophes are doubled."""
    return F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))


def unquoted(value: Column) -> Column:
    return F.replace(value, F.lit("''"), F.lit("'"))


def quoted_list(values: Column) -> Column:
    """The members of an array, sorted, quoted and one per line."""
    return F.array_join(F.transform(F.array_sort(values), quoted), ",\n ")


def prompt(
    brands: Column,
    codes: Sequence[str] = CATEGORY_CODES,
    head: str = PROMPT_HEAD,
    tail: str = PROMPT_TAIL,
) -> Column:
    """Request text for one batch of brands."""
    return F.concat(F.lit(head.replace("{codes}", ", ".join(codes))), quoted_list(brands), F.lit(tail))


def has_sql_block(reply: Column) -> Column:
    """False when a non-empty reply holds no fenced block; an empty reply has nothing to hold."""
    text = F.coalesce(reply, F.lit(""))
    return (text == "") | text.rlike(FENCED_BLOCK)


def sql_block(reply: Column, strict: bool = False) -> Column:
    """Content of the first fenced sql block, stripped; empty for an empty reply.

    Without a block the result is empty, or an error when ``strict``.
    """
    text = F.coalesce(reply, F.lit(""))
    block = F.btrim(F.regexp_extract(text, FENCED_BLOCK, 1), F.lit(WHITE_SPACE))
    if not strict:
        return block
    return F.when(has_sql_block(reply), block).otherwise(
        F.raise_error(F.lit("no fenced sql block in the reply")).cast("string")
    )


def value_pairs(block: Column) -> Column:
    """Array of the ('brand', 'code') texts in a statement; nothing is executed."""
    return F.regexp_extract_all(block, F.lit(VALUE_PAIR), F.lit(0))


def pair_member(pair: Column, position: int) -> Column:
    return unquoted(F.regexp_extract(pair, VALUE_PAIR, position))


def utf8_repair(value: Column) -> Column:
    """Text with every invalid UTF-8 sequence replaced by U+FFFD."""
    return F.make_valid_utf8(value)
