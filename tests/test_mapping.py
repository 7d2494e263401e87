import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shopmart.functions.text import quoted_list, utf8_repair
from shopmart.operators import mapping
from shopmart.schemas import CATEGORY_CODES

BRANDS = ["levi's", "a, b", "x'", "'", "plain", "tr%i_cky\\", "марка"]


def reply_frame(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "batch_id long, reply string")


def test_prompt_lists_sorted_quoted_brands(spark):
    batches = spark.createDataFrame([(0, "b"), (0, "levi's"), (0, "a"), (1, "z")], "batch_id long, brand string")
    first, second = mapping.batch_prompts(batches).orderBy("batch_id").collect()
    assert "'a',\n 'b',\n 'levi''s'" in first.prompt and "'z'" in second.prompt
    assert ", ".join(CATEGORY_CODES) in first.prompt


@pytest.mark.parametrize(
    "reply, block, ok",
    [
        ("text ```sql\n\n  VALUES (1)\t\n``` more ```sql\nVALUES (2)```", "VALUES (1)", True),
        ("", "", True),
        (None, "", True),
        ("no block", "", False),
        ("\n", "", False),
        ("```python\nx```", "", False),
        ("```sql VALUES (1)```", "", False),
        ("```sql\nnever closed", "", False),
        ("```sql\n```", "", True),
        ("```sql\n  a\nb  ```", "a\nb", True),
    ],
)
def test_sql_block(spark, reply, block, ok):
    row = mapping.extract_blocks(reply_frame(spark, reply)).first()
    assert (row.sql_text, row.parse_ok) == (block, ok)


def test_strict_reply(spark):
    with pytest.raises(Exception, match="no fenced sql block"):
        mapping.parse_replies(reply_frame(spark, "nothing here"), strict=True).collect()
    assert mapping.parse_replies(reply_frame(spark, "", None), strict=True).isEmpty()


def test_reply_pairs(spark, rows):
    text = "```sql\nINSERT INTO t (brand, category_index) VALUES\n ('valberg', 'electronics'),\n('levi''s','apparel') , ( 'a, b' , 'kids');```"
    expected = [("a, b", "kids"), ("levi's", "apparel"), ("valberg", "electronics")]
    assert rows(mapping.parse_replies(reply_frame(spark, text))) == sorted(expected, key=repr)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="`")), min_size=1, max_size=5))
def test_quoting_round_trip(spark, brands):
    def quote(text):
        return "'" + text.replace("'", "''") + "'"

    text = "```sql\nVALUES " + ",\n".join(f"({quote(b)}, 'kids')" for b in brands) + ";\n```"
    found = mapping.parse_replies(reply_frame(spark, text)).collect()
    assert sorted(row.brand for row in found) == sorted(brands)


def test_ask_and_parse(spark, rows):
    def answer(prompt):
        listed = prompt.split("Brands: ")[1].split("\nReply")[0]
        return "```sql\nVALUES " + ",".join(f"({name}, 'sport')" for name in listed.split(",\n ")) + "```"

    batches = spark.createDataFrame([(n % 3, brand) for n, brand in enumerate(BRANDS)], "batch_id long, brand string")
    for parallel in (None, 2):
        replies = mapping.ask(mapping.batch_prompts(batches), answer, parallel)
        assert rows(mapping.parse_replies(replies, strict=True)) == sorted(((b, "sport") for b in BRANDS), key=repr)


def test_classify_by_dictionary_and_fallback(spark, rows):
    brands = spark.createDataFrame([("acer",), ("zorg",)], "brand string")
    dictionary = spark.createDataFrame(
        [("acer", "computers"), ("acer", "electronics"), ("acer", "computers"), ("other", "kids")],
        "brand string, category_index string",
    )
    found = rows(mapping.classify_brands(brands, dictionary))
    assert found[:2] == [("acer", "computers"), ("acer", "electronics")]
    assert len(found) == 3 and found[2][0] == "zorg" and found[2][1] in CATEGORY_CODES


def test_allowed_codes(spark, rows):
    pairs = spark.createDataFrame([("a", "kids"), ("a", "toys"), ("b", None)], "brand string, category_index string")
    assert rows(mapping.valid_mapping(pairs)) == [("a", "kids")]
    assert rows(mapping.mapping_counts(pairs)) == [(1, 2)]


def test_expanded_mapping_joins_like_the_full_product(spark, rows):
    events = spark.createDataFrame(
        [("a", "auto.x"), ("a", "auto.y"), ("a", "kids.z"), ("b", "auto.x"), ("a", "auto.x"), (None, "auto.x"), ("b", None), ("c", "sport")],
        "brand string, category_code string",
    )
    pairs = spark.createDataFrame([("a", "auto"), ("b", "kids"), ("c", "sport")], "brand string, category_index string")
    found = mapping.expand_mapping(pairs, events)
    assert rows(found) == [("a", "auto.x"), ("a", "auto.y"), ("c", "sport")]
    codes = events.select("category_code").dropna().distinct()
    product = pairs.join(codes, F.split_part("category_code", F.lit("."), F.lit(1)) == F.col("category_index"))
    keys = ["brand", "category_code"]
    assert rows(events.join(found, keys)) == rows(events.join(product.select(*keys), keys))


def test_utf8_repair(spark):
    frame = spark.sql("SELECT CAST(X'61FF62' AS STRING) AS bad, 'ok é' AS good")
    assert tuple(frame.select(utf8_repair(F.col("bad")), utf8_repair(F.col("good"))).first()) == ("a�b", "ok é")


def test_quoted_list_of_one(spark):
    assert spark.range(1).select(quoted_list(F.array(F.lit("o'x")))).first()[0] == "'o''x'"
