import datetime
import gzip
import io

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopmart.functions.text import null_token
from shopmart.plans import jobs
from shopmart.schemas import EVENT_COLUMNS, NULL_TOKENS
from shopmart.sources.event_files import infer_types, read_events, read_inferred, read_raw_events
from shopmart.sources.registry import Dataset, lookup, monthly_registry, parse_registry, registry_rows
from shopmart.sources.tables import DETAIL, STAGING, Tables

HEADER = ",".join(EVENT_COLUMNS)
LINES = [
    "2019-10-01 00:00:00 UTC,view,44600062,2103807459595387724,,shiseido,35.79,541312140,s-1",
    "2019-10-01 00:00:01.25 UTC,cart,3900821,2053013552326770905,appliances.environment.water_heater,nan,33.2,554748717,s-2",
    '2019-10-01 00:00:02 UTC,purchase,17200506,2053013559792632471,furniture.living_room.sofa,"o""neil, co",543.1,519107250,s-3',
]


@pytest.fixture()
def tables(spark, tmp_path):
    return Tables(spark, str(tmp_path / "warehouse"))


def plain_file(path, lines=LINES, header=HEADER):
    path.write_text("\n".join([header, *lines]) + "\n", encoding="utf-8")
    return str(path)


def gzip_file(path, lines=LINES):
    with gzip.open(path, "wt", encoding="utf-8") as file:
        file.write("\n".join([HEADER, *lines]) + "\n")
    return str(path)


def dataset(url, key="1"):
    return Dataset(key, url, f"events_{key}", f"brands_{key}", f"categories_{key}")


@pytest.mark.parametrize("write", [plain_file, gzip_file])
def test_read_events(spark, tmp_path, write):
    path = write(tmp_path / ("events.csv" if write is plain_file else "events.csv.gz"))
    first, second, third = sorted(read_events(spark, path).collect(), key=lambda row: row.event_time)
    assert first.event_time == datetime.datetime(2019, 10, 1) and first.category_code is None
    assert second.event_time.microsecond == 250000 and second.brand is None
    assert third.brand == 'o"neil, co' and third.category_id == 2053013559792632471 and third.price == 543.1


def test_line_break_in_a_cell(spark, tmp_path):
    line = '2019-10-01 00:00:02 UTC,view,1,2,a.b,"two\nlines",1.0,3,s'
    path = plain_file(tmp_path / "events.csv", [line])
    assert read_events(spark, path, multi_line=True).first().brand == "two\nlines"
    with pytest.raises(Exception, match="MALFORMED|CAST_INVALID|FAILED_READ"):
        read_events(spark, path).collect()


def test_other_header_is_an_error(spark, tmp_path):
    path = plain_file(tmp_path / "events.csv", header=HEADER.replace("brand", "label"))
    with pytest.raises(Exception, match="header"):
        read_events(spark, path).collect()


@pytest.mark.parametrize("ansi, message", [("true", "CAST_INVALID_INPUT"), ("false", "product_id cannot hold many")])
def test_bad_number_is_an_error(spark, tmp_path, session_conf, ansi, message):
    session_conf("spark.sql.ansi.enabled", ansi)
    path = plain_file(tmp_path / "events.csv", [LINES[0].replace("44600062", "many")])
    with pytest.raises(Exception, match=message):
        read_events(spark, path).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_time_is_an_error(spark, tmp_path, session_conf, ansi):
    session_conf("spark.sql.ansi.enabled", ansi)
    path = plain_file(tmp_path / "events.csv", [LINES[0].replace(" UTC", " CET")])
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|event_time cannot hold"):
        read_events(spark, path).collect()


def test_read_inferred(spark, tmp_path):
    frame = read_inferred(spark, gzip_file(tmp_path / "events.csv.gz"))
    types = {field.name: field.dataType.simpleString() for field in frame.schema}
    assert types["product_id"] == "bigint" and types["price"] == "double"
    assert types["event_time"] == types["brand"] == types["user_session"] == "string"
    prices = pd.read_csv(tmp_path / "events.csv.gz")["price"].tolist()
    assert sorted(row.price for row in frame.collect()) == sorted(prices)


def test_null_tokens_equal_pandas(spark):
    cells = [*NULL_TOKENS, "none", "Nan", " ", "NA ", "0", "x"]
    csv = "n,cell\n" + "".join(f'{i},"{cell}"\n' for i, cell in enumerate(cells))
    expected = pd.read_csv(io.StringIO(csv))["cell"].isna().tolist()
    frame = spark.createDataFrame(list(enumerate(cells)), "n int, cell string")
    found = frame.select("n", null_token(F.col("cell")).isNull().alias("missing")).orderBy("n").collect()
    assert [row.missing for row in found] == expected


@pytest.mark.parametrize(
    "cells",
    [
        ["1", "2"],
        ["1", ""],
        ["1.5", "2"],
        ["+5", " 7"],
        ["1e5", "2"],
        ["inf", "-Infinity"],
        [" inf", "1"],
        ["True", "false"],
        ["18446744073709551615", "1"],
        ["18446744073709551615", "-1"],
        ["18446744073709551615", ""],
        ["18446744073709551615", "1.5"],
        ["-9223372036854775808", "9223372036854775807"],
        ["-9223372036854775809", "1"],
        ["123456789012345678901234567890", "1"],
        [".5", "5."],
        ["", "NA"],
        ["0x10", "1"],
        ["1.0f", "2"],
        ["1d", "2"],
        ["00123", "4"],
        ["1e400", "1"],
        ["- 5", "1"],
        ["1e", "3"],
        ["2019-10-01 00:00:00 UTC", "2019-10-01 00:00:00 UTC"],
    ],
)
def test_inferred_type_equals_pandas(spark, cells):
    kind = pd.read_csv(io.StringIO("c,d\n" + "".join(f'"{cell}",x\n' for cell in cells)))["c"].dtype.kind
    expected = {"i": "BIGINT", "u": "BIGINT", "f": "FLOAT"}.get(kind, "TEXT")
    frame = spark.createDataFrame([(cell or None, "x") for cell in cells], "c string, d string")
    assert [row.column_type for row in infer_types(frame).orderBy("position").collect()] == [expected, "TEXT"]


def test_inference_sees_every_row(spark):
    """A single odd cell decides, wherever it lies."""
    frame = spark.range(200_000).select(F.when(F.col("id") == 199_999, "x").otherwise(F.col("id").cast("string")).alias("c"))
    assert infer_types(frame).first().column_type == "TEXT"


def test_odd_header_names(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text("user.id,a`b,plain name\n1,x,2.5\n2,,NA\n", encoding="utf-8")
    frame = read_inferred(spark, str(path))
    assert [tuple(row) for row in frame.collect()] == [(1, "x", 2.5), (2, None, None)]
    assert frame.columns == ["user.id", "a`b", "plain name"]


def test_registry():
    months = monthly_registry("/landing/")
    assert list(months) == list("1234567")
    assert months["1"].dataset_url == "/landing/2019-Oct.csv.gz" and months["7"].table_name == "eCommerce_Apr"
    with pytest.raises(ValueError, match="not registered"):
        lookup(months, "8")
    partial = parse_registry('{"1": {"dataset_url": "", "table_name": "t"}}')
    with pytest.raises(ValueError, match="dataset_url"):
        lookup(partial, "1")
    assert lookup(partial, "1", ("table_name",)).table_name == "t"


def test_registry_names_are_unique():
    months = monthly_registry("/landing", months=30)
    for kind in ("table_name", "brands_table_name", "categories_table_name"):
        assert len({getattr(dataset, kind) for dataset in months.values()}) == 30
    with pytest.raises(ValueError, match="share the table"):
        parse_registry('{"1": {"dataset_url": "a", "table_name": "t"}, "2": {"dataset_url": "b", "table_name": "T"}}')


def test_registry_rows(spark):
    text = '{"1": {"dataset_url": "u", "table_name": "t"}, "2": {"dataset_url": "u", "table_name": ""}}'
    found = registry_rows(spark.createDataFrame([(text,)], "text string"), F.col("text")).orderBy("key").collect()
    assert [(row.key, row.is_valid, row.brands_table_name) for row in found] == [("1", True, None), ("2", False, None)]


def test_sinks(tables, rows):
    one, two = (tables.spark.createDataFrame([(value, value)], "k string, v string") for value in ("a", "b"))
    tables.save_if_absent(one, DETAIL, "kept")
    tables.save_if_absent(two, DETAIL, "kept")
    assert rows(tables.read(DETAIL, "kept")) == [("a", "a")]
    tables.save_new(one, DETAIL, "strict")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.save_new(two, DETAIL, "strict")
    tables.append(two, DETAIL, "strict")
    assert rows(tables.read(DETAIL, "strict")) == [("a", "a"), ("b", "b")]
    tables.replace(two, DETAIL, "kept")
    assert rows(tables.read(DETAIL, "kept")) == [("b", "b")]
    broken = two.withColumn("v", F.raise_error(F.col("v")).cast("string"))
    with pytest.raises(Exception, match="b"):
        tables.replace(broken, DETAIL, "kept")
    assert rows(tables.read(DETAIL, "kept")) == [("b", "b")]
    for gather in (False, True, True):
        tables.replace_partitions(one.union(two), DETAIL, "parts", "k", gather=gather)
    changed = one.withColumn("v", F.lit("new"))
    tables.replace_partitions(changed, DETAIL, "parts", "k")
    assert rows(tables.read(DETAIL, "parts").select("k", "v")) == [("a", "new"), ("b", "b")]


@pytest.mark.parametrize("times", [0, 1, 2])
@pytest.mark.parametrize("step", ["write", "mark", "drop"])
def test_a_replacement_that_breaks_leaves_a_whole_table(tables, rows, monkeypatch, step, times):
    """Whatever step fails, readers see all old rows or, once the version is marked, all new ones."""
    frames = [tables.spark.range(n * 10, n * 10 + 3).selectExpr("cast(id AS string) AS k") for n in range(5)]
    tables.save_new(frames[0], DETAIL, "broken")
    for n in range(times):
        tables.replace(frames[n + 1], DETAIL, "broken")
    old, new = rows(tables.read(DETAIL, "broken")), frames[4]

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        if step == "write":
            new = new.withColumn("k", F.raise_error(F.lit("lost")).cast("string"))
        elif step == "mark":
            patch.setattr(Tables, "versions", lambda *_: patch.undo() or fail())
        else:
            patch.setattr(Tables, "_drop", fail)
        if step == "drop" and not times:  # nothing to drop at the first replacement
            tables.replace(new, DETAIL, "broken")
        else:
            with pytest.raises(Exception, match="lost"):
                tables.replace(new, DETAIL, "broken")
    marked = step == "drop"
    assert rows(tables.read(DETAIL, "broken")) == (rows(frames[4]) if marked else old)
    tables.replace(frames[3], DETAIL, "broken")
    assert rows(tables.read(DETAIL, "broken")) == rows(frames[3])


def test_readers_keep_the_version_they_began_with(tables, rows):
    """A table read before a replacement still gives its rows after it; only the last two versions are kept."""
    frames = [tables.spark.createDataFrame([(str(n),)], "k string") for n in range(4)]
    for n, frame in enumerate(frames):
        before = tables.read(DETAIL, "read") if n else None
        tables.replace(frame, DETAIL, "read")
        assert before is None or rows(before) == [(str(n - 1),)]
        assert len(tables.versions(DETAIL, "read")) == min(n + 1, 2)
    own = tables.read(DETAIL, "read").selectExpr("concat(k, '!') AS k")
    tables.replace(own, DETAIL, "read")
    tables.append(frames[0], DETAIL, "read")
    assert rows(tables.read(DETAIL, "read")) == [("0",), ("3!",)]


def test_sql_reads_the_new_version(tables):
    tables.save_new(tables.spark.range(2), DETAIL, "named")
    tables.register(DETAIL, "named")
    tables.replace(tables.spark.range(5), DETAIL, "named")
    assert tables.spark.sql(f"SELECT count(*) AS n FROM {DETAIL}.named").first().n == 5
    tables.spark.sql(f"DROP TABLE {DETAIL}.named")


def test_create_if_absent(tables):
    assert not tables.exists(DETAIL, "unique_brands")
    tables.create_if_absent(DETAIL, "unique_brands", "brand string")
    assert tables.exists(DETAIL, "unique_brands") and tables.read(DETAIL, "unique_brands").count() == 0


def test_load_counts_and_rerun(spark, tmp_path, tables):
    source = dataset(gzip_file(tmp_path / "events.csv.gz"))
    for _ in range(2):
        assert jobs.load_dataset(tables, source) == jobs.LoadMetrics(3, 1, 1)
        assert jobs.staging_events(tables, "1").count() == 1


def test_load_then_clean(spark, tmp_path, tables, rows):
    source = dataset(gzip_file(tmp_path / "events.csv.gz"))
    assert jobs.load_dataset(tables, source, clean=False) == jobs.LoadMetrics(rows=3)
    assert jobs.staging_events(tables, "1", jobs.RAW).count() == 3
    for _ in range(2):
        assert jobs.clean_dataset(tables, "1") == jobs.LoadMetrics(3, 1, 1)
    separate = rows(jobs.staging_events(tables))
    jobs.load_dataset(tables, source)
    assert rows(jobs.staging_events(tables)) == separate and len(separate) == 1


def test_datasets_side_by_side(spark, tmp_path, tables):
    sources = [
        dataset(gzip_file(tmp_path / "a.csv.gz"), "1"),
        dataset(plain_file(tmp_path / "b.csv", []), "2"),
        dataset(plain_file(tmp_path / "c.csv", LINES[1:]), "3"),
    ]
    found = jobs.load_datasets(tables, sources)
    assert found == {"1": jobs.LoadMetrics(3, 1, 1), "2": jobs.LoadMetrics(), "3": jobs.LoadMetrics(2, 1, 0)}
    assert sorted(row.dataset_key for row in jobs.staging_events(tables).collect()) == ["1", "3"]


def test_header_only_file_stores_nothing(spark, tmp_path, tables):
    assert jobs.load_dataset(tables, dataset(plain_file(tmp_path / "empty.csv", []))) == jobs.LoadMetrics()
    assert not tables.exists(STAGING, jobs.EVENTS)


@pytest.mark.parametrize("together", [False, True])
def test_reload_of_a_file_without_rows_empties_the_dataset(spark, tmp_path, tables, together):
    sources = [dataset(plain_file(tmp_path / f"{key}.csv"), key) for key in ("1", "2")]
    jobs.load_datasets(tables, sources)
    plain_file(tmp_path / "1.csv", [])
    jobs.load_datasets(tables, sources if together else sources[:1])
    assert {row.dataset_key for row in jobs.staging_events(tables).collect()} == {"2"}


def test_raw_cells_stay_text(spark, tmp_path):
    raw = read_raw_events(spark, plain_file(tmp_path / "events.csv"))
    assert {field.dataType.simpleString() for field in raw.schema} == {"string"}
