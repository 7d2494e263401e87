import datetime
import gzip
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shopmart.plans import jobs
from shopmart.schemas import EVENT_COLUMNS, HOLIDAY_SCHEMA, STORED_EVENT_SCHEMA
from shopmart.session import scratch_path, scratch_root
from shopmart.sources import event_files
from shopmart.sources.registry import Dataset, monthly_registry
from shopmart.sources.tables import DETAIL, MART, STAGING, Tables
from shopmart.streaming.incremental import incremental_load, load_into_staging


def write_events(path, rows):
    """rows: (time, type, product, category, brand, session)"""
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [",".join(EVENT_COLUMNS)]
    lines += [f"{t} UTC,{kind},{product},9,{code},{brand},1.5,7,{session}" for t, kind, product, code, brand, session in rows]
    with gzip.open(path, "wt", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")
    return str(path)


OCTOBER = [
    ("2019-10-01 08:00:00", "cart", 1, "auto.tyre", "acme", "s1"),
    ("2019-10-01 09:00:00", "purchase", 1, "auto.tyre", "acme", "s1"),
    ("2019-10-02 09:00:00", "cart", 2, "kids.toy", "acme", "s1"),
    ("2019-10-02 09:00:00", "view", 2, "", "acme", "s1"),
    ("2019-10-02 09:00:00", "view", 2, "kids.toy", "", "s1"),
]
NOVEMBER = [
    ("2019-11-22 08:00:00", "cart", 3, "kids.toy", "o'neil", "s2"),
    ("2019-11-22 09:00:00", "purchase", 3, "kids.toy", "o'neil", "s2"),
    ("2019-11-23 09:00:00", "cart", 1, "auto.tyre", "acme", "s3"),
]


@pytest.fixture()
def store(spark, tmp_path):
    registry = {
        key: Dataset(key, write_events(tmp_path / f"{month}.csv.gz", rows), f"e_{month}", f"b_{month}", f"c_{month}")
        for key, month, rows in (("1", "oct", OCTOBER), ("2", "nov", NOVEMBER))
    }
    return Tables(spark, str(tmp_path / "warehouse")), registry


@pytest.fixture()
def holidays(spark):
    day = datetime.date(2019, 11, 22)
    row = ("Black Friday", day, datetime.date(2019, 11, 29), day)
    return spark.createDataFrame([row], HOLIDAY_SCHEMA)


@pytest.fixture()
def dictionary(spark):
    rows = [("acme", "auto"), ("o'neil", "kids"), ("acme", "no such code")]
    return spark.createDataFrame(rows, "brand string, category_index string")


def state(tables, rows):
    names = [
        (DETAIL, "unique_brands"),
        (DETAIL, "unique_categories"),
        (DETAIL, "brand_category_mapping"),
        (DETAIL, "brand_category_mapping_final"),
        (DETAIL, "final_table"),
        (MART, "conversion_rates_holidays"),
        (MART, "categories_conversion_rates"),
        (MART, "black_friday_sales"),
    ]
    return {name: rows(tables.read(layer, name)) for layer, name in names}


def test_build_all_and_rerun(store, holidays, dictionary, rows):
    tables, registry = store
    metrics = jobs.build_all(tables, registry, holidays, dictionary)
    assert metrics == {"1": jobs.LoadMetrics(5, 1, 1), "2": jobs.LoadMetrics(3, 0, 0)}
    first = state(tables, rows)
    assert sorted(first["unique_brands"]) == [("acme",), ("o'neil",)]
    assert sorted(first["unique_categories"]) == [("auto.tyre",), ("kids.toy",)]
    assert sorted(first["brand_category_mapping"]) == [("acme", "auto"), ("o'neil", "kids")]
    assert sorted(first["brand_category_mapping_final"]) == [("acme", "auto.tyre"), ("o'neil", "kids.toy")]
    assert len(first["final_table"]) == 5
    assert [tuple(map(float, row)) for row in first["conversion_rates_holidays"]] == [(0.5, 1.0)]
    assert [row[0] for row in first["black_friday_sales"]] == [1]
    assert jobs.build_all(tables, registry, holidays, dictionary) == {}
    assert state(tables, rows) == first


def test_sql_over_the_registered_tables(spark, store, holidays, dictionary):
    tables, registry = store
    jobs.build_all(tables, registry, holidays, dictionary)
    for _ in range(2):
        jobs.register_all(tables)
    found = spark.sql("SELECT dataset_key, count(*) AS n FROM dds.final_table GROUP BY 1 ORDER BY 1").collect()
    assert [tuple(row) for row in found] == [("1", 2), ("2", 3)]
    joined = spark.sql("SELECT count(*) FROM dds_stg.events st JOIN dds.unique_brands b ON b.brand = st.brand").first()
    assert joined[0] == 6 and spark.table("dm.black_friday_sales").count() == 1
    assert tables.read(DETAIL, "final_table").count() == 5


def test_marts_can_refuse_to_replace(store, holidays, dictionary):
    tables, registry = store
    jobs.build_all(tables, registry, holidays, dictionary)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        jobs.build_marts(tables, holidays, keep_existing=True)


def test_merge_counts(store):
    tables, registry = store
    for dataset in registry.values():
        jobs.load_dataset(tables, dataset)
        jobs.extract_dimensions(tables, dataset)
    counts = [jobs.merge_unique(tables, [dataset], "brand") for dataset in registry.values()]
    assert counts == [
        {"source_count": 1, "target_before": 0, "inserted": 1, "target_after": 1},
        {"source_count": 2, "target_before": 1, "inserted": 1, "target_after": 2},
    ]
    assert jobs.merge_unique(tables, [registry["2"]], "brand")["inserted"] == 0
    assert tables.read(DETAIL, "unique_brands").count() == 2
    together = {"source_count": 2, "target_before": 0, "inserted": 2, "target_after": 2}
    assert jobs.merge_unique(tables, list(registry.values()), "category_code") == together


def test_existing_dimensions_can_be_kept(store, rows):
    tables, registry = store
    october, november = registry["1"], registry["2"]
    jobs.load_dataset(tables, october)
    jobs.extract_dimensions(tables, october)
    write = Dataset("1", november.dataset_url, *[getattr(october, n) for n in ("table_name", "brands_table_name", "categories_table_name")])
    jobs.load_dataset(tables, write)
    jobs.extract_dimensions(tables, write, keep_existing=True)
    assert rows(jobs.dimension(tables, "brand", october)) == [("acme",)]
    jobs.extract_dimensions(tables, write)
    assert jobs.dimension(tables, "brand", october).count() == 2


def test_one_dataset_at_a_time(store, dictionary):
    tables, registry = store
    jobs.load_all(tables, registry)
    jobs.map_brands(tables, dictionary)
    jobs.expand_mapping(tables)
    for key in ("1", "2", "2"):
        jobs.insert_cleaned(tables, key)
    assert tables.read(DETAIL, "final_table").count() == 5


@pytest.mark.parametrize("one", ["1", None])
def test_rerun_without_rows_empties_the_partition(store, tmp_path, dictionary, one):
    tables, registry = store
    jobs.load_all(tables, registry)
    jobs.map_brands(tables, dictionary)
    jobs.expand_mapping(tables)
    jobs.insert_cleaned(tables)
    write_events(tmp_path / "oct.csv.gz", OCTOBER[3:])
    assert jobs.load_dataset(tables, registry["1"]) == jobs.LoadMetrics(2, 1, 1)
    assert {row.dataset_key for row in jobs.staging_events(tables).collect()} == {"2"}
    jobs.insert_cleaned(tables, one)
    final = tables.read(DETAIL, "final_table", STORED_EVENT_SCHEMA)
    assert {row.dataset_key for row in final.collect()} == {"2"}


def test_mapping_by_a_model_asks_once_per_brand(store, rows):
    tables, registry = store
    jobs.load_all(tables, registry)

    def answer(prompt):
        listed = prompt.split("Brands: ")[1].split("\nReply")[0].split(",\n ")
        return "```sql\nVALUES " + ",".join(f"({name}, 'kids'), ({name}, 'cars')" for name in listed) + ";```"

    jobs.map_brands(tables, answer=answer, size=1)
    expected = [("acme", "kids"), ("o'neil", "kids")]
    assert sorted(tuple(row) for row in tables.read(DETAIL, "brand_category_mapping").collect()) == expected

    def refuse(prompt):
        raise AssertionError("asked again")

    jobs.map_brands(tables, answer=refuse)
    assert sorted(tuple(row) for row in tables.read(DETAIL, "brand_category_mapping").collect()) == expected
    with pytest.raises(ValueError, match="dictionary"):
        jobs.map_brands(tables)


def test_bad_reply_keeps_the_good_ones(store):
    tables, registry = store
    jobs.load_all(tables, registry)

    def answer(prompt):
        return "```sql\nVALUES ('acme', 'auto')```" if "'acme'" in prompt else "I do not know."

    with pytest.raises(ValueError, match="1 replies"):
        jobs.map_brands(tables, answer=answer, size=1)
    assert [tuple(row) for row in tables.read(DETAIL, "brand_category_mapping").collect()] == [("acme", "auto")]
    jobs.map_brands(tables, answer=lambda prompt: "```sql\nVALUES ('o''neil', 'kids')```")
    assert tables.read(DETAIL, "brand_category_mapping").count() == 2


def test_only_answers_for_asked_brands_are_stored(store, rows):
    tables, registry = store
    jobs.load_all(tables, registry)
    reply = "```sql\nVALUES ('acme', 'kids'), ('acme', 'kids'), ('stranger', 'kids'), ('o''neil', 'cars');```"
    report = jobs.map_brands(tables, answer=lambda prompt: reply, size=1)
    assert rows(tables.read(DETAIL, "brand_category_mapping")) == [("acme", "kids")]
    assert rows(tables.read(DETAIL, "brand_mapping_rejects").drop("run")) == [("o'neil", "cars")]
    assert report == jobs.MappingReport(brands=2, accepted_pairs=1, rejected_pairs=1, unmapped_brands=1)


def test_thirteen_months_keep_every_brand(spark, tmp_path):
    registry = monthly_registry(str(tmp_path), months=13)
    for number, dataset in enumerate(registry.values()):
        row = ("2019-10-01 08:00:00", "cart", 1, "auto.tyre", f"brand{number}", "s")
        write_events(Path(dataset.dataset_url), [row, row])
    tables = Tables(spark, str(tmp_path / "warehouse"))
    jobs.load_all(tables, registry)
    assert tables.read(DETAIL, "unique_brands").count() == 13
    assert jobs.staging_events(tables).count() == 26


def test_a_bad_file_keeps_only_its_own_dataset_out(store, tmp_path):
    tables, registry = store
    write_events(tmp_path / "oct.csv.gz", [("no time", "cart", 1, "auto.tyre", "acme", "s1")])
    with pytest.raises(ValueError, match="not loaded: 1"):
        jobs.load_all(tables, registry)
    assert {row.dataset_key for row in jobs.staging_events(tables).collect()} == {"2"}
    assert jobs.finished(tables, "load") == {"2"}


def test_datasets_that_share_a_table_are_refused(store):
    tables, registry = store
    shared = {key: Dataset(key, one.dataset_url, f"e{key}", "brands", f"c{key}") for key, one in registry.items()}
    with pytest.raises(ValueError, match="share the table 'brands'"):
        jobs.load_all(tables, shared)


def test_unregistered_fields_stop_the_load(store):
    tables, registry = store
    broken = {"1": Dataset("1", registry["1"].dataset_url, "t", "", "c")}
    with pytest.raises(ValueError, match="brands_table_name"):
        jobs.load_all(tables, broken)


@pytest.mark.parametrize("files_per_trigger", [None, 1])
def test_stream_takes_each_file_once(spark, tmp_path, files_per_trigger):
    landing = tmp_path / "landing"
    paths = str(landing), str(tmp_path / "target"), str(tmp_path / "checkpoint")
    options = {"clean": True, "files_per_trigger": files_per_trigger}
    write_events(landing / "dataset_key=1" / "a.csv.gz", OCTOBER)
    write_events(landing / "dataset_key=1" / "b.csv.gz", OCTOBER[:1])
    assert incremental_load(spark, *paths, **options).count() == 4
    assert incremental_load(spark, *paths, **options).count() == 4
    write_events(landing / "dataset_key=2" / "a.csv.gz", NOVEMBER)
    write_events(landing / "dataset_key=1" / "c.csv.gz", OCTOBER[1:2])
    loaded = incremental_load(spark, *paths, **options)
    assert {row.dataset_key: row["count"] for row in loaded.groupBy("dataset_key").count().collect()} == {"1": 5, "2": 3}
    assert loaded.select("load_id").distinct().count() == (4 if files_per_trigger else 2)


def test_repeated_batch_is_stored_once(spark, tmp_path):
    """A batch that stored its rows but lost its commit runs again under the same id."""
    landing, target, checkpoint = tmp_path / "landing", tmp_path / "target", tmp_path / "checkpoint"
    write_events(landing / "dataset_key=1" / "a.csv.gz", OCTOBER)
    incremental_load(spark, str(landing), str(target), str(checkpoint))
    for commit in (checkpoint / "commits").glob("*0*"):
        commit.unlink()
    again = incremental_load(spark, str(landing), str(target), str(checkpoint))
    assert again.count() == 5


@pytest.mark.parametrize("step", ["stage", "extract_dimensions", "merge_unique", "finish"])
def test_stream_into_staging_breaks_off_and_goes_on(spark, tmp_path, rows, monkeypatch, step):
    """A batch that fails after any step is repeated: no row, pair, key or unique key is doubled or lost."""
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    tables = Tables(spark, str(tmp_path / "warehouse"))
    write_events(landing / "dataset_key=1" / "a.csv.gz", OCTOBER)
    assert load_into_staging(tables, str(landing), checkpoint) == ["1"]
    assert load_into_staging(tables, str(landing), checkpoint) == []
    write_events(landing / "dataset_key=1" / "b.csv.gz", OCTOBER[:1])
    write_events(landing / "dataset_key=2" / "a.csv.gz", NOVEMBER)
    whole = getattr(jobs, step)

    def breaks(*args, **options):
        whole(*args, **options)
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, step, breaks)
        with pytest.raises(Exception, match="lost"):
            load_into_staging(tables, str(landing), checkpoint)
    assert load_into_staging(tables, str(landing), checkpoint) == ["1", "2"]

    plain = Tables(spark, str(tmp_path / "plain"))
    registry = {k: Dataset(k, str(landing / f"dataset_key={k}"), f"t{k}", f"b{k}", f"c{k}") for k in ("1", "2")}
    jobs.load_all(plain, registry)
    for key in registry:
        for column in jobs.DIMENSIONS:
            found, wanted = (jobs.dimension(t, column, registry[key]) for t in (tables, plain))
            assert rows(found) == rows(wanted)
        assert rows(jobs.staging_events(tables, key)) == rows(jobs.staging_events(plain, key))
    assert rows(jobs.staged_pairs(tables)) == rows(jobs.staged_pairs(plain))
    for column, name in jobs.UNIQUE.items():
        assert rows(tables.read(DETAIL, name)) == rows(plain.read(DETAIL, name))
    assert jobs.load_all(tables, registry) == {}  # the ledger has them


def test_no_file_yet_stages_nothing(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    tables = Tables(spark, str(tmp_path / "warehouse"))
    assert load_into_staging(tables, str(tmp_path / "landing"), str(tmp_path / "checkpoint")) == []


def test_files_of_a_dataset_hold_spans_of_time(spark, tmp_path):
    """Stored by time, the events of a few days lie in the files of these days, also if one moment has most rows."""
    tables = Tables(spark, str(tmp_path / "warehouse"))
    events = spark.range(20_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN timestamp_ntz'2019-11-29 00:00:00'"
        " ELSE timestampadd(MINUTE, CAST(id % 40000 AS INT), timestamp_ntz'2019-11-01 00:00:00') END AS event_time",
        "'view' AS event_type", "id AS product_id", "id AS category_id", "'a.b' AS category_code", "'x' AS brand",
        "CAST(1 AS double) AS price", "id AS user_id", "CAST(id AS string) AS user_session", "'1' AS dataset_key",
    )
    wanted = [F.col(f.name).cast(f.dataType).alias(f.name) for f in jobs.STORED_EVENT_SCHEMA]
    jobs.store_events(tables, events.select(*wanted).repartition(4), STAGING, jobs.EVENTS, ["1"])
    jobs.stage(tables, ["1"])
    tables.save_new(spark.createDataFrame([("x", "a.b")], jobs.PAIR_SCHEMA), DETAIL, jobs.FINAL_MAPPING)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert jobs.insert_cleaned(tables, by_time=True) == ["1"]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    final = tables.read(DETAIL, jobs.FINAL, jobs.STORED_EVENT_SCHEMA)
    assert final.count() == 20_000
    spans = final.groupBy(F.input_file_name().alias("file")).agg(
        F.min("event_time").alias("first"), F.max("event_time").alias("last"), F.count("*").alias("rows")
    )
    spans = sorted((r["first"], r["last"], r["rows"]) for r in spans.collect())
    assert len(spans) > 3 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert max(r for *_, r in spans) < 8_000  # the moment with a third of all rows is cut as well


def test_scratch_folder(spark):
    root = scratch_root(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert root == (configured.rstrip("/") if configured else root)
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(root + "/")


def test_staging_prunes_partitions(store, plan):
    tables, registry = store
    jobs.load_all(tables, registry)
    text = plan(jobs.staging_events(tables, "1").select(F.count("*")))
    assert "PartitionFilters: [isnotnull(dataset_key" in text


def files_of(tables, layer, name):
    return {str(path): path.stat().st_mtime_ns for path in Path(tables.path(layer, name)).rglob("*.parquet")}


def many_datasets(tmp_path, count, rows=lambda number: [("2019-10-01 08:00:00", "cart", 1, "auto.tyre", f"b{number}", "s")]):
    registry = {}
    for number in range(count):
        path = write_events(tmp_path / "many" / f"day {number}.csv.gz", rows(number))
        registry[str(number)] = Dataset(str(number), path, f"e{number}", f"b{number}", f"c{number}")
    return registry


def test_many_files_are_one_scan(spark, tmp_path, plan):
    """The plan does not grow with the datasets, nor does the time in proportion."""
    registry = many_datasets(tmp_path, 120)
    seconds, plans = [], []
    for count in (4, 4, 120):
        tables = Tables(spark, str(tmp_path / f"warehouse{count}{len(seconds)}"))
        chosen = dict(list(registry.items())[:count])
        urls = {key: dataset.dataset_url for key, dataset in chosen.items()}
        plans.append(plan(event_files.read_dataset_events(spark, urls)))
        started = time.perf_counter()
        metrics = jobs.load_all(tables, chosen)
        seconds.append(time.perf_counter() - started)
        assert metrics == {key: jobs.LoadMetrics(1) for key in chosen}
        assert jobs.staging_events(tables).select("dataset_key").distinct().count() == count
        assert tables.read(DETAIL, "unique_brands").count() == count
    assert plans[2].count("\n(1) Scan csv") == 1 and plans[2].count("Scan csv") == 2 and "Union" not in plans[2]
    assert len(plans[2].splitlines()) == len(plans[0].splitlines())
    assert seconds[2] < 6 * seconds[1]


def test_rows_get_the_dataset_of_their_file(spark, tmp_path, rows):
    """Folders, patterns, odd names, and a file that two datasets share."""
    for name in ("in a/x 1.csv.gz", "in a/y%20.csv.gz", "b/z[1].csv.gz", "b/w.csv.gz"):
        write_events(tmp_path / name, [("2019-10-01 08:00:00", "cart", 1, "auto.tyre", name[-8:-7], "s")])
    urls = {"folder": f"{tmp_path}/in a", "pattern": f"{tmp_path}/b/*.csv.gz", "same": f"{tmp_path}/b/*.csv.gz", "one": f"{tmp_path}/b/w.csv.gz"}
    found = event_files.read_dataset_events(spark, dict(list(urls.items())[:3])).groupBy("dataset_key").count()
    assert sorted(rows(found)) == [("folder", 2), ("pattern", 2), ("same", 2)]
    overlapping = {key: urls[key] for key in ("folder", "one")}
    found = event_files.read_dataset_events(spark, overlapping).groupBy("dataset_key").count()
    assert sorted(rows(found)) == [("folder", 2), ("one", 1)]


def test_a_bad_file_among_many_costs_few_loads(spark, tmp_path, monkeypatch):
    bad = [("no time", "cart", 1, "auto.tyre", "x", "s")]
    good = [("2019-10-01 08:00:00", "cart", 1, "auto.tyre", "x", "s")]
    registry = many_datasets(tmp_path, 16, lambda number: bad if number == 5 else good)
    tables, loads = Tables(spark, str(tmp_path / "warehouse")), []
    load = jobs.load_datasets
    monkeypatch.setattr(jobs, "load_datasets", lambda tables, datasets: loads.append(len(datasets)) or load(tables, datasets))
    with pytest.raises(ValueError, match="not loaded: 5"):
        jobs.load_all(tables, registry)
    assert len(loads) == 9 and jobs.staging_events(tables).count() == 15
    assert tables.read(DETAIL, "load_metrics").count() == 15


def test_insert_touches_only_what_changed(store, tmp_path, dictionary, rows):
    tables, registry = store
    jobs.load_all(tables, registry)
    jobs.map_brands(tables, dictionary)
    jobs.expand_mapping(tables)
    assert jobs.insert_cleaned(tables) == ["1", "2"]
    before = files_of(tables, DETAIL, "final_table")
    assert jobs.insert_cleaned(tables) == [] and files_of(tables, DETAIL, "final_table") == before

    december = [("2019-12-01 08:00:00", "cart", 5, "kids.game", "o'neil", "s9"), ("2019-12-01 08:00:00", "cart", 5, "sport.ball", "new", "s9")]
    registry["3"] = Dataset("3", write_events(tmp_path / "dec.csv.gz", december), "e_dec", "b_dec", "c_dec")
    jobs.load_all(tables, registry)
    jobs.expand_mapping(tables)
    assert ("o'neil", "kids.game") in rows(tables.read(DETAIL, "brand_category_mapping_final"))
    assert jobs.insert_cleaned(tables) == ["3"]
    now = files_of(tables, DETAIL, "final_table")
    assert all("dataset_key=3" in path for path in set(now) - set(before))
    assert {path: now[path] for path in before} == before

    # A brand that is mapped later touches the datasets that hold it and no others.
    jobs.map_brands(tables, tables.spark.createDataFrame([("new", "sport")], "brand string, category_index string"), codes=["sport"])
    jobs.expand_mapping(tables)
    assert jobs.insert_cleaned(tables) == ["3"]
    assert tables.read(DETAIL, "final_table", STORED_EVENT_SCHEMA).count() == 7
    # So does a dataset that is loaded anew.
    write_events(tmp_path / "nov.csv.gz", NOVEMBER[:2])
    jobs.load_dataset(tables, registry["2"])
    assert jobs.insert_cleaned(tables) == ["2"]
    assert tables.read(DETAIL, "final_table", STORED_EVENT_SCHEMA).count() == 6
    assert jobs.insert_cleaned(tables, rebuild=True) == ["1", "2", "3"]
    assert tables.read(DETAIL, "final_table", STORED_EVENT_SCHEMA).count() == 6


def test_expansion_reads_no_events(store, dictionary, plan, rows):
    tables, registry = store
    jobs.load_all(tables, registry)
    jobs.map_brands(tables, dictionary)
    text = plan(jobs.mappings.expand_mapping(tables.read(DETAIL, "brand_category_mapping"), jobs.staged_pairs(tables)))
    assert "dataset_pairs" in text and "dds_stg" not in text
    for rebuild in (False, False, True):
        jobs.expand_mapping(tables, rebuild)
        assert sorted(rows(tables.read(DETAIL, "brand_category_mapping_final"))) == [("acme", "auto.tyre"), ("o'neil", "kids.toy")]


def test_dimensions_follow_their_dataset(spark, store, tmp_path, holidays, dictionary, rows):
    """An emptied dataset has no brands left, and the names of the registry are known to SQL."""
    tables, registry = store
    jobs.build_all(tables, registry, holidays, dictionary)
    jobs.register_all(tables, registry)
    assert sorted(row[0] for row in spark.sql("SELECT brand FROM dds.b_nov").collect()) == ["acme", "o'neil"]
    assert sorted(row[0] for row in spark.sql("SELECT category_code FROM dds.c_oct").collect()) == ["auto.tyre", "kids.toy"]
    assert spark.table("dds_stg.e_oct").count() == 3
    write_events(tmp_path / "nov.csv.gz", [])
    jobs.load_dataset(tables, registry["2"])
    jobs.extract_dimensions(tables, list(registry.values()))
    assert rows(jobs.dimension(tables, "brand", registry["2"])) == []
    assert rows(jobs.dimension(tables, "brand", registry["1"])) == [("acme",)]


def test_a_crash_after_the_replies_asks_nothing_twice(store, rows, monkeypatch, tmp_path):
    tables, registry = store
    jobs.load_all(tables, registry)
    asked = tmp_path / "asked"

    def answer(prompt):
        with open(asked, "a") as file:
            file.write("x")
        return "```sql\nVALUES " + ("('acme', 'auto'), ('acme', 'cars')" if "'acme'" in prompt else "('o''neil', 'cars')") + ";```"

    append = Tables.append

    def fail(self, frame, layer, name):
        if name == "brand_category_mapping":
            raise OSError("lost")
        append(self, frame, layer, name)

    monkeypatch.setattr(Tables, "append", fail)
    with pytest.raises(OSError, match="lost"):
        jobs.map_brands(tables, answer=answer, size=1)
    monkeypatch.setattr(Tables, "append", append)
    assert asked.read_text() == "xx"
    report = jobs.map_brands(tables, answer=answer, size=1)
    assert asked.read_text() == "xx" and report.accepted_pairs == 1 and report.unmapped_brands == 1
    assert rows(tables.read(DETAIL, "brand_category_mapping")) == [("acme", "auto")]
    # The refused brand is asked for again, and what was refused before stays on record.
    jobs.map_brands(tables, answer=answer, size=1)
    assert asked.read_text() == "xxx"
    rejects = tables.read(DETAIL, "brand_mapping_rejects")
    assert {row.brand for row in rejects.collect()} == {"acme", "o'neil"} and rejects.select("run").distinct().count() == 3
    assert tables.read(DETAIL, "brand_mapping_replies").count() == 3


def test_replies_come_in_waves(store, monkeypatch):
    tables, registry = store
    jobs.load_all(tables, registry)
    monkeypatch.setattr(jobs, "WAVE", 1)
    jobs.map_brands(tables, answer=lambda prompt: "```sql\nVALUES ('acme', 'auto'), ('o''neil', 'kids');```", size=1)
    assert tables.read(DETAIL, "brand_category_mapping").count() == 2
    assert tables.read(DETAIL, "brand_mapping_replies").select("batch_id").distinct().count() == 2


def test_a_stream_without_files_is_empty(spark, tmp_path):
    (tmp_path / "landing" / "dataset_key=1").mkdir(parents=True)
    paths = str(tmp_path / "landing"), str(tmp_path / "target"), str(tmp_path / "checkpoint")
    assert incremental_load(spark, *paths).count() == 0


def test_multi_line_files_are_spread(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text("a,b\n1,2\n")
    frame = event_files.read_raw(spark, str(path), multi_line=True)
    assert event_files.spread(frame) is frame
    assert "Rebalance" in event_files.spread(frame, multi_line=True)._jdf.queryExecution().toString()
