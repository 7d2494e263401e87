import json

import pytest

from shopmart.__main__ import arguments, main
from shopmart.sources.lookups import read_holidays
from shopmart.sources.tables import DETAIL, MART, Tables
from tests.test_jobs_and_streaming import NOVEMBER, OCTOBER, write_events


@pytest.fixture()
def inputs(tmp_path):
    entries = {
        key: {
            "dataset_url": write_events(tmp_path / f"{key}.csv.gz", rows),
            "table_name": f"e{key}",
            "brands_table_name": f"b{key}",
            "categories_table_name": f"c{key}",
        }
        for key, rows in (("1", OCTOBER), ("2", NOVEMBER))
    }
    (tmp_path / "holidays.csv").write_text(
        "holiday,start_date,end_date,date\nBlack Friday,2019-11-22,2019-11-29,2019-11-22\n", encoding="utf-8"
    )
    (tmp_path / "dictionary.csv").write_text("brand,category_index\nacme,auto\no'neil,kids\n", encoding="utf-8")
    return {
        "--warehouse": str(tmp_path / "warehouse"),
        "--registry": json.dumps(entries),
        "--dictionary": str(tmp_path / "dictionary.csv"),
        "--holidays": str(tmp_path / "holidays.csv"),
    }


@pytest.mark.parametrize("steps", [["all"], ["load", "map", "insert", "marts"]])
def test_steps(spark, inputs, steps):
    for step in steps:
        main([step, *(part for pair in inputs.items() for part in pair)])
    tables = Tables(spark, inputs["--warehouse"])
    assert tables.read(DETAIL, "final_table").count() == 5
    assert tables.read(MART, "black_friday_sales").first().saleday == "Black Friday"


@pytest.mark.parametrize("step", ["load", "map", "marts"])
def test_missing_input_is_refused(step, capsys):
    with pytest.raises(SystemExit):
        arguments([step, "--warehouse", "w"])
    assert "need" in capsys.readouterr().err


def test_holidays_from_parquet(spark, inputs, tmp_path):
    frame = read_holidays(spark, inputs["--holidays"])
    frame.write.parquet(str(tmp_path / "holidays"))
    assert read_holidays(spark, str(tmp_path / "holidays")).collect() == frame.collect()
