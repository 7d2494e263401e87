"""Every registered query against its SQL, and the driver contract."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle

import __spark_entry__ as contract
from checks import views
from checks.compare import differences
from checks.spark_queries import QUERIES, cart_then_purchase, digest_model, holiday_pairs
from shopmart.operators import joins
from shopmart.operators.intervals import interval_join

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not there")


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, name):
    assert differences(spark, SF, name) is None


@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_join_and_no_needless_python(spark, plan, name):
    text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text
    assert ("MapInPandas" in text) == (name == "ask_model")
    assert "EvalPython" not in text


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 5


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_events_keep_every_row(spark, sf):
    """Each event finds its product, so the join loses and repeats nothing."""
    sf_dir = f"/root/testdata/sf{sf}"
    shaped = views.shop_events(spark, sf_dir)
    assert shaped.count() == views.table(spark, sf_dir, "events").count()


@pytest.mark.parametrize(
    "sf, expected",
    [
        ("0.001", [1000, 867, 114, 461, 3, 50]),
        ("0.01", [10000, 8667, 1204, 6117, 46, 723]),
        ("0.1", [100000, 86667, 7261, 80588, 568, 9051]),
    ],
)
def test_fixture_counts(spark, sf, expected):
    """The counts recorded in FIXTURES.md, from Spark."""
    sf_dir = f"/root/testdata/sf{sf}"
    pairs = holiday_pairs(spark, sf_dir)
    found = [
        views.shop_events(spark, sf_dir).count(),
        views.cleaned(spark, sf_dir).count(),
        views.mapping_final(spark, sf_dir).count(),
        views.final_table(spark, sf_dir).count(),
        cart_then_purchase(spark, sf_dir).count(),
        pairs.filter(pairs.event_type == views.CART).count(),
    ]
    assert found == expected


@pytest.mark.parametrize("name", ["holiday_conversion", "insert_cleaned", "insert_cleaned_semi", "expand_mapping"])
def test_query_without_broadcast_equals_sql(spark, monkeypatch, name):
    """With no dimension small enough, every join splits off the frequent keys."""
    monkeypatch.setitem(joins.dimension_join.__kwdefaults__, "broadcast_bytes", 0)
    monkeypatch.setitem(interval_join.__kwdefaults__, "broadcast_bytes", 0)
    monkeypatch.setattr(joins.hot_keys, "__defaults__", (20,))
    assert differences(spark, SF, name) is None


def test_stand_in_model_travels_by_value():
    """Workers have only what is pickled, not this repository."""
    code = "import sys, pickle; print(pickle.loads(sys.stdin.buffer.read())('Brands: \\'a\\'\\nReply with'))"
    done = subprocess.run(
        [sys.executable, "-c", code], input=cloudpickle.dumps(digest_model(("x",))), cwd="/", capture_output=True
    )
    assert b"('a', 'x')" in done.stdout, done.stderr


@pytest.mark.parametrize("left", [(), ("corpus_pipeline.py",), ("corpus_pipeline.py", "shopmart/llm/__pycache__/x.pyc")])
def test_contract_without_the_text_operators(tmp_path, left):
    """The other queries import and run when the folder is gone, whether its pipeline or empty folders stay or not."""
    root = Path(contract.__file__).parent
    ignored = shutil.ignore_patterns("llm", "__pycache__", ".git", "tests", "corpus_pipeline.py")
    shutil.copytree(root, tmp_path / "repo", ignore=ignored)
    for name in left:
        place = tmp_path / "repo" / name
        place.parent.mkdir(parents=True, exist_ok=True)
        place.write_bytes((root / name).read_bytes() if (root / name).exists() else b"")
    code = (
        "import __spark_entry__ as e; from shopmart.session import build_session;"
        "names = set(e.queries()); assert names and not [n for n in names if n.startswith('op') or n == 'pipeline'];"
        f"assert names == set(e.oracle_sql()); print(e.entry(build_session('t', 'local[2]')).count() if {not left} else 5)"
    )
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True)
    assert done.stdout.split()[-1:] == ["5"], done.stderr[-2000:]
