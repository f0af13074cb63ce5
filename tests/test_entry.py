import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_on_smallest_scale(spark):
    mod = _entry()
    df = mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["day", "user_id", "n_views", "view_cents", "click", "error", "purchase", "signup",
                          "c_nationkey", "c_mktsegment"]


def test_every_query_has_an_oracle_but_the_model():
    mod = _entry()
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q)
    assert {n for n in set(q) - set(o) if n.startswith("q")} == {"q21_gbt_score"}
