import importlib.util
import os
import subprocess
import sys

from helpers import SF_SMOKE

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_smoke(spark):
    mod = _entry()
    df = mod.entry(spark)
    assert df.count() > 0
    assert "listing_key" in df.columns


def test_every_query_has_oracle_or_is_listed():
    mod = _entry()
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q)


def test_queries_run_on_smoke_data(spark):
    mod = _entry()
    for name in ("dim_market", "valid_outlet", "json_path", "lineage_join", "missing_coverage"):
        assert mod.queries()[name](spark, SF_SMOKE).count() >= 0


def test_entry_survives_a_missing_dependency_of_the_optional_part():
    code = ("import sys; sys.modules['xxhash'] = None; sys.modules['pyarrow'] = None\n"
            "import __spark_entry__ as e; q = e.queries()\n"
            "print(len([k for k in q if not k.startswith('op')]), len([k for k in q if k.startswith('op') or k == 'pipeline']))")
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr
    own, optional = map(int, out.stdout.split()[-2:])
    assert own >= 48 and optional == 0
