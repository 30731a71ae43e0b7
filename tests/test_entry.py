import importlib.util
import os
import re

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_contract(spark):
    m = _entry()
    qs, sql = m.queries(), m.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 60
    numbered = {k for k in qs if re.match(r"op\d+_|pipeline$", k)}
    if os.path.isdir(os.path.join(ROOT, "hearth", "llm")):
        numbers = sorted(int(k[2:].split("_")[0]) for k in numbered - {"pipeline"})
        assert "pipeline" in numbered and numbers == list(range(1, len(numbers) + 1)) and len(numbers) >= 10
    else:
        assert not numbered
    df = m.entry(spark)
    assert df.count() > 0 and "nk_update_date" in df.columns
