"""The package's names, and that nothing but its own folder needs the training-data operators."""

import ast
import pathlib

import keyharbor as kh

ROOT = pathlib.Path(kh.__file__).parent


def test_all_names_load():
    assert len(kh.__all__) > 120
    for name in kh.__all__:
        assert getattr(kh, name) is not None
    assert set(kh.__all__) <= set(dir(kh))


def test_nothing_imports_the_training_data_operators():
    for path in ROOT.rglob("*.py"):
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n for n in names), path


def test_no_rows_pass_python_in_the_engine(spark, data):
    """The engine's own queries are expressions: no UDF in any plan."""
    from keyharbor.plans.registry import QUERIES

    skip = {"stream_available_now", "stream_tumbling", "cache_roundtrip", "infer_schema"}  # these run when they are built
    for name, fn in QUERIES.items():
        if name not in skip:
            plan = fn(spark, data)._jdf.queryExecution().optimizedPlan().toString()
            assert "Python" not in plan and "Arrow" not in plan, name
