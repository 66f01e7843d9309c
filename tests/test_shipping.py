"""What executors need: functions that arrive by value, without this package installed there."""

import subprocess
import sys

import pandas as pd
from pyspark import cloudpickle

from tablework.functions import udfs
from tablework.sinks import files


def run_elsewhere(function, tmp_path, call: str) -> str:
    """Call the pickled function in a process that cannot import the package."""
    pickled = tmp_path / "function.pkl"
    pickled.write_bytes(cloudpickle.dumps(function))
    code = f"import pickle, pandas as pd; f = pickle.load(open({str(pickled)!r}, 'rb')); print({call})"
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr
    return done.stdout.strip()


def test_value_function_ships_by_value(spark, tmp_path):
    grade = udfs.value_function(lambda value: "A" if value > 1 else "B", "string")
    assert run_elsewhere(grade.func, tmp_path, "[f(1), f(2)]") == "['B', 'A']"


def test_row_function_and_array_writer_ship_by_value(spark, tmp_path, monkeypatch):
    shipped = []
    kind = type(spark.range(1))
    for name in ("mapInPandas", "mapInArrow"):

        def remember(df, function, schema, *args, original=getattr(kind, name), **kwargs):
            shipped.append(function)
            return original(df, function, schema, *args, **kwargs)

        monkeypatch.setattr(kind, name, remember)
    udfs.map_rows(spark.range(1), lambda row: [{"n": row["id"] + 1}] * 2, "n bigint")
    files.write_json_arrays(spark.range(2), str(tmp_path / "arrays"))
    rows, lines = shipped
    batch = "__import__('pyarrow').RecordBatch.from_pylist([{'id': 4}])"
    assert run_elsewhere(rows, tmp_path, f"[b.to_pydict()['n'] for b in f([{batch}])]") == "[[5, 5]]"
    call = "[v for b in f([pd.DataFrame({'value': ['a', 'b']})]) for v in b['value']]"
    assert run_elsewhere(lines, tmp_path, call) == "['[ a', ', b', ']']"


def test_row_function_may_return_nothing(spark):
    kept = udfs.map_rows(
        spark.range(10), lambda row: [row] if row["id"] > 7 else [], "id bigint"
    )
    assert sorted(row["id"] for row in kept.collect()) == [8, 9]
    assert pd.DataFrame(kept.collect()).shape == (2, 1)


def test_large_and_missing_numbers_arrive_exactly(spark):
    big = 2**53 + 1
    df = spark.createDataFrame([(1, big), (2, None)], "id long, n long")
    told = udfs.value_function(lambda value: repr(value), "string")
    assert [row[0] for row in df.orderBy("id").select(told("n")).collect()] == [str(big), "None"]
    back = udfs.map_rows(df, lambda row: [row], "id long, n long")
    assert sorted(tuple(row) for row in back.collect()) == [(1, big), (2, None)]
