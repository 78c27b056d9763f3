"""Array files cut at many places, against Python's own reader."""

import json
import random

import pytest
from pyspark import cloudpickle

from tablecheck.sources import json_array
from tablecheck.sources.json_array import read_json_array

TEXTS = ["", "plain", "},{", '"', '\\"}', "\\", "a{b}c", "[{", "line\nbreak", "\t}", "}\\\\", "é€😀}", '{"a": "}"}', "}" * 7, "NaN"]
SCHEMA = "id int, t string, inner struct<x:string,list:array<struct<y:string>>>"


def rows(n, seed=1):
    rng = random.Random(seed)
    pick = lambda: "".join(rng.choice(TEXTS) for _ in range(rng.randint(0, 3)))
    return [
        {"id": i, "t": pick(), "inner": {"x": pick(), "list": [{"y": pick()} for _ in range(rng.randint(0, 2))]}} for i in range(n)
    ]


def found(df):
    return {r["id"]: r.asDict(recursive=True) for r in df.collect()}


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_elements_across_splits(spark, tmp_path, indent, ascii_only):
    want = rows(60)
    # One element is larger than many splits.
    want.append({"id": 60, "t": "},{" * 5000, "inner": {"x": "", "list": [{"y": "}"}] * 300}})
    want += [{**r, "id": r["id"] + 100} for r in rows(20, 2)]
    path = tmp_path / "a.json"
    path.write_text(json.dumps(want, indent=indent, ensure_ascii=ascii_only), encoding="utf-8")
    size = path.stat().st_size
    for split in (size * 2, 4000, 701):
        df = read_json_array(spark, str(path), SCHEMA, split_bytes=split)
        assert found(df) == {r["id"]: r for r in want}, split
    assert found(read_json_array(spark, str(path), split_bytes=4000)) == {r["id"]: r for r in want}


def test_one_large_file_uses_several_tasks(spark, tmp_path):
    path = tmp_path / "large.json"
    path.write_text(json.dumps([{"id": i, "t": "x" * 100} for i in range(20_000)]))
    df = read_json_array(spark, str(path), "id int, t string", split_bytes=256 << 10)
    assert df.inputFiles() and len([f for f in df.inputFiles() if "kind=0" in f]) >= 8
    assert df.count() == 20_000 and df.agg({"id": "sum"}).first()[0] == sum(range(20_000))


def test_several_files_and_odd_contents(spark, tmp_path):
    contents = {
        "empty_array": "[]", "blank": "  \n", "one": '{"id": 1, "t": "}"}', "spaces": ' [ {"id": 2 , "t":"{"} ,\r\n{ "id":3,"t":null}\n]\n',
        "others": '[1, "a{b", {"id": 4, "t": "\\\\"}, [], null, "}"]', "lines": '{"id": 5}\n{"id": 6, "t": "\\""}\n',
    }
    for name, text in contents.items():
        (tmp_path / f"{name}.json").write_text(text)
    df = read_json_array(spark, str(tmp_path), "id int, t string", split_bytes=9)
    assert {(r["id"], r["t"]) for r in df.collect()} == {(1, "}"), (2, "{"), (3, None), (4, "\\"), (5, None), (6, '"')}


def test_nothing_but_empty_arrays(spark, tmp_path):
    (tmp_path / "e.json").write_text("[ ]")
    df = read_json_array(spark, str(tmp_path / "e.json"), "id int")
    assert df.columns == ["id"] and df.count() == 0
    assert read_json_array(spark, str(tmp_path / "e.json")).count() == 0


def test_what_a_task_gets_does_not_grow_with_the_splits(spark, tmp_path, monkeypatch):
    path = tmp_path / "a.json"
    path.write_text(json.dumps([{"id": i, "t": "},{"} for i in range(400)]))
    sizes, made = [], json_array._elements
    monkeypatch.setattr(json_array, "_elements", lambda states: sizes.append(len(cloudpickle.dumps(made(states)))) or made(states))
    for split in (5000, 50):
        assert read_json_array(spark, str(path), "id int, t string", split_bytes=split).count() == 400
    assert sizes[1] < sizes[0] + 200
