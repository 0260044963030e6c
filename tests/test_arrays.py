"""JSON arrays cut into elements over ranges, against a whole reading."""

import json
import random

import pytest

from pollwright.sources import arrays, qa_items
from tests.test_files import write


@pytest.fixture
def small_ranges(spark):
    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)

    yield of
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


def some_value(rng, depth=0):
    signs = ['"', "\\", "}", "{", "[", "]", "\n", ",", "ü", "a", " ", "}\\", '\\"']
    kind = rng.randrange(4 if depth > 2 else 6)
    if kind == 4:
        return [some_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    if kind == 5:
        return {f"k{i}}}": some_value(rng, depth + 1) for i in range(rng.randrange(4))}
    return ["".join(rng.choices(signs, k=rng.randrange(12))), rng.randrange(10**6), None, True][kind]


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_elements_are_those_of_the_array(spark, tmp_path, small_ranges, size):
    small_ranges(size)
    rng, expected = random.Random(size), {}
    few = 6 if size == 7 else 40
    for name, n, indent in (("a", few, None), ("b", few, 2), ("none", 0, None), ("one", 1, 1)):
        items = [{f"k{i}": some_value(rng) for i in range(rng.randrange(5))} for _ in range(n)]
        write(tmp_path / f"{name}.json", json.dumps(items, indent=indent, ensure_ascii=name == "a"))
        expected |= {(f"{name}.json", i): item for i, item in enumerate(items)}
    rows = arrays.elements(spark, f"{tmp_path}/*.json").collect()
    assert len(rows) == len(expected)
    assert {(r["path"].rsplit("/", 1)[1], r["pos"]): json.loads(r["value"]) for r in rows} == expected


def test_items_in_ranges_and_whole_are_equal(spark, tmp_path, small_ranges):
    small_ranges(50)
    items = [
        {"case_id": f"case_{i}", "question": "} or {?", "expected_answer": ["a", i, 2.0, "it's"], "n": i + 0.5, "x": {"y": [i]}}
        for i in range(30)
    ]
    write(tmp_path / "d e" / "d e_my_task_qa_pairs.json", json.dumps(items, indent=1))
    whole, ranged = (
        sorted(map(str, qa_items.read_items(spark, str(tmp_path), layout).collect())) for layout in ("array", "ranges")
    )
    assert whole == ranged and len(whole) == 30


def test_numbers_are_printed_as_they_are_read(spark, tmp_path):
    lexemes = ["10000000000000000000.0", "1000000000000000001.5", "12345678901234567890123", "3.0", "1e2", "-0.0", "1E-7", "0.1", "7", "-5"]
    text = f'[{{"case_id": "case_1", "expected_answer": [{", ".join(lexemes)}, "1.0", true, null], ' + ", ".join(
        f'"n{i}": {x}' for i, x in enumerate(lexemes)
    ) + ', "text": "1.50", "flag": false}]'
    write(tmp_path / "d" / "d_t_qa_pairs.json", text)
    for layout in ("array", "ranges"):
        (row,) = qa_items.read_items(spark, str(tmp_path), layout).collect()
        fields = {f["key"]: f["value"] for f in row["fields"]}
        item = json.loads(text)[0]
        assert fields == {k: v if isinstance(v, str) else str(v) for k, v in item.items()}
