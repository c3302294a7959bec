"""JSON arrays read by byte ranges equal the plain parser's, whatever is nested, escaped or cut."""

import json
import random

import pytest

from veilspark.sources.arrays import PLAIN, read_array, step
from veilspark.sources.records import read_records, read_records_variant
from veilspark.sources.sealed import read_sealed


@pytest.fixture
def ranges(spark):
    """A function that sets the bytes of a range; all is as before afterwards."""
    keys = {"spark.sql.files.maxPartitionBytes": "128MB", "spark.sql.files.openCostInBytes": "4MB", "spark.sql.shuffle.partitions": None}
    old = {k: spark.conf.get(k, d) for k, d in keys.items()}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", f"{n}b")
    for k, v in old.items():
        spark.conf.set(k, v)


def value(rng, depth=0):
    kind = rng.random()
    if kind < 0.5 or depth > 3:
        return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", "a", "é", "日", "\n", " "]) for _ in range(rng.randint(0, 6)))
    if kind < 0.65:
        return rng.choice([1, None, True, -2.5])
    if kind < 0.8:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {value(rng, 9): value(rng, depth + 1) for _ in range(rng.randint(0, 3))}


def test_states_compose():
    """Stepping through a text in two parts is stepping through it whole."""
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice('ab"\\{}[],') for _ in range(rng.randint(0, 14)))
        cut = rng.randint(0, len(text))
        for state in (0, 1, 2):
            middle, a = step(state, text[:cut])
            end, b = step(middle, text[cut:])
            assert (end, a + b) == step(state, text)


def test_elements_equal_the_plain_parser(spark, tmp_path, ranges):
    rng = random.Random(2)
    given = {}
    for i in range(3):
        given[f"f{i}.json"] = [{f"k{j}": value(rng) for j in range(rng.randint(0, 4))} for _ in range(15 * i)]
        text = json.dumps(given[f"f{i}.json"], ensure_ascii=bool(i % 2), indent=(None, 2, None)[i])
        (tmp_path / f"f{i}.json").write_text(rng.choice(["", " \n", "﻿"]) + text + rng.choice(["", "\n "]))
    for n in (64, 10_000_000):
        ranges(n)
        rows = sorted(read_array(spark, str(tmp_path)).collect(), key=lambda r: (r.file, r.block, r.place))
        for name, objects in given.items():
            assert [json.loads(r.text) for r in rows if r.file.endswith(name)] == objects
        if n == 64:
            assert len({(r.file, r.block) for r in rows}) > 20  # many tasks took part in one file


@pytest.mark.parametrize("text", ['{"a": 1}', '[{"a": 1}', '[{"a": 1}, 2]', '[{"a": 1} {"b": 2}]', '[{"a": 1}] x', '[, {"a": 1}]', '[{"a": 1},]',
                                  '[{"a": "]}', "1", '[{"a": 1}]]'])
def test_what_is_no_array_of_objects_fails(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="JSON array"):
        read_array(spark, str(tmp_path)).collect()


def test_scans_by_ranges(spark, tmp_path, ranges):
    ranges(80)
    records = [{"id": i, "category": "c", "rating": i / 2, "body": "b}{" * i} for i in range(30)]
    (tmp_path / "r.json").write_text(json.dumps(records))
    path = str(tmp_path / "r.json")
    for plain, strict in [(read_records(spark, path, True), read_records(spark, path, True, strict=True))]:
        assert sorted(map(str, strict.collect())) == sorted(map(str, plain.collect()))
    got = read_records_variant(spark, path, True, strict=True).selectExpr("variant_get(record, '$.body', 'string') AS body").collect()
    assert sorted(r.body for r in got) == sorted(r["body"] for r in records)
    sealed = [{"header": json.dumps({"n": i}), "nonce": "AAAAAAAAAAAAAAAA", "ciphertext": "AAAA", "id": i} for i in range(20)] + [{"nonce": "AAAA"}]
    (tmp_path / "s.json").write_text(json.dumps(sealed))
    rows = read_sealed(spark, str(tmp_path / "s.json"), multi_line=True, extra_schema="id long", strict=True).collect()
    assert sorted(r.id for r in rows) == list(range(20)) and {bytes(r.nonce) for r in rows} == {bytes(12)}
    (tmp_path / "lone.json").write_text('{"id": 1}')
    with pytest.raises(Exception, match="JSON array"):
        read_records(spark, str(tmp_path / "lone.json"), True, strict=True).collect()
    assert step(PLAIN, "") == (PLAIN, 0)
