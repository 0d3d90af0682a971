from __future__ import annotations

import csv
import io
import random

import pytest

from tabloom import ValidationError, read_csv
from tabloom.sources.quoted import ends_inside, read_quoted_csv


def state_by_characters(line: str, inside: bool) -> bool:
    """The same by walking over the line."""
    at, fresh = 0, not inside
    while at < len(line):
        c = line[at]
        if inside:
            if c == '"':
                if line[at + 1 : at + 2] == '"':
                    at += 1
                else:
                    inside = False
        elif c == ",":
            fresh = True
            at += 1
            continue
        elif c == '"' and fresh:
            inside = True
        fresh = False
        at += 1
    return inside


def test_states_of_lines():
    rng = random.Random(4)
    for _ in range(30_000):
        line = "".join(rng.choice('"",ab ') for _ in range(rng.randint(0, 12)))
        for inside in (False, True):
            assert ends_inside(line, inside) == state_by_characters(line, inside), (line, inside)
    assert ends_inside('"' + "x" * 200_000 + '""' * 50_000, False)  # no deep recursion


def _field(rng: random.Random) -> str:
    kind = rng.random()
    if kind < 0.15:
        return ""
    parts = ["a", "bc", "1", " ", ",", '"', "\n", "\n\n", "é", "x,y", '""', 'inch"', "\r\n"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(1, 6)))


def _written(rows, quoting, end="\n") -> str:
    out = io.StringIO()
    csv.writer(out, quoting=quoting, lineterminator=end).writerows(rows)
    return out.getvalue()


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [0, 3, 7])
def test_equal_to_the_whole_file_reader(spark, tmp_path, seed):
    rng = random.Random(seed)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    end = "\r\n" if seed == 7 else "\n"
    for k in range(2):  # several files
        rows = [["key", 'long "name"\nof a column', "third"]] + [[str(k * 1000 + i), _field(rng), _field(rng)] for i in range(50)]
        text = _written(rows, csv.QUOTE_ALL if seed % 2 else csv.QUOTE_MINIMAL, end)
        if seed in (2, 3):  # quotes that open nothing, and blank lines between records
            text += f'9{k},5" pipe,un"even\n\n'
        (tmp_path / f"f{k}.csv").write_bytes(text.encode())
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", {0: 83, 3: 300, 7: 128}[seed])
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        got = read_quoted_csv(spark, str(tmp_path))
        assert got.columns == ["key", 'long "name"\nof a column', "third"]
        got = _rows(got)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    want = spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(str(tmp_path))
    assert len(got) >= 100 and got == _rows(want)


def test_typed_by_content_and_by_schema(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,text,flag\n1,"one\ntwo",true\n2,"NA",false\n3,,true\n')
    df = read_csv(spark, str(tmp_path / "a.csv"))
    assert dict(df.dtypes) == {"k": "double", "text": "string", "flag": "boolean"}
    assert _rows(df) == [(1.0, "one\ntwo", True), (2.0, None, False), (3.0, None, True)]
    df = read_csv(spark, str(tmp_path / "a.csv"), schema="k int, text string, flag string", multiline=True)
    assert [r.k for r in df.orderBy("k").collect()] == [1, 2, 3]


def test_a_value_that_is_never_closed(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,text\n1,"open\n2,plain\n')
    with pytest.raises(ValidationError, match="not closed"):
        read_csv(spark, str(tmp_path / "a.csv"))
