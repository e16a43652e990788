"""Delimited files with line breaks in fields, read in blocks, against Spark's reader of whole files and a plain join."""

import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clinlake.sources import delimited as D
from clinlake.sources import readers

FIELDS = st.one_of(
    st.text("ab ", max_size=3),
    st.sampled_from(['a"', 'a""', 'a"b"', '""', '"a"b', '"a"b"c']),
    st.lists(st.sampled_from(["a", '""', "\n", "|", "é", " "]), max_size=8).map(lambda t: '"' + "".join(t) + '"'),
)
RECORDS = st.lists(st.lists(FIELDS, min_size=2, max_size=3).map("|".join), min_size=1, max_size=12)


def batches(blocks, bits, size):
    for start, (lines, bit) in enumerate(zip(blocks, bits, strict=True)):
        for low in range(0, len(lines), size):
            rows = [{"value": v, "path": "f", "start": start, "bit": bit, "heads": start == 0} for v in lines[low : low + size]]
            yield pa.RecordBatch.from_pylist(rows)


@given(RECORDS, st.lists(st.integers(1, 40), max_size=4), st.integers(1, 5))
@settings(max_examples=300, deadline=None)
def test_blocks_give_every_record_once(records, cuts, size):
    lines = "\n".join(records).split("\n")
    edges = [0, *sorted({c for c in cuts if c < len(lines)}), len(lines)]
    blocks = [lines[low:high] for low, high in zip(edges, edges[1:], strict=False)]
    bits, bit = [], 0
    for block in blocks:
        bits.append(bit)
        bit = int(D._bits_after(D._moves(pa.array(block), "|"), bit)[-1])
    assert bit == 0
    found = [r for b in D._records("|", crossing=False)(batches(blocks, bits, size)) for r in b.to_pylist()]
    pieces = [r for b in D._records("|", crossing=True)(batches(blocks, bits, size)) for r in b.to_pylist()]
    for piece in sorted(pieces, key=lambda r: (r["start"], r["side"])):
        if piece["side"] == 2:
            found.append(piece)
        else:
            found[-1]["record"] += "\n" + piece["record"]
    assert sorted(r["record"] for r in found) == sorted(records)
    assert [r["record"] for r in found if r["first"]] == [records[0]]


@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 1)), min_size=1, max_size=20), st.integers(0, 1))
@settings(max_examples=200, deadline=None)
def test_bits_follow_the_lines_one_after_another(moves, bit):
    after, now = [], bit
    for move in moves:
        now = move[now]
        after.append(now)
    assert D._bits_after(D.np.array(moves), bit).tolist() == after


def extract(seed, rows):
    rng = random.Random(seed)

    def field():
        text = "".join(rng.choice(["a", "b", '""', "\n", "|", "\n\n", " ", "é"]) for _ in range(rng.randint(0, 12)))
        return rng.choice([f'"{text}"', f'"{text}"', "ab", 'a"b', ""])

    return "\n".join(['x|"y\n1"|z'] + ["|".join(field() for _ in range(3)) for _ in range(rows)]) + "\n"


@pytest.fixture
def small_blocks(spark):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {name: spark.conf.get(name) for name in names}
    for name, value in zip(names, ("400", "0"), strict=True):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_split_files_read_as_whole_ones(spark, tmp_path, small_blocks):
    for n in range(2):
        (tmp_path / f"{n}.csv").write_text(extract(n, 60))
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "h.csv").write_text('x|"y\n1"|z')
    found = readers.read_delimited(spark, str(tmp_path))
    whole = readers.read_delimited(spark, str(tmp_path), multi_line=True)
    assert found.rdd.getNumPartitions() > 4 and found.columns == whole.columns == ["x", "y\n1", "z"]
    assert rows(found) == rows(whole)
    shuffled = D.broken_records(spark, str(tmp_path), "|", broadcast_blocks=0)
    assert rows(shuffled) == rows(D.broken_records(spark, str(tmp_path), "|"))


def test_a_record_longer_than_blocks(spark, tmp_path, small_blocks):
    text = "a line of the field\n" * 150
    (tmp_path / "t.csv").write_text(f'x|y\n1|"{text}"\n2|c\n')
    assert rows(readers.read_delimited(spark, str(tmp_path))) == [("1", text), ("2", "c")]


def test_line_breaks_of_two_characters_types_and_empty_lines(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes(b'\r\nx,y\r\n1,"a\r\nb"\r\n\r\n2,""\r\n3,\r\n')
    found = readers.read_delimited_typed(spark, str(tmp_path), "x int, y string")
    assert rows(found) == [(1, "a\nb"), (2, None), (3, None)]
    assert rows(found) == rows(readers.read_delimited_typed(spark, str(tmp_path), "x int, y string", multi_line=True))
    assert readers.read_delimited_typed(spark, str(tmp_path)).dtypes == [("x", "int"), ("y", "string")]
    assert readers.read_csv_plain(spark, str(tmp_path)).count() == 3


def test_a_quote_left_open_is_an_error(spark, tmp_path):
    (tmp_path / "t.csv").write_text('x|y\n1|"a\n2|c\n')
    with pytest.raises(ValueError, match="never closed"):
        readers.read_delimited(spark, str(tmp_path))


def test_files_without_line_breaks_in_fields_are_read_by_spark_alone(spark, tmp_path):
    (tmp_path / "t.csv").write_text('x|y\n1|"a ""b"""\n')
    found = readers.read_delimited(spark, str(tmp_path))
    assert rows(found) == [("1", 'a "b"')]
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_delimiter_of_several_characters(spark, tmp_path):
    (tmp_path / "t.csv").write_text('x||y\n1||"a\nb"\n')
    with pytest.raises(ValueError, match="one character"):
        readers.read_delimited(spark, str(tmp_path), "||")
    assert rows(readers.read_delimited(spark, str(tmp_path), "||", multi_line=True)) == [("1", "a\nb")]
