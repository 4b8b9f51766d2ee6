"""Sources: split files with quoted line breaks, two header rows, image files."""

import random
import string
import struct
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortline.sources import frames, metrics, quoted, tables


def plain_csv(spark, path):
    """The one-task reading of the same files."""
    return spark.read.options(header=True, quote='"', escape='"', multiLine=True).csv(path)


def odd_cell(rng):
    return "".join(rng.choices(["a", "b", " ", ",", '"', "\n", "\n\n", "é", "'", "#", "x" * 40], k=rng.randrange(1, 9)))


def written(path, rows, end="\n", mark=""):
    def quoted_cell(text):
        return '"' + text.replace('"', '""') + '"' if set(text) & set(',"\n\r') else text

    lines = [",".join(map(quoted_cell, r)) for r in rows]
    path.write_bytes((mark + end.join(lines) + end).encode())
    return str(path)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_split_reading_equals_one_task(spark, tmp_path, small_splits, end):
    rng = random.Random(3)
    rows = [["id", "first name", "a.b"]] + [[str(i), odd_cell(rng), odd_cell(rng)] for i in range(4000)]
    rows[7][1] = "one cell\n" * 3000  # spans many splits
    path = written(tmp_path / "large.csv", rows, end, mark="﻿")
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    ours = quoted.read_quoted(spark, path)
    assert ours.columns == rows[0]
    got = sorted(map(tuple, ours.collect()), key=lambda r: int(r[0]))
    want = sorted(map(tuple, plain_csv(spark, path).collect()), key=lambda r: int(r[0]))
    assert got == want
    # Spaces around a cell are kept, an empty cell is missing.
    assert [(r[0], (r[1], r[2])) for r in got] == [(r[0], (r[1] or None, r[2] or None)) for r in rows[1:]]


def test_many_files_and_headers(spark, tmp_path):
    for k in range(3):
        written(tmp_path / f"part{k}.csv", [["k", "text"], [str(k), "a\nb"], [str(k), ""]])
    found = quoted.read_quoted(spark, str(tmp_path)).orderBy("k", "text").collect()
    assert [tuple(r) for r in found] == [(str(k), t) for k in range(3) for t in (None, "a\nb")]
    written(tmp_path / "other.csv", [["k", "other"], ["9", "x"]])
    with pytest.raises(ValueError, match="different headers"):
        quoted.read_quoted(spark, str(tmp_path))


def test_headers_of_all_kinds(spark, tmp_path):
    path = written(tmp_path / "h.csv", [["a", "a", "", "two\nlines", "x,y"], ["1", "2", "3", "4", "5"]])
    read = quoted.read_quoted(spark, path)
    assert read.columns == ["a0", "a1", "_c2", "two\nlines", "x,y"]
    assert [tuple(r) for r in read.collect()] == [("1", "2", "3", "4", "5")]


def test_empty_files_and_schemas(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    assert quoted.read_quoted(spark, str(tmp_path / "none.csv")).count() == 0
    path = written(tmp_path / "head.csv", [["n", "t"]])
    assert quoted.read_quoted(spark, path).collect() == []
    schema = spark.createDataFrame([], "n int, t string").schema
    path = written(tmp_path / "typed.csv", [["n", "t"], ["1", "x\ny"], ["2", ""]])
    assert [tuple(r) for r in tables.read_csv(spark, path, schema).orderBy("n").collect()] == [(1, "x\ny"), (2, None)]
    path = written(tmp_path / "bad.csv", [["n", "t"], ["one", "x"]])
    with pytest.raises(Exception, match="(?i)malformed"):
        tables.read_csv(spark, path, schema).collect()


def test_multi_line_records_are_few_rows(spark, tmp_path):
    rows = [["id", "t"]] + [[str(i), "a\nb" if i % 500 == 0 else "plain"] for i in range(2000)]
    path = written(tmp_path / "few.csv", rows)
    found = quoted.records(spark, path)
    assert found.count() == 2001
    assert found.filter(F.col("record").contains("\n")).count() == 4


def test_two_header_rows(spark, tmp_path):
    (tmp_path / "one.csv").write_text(",LASSO,,MLP\nDataset,AUC,F1 Score,AUC\n\"Full, all\",0.5,,0.75\nother,1.0,0.25,x\n")
    (tmp_path / "two.csv").write_text(",MLP\nDataset,AUC\nthird,0.1\n")
    (tmp_path / "three.csv").write_text(",MLP\nDataset,AUC\n")
    found = sorted(map(tuple, metrics.read_metrics(spark, str(tmp_path)).collect()))
    assert found == [
        ("Full, all", "LASSO", "AUC", 0.5), ("Full, all", "LASSO", "F1 Score", None), ("Full, all", "MLP", "AUC", 0.75),
        ("other", "LASSO", "AUC", 1.0), ("other", "LASSO", "F1 Score", 0.25), ("other", "MLP", "AUC", None),
        ("third", "MLP", "AUC", 0.1),
    ]
    (tmp_path / "uneven.csv").write_text(",MLP,MLP\nDataset,AUC\n")
    with pytest.raises(ValueError, match="different lengths"):
        metrics.read_metrics(spark, str(tmp_path))


def test_metrics_survive_writing(spark, tmp_path):
    rows = [(d, m, x, v) for d, v in (("a", 0.25), ('b "x", y', 1.0), ("c", None)) for m in ("L", "M") for x in ("p", "q")]
    long = spark.createDataFrame(rows, "dataset string, model string, metric string, value double").repartition(5)
    path = str(tmp_path / "metrics")
    metrics.write_metrics(long, path, [(m, x) for m in ("L", "M") for x in ("p", "q")])
    assert sorted(metrics.read_metrics(spark, path).collect(), key=repr) == sorted(long.collect(), key=repr)
    metrics.write_metrics(long.limit(0), path, [("L", "p")])
    assert metrics.read_metrics(spark, path).count() == 0


def random_frames(rng, n=3, bits=16, height=5, width=7):
    return rng.integers(0, 1 << bits, (n, height, width))


@pytest.mark.parametrize("bits", [1, 8, 16])
@pytest.mark.parametrize("n", [1, 4])
def test_image_files_round_trip(bits, n):
    cells = random_frames(np.random.default_rng(bits), n, bits)
    assert (frames.decode(frames.encode(cells, bits)) == cells).all()


def test_image_files_of_other_writers():
    cells = random_frames(np.random.default_rng(1), 2)
    data = frames.encode(cells)
    at = data.index(struct.pack("<HH2s", 0x28, 2, b"US"))
    item = struct.pack("<HHI", 0xFFFE, 0xE000, 0xFFFFFFFF)
    ends = struct.pack("<HHI", 0xFFFE, 0xE00D, 0), struct.pack("<HHI", 0xFFFE, 0xE0DD, 0)
    inner = struct.pack("<HH2sHI", 8, 0x1199, b"SQ", 0, 0xFFFFFFFF) + item + struct.pack("<HH2sH", 8, 0x1150, b"UI", 4) + b"1.2\0"
    nested = struct.pack("<HH2sHI", 8, 0x1115, b"SQ", 0, 0xFFFFFFFF) + item + inner + ends[0] + ends[1] + ends[0] + ends[1]
    # Sequences of undefined length, nested and with pixels of their own, are passed over.
    assert (frames.decode(data[:at] + nested + data[at:]) == cells).all()
    # Implicit representations: the same elements without their kinds.
    implicit, at = bytearray(data[: data.index(b"1.2.840")] + b"1.2.840.10008.1.2\0"), 132
    implicit[implicit.index(b"UI") + 2 : implicit.index(b"UI") + 4] = struct.pack("<H", 18)
    view = memoryview(data)
    at = data.index(struct.pack("<HH2s", 0x28, 2, b"US"))
    while at < len(data):
        tag, size, value = frames._head(view, at, True)
        implicit += struct.pack("<HHI", tag >> 16, tag & 0xFFFF, size) + data[value : value + size]
        at = value + size
    assert (frames.decode(bytes(implicit)) == cells).all()


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda d: d[:-3], "ends within"),
        (lambda d: b"x" * 200, "not an image"),
        (lambda d: d.replace(b"1.2.840.10008.1.2.1", b"1.2.840.10008.1.2.9"), "transfer syntax"),
        (lambda d: d[: d.index(struct.pack("<HH2s", 0x28, 0x100, b"US"))], "missing"),
    ],
)
def test_image_files_that_cannot_be_read(change, message):
    with pytest.raises(ValueError, match=message):
        frames.decode(change(frames.encode(random_frames(np.random.default_rng(2)))))


def test_frames_through_the_data_source(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = []
    for series in ("a/ct", "a/seg", "b"):
        for k in range(4):
            cells = random_frames(rng, 1 + k)
            rows += [(series, f"1-{k}.dcm", i, 5, 7, c.ravel().tolist()) for i, c in enumerate(cells)]
    df = spark.createDataFrame(rows, frames.SCHEMA).repartition(6)
    root = str(tmp_path / "images")
    assert frames.write_frames(df, root).agg(F.sum("frames")).first()[0] == len(rows)
    read = frames.read_frames(spark, root, partition_bytes=600)
    assert read.rdd.getNumPartitions() > 3
    assert sorted(map(tuple, read.collect())) == sorted(rows)
    # An aborted attempt leaves a file that is not read.
    (tmp_path / "images" / "b" / "_1-9.dcm.7").write_bytes(b"half")
    assert read.count() == frames.read_frames(spark, root).count() == len(rows)
    (tmp_path / "images" / "b" / "1-9.dcm").write_bytes(b"half")
    with pytest.raises(Exception, match="1-9.dcm: not an image file"):
        frames.read_frames(spark, root).collect()


def test_small_files_share_partitions_and_batches(tmp_path, monkeypatch):
    rng = np.random.default_rng(6)
    cells = {f"s/1-{k}.dcm": random_frames(rng, k % 3 + 1, 16, 4 + k % 2, 3) for k in range(24)}
    (tmp_path / "s").mkdir()
    for name, own in cells.items():
        (tmp_path / name).write_bytes(frames.encode(own))
    reader = frames.FrameReader({"path": str(tmp_path), "partitionbytes": str(4 * frames.OPEN_BYTES)})
    parts = reader.partitions()
    # Before, all small files were one partition and each was a batch of its own.
    assert len(parts) == 8 and sorted(n for p in parts for n in p.names) == sorted(cells)
    for most, batches in ((1 << 18, [1]), (40, [2, 3])):
        monkeypatch.setattr(frames, "BATCH_CELLS", most)
        for part in parts:
            found = list(reader.read(part))
            assert len(found) in batches
            rows = [tuple(r.values()) for b in found for r in b.to_pylist()]
            assert rows == [
                ("s", n[2:], i, *c.shape, c.ravel().tolist()) for n in part.names for i, c in enumerate(cells[n])
            ]


def test_an_empty_folder_has_no_frames(spark, tmp_path):
    assert frames.read_frames(spark, str(tmp_path)).count() == 0


def test_quoted_text_is_written_twice_only(spark, tmp_path):
    rng = random.Random(4)
    # Every document has many lines, so each line belongs to a longer record.
    rows = [(str(i), "\n".join("".join(rng.choices(string.ascii_letters + string.digits, k=70)) for _ in range(40))) for i in range(2000)]
    path = tmp_path / "long.csv"
    path.write_text("k,text\n" + "".join(f'{k},"{t}"\n' for k, t in rows))
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    size = lambda: sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    before, split = size(), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        found = quoted.read_quoted(spark, str(path))
        assert sorted(tuple(r) for r in found.collect()) == sorted(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    assert size() - before < 2.7 * path.stat().st_size


def test_lines_of_many_splits_in_one_batch():
    texts = ['a,"x', "y", 'z"', "b,c", 'd,"""', '"']
    kinds = [pa.string(), pa.int64(), pa.string()]
    columns = [["f"] * 6 + ["g"] * 6, [0, 0, 9, 9, 9, 20] + [0] * 5 + [7], texts * 2]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["file", "block", "value"])
    whole = [r for b in quoted._numbered(iter([batch])) for r in b.to_pylist()]
    parts = [r for b in quoted._numbered(iter([batch[:4], batch[4:4], batch[4:]])) for r in b.to_pylist()]
    assert whole == parts
    assert [r["at"] for r in whole] == [1, 2, 1, 2, 3, 1, 1, 2, 3, 4, 5, 1]
    assert [r["before"] for r in whole[6:]] == [False, True, True, False, False, False]
    assert [r["even_from"] for r in whole[6:]] == [1, 1, 1, 4, 5, 1]
    assert [r["odd_from"] for r in whole[6:]] == [0, 2, 3, 3, 3, 0]
