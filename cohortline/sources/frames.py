"""Image series in files, as a data source of decoded frames.

``register(spark)`` makes the format ``image_frames`` known: it reads a folder of
image files, each with one or more frames, in partitions of some files each. The
files follow the public medical image file format (part 10, little endian, not
compressed): tagged elements, of which only those of the pixels are kept.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cohortline.sources.files import get_file, list_files, put_file, system_of

FORMAT = "image_frames"
SCHEMA = "path string, file_name string, frame int, height int, width int, pixels array<int>"
# Files of one partition hold about this many bytes; a larger file is one of its own.
PARTITION_BYTES = 32 << 20
# Opening a file takes as long as reading this many bytes, so small files make partitions too.
OPEN_BYTES = 32 << 10
# Pixels and rows of a batch; a larger file is one of its own.
BATCH_CELLS = 1 << 18

# Fixed values of the file format: transfer syntaxes, and value representations with a long length field.
IMPLICIT, EXPLICIT = "1.2.840.10008.1.2", "1.2.840.10008.1.2.1"
LONG_LENGTH = {b"OB", b"OD", b"OF", b"OL", b"OV", b"OW", b"SQ", b"SV", b"UC", b"UN", b"UR", b"UT", b"UV"}
SYNTAX, SAMPLES, FRAMES = 0x00020010, 0x00280002, 0x00280008
ROWS, COLUMNS, BITS, SIGNED, PIXELS = 0x00280010, 0x00280011, 0x00280100, 0x00280103, 0x7FE00010
ITEM, ITEM_END, SEQUENCE_END = 0xFFFEE000, 0xFFFEE00D, 0xFFFEE0DD
UNDEFINED = 0xFFFFFFFF
WANTED = {SYNTAX, SAMPLES, FRAMES, ROWS, COLUMNS, BITS, SIGNED, PIXELS}


def _head(data: memoryview, at: int, explicit: bool) -> tuple[int, int, int]:
    """Tag and length of the element at ``at``, and where its value begins."""
    group, element = struct.unpack_from("<HH", data, at)
    tag = group << 16 | element
    if not explicit or group == 0xFFFE:
        return tag, struct.unpack_from("<I", data, at + 4)[0], at + 8
    if bytes(data[at + 4 : at + 6]) in LONG_LENGTH:
        return tag, struct.unpack_from("<I", data, at + 8)[0], at + 12
    return tag, struct.unpack_from("<H", data, at + 6)[0], at + 8


def _behind(data: memoryview, at: int, explicit: bool) -> int:
    """Where a sequence of undefined length ends; items may hold sequences again."""
    open_parts = 1
    while open_parts:
        tag, size, at = _head(data, at, explicit)
        if tag in (ITEM_END, SEQUENCE_END):
            open_parts -= 1
        elif size == UNDEFINED:
            open_parts += 1
        elif tag != ITEM:
            at += size
        # An item of known length is walked through: what it holds counts for itself.
    return at


def elements(data: bytes) -> dict[int, bytes]:
    """The wanted elements of a file by their tags."""
    view = memoryview(data)
    if data[128:132] != b"DICM":
        raise ValueError("not an image file")
    found: dict[int, bytes] = {}
    at, explicit = 132, True
    while at + 8 <= len(data):
        # The first group is always explicit; the others as it says.
        if struct.unpack_from("<H", view, at)[0] > 2 and SYNTAX in found:
            syntax = found[SYNTAX].rstrip(b"\0 ").decode()
            if syntax not in (IMPLICIT, EXPLICIT):
                raise ValueError(f"pixels in transfer syntax {syntax} are not read")
            explicit = syntax == EXPLICIT
        tag, size, at = _head(view, at, explicit)
        if size == UNDEFINED:
            if tag == PIXELS:
                raise ValueError("compressed pixels are not read")
            at = _behind(view, at, explicit)
            continue
        if at + size > len(data):
            raise ValueError("the file ends within an element")
        if tag in WANTED:
            found[tag] = bytes(view[at : at + size])
        at += size
    return found


def decode(data: bytes) -> np.ndarray:
    """Frames of a file, ``(frame, row, column)``, as they are stored."""
    found = elements(data)
    missing = {ROWS, COLUMNS, BITS, PIXELS} - found.keys()
    if missing:
        raise ValueError(f"elements are missing: {sorted(map(hex, missing))}")
    number = lambda tag, default: struct.unpack("<H", found[tag])[0] if tag in found else default
    if number(SAMPLES, 1) != 1:
        raise ValueError("only one sample for each pixel is read")
    n = int(found[FRAMES].strip(b"\0 ") or 1) if FRAMES in found else 1
    height, width, bits = number(ROWS, 0), number(COLUMNS, 0), number(BITS, 0)
    if bits == 1:
        cells = np.unpackbits(np.frombuffer(found[PIXELS], np.uint8), bitorder="little")
    elif bits in (8, 16, 32):
        kind = f"<{'i' if number(SIGNED, 0) else 'u'}{bits // 8}"
        cells = np.frombuffer(found[PIXELS][: n * height * width * bits // 8], kind)
    else:
        raise ValueError(f"{bits} bits for a pixel are not read")
    return cells[: n * height * width].reshape(n, height, width)


def encode(frames: np.ndarray, bits: int = 16) -> bytes:
    """A file of the frames ``(frame, row, column)``, of unsigned pixels."""
    n, height, width = frames.shape
    if frames.size and not 0 <= int(frames.min()) <= int(frames.max()) < 1 << bits:
        raise ValueError(f"pixels do not fit into {bits} bits")
    if bits == 1:
        cells = np.packbits(frames.ravel().astype(np.uint8), bitorder="little").tobytes()
    else:
        cells = frames.astype(f"<u{bits // 8}").tobytes()

    def even(value: bytes, pad: bytes = b"\0") -> bytes:
        return value + pad * (len(value) % 2)

    def element(tag: int, kind: bytes, value: bytes) -> bytes:
        head = struct.pack("<HH2s", tag >> 16, tag & 0xFFFF, kind)
        size = struct.pack("<HI", 0, len(value)) if kind in LONG_LENGTH else struct.pack("<H", len(value))
        return head + size + value

    def short(tag: int, value: int) -> bytes:
        return element(tag, b"US", struct.pack("<H", value))

    syntax = element(SYNTAX, b"UI", even(EXPLICIT.encode()))
    first = element(0x00020000, b"UL", struct.pack("<I", len(syntax)))
    body = [
        short(SAMPLES, 1), element(FRAMES, b"IS", even(str(n).encode(), b" ")), short(ROWS, height), short(COLUMNS, width),
        short(BITS, bits), short(SIGNED, 0), element(PIXELS, b"OW" if bits == 16 else b"OB", even(cells)),
    ]
    return bytes(128) + b"DICM" + first + syntax + b"".join(body)


@dataclass
class FilesPartition(InputPartition):
    """Some files: their paths below the root."""

    names: list[str]


class FrameReader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.root = options["path"].rstrip("/")
        self.bytes = int(options.get("partitionbytes", PARTITION_BYTES))

    def partitions(self) -> list[FilesPartition]:
        root = system_of(self.root)[1]
        parts: list[list[str]] = []
        held = 0
        for path, size in list_files(self.root):
            size += OPEN_BYTES
            if not parts or held + size > self.bytes:
                parts.append([])
                held = 0
            parts[-1].append(path[len(root) + 1 :])
            held += size
        return [FilesPartition(p) for p in parts or [[]]]

    def read(self, partition: FilesPartition) -> Iterator[pa.RecordBatch]:
        held, cells = [], 0
        for name in partition.names:
            try:
                frames = decode(get_file(f"{self.root}/{name}"))
            except ValueError as error:
                raise ValueError(f"{self.root}/{name}: {error}") from error
            if held and cells + frames.size + len(frames) > BATCH_CELLS:
                yield _batch(held)
                held, cells = [], 0
            held.append((name, frames))
            cells += frames.size + len(frames)
        if held:
            yield _batch(held)


def _batch(files: list[tuple[str, np.ndarray]]) -> pa.RecordBatch:
    """A row for each frame of the files."""
    counts, heights, widths = (np.array(x) for x in zip(*[f.shape for _, f in files], strict=True))
    names = [name.rpartition("/") for name, f in files for _ in range(len(f))]
    height, width = (np.repeat(x, counts).astype(np.int32) for x in (heights, widths))
    ends = np.concatenate([[0], np.cumsum(height.astype(np.int64) * width)])
    pixels = np.concatenate([f.ravel().astype(np.int32) for _, f in files])
    return pa.RecordBatch.from_arrays(
        [
            pa.array([n[0] for n in names], pa.string()), pa.array([n[2] for n in names], pa.string()),
            pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in counts])), pa.array(height), pa.array(width),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pixels)),
        ],
        ["path", "file_name", "frame", "height", "width", "pixels"],
    )


class FrameSource(DataSource):
    """Decoded frames of all image files below a folder."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FrameReader:
        return FrameReader(self.options)


def read_frames(spark: SparkSession, root: str, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """``path, file_name, frame, height, width, pixels`` of all image files below ``root``.

    ``path`` is the folder of a file below the root, as the catalogue names series.
    A file that cannot be read stops the job and is named.
    """
    spark.dataSource.register(FrameSource)
    return spark.read.format(FORMAT).option("partitionBytes", partition_bytes).load(root)


def write_frames(frames: DataFrame, root: str, bits: int = 16) -> DataFrame:
    """Write frames as image files below ``root``; one row ``path, file_name, frames`` for each file.

    The frames of a file meet in a task, in order; their number is what a file may hold.
    """

    def write(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def close() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            first = held[0]
            cells = np.array([r["pixels"] for r in held]).reshape(len(held), first["height"], first["width"])
            put_file(f"{root}/{first['path']}/{first['file_name']}", [encode(cells, bits)])
            yield pa.RecordBatch.from_pydict(
                {"path": [first["path"]], "file_name": [first["file_name"]], "frames": pa.array([len(held)], pa.int32())}
            )
            held.clear()

        for part in parts:
            for row in part.to_pylist():
                if held and (held[0]["path"], held[0]["file_name"]) != (row["path"], row["file_name"]):
                    yield from close()
                held.append(row)
        yield from close()

    file = ["path", "file_name"]
    ordered = frames.select(*file, "frame", "height", "width", "pixels").repartition(*file)
    return ordered.sortWithinPartitions(*file, "frame").mapInArrow(write, "path string, file_name string, frames int")
