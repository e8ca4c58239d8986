"""SHA-256 of large files, a range of bytes a task.

Each block of SHA-256 needs the state after all blocks before it, so ranges are hashed one after the other; what passes from task
to task is that state, about 100 bytes. A range is read as lines (the text source can read a part of a file anywhere Spark can) and
line ends are put back, so memory holds a batch of lines.
"""

from __future__ import annotations

import _hashlib
import ctypes
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from scorelake.session import ship_by_value

ship_by_value(__name__)

#: The text source leaves it out at the start of a file.
BYTE_ORDER_MARK = b"\xef\xbb\xbf"


class Sha256:
    """SHA-256 by the library below ``hashlib``, which gives no access to the state between two updates."""

    def __init__(self, state: bytes | None = None):
        self._lib = ctypes.CDLL(_hashlib.__file__)
        # SHA256_CTX of openssl/sha.h: 28 words.
        self._ctx = ctypes.create_string_buffer(112)
        if state is None:
            self._lib.SHA256_Init(self._ctx)
        else:
            ctypes.memmove(self._ctx, state, 112)

    @property
    def state(self) -> bytes:
        return self._ctx.raw[:112]

    def update(self, data: bytes) -> None:
        self._lib.SHA256_Update(self._ctx, ctypes.c_char_p(data), ctypes.c_size_t(len(data)))

    def hexdigest(self) -> str:
        out, last = ctypes.create_string_buffer(32), ctypes.create_string_buffer(self.state, 112)
        self._lib.SHA256_Final(out, last)
        return out.raw.hex()


def resumable() -> bool:
    """Whether this Python's library lets a hash go on from a state."""
    try:
        first = Sha256()
        first.update(b"x" * 100)
        then = Sha256(first.state)
        then.update(b"y" * 100)
        return then.hexdigest() == hashlib.sha256(b"x" * 100 + b"y" * 100).hexdigest()
    except (OSError, AttributeError):
        return False


def _next_range(state: bytes, length: int, block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """State, bytes so far and start of the range, after the lines of one range. ``length`` is -1 before the first line."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, done, at = Sha256(state), length, block
        for batch in batches:
            if not batch.num_rows:
                continue
            starts = batch.column(1)
            if starts[0].as_py() < at:
                raise ValueError("ranges are out of order")
            at = starts[-1].as_py()
            data = b"\n".join([*([b""] if done >= 0 else []), *batch.column(0).to_pylist()])
            digest.update(data)
            done = max(done, 0) + len(data)
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (digest.state, done, at)], ["state", "length", "block"])

    return add


def sha256_by_ranges(spark: SparkSession, path: str, size: int) -> str | None:
    """SHA-256 of a file of ``size`` bytes; None if the text source changes it, as it does with compressed files."""
    # The path is one file's, whatever characters it has.
    lines = spark.read.text(re.sub(r"([\\\[\]{}*?])", r"\\\1", path), lineSep="\n")
    lines = lines.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_block_start").alias("block"))
    ranges = lines.rdd.getNumPartitions()

    def chained(head: bytes) -> tuple[Sha256, int]:
        digest = Sha256()
        digest.update(head)
        state, length, block = digest.state, -1, 0
        for i in range(ranges):
            hashed: DataFrame = lines.mapInArrow(_next_range(state, length, block), "state binary, length long, block long")
            # One row.
            ((state, length, block),) = spark.sparkContext.runJob(hashed.rdd, lambda rows: [tuple(r) for r in rows], [i])
            if length > size:
                break
        return Sha256(bytes(state)), size - len(head) - max(length, 0)

    for head in (b"", BYTE_ORDER_MARK):
        digest, left = chained(head)
        if left in (0, 1):
            # The end of the last line, if there is one.
            digest.update(b"\n" * left)
            return digest.hexdigest()
        if left not in (3, 4):
            return None
    return None
