"""Large files are hashed range by range, to the same SHA-256."""

import gzip
import hashlib
import os

import pytest

from scorelake.sources import hashing, tables

NOISE = os.urandom(400_000)
CONTENTS = {
    "noise.bin": NOISE, "ends[1] {a}.csv": b"a,b\r\n\n\n" * 40_000, "open.csv": b"\n\n" + b"x,y\n" * 50_000 + b"z", "mark.csv": hashing.BYTE_ORDER_MARK + b"q\n" * 90_000,
    "mark-open.csv": hashing.BYTE_ORDER_MARK + b"q\n" * 90_000 + b"q", "one-line.txt": b"\0" * 200_000, "packed.csv.gz": gzip.compress(NOISE), "lines.txt": b"\n" * 100_000, "small.txt": b"abc",
}


@pytest.fixture
def narrow(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 16)
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_same_hash_by_ranges(narrow, tmp_path):
    for name, data in CONTENTS.items():
        (tmp_path / name).write_bytes(data)
    found = {r.path.rsplit("/", 1)[1]: r.sha256 for r in tables.file_hashes(narrow, str(tmp_path), whole=80_000).collect()}
    assert found == {name: hashlib.sha256(data).hexdigest() for name, data in CONTENTS.items()}


def test_no_task_reads_all(narrow, tmp_path):
    (tmp_path / "noise.bin").write_bytes(NOISE)
    narrow.sparkContext.setJobGroup("hash", "hash")
    try:
        tables.file_hashes(narrow, str(tmp_path / "noise.bin"), whole=80_000)
        tracker = narrow.sparkContext.statusTracker()
        jobs = tracker.getJobIdsForGroup("hash")
    finally:
        narrow.sparkContext.setJobGroup("other", "other")
    assert len(jobs) >= len(NOISE) // (1 << 16)
