"""Files hashed in pieces by a data source, against a manifest."""

import hashlib
import os

from strata.operators.reconcile import reconcile_manifest
from strata.session import scratch_path
from strata.sources import folder
from strata.sources.folder import folder_hashes


def _write(root, files):
    for name, data in files.items():
        path = f"{root}/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as file:
            file.write(data)


FILES = {"top.bin": b"x", "empty": b"", "a/one": b"1" * 100, "a/b/c/deep": b"deep", "a/b/none": b"", "odd name [1]%20*/é.txt": b"odd"}


def _expected(files):
    return sorted((n, len(d), hashlib.sha256(d).hexdigest()) for n, d in files.items())


def test_every_file_is_hashed_once_however_it_is_dealt(spark, monkeypatch):
    root = scratch_path(spark, "hashes").removeprefix("file:")
    _write(root, FILES)
    for splits, per in ((1, 1000), (2, 1), (64, 1), (64, 1000)):
        assert sorted(map(tuple, folder_hashes(spark, root, splits, per).collect())) == _expected(FILES)
    assert sorted(map(tuple, folder_hashes(spark, f"file://{root}").collect())) == _expected(FILES)


def test_files_are_read_in_pieces(tmp_path, monkeypatch):
    monkeypatch.setattr(folder, "PIECE", 7)
    _write(str(tmp_path), {"f": b"abc" * 100})
    reader = folder._Reader(str(tmp_path), 64, 10)
    assert [row for part in reader.partitions() for row in reader.read(part)] == _expected({"f": b"abc" * 100})


def test_folders_are_shared_out(tmp_path):
    _write(str(tmp_path), {f"{k}/{j}": b"z" for k in range(20) for j in range(5)})
    reader = folder._Reader(str(tmp_path), 8, 3)
    parts = reader.partitions()
    assert len(parts) == 20 and all(len(p.folders) == 1 for p in parts)
    flat = folder._Reader(str(tmp_path / "3"), 8, 2).partitions()
    assert sorted(len(p.files) for p in flat) == [1, 2, 2]


def test_an_empty_folder(spark):
    root = scratch_path(spark, "nothing").removeprefix("file:")
    os.makedirs(root)
    assert folder_hashes(spark, root).count() == 0


def test_against_a_manifest(spark):
    root = scratch_path(spark, "manifest").removeprefix("file:")
    _write(root, FILES)
    listed = {n: hashlib.sha256(d).hexdigest() for n, d in FILES.items() if n != "a/one"} | {"gone": "0", "top.bin": "1"}
    manifest = spark.createDataFrame(list(listed.items()), "path STRING, content_hash STRING")
    states = {r["path"]: r["state"] for r in reconcile_manifest(folder_hashes(spark, root), manifest).collect()}
    assert states == {n: "ok" for n in FILES} | {"a/one": "stale", "gone": "missing", "top.bin": "changed"}
