import hashlib
import struct

import pyarrow.fs

from lodestone.llm import warc
from lodestone.llm.common import fresh_dir, prepare


def test_round_trip_and_revisits(spark):
    big, small = "<p>" + "x é " * 60, "tiny"
    rows = [(5, "http://a/", big, "q"), (2, "http://b/\r\nX: y", big, "q"), (9, None, big, "q"), (1, "u", small, "q"), (3, "u", small, "q"), (4, "u", None, "q"), (6, "u", "", "q"), (None, "u", big, "q"), (2, "http://b/", big, "q")]
    prepare(spark)
    uri = fresh_dir(spark, "warc")
    archives = warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string, digest string"), uri)
    got = sorted((tuple(r) for r in warc.read_warc(archives, uri).drop("url").collect()), key=str)
    want = []
    for pid, _, html, _ in rows:
        raw = (html or "").encode()
        revisit = len(raw) >= 100 and pid != 2
        want.append((pid, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None))
    assert got == sorted(want, key=str)
    fs, folder = pyarrow.fs.FileSystem.from_uri(uri)
    files = [f for f in fs.get_file_info(pyarrow.fs.FileSelector(folder)) if f.path.endswith(".warc.zst")]
    assert files and sum(r.records for r in archives.collect()) == len(rows)
    with open(files[0].path, "rb") as f:
        assert struct.unpack("<I", f.read(4))[0] == warc.DICT_MAGIC


def test_empty_table(spark):
    prepare(spark)
    uri = fresh_dir(spark, "warc")
    archives = warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), uri)
    assert warc.read_warc(archives, uri).collect() == []


def test_payloads_come_back(tmp_path):
    recs = [warc.record(k, "http://h/", f"body {k} {'y' * k}".encode(), "d", None) for k in range(40)]
    w = warc.ArchiveWriter(pyarrow.fs.LocalFileSystem(), str(tmp_path), 0, "a", recs)
    for r in recs:
        w.write(r)
    w.close()
    with open(w.done[0][0], "rb") as f:
        back = list(warc.read_archive(f))
    assert [b.split(b"\r\n\r\n", 1)[1] for _, b in back] == [f"body {k} {'y' * k}".encode() for k in range(40)]


def test_a_payload_of_many_megabytes_and_its_copies(spark):
    big = "".join(chr(0x4E00 + k % 5000) for k in range(1_500_000)) + "z" * 3_000_000
    rows = [(k, "u", big) for k in (4, 2, 8)] + [(1, "u", "short")] * 3
    prepare(spark)
    uri = fresh_dir(spark, "warc")
    got = sorted(tuple(r) for r in warc.read_warc(warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), uri), uri).drop("url", "payload_digest").collect())
    n = len(big.encode())
    assert got == [(1, 5, "response", None)] * 3 + [(2, n, "response", None), (4, n, "revisit", 2), (8, n, "revisit", 2)]
