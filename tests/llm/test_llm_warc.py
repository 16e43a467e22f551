import base64
import glob
import gzip
import hashlib

import pytest

from tillroll.llm import warc
from tillroll.session import scratch_path

ROWS = [(5, "http://a.org/x y\r\nInjected: 1", "<p>one</p>"), (3, "http://b.org/", "<p>one</p>"), (3, "http://b.org/", "<p>one</p>"),
        (7, None, None), (8, "http://c.org/é", ""), (None, "http://d.org/", "<p>two</p>"), (9, "http://e.org/", "<p>two</p>"),
        (10, "http://f.org/", "\r\n\r\nWARC/1.1\r\n\r\n" + "ü" * 300_000), (11, "u", "small"), (12, "u", "small")]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows],
                                 "page_id long, url string, html string, URL string, record_type string")


def expected(rows, least=0):
    out, seen = [], {}
    for p, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        raw = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        first = seen.setdefault(digest, (p,)) if len(raw) >= least else None
        again = first is not None and (digest, "met") in seen
        seen[digest, "met"] = True
        out.append((p, len(raw), digest, "revisit" if again else "response", first[0] if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least,roll", [(0, 64 << 20), (6, 300)])
def test_records_come_back(spark, least, roll):
    folder = scratch_path(spark, "t_warc")
    manifest = warc.write(pages(spark, ROWS), folder, shards=3, roll_bytes=roll, revisit_bytes=least)
    got = warc.read(spark, folder).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=repr) == expected(ROWS, least)
    files = manifest.collect()
    assert sum(f.records for f in files) == len(ROWS) and (roll > 1000 or len(files) > 3)
    for f in files:  # any gzip reader can read them, and the manifest tells the truth
        with open(f"{folder.removeprefix('file:')}/{f.file}", "rb") as stream:
            raw = stream.read()
        assert len(raw) == f.bytes and hashlib.sha256(raw).hexdigest() == f.sha256
        assert gzip.decompress(raw).count(b"WARC-Type: ") == f.records
    assert b"Injected: 1\r\n" not in b"".join(gzip.decompress(open(g, "rb").read()) for g in glob.glob(f"{folder.removeprefix('file:')}/*.gz"))


def test_writing_again_gives_the_same_bytes(spark):
    shas = []
    for _ in range(2):
        folder = scratch_path(spark, "t_warc_again")
        shas.append(sorted((r.file, r.sha256) for r in warc.write(pages(spark, ROWS).repartition(4), folder, shards=2).collect()))
    assert shas[0] == shas[1]


def test_many_pages_give_the_same_files_whatever_the_partitions(spark):
    """Far more rows than a range partitioning samples, in other orders and partitions."""
    made = spark.range(60_000).selectExpr("id * 7919 % 60000 AS page_id", "concat('http://h/', id) AS url",
                                          "repeat(cast(id % 5000 AS string), cast(id % 90 AS int)) AS html")
    found = []
    for parts in (3, 7):
        folder = scratch_path(spark, "t_warc_many")
        manifest = warc.write(made.repartition(parts, "html"), folder, shards=6)
        found.append(sorted((r.file, r.shard, r.records, r.sha256) for r in manifest.collect()))
    assert found[0] == found[1] and {r[1] for r in found[0]} == set(range(6)) and sum(r[2] for r in found[0]) == 60_000
    sizes = [r[2] for r in found[0]]
    assert max(sizes) < 2 * min(sizes)


def test_addresses_that_spark_takes():
    with pytest.raises(Exception) as e:
        warc.open_store("nostore://x/y")
    assert "nostore" in str(e.value)
    assert warc.open_store("file:///tmp/x")[1] == "/tmp/x"


def test_files_without_a_manifest_row_are_not_read(spark):
    folder = scratch_path(spark, "t_warc_left")
    warc.write(pages(spark, ROWS[:2]), folder, shards=1)
    with open(f"{folder.removeprefix('file:')}/shard-00099-00000.warc.gz", "wb") as f:
        f.write(b"half a record")
    assert warc.read(spark, folder).count() == 2
    assert not glob.glob(f"{folder.removeprefix('file:')}/_temporary*")


def test_a_broken_record_is_an_error():
    member = gzip.decompress(warc.record(1, "http://a/", b"payload", "00" * 32, 0, None))
    fields, block = warc.parse(member)
    assert block.endswith(b"payload") and fields["WARC-Record-ID"] == "<urn:x-page:1:0000000000000000:0>"
    with pytest.raises(ValueError):
        warc.parse(member.replace(b"payload", b"Payload"))


def test_empty_table(spark):
    folder = scratch_path(spark, "t_warc_none")
    assert warc.write(pages(spark, []), folder).count() == 0
    assert warc.read(spark, folder).count() == 0
