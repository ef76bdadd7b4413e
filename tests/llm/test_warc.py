import base64
import gzip
import hashlib
import io
import random
import zlib

import pytest
from helpers import clashing
from pyspark.sql import functions as F

from shiplabel.llm import warc

SCHEMA = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def odd_pages():
    rng = random.Random(4)
    body = lambda n: "".join(rng.choice("<p>äbc\n defghi") for _ in range(n))
    rows = [(i, f"http://a.example/{i}?q=ü\r\nx", body(rng.choice([0, 5, 400, 9000]))) for i in range(40)]
    rows += [(100 + i, None, rows[3][2]) for i in range(5)]
    rows += [(200, "u", None), (201, "v", ""), (None, "w", rows[4][2]), (None, None, "lone"), (7, "z", rows[7][2])]
    rows += [(300, "same", "repeated")] * 4 + [(None, None, "nulls")] * 2 + [(301, "long", body(300_000))]
    return rows


def brute(rows, least=0):
    out = []
    by_text = {}
    for page_id, url, html in rows:
        by_text.setdefault(html or "", []).append((page_id is None, page_id or 0, url is None, url or "", page_id))
    for html, found in by_text.items():
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        for i, key in enumerate(sorted(found)):
            first = i == 0 or len(data) < least
            out.append((key[4], len(data), digest, "response" if first else "revisit", None if first else sorted(found)[0][4]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [0, 100])
@pytest.mark.parametrize("split", [1 << 20, 501])
def test_written_and_read(spark, least, split):
    rows = odd_pages()
    got = warc.archived(clashing(pages(spark, rows)).repartition(3), None, least, split)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, least)


def test_hot_copies_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(warc, "HOT_COPIES", 20)
    monkeypatch.setattr(warc, "REPEATS", 7)
    rows = [(i, f"u{i}", "copy") for i in range(300)] + [(1000, "r", "again")] * 60 + [(i, "x", str(i)) for i in range(400, 500)]
    got = warc.archived(pages(spark, rows), split_bytes=1000)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_archives_are_plain_gzip(spark, tmp_path):
    rows = odd_pages()
    warc.write(pages(spark, rows).coalesce(1), str(tmp_path / "w"))
    text = b"".join(gzip.decompress(path.read_bytes()) for path in (tmp_path / "w").glob("part-*"))
    assert text.count(b"WARC/1.0\r\n") == len(rows)
    found = warc.index(spark, str(tmp_path / "w"), 1000).where("record_type = 'response'")
    payloads = {r["payload"].decode() for r in warc.payloads(found).collect()}
    assert payloads == {r[2] or "" for r in rows}
    ids = [r[0] for r in found.select(F.col("headers")["WARC-Record-ID"]).collect()]
    assert len(set(ids)) == len(ids)


def test_a_record_of_16_mib_and_more():
    payload = random.Random(1).randbytes(17 << 20)
    written = warc.member([("WARC-Type", "resource")], b"", payload, 1) + b"\0"
    assert warc.member([("WARC-Type", "resource")], b"", b"", 1)[-1:] != b"" and len(gzip.decompress(written)) > len(payload)
    ((at, record),) = warc.owned(io.BytesIO(written), 0, len(written))
    assert at == 0 and record.n == len(payload) and record.row("p", 0, 0)[-1]


def test_ranges_own_what_starts_inside(spark, tmp_path):
    """An archive stored inside a record, false magic, rubbish between records and a cut-off record."""
    rng = random.Random(2)
    one = lambda payload, level=6: warc.member([("WARC-Type", "resource")], b"", payload, level) + b"\0"
    inner = b"".join(one(rng.randbytes(200)) for _ in range(30))
    parts = [one(b"a" * 50), one(rng.randbytes(900)), one(inner, 0), one(warc.MAGIC * 40, 0), zlib.compress(b"no record" * 30, wbits=31), one(b"b" * 9), one(rng.randbytes(500))[:-200]]
    places = [sum(map(len, parts[:i])) for i in (0, 1, 2, 3, 5, 6)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.warc.gz").write_bytes(b"".join(parts))
    for split in (100, 333, 1 << 20):
        rows = warc.index(spark, str(tmp_path / "a"), split).orderBy("offset").collect()
        assert [r["offset"] for r in rows] == places
        assert [r["whole"] for r in rows] == [True] * 5 + [False]
    with pytest.raises(Exception, match="damaged record"):
        found = warc.index(spark, str(tmp_path / "a"), 100).withColumn("record_type", F.lit("response"))
        warc.page_records(found).collect()


def test_empty(spark):
    assert warc.archived(pages(spark, [])).count() == 0
