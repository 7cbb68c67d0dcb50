import hashlib

import pytest
from pyspark.sql import functions as F

from catalogflow.llm import archive

PAGES = [
    (4, "http://a", "x" * 150), (2, None, "x" * 150), (9, "http://c\r\nEvil: 1", "x" * 150), (5, "http://d", "short"),
    (6, "http://e", "short"), (7, "u", None), (8, "u", ""), (None, "u", "y" * 120), (11, "u", "y" * 120),
    (12, "u", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "é" * 100), (4, "http://a", "x" * 150),
    (13, "u", "z" * 300_000), (14, "u", "é" * 49 + "a"), (15, "u", "é" * 49 + "a"), (16, "u", "é" * 50), (17, "u", "é" * 50),
]


@pytest.fixture
def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return df.withColumns({"digest": F.lit(1), "copy": F.lit("x"), "bytes": F.lit(None).cast("int"), "payload": F.lit("p")})


def expected():
    big = 2**63
    first, out, seen = {}, [], set()
    for i, _, h in PAGES:
        b = (h or "").encode()
        if len(b) >= 100:
            first[b] = min(first.get(b, big), big if i is None else i)
    for i, _, h in PAGES:
        b, d = (h or "").encode(), hashlib.sha256((h or "").encode()).hexdigest()
        head = first.get(b)
        if head is None or (head == (big if i is None else i) and b not in seen):
            seen.add(b)
            out.append((i, len(b), d, "response", None))
        else:
            out.append((i, len(b), d, "revisit", None if head == big else head))
    return sorted(out, key=repr)


def test_round_trip(spark, pages, rows, tmp_path):
    path = archive.write_archive(pages, str(tmp_path / "a"))
    found = archive.read_archive(spark, path)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows(archive.resolved(archive.parse_records(found)), *names) == expected()
    stored = spark.read.parquet(f"{path}/payloads")
    assert stored.count() == len({h or "" for _, _, h in PAGES})
    archive.export_warc(found, str(tmp_path / "w"))
    again = archive.read_warc(spark, str(tmp_path / "w/*.txt"))
    assert rows(again) == rows(found, "record")
    assert rows(archive.resolved(archive.parse_records(again)), *names) == expected()


def test_damage_is_found(spark, pages, tmp_path):
    path = archive.write_archive(pages, str(tmp_path / "a"))
    found = archive.read_archive(spark, path)
    bad = found.withColumn("record", F.expr("cast(replace(cast(record as string), 'yyyy', 'yyyz') as binary)"))
    with pytest.raises(Exception, match="damaged record"):
        archive.parse_records(bad).select("payload").collect()


def test_empty(spark, pages, rows, tmp_path):
    path = archive.write_archive(pages.limit(0), str(tmp_path / "a"))
    assert rows(archive.resolved(archive.parse_records(archive.read_archive(spark, path)))) == []
