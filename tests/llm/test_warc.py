import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.frames import small_frame
from rowtide.llm.warc import inflated, parse, payload_digest, read_archives, resolve, write_archives
from tests.llm.data import rows, same_rows, table

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("digest", T.StringType()), T.StructField("refers_to", T.StringType())])


def pages_of(spark, pages):
    return small_frame(spark, [(*p, "x", "y") for p in pages], SCHEMA)


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def expected(pages, least=0):
    out = []
    for i, _, html in pages:
        html = html or ""
        same = [j for j, _, h in pages if (h or "") == html and j is not None]
        first = max(same, default=None)
        again = len(html.encode()) >= least and first is not None and i != first
        out.append((i, len(html.encode()), digest(html), "revisit" if again else "response", first if again else None))
    return out


def back(spark, pages, path, **how):
    write_archives(pages, path, **how)
    return read_archives(spark, path)


def short(frame):
    return rows(frame.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


ODD = [
    (1, "http://a", "same"),
    (2, None, "same"),
    (3, "http://c\r\nX: y", "same"),
    (4, "http://d", None),
    (5, "http://e", ""),
    (6, "http://f", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (7, "http://g", "x" * 300_000),
    (8, "http://h", "Content-Length: 5\r\n\r\n"),
    (None, "http://n", "same"),
    (9, "http://i", "alone"),
    (9, "http://i", "alone"),
]


def test_round_trip_of_odd_pages(spark, tmp_path):
    got = back(spark, pages_of(spark, ODD), str(tmp_path / "w"))
    assert same_rows(short(got), expected(ODD))


def test_small_payloads_may_all_be_responses(spark, tmp_path):
    got = back(spark, pages_of(spark, ODD), str(tmp_path / "w"), min_bytes=5)
    assert same_rows(short(got), expected(ODD, 5))


def test_given_pages_with_copies(spark, tmp_path):
    own = table(spark, "pages")
    pages = own.union(own.where("page_id % 3 = 0").withColumn("page_id", F.col("page_id") + 1000))
    got = short(back(spark, pages, str(tmp_path / "w"), file_bytes=20_000))
    assert same_rows(got, expected([tuple(r) for r in pages.select("page_id", "url", "html").collect()]))


def test_resolved_payloads_are_the_pages(spark, tmp_path):
    pages = [p for p in ODD if p[0] is not None]
    got = resolve(back(spark, pages_of(spark, pages), str(tmp_path / "w")))
    assert same_rows([(r.page_id, bytes(r.payload).decode()) for r in got.collect()], [(i, h or "") for i, _, h in pages])


def test_many_records_in_one_file(spark, tmp_path):
    pages = [(i, "u", f"p{i}") for i in range(1203)]
    write_archives(pages_of(spark, pages).coalesce(1), str(tmp_path / "w"))
    assert same_rows(short(read_archives(spark, str(tmp_path / "w"))), expected(pages))


def test_files_are_plain_warc(spark, tmp_path):
    write_archives(pages_of(spark, ODD), str(tmp_path / "w"))
    whole = b"".join(gzip.open(p).read() for p in (tmp_path / "w").glob("*.gz"))
    assert whole.startswith(b"WARC/1.1\r\n") and whole.endswith(b"\r\n\r\n") and len(list(parse(whole))) == len(ODD)
    assert whole.count(b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n") == 4


def test_damage_is_seen(spark, tmp_path):
    write_archives(pages_of(spark, [(1, "u", "abcdef")]), str(tmp_path / "w"))
    whole = b"".join(gzip.open(p).read() for p in (tmp_path / "w").glob("*.gz"))
    with pytest.raises(ValueError):
        list(parse(whole.replace(b"abcdef", b"abcdeX")))


def test_empty(spark, tmp_path):
    assert short(back(spark, pages_of(spark, []), str(tmp_path / "w"))) == []


def test_digest(spark):
    got = spark.range(200).select(F.col("id").cast("string").alias("t")).select("t", payload_digest(F.col("t")).alias("d")).collect()
    assert all(r.d == digest(r.t) for r in got)


def test_a_member_per_record_and_other_record_types(spark, tmp_path):
    write_archives(pages_of(spark, ODD), str(tmp_path / "w"))
    whole = b"".join(gzip.open(p).read() for p in (tmp_path / "w").glob("*.gz"))
    info = b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: 3\r\n\r\na b\r\n\r\n"
    parts = [info] + [b"WARC/1.1\r\nWARC-Type: re" + x for x in whole.split(b"WARC/1.1\r\nWARC-Type: re")[1:]]
    (tmp_path / "usual").mkdir()
    (tmp_path / "usual" / "a.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    assert same_rows(short(read_archives(spark, str(tmp_path / "usual"))), expected(ODD))


def test_pieces_of_any_size():
    data = b"".join(gzip.compress(bytes([65 + k]) * (k * 1000)) for k in range(20))
    whole = b"".join(bytes([65 + k]) * (k * 1000) for k in range(20))
    for step in (1, 7, 64, 1000, 1 << 20):
        assert b"".join(inflated(data, step)) == whole
    with pytest.raises(ValueError):
        list(inflated(data[:-5], 64))
    with pytest.raises(ValueError):
        list(parse(b"WARC/1.1\r\nContent-Length: 900\r\n\r\nabc"))
