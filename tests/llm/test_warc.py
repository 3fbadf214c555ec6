import hashlib
import io
import random
import zlib
from base64 import b32encode

from stratamart.llm.warc import archive_round_trip, members, read_archive, write_archive

SCHEMA = "page_id long, url string, html string, record_type string"


def expected(rows):
    first = {}
    for page_id, _, html, _ in rows:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    out = []
    for page_id, _, html, _ in rows:
        payload, to = (html or "").encode(), first.get(html or "")
        revisit = page_id != to
        sha = b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page_id, len(payload), sha, "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


def got(df):
    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


ROWS = [
    (5, "http://a.example/ä b\r\nX: y", "<p>same</p>", "clash"),
    (3, None, "<p>same</p>", None),
    (9, "http://b.example", None, None),
    (8, "http://b.example", "", None),
    (1, "http://c.example", "line\r\n\r\nWARC/1.1\r\n" * 50, None),
    (2, "http://d.example", "é ü" * 200_000, None),
    (None, "http://e.example", "<p>same</p>", None),
    (3, None, "<p>same</p>", None),
]


def test_round_trip(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert got(archive_round_trip(df)) == expected(ROWS)
    assert got(archive_round_trip(df, split_bytes=97)) == expected(ROWS)


def test_payloads_come_back(spark, tmp_path):
    df = spark.createDataFrame(ROWS[:6], SCHEMA)
    manifest = write_archive(df, str(tmp_path / "out"), file_bytes=200)
    rows = read_archive(manifest, 64).where("record_type = 'response'").collect()
    assert sorted(bytes(r.payload).decode() for r in rows) == sorted({x[2] or "" for x in ROWS[:6]})
    assert manifest.agg({"records": "sum"}).first()[0] == 6


def test_small_payloads_are_not_revisited(spark, tmp_path):
    df = spark.createDataFrame(ROWS[:4], SCHEMA)
    kinds = read_archive(write_archive(df, str(tmp_path / "out"), smallest_revisit=12)).collect()
    assert {r.record_type for r in kinds} == {"response"}


def test_every_range_cut_finds_each_member_once():
    rng = random.Random(1)
    raw = b""
    for k in range(20):
        noise = bytes(rng.randrange(256) for _ in range(300)) + b"\x1f\x8b\x08\x00"
        packer = zlib.compressobj(0 if k % 2 else 6, zlib.DEFLATED, 31)
        raw += packer.compress(b"WARC/1.1\r\nContent-Length: 0\r\n\r\n%d" % k + noise) + packer.flush()
    whole = list(members(io.BytesIO(raw), len(raw), 0, len(raw)))
    assert len(whole) == 20
    for cut in (1, 7, 150, 333, 1000):
        parts = [m for s in range(0, len(raw), cut) for m in members(io.BytesIO(raw), len(raw), s, min(len(raw), s + cut))]
        assert parts == whole


def test_empty_table(spark):
    assert archive_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
