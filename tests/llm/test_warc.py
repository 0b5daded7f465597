import base64
import hashlib
import os
import random
import zlib

import duckdb
import pytest

from closeledger.llm import warc
from closeledger.llm.warc import archives, key_of, op13_warc, oracle_sql, payloads, read_index, record, write_warc

SCHEMA = "page_id long, url string, html string, payload string, start string, path string, record_type string, row string, n string"


def brute(rows):
    groups = {}
    for page, _, html in rows:
        groups.setdefault(html or "", []).append(page)
    out = []
    for html, pages in groups.items():
        pages.sort(key=lambda p: (p is not None, p or 0), reverse=True)
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out += [(p, len(data), digest, "revisit" if i else "response", pages[0] if i else None) for i, p in enumerate(pages)]
    return sorted(out, key=repr)


def pages_of(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e", "f") for r in rows], SCHEMA).repartition(parts)


def answer(index):
    rows = index.where("record_type <> 'warcinfo'").select(
        key_of("record_id").cast("long"), "payload_bytes", "payload_digest", "record_type", key_of("refers_id").cast("long")
    )
    return sorted((tuple(r) for r in rows.collect()), key=repr)


def odd_rows():
    pick = random.Random(3)
    htmls = [None, "", " ", "é▁😀\x00", "WARC/1.1\r\n\r\n", "<p>x</p>" * 40_000, "".join(chr(pick.randint(1, 0x7FF)) for _ in range(30_000))]
    rows = [(i, pick.choice([None, "http://a/b c\r\nX: y", "http://é/"]), pick.choice(htmls)) for i in range(60)]
    rows += [(None, None, "none"), (None, "u", "none"), (7, "u", "twice"), (7, "u", "twice"), (100 + 1, "u", "z" * 100), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("step", [64, 5000, 8 << 20])
def test_round_trip(spark, scratch, monkeypatch, step):
    monkeypatch.setattr(warc, "FILE_BYTES", 30_000)
    monkeypatch.setattr(warc, "READ_BYTES", 4096)
    monkeypatch.setattr(warc, "FEED_BYTES", 100)
    monkeypatch.setattr(warc, "TASK_BYTES", 100_000)
    monkeypatch.setattr(warc, "HOT", 10)
    rows = odd_rows()
    files = write_warc(pages_of(spark, rows), scratch, "page_id", "url", "html")
    index = read_index(files, step if step > 64 else 64 * 50)
    assert answer(index) == brute(rows)
    assert index.count() == files.selectExpr("sum(records)").first()[0]
    listed = archives(spark, scratch)
    assert sorted(r.length for r in listed.collect()) == sorted(r.length for r in files.collect())
    kept = {r.payload_digest: bytes(r.payload) for r in payloads(index).where("record_type = 'response'").collect()}
    assert sorted(kept.values()) == sorted({(h or "").encode() for _, _, h in rows})


def test_small_payloads_are_responses(spark, scratch):
    rows = [(i, "u", "ab" if i % 2 else "abc") for i in range(6)]
    index = read_index(write_warc(pages_of(spark, rows), scratch, "page_id", "url", "html", least_bytes=3))
    assert [r[3:] for r in answer(index)] == [("revisit", 4), ("response", None), ("revisit", 4), ("response", None), ("response", None), ("response", None)]


def test_no_pages(spark, scratch):
    files = write_warc(pages_of(spark, []), scratch, "page_id", "url", "html")
    assert files.count() == 0 and read_index(files).count() == 0 and not os.listdir(scratch)


def _stored(member: bytes) -> bytes:
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    return packer.compress(zlib.decompress(member, 31)) + packer.flush()


def test_archive_inside_an_archive_and_false_magic(spark, scratch):
    inner = record("response", "urn:page:k9:9", None, b"inner", None, "d")
    payload = b"\x1f\x8b\x08 no member " * 30 + inner * 40 + b"\x1f\x8b\x08"
    members = [_stored(record("response", f"urn:page:k{i}:{i}", "u", payload, None, "d")) for i in range(3)]
    path = os.path.join(scratch, "x.warc.gz")
    with open(path, "wb") as f:
        f.write(b"".join(members))
    files = archives(spark, scratch)
    for step in (100, 777, 1 << 20):
        found = read_index(files, step)
        assert [r.record_id for r in found.orderBy("start").collect()] == [f"urn:page:k{i}:{i}" for i in range(3)]
    assert {bytes(r.payload) for r in payloads(found).collect()} == {payload}


@pytest.mark.parametrize("harm", ["cut", "flip", "lost"])
def test_damage_is_an_error(spark, scratch, harm):
    members = [record("response", f"urn:page:k{i}:{i}", "u", b"text %d" % i * 50, None, "d") for i in range(4)]
    data = bytearray(b"".join(members))
    if harm == "flip":
        data[len(members[0]) + 40] ^= 255
    data = {"cut": data[:-3], "flip": data, "lost": data[5:]}[harm]
    with open(os.path.join(scratch, "x.warc.gz"), "wb") as f:
        f.write(data)
    with pytest.raises(OSError, match="no whole record at byte"):
        read_index(archives(spark, scratch), 100)


def test_query_matches_sql_and_brute_force(spark, sf):
    db = duckdb.connect()
    db.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    want = db.sql(oracle_sql())
    got = op13_warc(spark, sf)
    assert got.columns == want.columns
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == sorted(want.fetchall(), key=repr) == brute(db.sql("select page_id, url, html from pages").fetchall())
    db.execute("create or replace view pages as select * from (values (1, 'a'), (2, 'a'), (3, null), (4, '')) t(page_id, html)")
    assert sorted(db.sql(oracle_sql()).fetchall()) == brute([(1, "", "a"), (2, "", "a"), (3, "", None), (4, "", "")])
