import glob
import hashlib
import struct

import pytest
import zstandard as zstd

from cdcflow.llm.warc import FILE_RECORDS, archived, read_archives, read_frames, read_record, write_archives


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "x") for i, u, h in rows], "page_id long, url string, html string, payload string, refers_to string")


def expected(rows):
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        last = max((j for j, _, g in rows if j is not None and (g or "") == (h or "")), default=None)
        again = len(b) >= 1000 and i is not None and i < last
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", last if again else None))
    return sorted(out, key=str)


def test_round_trip(spark, tmp_path):
    long = "<p>é漢" + "x" * 1000
    rows = [(i, f"http://a.example/{i}", f"<html>{i % 7} " + "body words " * (i % 200)) for i in range(300)]
    rows += [(1000, None, long), (1001, "http://b/\r\nX: y", long), (1002, "u", long), (1002, "u", long), (1003, "u", None), (1004, "u", ""), (None, "u", long), (1005, "u", "z" * 999),
             (1006, "u", "z" * 999), (1007, "u", "y" * 1000), (1008, "u", "y" * 1000), (1009, "u", "WARC/1.1\r\n\r\n" + "q" * 500_000)]
    got = sorted((tuple(r) for r in archived(pages(spark, rows), str(tmp_path / "a")).collect()), key=str)
    assert got == expected(rows)
    back = {(r.page_id, bytes(r.payload)) for r in read_archives(spark, str(tmp_path / "a")).collect() if r.record_type == "response"}
    want = {(i, (h or "").encode()) for i, _, h in rows}
    assert back <= want and {p for _, p in back} == {p for _, p in want}


def test_files_are_plain_zstandard_with_a_leading_dictionary(spark, tmp_path):
    df = pages(spark, [(i, "http://a/", f"<html>{i} same same same") for i in range(FILE_RECORDS + 50)]).coalesce(1)
    write_archives(df, str(tmp_path / "a"))
    files = [f for f in glob.glob(str(tmp_path / "a/part*")) if open(f, "rb").read()]
    assert len(files) == 2
    for f in files:
        data = open(f, "rb").read()
        magic, size = struct.unpack_from("<II", data)
        assert magic == 0x184D2A5D
        reader = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(data[8 : 8 + size])).stream_reader(data, read_across_frames=True)
        assert reader.read().count(b"WARC/1.1\r\n") == sum(1 for _ in read_frames(data)) <= FILE_RECORDS
    assert archived(pages(spark, []), str(tmp_path / "none")).collect() == []


def test_damage_is_named():
    good = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: 44\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    import base64

    good = good.replace(b"%s", base64.b32encode(hashlib.sha1(b"abc").digest())).replace(b": 44", b": %d" % (len(b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc")))
    assert read_record(good).get("problem") is None and read_record(good)["payload"] == b"abc"
    for bad in (good[:-1], good.replace(b"abc", b"abd"), good.replace(b"WARC/1.1", b"HTTP/1.1"), good.replace(b"WARC-Date", b"X-Date"), good.replace(b"Length: 3", b"Length: 4"), b""):
        assert read_record(bad)["problem"]
    frame = zstd.ZstdCompressor(write_checksum=True).compress(good)
    assert [p for _, _, p in read_frames(frame + frame)] == [None, None]
    assert [p for _, _, p in read_frames(frame + frame[:-3])] == [None, "frame cut off"]
    assert list(read_frames(b"garbage!!"))[0][2]
    plain = zstd.ZstdCompressor().compress(b"raw dictionary content " * 4)
    packed = zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(b"raw dictionary content " * 4)).compress(good)
    assert list(read_frames(struct.pack("<II", 0x184D2A5D, len(plain)) + plain + packed))[0][1] == good


def test_equals_sql_twin(spark, sf_dir):
    import duckdb

    from cdcflow.llm.queries import ORACLES, op7_warc

    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf_dir}/pages.parquet'")
    got = sorted((tuple(r) for r in op7_warc(spark, sf_dir).collect()), key=str)
    assert got == sorted(con.execute(ORACLES["op7_warc"]).fetchall(), key=str)


@pytest.mark.parametrize("size", [1, 5])
def test_few_pages_have_a_dictionary_or_none(spark, tmp_path, size):
    assert len(archived(pages(spark, [(i, "u", "h") for i in range(size)]), str(tmp_path / "few")).collect()) == size
