import io
import struct

import pytest
import zstandard

from tests.compare import connect, differences
from tests.conftest import SF_DIR
from umbu.llm import warc

PAGE = "page_id bigint, url string, html string, path string, sha1 string"


def archive(*records, dictionary=b"abc " * 2000):
    shared = zstandard.ZstdCompressionDict(dictionary)
    packer = zstandard.ZstdCompressor(dict_data=shared)
    return warc.dictionary_frame(dictionary) + b"".join(packer.compress(r) for r in records)


def record(payload=b"abc abc", **more):
    return warc.record_bytes(1, "http://a/", payload, warc.sha1_base32(payload), more.get("refers_to"))


def test_query_equals_its_sql(spark):
    assert differences(warc.op6_warc_zstd(spark, SF_DIR), connect(SF_DIR), warc.SQL) == []


def test_odd_pages_equal_the_sql(spark, tmp_path, monkeypatch):
    import duckdb

    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 300)
    rows = [(i, f"http://h/{i}", "<p>same</p>", "p", "s") for i in range(40)]
    rows += [(100, None, None, None, None), (101, "a\r\nb", "", "", ""), (102, "u", "é\r\n\r\n日本" * 50_000, "", "")]
    rows += [(None, "u", "<p>same</p>", "", ""), (None, "u", "alone", "", ""), rows[3], rows[39]]
    pages = spark.createDataFrame(rows, PAGE)
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert differences(warc.op6_warc_zstd(spark, str(tmp_path)), con, warc.SQL) == []
    # Payloads and addresses come back as they were.
    paths = warc.write_archives(pages, str(tmp_path / "archives"))
    assert paths.count() > 3
    found = {(r["page_id"], r["record_type"]): r for r in warc.read_archives(paths, payloads=True).collect()}
    assert found[102, "response"]["payload"].decode() == rows[42][2]
    assert found[101, "response"]["url"] == "a%0D%0Ab" and found[100, "revisit"]["url"] is None


def test_empty(spark, tmp_path):
    paths = warc.write_archives(spark.createDataFrame([], PAGE), str(tmp_path / "none"))
    assert warc.read_archives(paths).count() == 0


def test_frames():
    data = archive(record(), record(b""))
    assert [warc.parse_record(f)["payload"] for f in warc.frames(io.BytesIO(data))] == [b"abc abc", b""]
    later = data + struct.pack("<II", 0x184D2A50, 3) + b"xyz" + archive(record())[len(warc.dictionary_frame(b"abc " * 2000)):]
    assert len(list(warc.frames(io.BytesIO(later)))) == 3
    plain = zstandard.ZstdCompressor().compress(record())
    assert len(list(warc.frames(io.BytesIO(plain)))) == 1
    with pytest.raises(ValueError, match="cut off"):
        list(warc.frames(io.BytesIO(data[:-3])))
    with pytest.raises(zstandard.ZstdError):
        list(warc.frames(io.BytesIO(b"no archive at all")))


@pytest.mark.parametrize(
    "old, new, message",
    [
        (b"WARC/1.1", b"WARK/1.1", "begins"),
        (b"WARC-Date", b"WARC-Data", "no warc-date"),
        (b"abc abc", b"abc abd", "digest"),
        (b"abc abc\r\n", b"abc\r\n", "declared"),
        (b"WARC-Type: response", b"WARC-Type: revisit", "revisit"),
        (b"charset=UTF-8\r\nContent-Length", b"charset=UTF-8\r\nContent-Lengtx", "no length"),
    ],
)
def test_faults_are_found(old, new, message):
    with pytest.raises(ValueError, match=message):
        warc.parse_record(record().replace(old, new))
