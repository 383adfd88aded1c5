"""Archives: exact round trips, revisits, the index, damaged input."""

import gzip
import hashlib
import io
import json
import zlib

import pytest
from pyarrow import fs

from masterline.llm import warc

SCHEMA = "page_id long, url string, html string"


def pages(spark):
    same, short = "<p>" + "same " * 40, "tiny"
    rows = [(5, "http://a/5", same), (3, "http://a/3", same), (9, None, same), (3, "http://a/3", same), (None, "http://a/n", same), (1, "http://b/1", short), (2, "http://b/2", short)]
    rows += [(10, "http://c/ü\r\nX: y", "é日👍\r\n\r\nWARC/1.1\r\n" * 30), (11, "u", None), (12, "u", ""), (13, "u", "z" * 3_000_000)]
    rows += [(100 + i, f"http://d/{i}", f"<html>{i}</html>" * 20) for i in range(30)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_round_trip(spark):
    rows, df = pages(spark)
    archives, root = warc.archive(df)
    got = warc.read_archives(archives, root, with_payload=True).collect()
    assert len(got) == len(rows)
    html = {r[0]: (r[2] or "").encode() for r in rows}
    for r in got:
        data = html[r["page_id"]]
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == hashlib.sha256(data).hexdigest()
        assert r["record_type"] == "revisit" or bytes(r["payload"]) == data
    kinds = {(r["page_id"], r["record_type"], r["refers_to"]) for r in got}
    assert {(3, "response", None), (5, "revisit", 3), (9, "revisit", 3), (None, "revisit", 3), (1, "response", None), (2, "response", None), (11, "response", None), (12, "response", None)} <= kinds


def test_members_and_index(spark):
    _, df = pages(spark)
    archives, root = warc.archive(df)
    store, _ = fs.FileSystem.from_uri(root)
    n = 0
    for path, index, records in archives.collect():
        data = store.open_input_file(path).read()
        lines = [json.loads(x) for x in store.open_input_file(index).read().decode().splitlines()]
        assert len(lines) == records and lines[0]["type"] == "warcinfo"
        assert [x["offset"] for x in lines] == [sum(y["length"] for y in lines[:i]) for i in range(len(lines))] and sum(x["length"] for x in lines) == len(data)
        for x in lines:
            member = zlib.decompressobj(warc.GZIP)
            record = member.decompress(data[x["offset"] : x["offset"] + x["length"]])
            assert member.eof and not member.unused_data and warc.parse(record)[0]["warc-record-id"] == x["id"]
        assert b"".join(warc.records_of(warc.inflated(io.BytesIO(data), 999))) == gzip.decompress(data)
        n += records - 1
    assert n == df.count()


def test_archives_roll_over(spark):
    rows, df = pages(spark)
    root = warc.scratch_path(spark, "roll")
    paths = warc.write_archives(warc.with_revisits(df), root, archive_bytes=2_000)
    assert paths.count() > 5
    assert warc.read_archives(warc.normalize(paths, root + "/n"), root).count() == len(rows)


def test_small_chunks_and_damage():
    records = [warc.record("response", {"WARC-Record-ID": f"<{i}>"}, b"x" * i) for i in range(50)]
    whole = b"".join(records)
    for step in (1, 7, 64):
        assert list(warc.records_of(whole[i : i + step] for i in range(0, len(whole), step))) == records
    with pytest.raises(ValueError, match="inside a record"):
        list(warc.records_of([whole[:-5]]))


def test_no_pages(spark):
    archives, root = warc.archive(spark.createDataFrame([], SCHEMA))
    assert warc.read_archives(archives, root).count() == 0
