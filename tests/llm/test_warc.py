from __future__ import annotations

import base64
import hashlib
import io

import pyarrow as pa
import zstandard

from trajlake.llm import warc
from trajlake.llm.common import folder

SCHEMA = "page_id long, url string, html string, digest int"


def test_round_trip_revisits_and_seeking(spark):
    rows = [(i, f"http://a/{i}", f"<p>{i % 7} é</p>" * (i % 7 + 1), 0) for i in range(60)]
    rows += [(100, None, None, 1), (101, "http://x/\r\nEvil: 1", "", 1), (102, "u", "one\r\n\r\nWARC/1.1\r\n", 1), (103, "u", "x" * 500_000, 1), (104, "u", "y", 1), (104, "u", "y", 1), (None, "u", "z", 1)]
    marked = warc.mark_revisits(spark.createDataFrame(rows, SCHEMA), "page_id", "url", "html")
    index = warc.write_bundles(marked, frame_bytes=2000, bundle_bytes=20_000)
    got = {r["page_id"]: r for r in warc.read_bundles(index).collect()}
    last: dict[bytes, int] = {}
    for i, _, h, _ in rows:
        data = (h or "").encode()
        last[data] = max(last.get(data, -1), -1 if i is None else i)
    assert warc.read_bundles(index).count() == len(rows)
    for i, _, h, _ in rows:
        data = (h or "").encode()
        r = got[i]
        assert r["payload_bytes"] == len(data)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (r["record_type"], r["refers_to"]) == (("response", None) if i is None or last[data] == i else ("revisit", last[data]))
    some = spark.createDataFrame([(3,), (103,), (999,)], "id long")
    assert sorted((r["page_id"], r["payload_bytes"]) for r in warc.fetch(index, some, "id").collect()) == [(3, got[3]["payload_bytes"]), (103, 500_000)]
    path = index.select("bundle").first()["bundle"]
    store, name = folder(path)
    data = store.open_input_stream(name).read()
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert plain.startswith(b"WARC/1.1\r\n")  # any reader can read it from the start


def test_bundles_are_read_in_many_tasks(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(i, f"u{i}", f"{i} " * 200, 0) for i in range(400)], SCHEMA)
    index = warc.write_bundles(warc.mark_revisits(docs, "page_id", "url", "html"), frame_bytes=2000, bundle_bytes=4000)
    fan = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert index.select("bundle").distinct().count() >= 10 * fan
    for out in (warc.read_bundles(index), warc.fetch(index, docs, "page_id")):
        own = out.groupBy(F.spark_partition_id()).count().collect()
        assert len(own) == fan and max(r["count"] for r in own) < 2 * 400 / fan


def test_least_size_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "u", "a", 0), (2, "u", "a", 0), (3, "u", "abc", 0), (4, "u", "abc", 0)], SCHEMA)
    kinds = {r["page_id"]: r["revisit"] for r in warc.mark_revisits(docs, "page_id", "url", "html", min_bytes=2).collect()}
    assert kinds == {1: False, 2: False, 3: True, 4: False}
    none = spark.createDataFrame([], SCHEMA)
    assert warc.read_bundles(warc.write_bundles(warc.mark_revisits(none, "page_id", "url", "html"))).count() == 0


def test_damage_is_seen(tmp_path):
    b = warc.Bundle(100, 3)
    b.add(warc.record(1, "u", b"data", "X", None, True))
    data = bytearray(b.close())
    good = warc.Seekable(pa.BufferReader(bytes(data)))
    assert warc.parse(good.frame(0))[0]["warc-type"] == "revisit"
    table = len(data) - 9 - 4
    data[table] ^= 1
    try:
        warc.Seekable(pa.BufferReader(bytes(data))).frame(0)
    except ValueError:
        return
    raise AssertionError("damage went unseen")
