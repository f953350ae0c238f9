import hashlib

import llm_cases as cases
import pyarrow.fs
import pytest
from shoplens.llm import warc_bundles as warc

PAGES = "page_id BIGINT, url STRING, html STRING, digest STRING, n BIGINT, size BIGINT, same INT"


def pages(spark):
    big = "<p>" + cases.prose(1, 400) + "</p>"
    rows = [
        (1, "http://a/1", big),
        (5, "http://a/5", big),
        (3, "http://a/\r\n 3", big),
        (5, "http://a/5", big),  # a row that repeats
        (2, None, "small"),
        (4, "http://a/4", "small"),
        (6, "u", None),
        (7, "u", ""),
        (None, "u", big),
        (8, "u", "\x00\r\n\r\nWARC/1.1\r\n" * 100),
        (9, "ü", cases.prose(2, 60_000)),
        (10, "u", "x" * 1000),
        (11, "u", "x" * 1000),
        (12, "u", "y" * 999),
        (13, "u", "y" * 999),
    ]
    return spark.createDataFrame([(*r, "d", 0, 0, 0) for r in rows], PAGES).repartition(4)


def expected(rows):
    payloads = [((r.html or "").encode(), r.page_id) for r in rows]
    last = {}
    for payload, page in payloads:
        if len(payload) >= 1000 and page is not None:
            last[payload] = max(page, last.get(payload, page))
    out = []
    for payload, page in payloads:
        latest = last.get(payload)
        revisit = page is not None and latest is not None and page < latest
        out.append(
            (
                page,
                len(payload),
                hashlib.sha1(payload).hexdigest(),
                "revisit" if revisit else "response",
                latest if revisit else None,
            )
        )
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])


def test_round_trip(spark):
    table = pages(spark)
    assert cases.found(warc.round_trip(table)) == expected(table.collect())
    assert warc.round_trip(table.limit(0)).collect() == []


@pytest.mark.parametrize("frame", [1, 5000, 1 << 18])
def test_payloads_and_single_records(spark, tmp_path, monkeypatch, frame):
    monkeypatch.setattr(warc, "FRAME_BYTES", frame)
    folder = f"file://{tmp_path}/w"
    index = warc.write_archives(pages(spark).coalesce(2), folder)
    records = {r.page_id: r for r in warc.read_archives(index, folder).collect()}
    for row in pages(spark).collect():
        record = records[row.page_id]
        if record.record_type == "response":
            assert bytes(record.payload) == (row.html or "").encode()
        else:
            assert record.payload is None
            assert bytes(records[record.refers_to].payload) == row.html.encode()
    one = warc.read_archives(index.filter("page_id = 9"), folder).first()
    assert one.record_id == warc.record_id(9)
    assert "%0D%0A" in records[3].url


def test_a_bundle_is_zstandard_with_a_seek_table(tmp_path):
    import zstandard

    files, root = pyarrow.fs.FileSystem.from_uri(f"file://{tmp_path}")
    bundle = warc.Bundle(files, f"{root}/b.warc.zst")
    raws = [warc.record(i, "u", cases.prose(i, 3000).encode(), 1, "d", None) for i in range(40)]
    for raw in raws:
        bundle.add(raw)
    bundle.close()
    data = (tmp_path / "b.warc.zst").read_bytes()
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole == b"".join(raws)
    table = warc.seek_table(files.open_input_file(f"{root}/b.warc.zst"))
    assert len(table) > 1 and sum(full for *_, full in table) == len(whole)


def test_a_frame_that_is_cut_is_an_error(tmp_path):
    (tmp_path / "x").write_bytes(b"no seek table here")
    files, root = pyarrow.fs.FileSystem.from_uri(f"file://{tmp_path}")
    with pytest.raises(ValueError):
        warc.seek_table(files.open_input_file(f"{root}/x"))
    with pytest.raises(ValueError):
        warc.parse(b"HTTP/1.1 200 OK\r\n\r\n")
