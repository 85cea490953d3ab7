import hashlib

import pyarrow as pa
import zstandard

from barlake.llm.warc import archived_pages, fetch_records, parse_record, plan_records, read_archives, read_seek_table, write_archives

BIG, OTHER = "<p>é</p>" * 200, "x" * 1000
PAGES = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (9, None, BIG), (9, None, BIG), (4, "http://a/\r\n4", "small"), (5, "u", "small"),
    (6, "u", None), (7, "u", ""), (8, "u", OTHER), (None, "u", BIG),
]


def frame(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, payload string")


def expected():
    out = []
    for page_id, _, html in PAGES:
        data = (html or "").encode()
        same = [p for p, _, h in PAGES if h == html and p is not None]
        revisit = len(data) >= 1000 and len(same) > 1 and page_id != max(same)
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=str)


def rows(records):
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted((tuple(r[n] for n in names) for r in records.collect()), key=str)


def test_archives_give_every_page_back(spark):
    assert rows(archived_pages(frame(spark))) == expected()
    assert archived_pages(frame(spark, [])).count() == 0


def test_large_group_tables_are_joined_by_shuffle(spark):
    plain, joined = plan_records(frame(spark)), plan_records(frame(spark), max_rows=0)
    names = ["page_id", "record_type", "refers_to"]
    assert sorted(map(str, plain.select(*names).collect())) == sorted(map(str, joined.select(*names).collect()))


def test_frames_are_independent_and_seekable(spark, tmp_path):
    folder = str(tmp_path / "archive")
    write_archives(plan_records(frame(spark)).coalesce(1), folder, frame_bytes=2000)
    index = spark.read.parquet(f"{folder}/index").collect()
    path = f"{folder}/data/{index[0].file}"
    with pa.OSFile(path) as file:
        frames = read_seek_table(file)
    data = open(path, "rb").read()
    assert len(frames) > 1 and len({r.frame for r in index}) == len(frames)
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert len(whole) == sum(plain for _, _, plain in frames)
    for r in index:
        one = zstandard.ZstdDecompressor().decompress(data[r.frame_at : r.frame_at + r.frame_size])
        assert parse_record(one, r.record_at)[0]["page_id"] == r.page_id
    wanted = spark.createDataFrame([(8,), (4,)], "page_id bigint")
    assert {(r.page_id, r.url) for r in fetch_records(spark, folder, wanted).collect()} == {(8, "u"), (4, "http://a/%0D%0A4")}
    assert rows(read_archives(spark, folder)) == expected()
