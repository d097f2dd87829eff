import gzip
import hashlib
import random

import pytest

from postloom.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, size int"


def test_roundtrip(spark):
    long = "<p>é" * 50
    rows = [(5, "http://a/ b\r\n", long), (3, None, long), (9, "http://c", long), (1, "u", "short"), (2, "u", "short")]
    rows += [(10, "u", None), (11, "u", ""), (None, "u", long), (3, None, long), (12, "u", "x" * 300_000), (13, "u", "\r\n\r\nWARC/1.1\r\n" * 20)]
    pages = spark.createDataFrame([(*r, "d", 1) for r in rows], SCHEMA)
    got = sorted(warc.roundtrip(pages, with_payload=True).collect(), key=str)
    low = min(i for i, _, h in rows if h == long and i is not None)
    want = []
    for i, url, html in rows:
        body = (html or "").encode()
        again = html == long and i is not None and i != low
        url = url and url.replace(" ", "%20").replace("\r", "%0D").replace("\n", "%0A")
        want.append((i, url, "revisit" if again else "response", low if again else None, len(body), hashlib.sha256(body).hexdigest(), None if again else body))
    assert sorted(map(str, want)) == sorted(str((*tuple(r)[:6], r.payload and bytes(r.payload) if r.payload is not None else None)) for r in got)


def test_archives_roll_and_are_plain_gzip(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", str(random.Random(i).random()) * 50) for i in range(30)], "page_id long, url string, html string")
    made = warc.write_archives(pages.coalesce(1), str(tmp_path / "w"), roll=2000)
    files = made.collect()
    assert len(files) > 3 and sum(f.records for f in files) == 30
    assert gzip.open(files[0].path.removeprefix("file:")).read().startswith(b"WARC/1.1\r\n")
    binary = spark.read.format("binaryFile").load(str(tmp_path / "w")).select("content")
    assert sorted(r.page_id for r in warc.read_archives(binary).collect()) == list(range(30))


def test_stream_in_chunks_of_any_size():
    data = b"".join(warc.record(i, "u", b"x" * i, i, hashlib.sha256(b"x" * i).hexdigest(), None) for i in range(5))
    whole = list(warc.members([data]))
    for step in (1, 7, 100):
        assert list(warc.members(data[i : i + step] for i in range(0, len(data), step))) == whole
    assert [warc.parse(c)["payload_bytes"] for c in whole] == list(range(5))
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.members([data[:-3]]))


@pytest.mark.parametrize("old,new", [(b"payload!", b"payload?"), (b"Content-Length: 8\r\n\r\npay", b"Content-Length: 8\r\n\r\npax")])
def test_a_changed_record_is_an_error(old, new):
    content = gzip.decompress(warc.record(1, "u", b"payload!", 8, hashlib.sha256(b"payload!").hexdigest(), None))
    warc.parse(content)
    with pytest.raises(ValueError, match="digest"):
        warc.parse(content.replace(old, new))
    with pytest.raises(ValueError, match="framing"):
        warc.parse(content[:-1])
    other = content.replace(hashlib.sha256(b"payload!").hexdigest().encode(), b"0" * 64)
    with pytest.raises(ValueError, match="payload digest"):
        warc.parse(other)


def test_empty_table(spark):
    assert warc.roundtrip(spark.createDataFrame([], SCHEMA)).count() == 0
