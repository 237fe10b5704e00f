import base64
import hashlib
import io

import pytest
import zstandard
from pyspark.sql import types as T

from tests.llm.cases import prose
from trellis.llm import warc as W
from trellis.session import shared_dir

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                       T.StructField("html", T.StringType()), T.StructField("payload", T.StringType()),
                       T.StructField("digest", T.StringType())])


def pages():
    rows = [(i, f"http://h/{i}?q=ä b", f"<html>{prose(i, 40)}</html>") for i in range(60)]
    rows += [(100, "http://a", rows[3][2]), (101, None, rows[3][2]), (102, "http://e", None), (103, "", ""),
             (104, "http://l\r\nX: y", "<p>" + prose(5, 60_000)), (None, "http://n", rows[5][2]), (None, "http://z", "only null"),
             (105, "http://d", "twice"), (105, "http://d", "twice"), (-7, "http://neg", "minus\r\n\r\nWARC/1.1")]
    return rows


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize("size", [W.ARCHIVE_BYTES, 2000])
def test_records_read_back_whole(spark, size):
    rows = pages()
    df = spark.createDataFrame([(*r, "p", "d") for r in rows], SCHEMA)
    manifest = W.write_archives(W.with_revisits(df), shared_dir(spark, "warc-test"), size)
    out = W.read_archives(manifest).collect()
    top = {}
    for i, _, h in rows:
        d = digest(h)
        top[d] = max(top.get(d, -10 ** 18), -10 ** 18 if i is None else i)
    want = []
    for i, _, h in rows:
        chosen = top[digest(h)]
        same = chosen == (-10 ** 18 if i is None else i)
        want.append((i or -1, len((h or "").encode()), digest(h), "response" if same else "revisit", 0 if same else chosen))
    got = [(r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0) for r in out]
    assert sorted(got) == sorted(want)
    by = {r.page_id: r for r in out}
    assert bytes(by[104].payload).decode() == rows[64][2] and by[104].url == "http://l%0D%0AX:%20y"
    assert by[101].url == "about:blank" and by[-7].record_type == "response"


def test_archive_layout():
    records = [W.make_record(i, f"http://x/{i}", prose(i, 80).encode(), None) for i in range(200)]
    out = io.BytesIO()
    W.write_archive(records, out)
    data = out.getvalue()
    assert data[:4] == W.DICTIONARY_MAGIC.to_bytes(4, "little")
    size = int.from_bytes(data[4:8], "little")
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8:8 + size]))
    assert dictionary.dict_id() != 0
    plain = zstandard.ZstdDecompressor(dict_data=dictionary).decompress(data[8 + size:])   # the first frame alone
    assert plain == records[0]
    assert list(W.read_archive(io.BytesIO(data))) == records


def test_few_records_need_no_dictionary():
    out = io.BytesIO()
    W.write_archive([b"one"], out)
    assert list(W.read_archive(io.BytesIO(out.getvalue()))) == [b"one"]
    with pytest.raises(ValueError):
        list(W.read_archive(io.BytesIO(out.getvalue()[:-2])))


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    manifest = W.write_archives(W.with_revisits(df), shared_dir(spark, "warc-test"))
    assert manifest.count() == 0 and W.read_archives(manifest).count() == 0
