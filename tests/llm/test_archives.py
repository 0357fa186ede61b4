"""WARC archives as written: format of the records, sizes, and reading that doesn't depend on batches."""

import glob
import gzip

import pytest
from pyspark.sql import functions as F

from fleetspark.llm import warc


def test_records_on_disk(spark, tmp_path):
    path = str(tmp_path / "warc")
    df = spark.createDataFrame([(1, "http://a", "<p>é\r\n\r\nx\n"), (2, "http://b", "<p>é\r\n\r\nx\n")], "page_id long, url string, html string")
    warc.write_archives(df, path)
    data = b"".join(gzip.open(f).read() for f in sorted(glob.glob(path + "/part-*.gz")))
    whole = [record for done in warc.parse_records(iter([data])) for record in done]
    by_byte = [record for done in warc.parse_records(bytes([x]) for x in data) for record in done]
    assert whole == by_byte
    kinds = {head["X-Page-ID"]: (head["WARC-Type"], head["Content-Type"].split(";")[0], payload) for head, payload in whole}
    assert kinds == {"1": ("revisit", "application/http", b""), "2": ("response", "application/http", "<p>é\r\n\r\nx\n".encode())}
    assert b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: 11\r\n\r\n<p>" in data
    with pytest.raises(ValueError):
        list(warc.parse_records(iter([data[:-5]])))


def test_large_payloads_over_many_batches(spark, tmp_path):
    path = str(tmp_path / "warc")
    df = spark.range(40).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.repeat(F.concat(F.col("id").cast("string"), F.lit(" line\r\n\n")), F.when(F.col("id") == 7, 400_000).otherwise(3000).cast("int")).alias("html"),
    )
    warc.write_archives(df, path, archive_bytes=1 << 20)
    assert len(glob.glob(path + "/part-*.gz")) > 2
    back = warc.read_archives(spark, path, payloads=True).join(df.withColumnRenamed("page_id", "page"), "page")
    assert back.where("payload = html and bytes = octet_length(html)").count() == 40
