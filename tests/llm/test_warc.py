import gzip
import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gaugeflow.llm.warc import archive_round_trip, chunk_rows, read_chunks, record_rows, revisits, write_archives


def brute(pages):
    first = {}
    for page, html in pages:
        raw = (html or "").encode()
        if len(raw) >= 100 and page is not None:
            first[raw] = min(first.get(raw, page), page)
    out = []
    for page, html in pages:
        raw = (html or "").encode()
        refers = first.get(raw) if first.get(raw) != page else None
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(),
                    "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


def pages():
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice(["a", "é", "\r\n", "\r\n\r\n", "\n", " ", "WARC/1.1\r\n"]) for _ in range(n))
    rows = [(i, text(rng.randrange(0, 200))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "x" * 99), (103, "x" * 99), (104, "y" * 100), (99, "y" * 100),
             (105, "y" * 100), (106, "z" * 5000 + "\r\n"), (107, "\r\n\r\n" * 40), (107, "\r\n\r\n" * 40),
             (None, "y" * 100), (None, "n" * 100), (None, "n" * 100), (108, "日" * 3000), (109, "\r\n" * 333)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(p, f"http://e.com/{p} \r\n?" if p != 3 else None, h, "d", 1) for p, h in rows],
                                 "page_id long, url string, html string, payload string, chunks int").repartition(3)


def test_round_trip(spark):
    got = archive_round_trip(frame(spark, pages())).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(pages())
    assert archive_round_trip(frame(spark, pages()).limit(0)).count() == 0


@pytest.mark.parametrize("chunk", [7, 100, 1 << 20])
def test_chunks_hold_the_payload_and_its_running_digest(spark, tmp_path, chunk):
    write_archives(frame(spark, pages()), str(tmp_path / "w"), chunk)
    rows = sorted(read_chunks(spark, str(tmp_path / "w"), chunk_bytes=chunk).where("page_id IS NOT NULL AND page_id <> 107")
                  .collect(), key=lambda r: (r.page_id, r.chunk_no))
    payloads = {p: (h or "").encode() for p, h in pages()}
    whole = {}
    for r in rows:
        assert len(r.payload) <= chunk
        whole.setdefault(r.page_id, bytearray()).extend(r.payload)
        done = bytes(whole[r.page_id])
        assert (len(done), hashlib.sha256(done).hexdigest()) == (r.payload_bytes, r.payload_digest)
        if r.last and r.record_type == "response":
            assert done == payloads[r.page_id] and r.stated_bytes == len(done)
            assert r.stated_digest == r.payload_digest


def test_files_follow_the_format(spark, tmp_path):
    write_archives(frame(spark, pages()), str(tmp_path / "w"), 500)
    kinds = []
    for name in Path(tmp_path / "w").glob("part-*.gz"):
        raw = gzip.open(name).read()
        while raw:
            head, _, rest = raw.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            assert lines[0] == "WARC/1.1" and fields["WARC-Record-ID"].startswith("<urn:")
            size = int(fields["Content-Length"])
            assert rest[size:size + 4] == b"\r\n\r\n" and size <= 500 + 200
            kinds.append(fields["WARC-Type"])
            raw = rest[size + 4:]
    assert kinds.count("continuation") > 10
    assert kinds.count("response") + kinds.count("revisit") == len(pages())


def test_writing_holds_a_chunk_in_a_row(spark):
    documents = frame(spark, pages())
    rows = chunk_rows(documents, 100)
    assert rows.agg(F.max(F.octet_length("part"))).first()[0] == 100
    assert "payload" not in rows.columns and set(revisits(documents).columns) == {"page_id", "payload_digest", "refers_to"}
    plan = record_rows(documents, 100)._jdf.queryExecution().optimizedPlan().toString()
    assert "flatten" not in plan and "transform(" not in plan


def test_equal_rows_stay_apart_in_any_order(spark, tmp_path):
    copies = [(7, "é\r\n\r\n" * 60)] * 5 + [(None, "q" * 300)] * 4
    write_archives(frame(spark, copies).repartition(4), str(tmp_path / "w"), 50)
    got = read_chunks(spark, str(tmp_path / "w"), chunk_bytes=50).where("last").collect()
    assert len(got) == 9 and all(r.record_type == "response" for r in got)
    assert all(r.payload_digest == r.stated_digest for r in got)
