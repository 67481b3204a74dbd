import gzip
import hashlib

import pytest

from tests.llm.helpers import documents
from tripmill.llm import files, warc

LONG, OTHER = "x" * 100, "y" * 99 + "é"
PAGES = [
    (5, "http://a/5", LONG), (3, "http://a/3", LONG), (9, None, LONG), (1, "http://a/1", "x" * 99), (2, "http://a/2", "x" * 99),
    (4, "http://a/4\r\nX: y % %41", None), (6, "é ", ""), (7, "u", OTHER), (7, "t", OTHER), (8, "u", OTHER), (None, "u", LONG),
    (None, "u", LONG), (10, "u", "z" * 300_000), (11, "u", "z" * 300_000),
]


def frame(spark, rows):
    rows = [(*r, "d", 1) for r in rows]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, first long").repartition(3)


def expected(rows):
    smallest, out = {}, []
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 100:
            smallest[html] = min(page, smallest.get(html, page))
    taken = set()
    for page, url, html in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        data = (html or "").encode()
        refers = None
        if page is not None and len(data) >= 100:
            refers = smallest[html] if html in taken else None
            taken.add(html)
        kind = "response" if refers is None else "revisit"
        out.append((page, url, kind, refers, len(data), hashlib.sha256(data).hexdigest(), data if kind == "response" else None))
    return sorted(out, key=repr)


def found(spark, folder):
    return sorted((tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in warc.read(spark, folder).collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 200, "roll_bytes": 1}])
def test_round_trip(spark, tmp_path, options):
    warc.write(frame(spark, PAGES), f"{tmp_path}/w", **options)
    assert found(spark, f"{tmp_path}/w") == expected(PAGES)


def test_pages(spark, tmp_path):
    pages = documents(spark, table="pages")
    copies = pages.selectExpr("page_id + 1000 as page_id", "url", "html").where("page_id % 3 = 0")
    both = pages.unionByName(copies)
    listed = warc.write(both, f"{tmp_path}/w", shard_bytes=60_000, roll_bytes=10_000).collect()
    assert len({r["shard"] for r in listed}) > 2 and len(listed) > len({r["shard"] for r in listed})
    rows = [(r["page_id"], r["url"], r["html"]) for r in both.collect()]
    assert found(spark, f"{tmp_path}/w") == expected(rows)


def test_the_same_bytes_again(spark, tmp_path):
    pages = documents(spark, table="pages")
    one = warc.write(pages, f"{tmp_path}/a", shard_bytes=60_000)
    two = warc.write(pages.repartition(7), f"{tmp_path}/b", shard_bytes=60_000)
    assert sorted(one.collect()) == sorted(two.collect())


def test_empty_table(spark, tmp_path):
    warc.write(frame(spark, []), f"{tmp_path}/w")
    assert found(spark, f"{tmp_path}/w") == []


def test_gzip_reads_the_files(spark, tmp_path):
    warc.write(frame(spark, PAGES), f"{tmp_path}/w")
    (name,) = [r["file"] for r in warc.manifest(spark, f"{tmp_path}/w").collect()]
    assert gzip.open(f"{tmp_path}/w/{name}").read().count(b"WARC/1.1\r\n") == len(PAGES) + 1


@pytest.mark.parametrize("rows", [PAGES, [*PAGES, (3, None, LONG)]])
def test_revisits_name_url_and_date_of_what_they_refer_to(spark, tmp_path, rows):
    warc.write(frame(spark, rows), f"{tmp_path}/w", date="2020-02-02T00:00:00Z")
    (name,) = [r["file"] for r in warc.manifest(spark, f"{tmp_path}/w").collect()]
    with files.opened(f"file://{tmp_path}/w", name) as f:
        headers = [warc.parse(record)[0] for record in warc.members(f)]
    by_id = {h["WARC-Record-ID"]: h for h in headers}
    assert len(by_id) == len(headers)
    revisits = [h for h in headers if h["WARC-Type"] == "revisit"]
    assert len(revisits) == sum(r[2] == "revisit" for r in expected(rows))
    for h in revisits:
        response = by_id[h["WARC-Refers-To"]]
        assert response["WARC-Type"] == "response" and response["WARC-Payload-Digest"] == h["WARC-Payload-Digest"]
        assert h.get("WARC-Refers-To-Target-URI") == response.get("WARC-Target-URI")
        assert h["WARC-Refers-To-Date"] == response["WARC-Date"] == "2020-02-02T00:00:00Z"


def test_damage_is_found(spark, tmp_path):
    warc.write(frame(spark, PAGES), f"{tmp_path}/w")
    (name,) = [r["file"] for r in warc.manifest(spark, f"{tmp_path}/w").collect()]
    with files.opened(f"file://{tmp_path}/w", name) as f:
        records = list(warc.members(f))
    with pytest.raises(ValueError, match="digest"):
        warc.parse(records[1].replace(b"text/html", b"text/htmm"))
    with open(f"{tmp_path}/w/{name}", "ab") as f:
        f.write(b"x")
    with pytest.raises(Exception, match="isn't as long"):
        warc.read(spark, f"{tmp_path}/w").collect()
