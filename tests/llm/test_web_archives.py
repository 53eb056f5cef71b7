"""Archives: what is read equals what SQL says, the index is in order, the cases."""

import gzip
import hashlib

import oracle
from hypothesis import given, strategies as st

from etlkit.llm import web_archives as wa
from etlkit.llm.queries import ORACLES, QUERIES
from etlkit.workspace import new_path


@given(st.lists(st.lists(st.tuples(st.text("ab"), st.integers(0, 3))).map(sorted), min_size=1, max_size=9))
def test_loser_tree(runs):
    order = list(wa.merged(runs))
    assert [runs[r][i] for r, i in order] == sorted(key for run in runs for key in run)
    assert sorted(order) == [(r, i) for r, run in enumerate(runs) for i in range(len(run))]


def test_url_keys():
    assert wa.url_key("https://www.Blog.example.com:443/A?x=1#top") == "com,example,blog)/a?x=1"
    assert wa.url_key("http://example.com:8080") == "com,example:8080)/"
    assert wa.url_key("http://[bad") == "http://[bad" and wa.url_key(None) == "" and wa.url_key("mailto:x") == "mailto:x"


def test_query_equals_sql(spark, sf):
    assert oracle.compare(oracle.connect(sf), ORACLES["op7_web_archives"], QUERIES["op7_web_archives"](spark, sf)) is None


def test_index_is_globally_ordered_and_names_the_bytes(spark, tables, conf):
    conf(spark__sql__shuffle__partitions="5")
    folder = new_path(spark, "test-archives")
    pages = tables("pages").repartition(7)
    wa.write_archives(pages, folder, file_bytes=3_000)
    rows = wa.index(spark, folder).orderBy("part", "place").collect()
    assert len(rows) == pages.count() and len({r["run"] for r in rows}) > 7 and len({r["part"] for r in rows}) > 1
    keys = [(r["url_key"], r["time"], r["row"]) for r in rows]
    assert keys == sorted(keys)
    system, path = wa.file_system(f"{folder}/archives")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in rows[:20]:
        with system.open_input_file(f"{path}/{r['run']}") as file:
            fields, block = wa.parse(file.read_at(r["length"], r["offset"]))
        assert block.partition(b"\r\n\r\n")[2].decode() == html[int(fields["X-Page-ID"])]
        assert wa.url_key(fields["WARC-Target-URI"]) == r["url_key"]
    with system.open_input_file(f"{path}/{rows[0]['run']}") as file:
        assert gzip.decompress(file.read()).startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_cases(spark):
    same, long = "é" * 500, "z" * 3_000_000
    rows = [(1, "http://a.example/x", same), (2, "http://a.example/x", same), (7, None, same), (7, None, same), (3, "", None),
            (4, "u v\nw", ""), (None, "http://b.example", same), (5, "http://b.example", long), (6, "http://b.example", long),
            (8, "http://c", "small"), (9, "http://c", "small"), (10, "x", "\r\n\r\nWARC/1.1\r\n\0"), (None, "n", "q" * 2000),
            (None, "n", "q" * 2000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, row string")
    folder = new_path(spark, "test-archives")
    wa.write_archives(pages, folder)
    got = [tuple(r) for r in wa.read_archives(spark, folder).collect()]
    want = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        group = [i for i, _, h in rows if (h or "") == (html or "")]
        first = max(group, key=lambda i: -1 if i is None else i)
        revisit = len(data) >= 1000 and len(group) > 1 and page_id != first
        want.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    want[3] = (*want[3][:3], "revisit", 7)  # of two equal rows one is the response
    want[-1] = (*want[-1][:3], "revisit", None)
    assert sorted(got, key=str) == sorted(want, key=str)
    wa.write_archives(pages.limit(0), empty := new_path(spark, "test-archives"))
    assert wa.read_archives(spark, empty).collect() == [] and wa.index(spark, empty).collect() == []
