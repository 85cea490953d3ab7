import pytest

from barlake.llm.queries import URL_RULES
from barlake.llm.url_tree import judge_pages, url_parts


def judged(spark, urls):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    return {r.page_id: r for r in judge_pages(pages, URL_RULES).collect()}


@pytest.mark.parametrize(
    "url, host, path",
    [
        ("HTTP://WWW.Example.COM/A/b?c=/d#e", "www.example.com", "/A/b"), ("x://h#/p", "h", ""), ("x://h?q/p", "h", ""), ("no mark", "", ""),
        (None, "", ""), ("", "", ""), ("a://b://c/d", "b:", "//c/d"), ("://É.com/x", "É.com", "/x"),
    ],
)
def test_parts(spark, url, host, path):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(url,)], "url string")
    assert tuple(frame.select(*url_parts(F.col("url"))).first()) == (host, path)


def test_longest_rule_wins(spark):
    rows = judged(spark, [
        "http://a.com/x", "http://www.example.com/en/1", "http://b.example.com/en/1", "http://notexample.com/en/1", "http://a.net/es/1",
        "http://a.net/es", "http://com/x", "http://a.com", None, "http://a.net/fr/2",
    ])
    assert [rows[i].rule for i in range(10)] == [
        "com/", "www.example.com/en/", "example.com/en/", "com/", "net/es/", None, "com/", None, None, "net/fr/",
    ]
    assert [rows[i].verdict for i in (0, 1, 2, 4)] == ["allow", "allow", "block", "block"]


def test_templates_learn_from_labelled_branches(spark):
    blocked = [f"http://h.net/es/{i}" for i in range(40)] + [f"http://h.net/fr/{i}.html" for i in range(40)]
    same = ["http://h.net/es", "http://h.net/en/7"]
    clean = [f"http://x.org/page/{i}" for i in range(30)] + [f"http://y.com/{c}{c}{i}/a" for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    rows = judged(spark, blocked + same + clean + [blocked[0]])
    assert {rows[i].verdict for i in range(80)} == {"block"}
    assert (rows[81].verdict, rows[81].template) == ("allow", "h.net/en/**")
    assert {rows[i].verdict for i in range(82, 82 + len(clean))} == {"allow"}
    # The page above 40 blocked ones differs from them significantly.
    assert (rows[80].verdict, rows[80].template) == ("allow", "h.net/es//**") and rows[138].verdict == "block"
    assert judge_pages(spark.createDataFrame([], "page_id bigint, url string"), URL_RULES).count() == 0


def test_variable_segments_become_wildcards(spark):
    from pyspark.sql import functions as F

    from barlake.llm.url_tree import path_templates

    parts = spark.createDataFrame(
        [("h", f"/item/{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}/view", 1) for i in range(100)] + [("h", f"/news/{i}", 0) for i in range(100)],
        "host string, path string, label int",
    )
    rows = path_templates(parts).groupBy("template").agg(F.sum("pages").alias("n"), F.max("purity").alias("p")).collect()
    assert {r.template: r.n for r in rows} == {"h/item/**": 100, "h/news/**": 100}
    assert {r.template: r.p >= 0.5 for r in rows} == {"h/item/**": True, "h/news/**": False}


def test_branches_stand_apart_only_where_they_differ(spark):
    blocked = [f"http://h.net/es/{c}" for c in "abcdefgh"]
    urls = blocked + [f"http://h.net/en/{c}" for c in "abcdefgh"] + ["http://lone.net/en/a", "http://lone.net/es/a"]
    rows = judged(spark, urls)
    assert {rows[i].template for i in range(8, 16)} == {"h.net/en/**"} and {rows[i].verdict for i in range(8, 16)} == {"allow"}
    assert {rows[i].template for i in range(8)} == {"h.net/es/**"}
    # Two pages show no difference, so they are judged together.
    assert rows[16].template == rows[17].template == "lone.net/**"


def test_odd_rows_and_clashing_columns(spark):
    long = "http://h.net/es/" + "x/" * 20000
    rows = [(None, "http://h.net/es/1", 1, "a"), (1, long, 2, "b"), (1, long, 2, "b"), (2, None, None, None), (3, "http://h.net/es", 4, "c")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, purity int, host string")
    found = judge_pages(pages, URL_RULES)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict", "template"]
    got = sorted(((r.page_id, r.host, r.verdict) for r in found.collect()), key=str)
    assert got == sorted([(None, "h.net", "block"), (1, "h.net", "block"), (1, "h.net", "block"), (2, "", "allow"), (3, "h.net", "block")], key=str)
