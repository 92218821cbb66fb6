import numpy as np
import pytest

from clickweave.llm import url_filter as u
from clickweave.llm.queries import URL_RULES
from llm_help import rows

URLS = [
    ("http://a.Example.NET/en/x?y#z", "example.net/en/", "allow"), ("https://example.net/enx", "net/", "block"), ("https://example.net", None, "allow"),
    ("https://net/", "net/", "block"), ("https://xnet/", None, "allow"), ("http://sub.example.com/de/", "example.com/de/", "block"),
    ("http://example.com/DE/", None, "allow"), ("x://org/fr/?q=://net/", "org/fr/", "allow"), ("no scheme.net/", None, "allow"), (None, None, "allow"),
    ("", None, "allow"), ("://", None, "allow"), ("http://" + "a." * 20_000 + "net/" + "p" * 50_000, "net/", "block"), ("http://.net/x", "net/", "block"),
]


def test_rules_on_odd_urls(spark):
    pages = spark.createDataFrame([(i, x, "h", "c") for i, (x, _, _) in enumerate(URLS)] + [(0, URLS[0][0], None, None)], "page_id long, url string, host string, rule string")
    got = rows(u.filter_urls(pages.repartition(3), URL_RULES), "page_id", "rule", "verdict")
    assert got == sorted([(i, r, v) for i, (_, r, v) in enumerate(URLS)] + [(0, *URLS[0][1:])], key=repr)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert u.filter_urls(none, URL_RULES).collect() == []
    one = spark.createDataFrame([(None, "http://a.net/")], "page_id long, url string")
    assert rows(u.filter_urls(one, []), "page_id", "rule", "verdict") == [(None, None, "allow")]
    assert rows(u.filter_urls(one, [("block", "net")], default="block"), "host", "path", "rule", "verdict") == [("a.net", "/", "net", "block")]


def test_equal_keys_are_told_apart(tmp_path):
    path = tmp_path / "index"
    path.write_bytes(u.packed(URL_RULES, key=lambda s: 7))
    index = u.Mapped(str(path), key=lambda s: 7)
    assert index.judge(["a.net", "b.com", "org"], ["/x", "/y", "/fr/"]) == [("net/", 1), None, ("org/fr/", 0)]
    assert isinstance(index.keys.base, np.memmap) or isinstance(index.keys, np.memmap)


def test_the_last_of_equal_rules_holds_and_longer_hosts_win_ties(tmp_path):
    path = tmp_path / "index"
    path.write_bytes(u.packed([("block", "a.com/bc"), ("allow", "x.a.com/"), ("block", "z.org/"), ("allow", "Z.org/")]))
    assert u.Mapped(str(path)).judge(["x.a.com", "z.org"], ["/bc", "/"]) == [("x.a.com/", 0), ("z.org/", 0)]


def test_refusals(spark):
    with pytest.raises(ValueError):
        u.packed([("block", "/only/path")])
    with pytest.raises(ValueError):
        u.publish(spark, [("block", "net/")], max_bytes=3)
