"""URL filters: keys, rules, the cascade."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantlake.llm.queries import URL_RULES
from plantlake.llm.urlfilter import Cascade, build_cascade, in_cascade, judge


def pages(spark, *urls):
    rows = [(k, u) for k, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string").withColumn("listed", F.lit("own"))


def test_keys_rules_and_verdicts(spark):
    got = judge(pages(
        spark, "https://A.Example.ORG/es/x?q#f", "http://example.org/en/12", "http://badexample.org/es/",
        "http://x.com/fr/1", "http://x.com/de/1", "http://com/de/", "ftp://x.net", None, "no scheme",
        "http://x.org#://y/es/", "x://y.com?/de/", "a\nb://x.com/de/\n?", "http://x.com:80/de/",
    ), URL_RULES).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [
        ("a.example.org", "/es/x", "example.org/es/", "block"),
        ("example.org", "/en/12", "example.org/en/1", "block"),
        ("badexample.org", "/es/", "org/", "allow"),
        ("x.com", "/fr/1", "com/fr/", "allow"),
        ("x.com", "/de/1", "com/de/", "block"),
        ("com", "/de/", "com/de/", "block"),
        ("x.net", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("x.org", "", None, "allow"),
        ("y.com", "", None, "allow"),
        ("x.com", "/de/\n", "com/de/", "block"),
        ("x.com:80", "/de/", None, "allow"),
    ]


@pytest.mark.parametrize("listed", [0, 1, 300, 2999, 3000])
def test_cascade_is_exact_over_its_universe(listed):
    rng = np.random.default_rng(listed)
    h1, h2 = (rng.integers(0, 2**64, 3000, dtype=np.uint64) for _ in range(2))
    inside = np.arange(3000) < listed
    levels = build_cascade(h1, h2, inside)
    assert (in_cascade(levels, h1, h2) == inside).all()
    assert listed != 300 or len(levels) > 2


def test_shipped_and_routed_filters_agree(spark):
    urls = [f"http://h{k % 7}.com/{'de' if k % 3 else 'fr'}/{k % 50}" for k in range(400)]
    keyed = judge(pages(spark, *urls), URL_RULES).select("page_id", "host", "path", "verdict")
    universe = keyed.select("host", "path", (F.col("verdict") == "block").alias("listed")).distinct()
    cascade = Cascade.build(universe, shard_keys=20)
    assert cascade.count > 3
    shipped = cascade.contains(keyed)
    routed = cascade.contains(keyed, max_shipped=0)
    assert shipped.exceptAll(routed).isEmpty() and routed.exceptAll(shipped).isEmpty()
    assert shipped.where("listed <> (verdict = 'block')").isEmpty()


def test_empty_table(spark):
    assert judge(pages(spark, "http://x.com/de/").where("false"), URL_RULES).collect() == []
