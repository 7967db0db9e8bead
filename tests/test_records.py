"""Names, summaries, surviving fragments and short needles against brute force."""

import random

from pyspark.sql import functions as F

from folioforge.operators import dedup, names, provenance, relational, summary
from folioforge.sources import html


def test_names_and_titles(spark):
    assert names.names_match("Lu Xun", "Lu, Xun, 1881-1936") and not names.names_match("Lu Xun", "Lu Xin")
    assert names.names_match("鲁迅", "（清）鲁 迅 著") and names.names_match("ﾊﾅｺ", "ハナコ") and not names.names_match("《》", "鲁迅")
    assert not names.names_match(None, "x") and not names.names_match("x", "") and not names.names_match("123", "123")
    a = spark.createDataFrame([("《Ｆｏｏ》 Bar",), ("...",), (None,)], "t string")
    b = spark.createDataFrame([("foo-bar",), ("Foo Bar",), ("foo",), (None,)], "u string")
    assert {tuple(r) for r in names.same_titles(a, b, "t", "u").collect()} == {("《Ｆｏｏ》 Bar", "foo-bar"), ("《Ｆｏｏ》 Bar", "Foo Bar")}
    both = spark.createDataFrame([("Lu Xun", "Xun Lu"), (None, "x")], "n string, f string")
    assert [r[0] for r in both.select(names.match_column(F.col("n"), F.col("f"))).collect()] == [True, False]


def test_surviving_fragments_and_short_needles(spark):
    rng = random.Random(4)
    long = ["".join(rng.choice("abcdefgh 一二三四,.") for _ in range(rng.randrange(1, 90))) for _ in range(30)]
    rows = [(i % 2, 100 + i, t) for i, t in enumerate(long)]
    for i in range(60):
        t = rng.choice(long)
        a = rng.randrange(len(t))
        rows.append((i % 2, 200 + i, t[a : a + rng.randrange(1, 40)]))
    rows += [(0, 900, None), (0, 901, ""), (None, 902, "x")]
    df = spark.createDataFrame(rows, "g int, k int, t string")
    want = {(g, t) for g, _, t in rows if t and g is not None and not any(h == g and u and len(u) > len(t) and t in u for h, _, u in rows)}
    assert {(r["g"], r["text"]) for r in dedup.surviving(df, "g", "k", "t").collect() if r["g"] is not None} == want
    needles = spark.createDataFrame([(1, "a"), (2, "一二"), (3, "bcd"), (4, "zz"), (5, None), (6, ",.")], "n int, q string")
    hays = spark.createDataFrame([(i, t) for i, t in enumerate(long)], "d int, t string")
    solid = lambda t: "".join(c for c in t if c not in " ,.")
    got = {(r["n"], r["d"]) for r in provenance.located(needles, hays, "n", "q", "d", "t").collect()}
    assert got == {(n, i) for n, q in ((1, "a"), (2, "一二"), (3, "bcd"), (4, "zz")) for i, t in enumerate(long) if q in solid(t)}


def test_upper_median_and_summaries(spark):
    rows = [("a", 3), ("a", 1), ("a", 1), ("a", 9), ("b", 5), ("b", None), (None, 1)]
    df = spark.createDataFrame(rows, "g string, v int")
    assert {tuple(r) for r in relational.upper_median(df, "g", "v").collect()} == {("a", 3), ("b", 5)}
    assert relational.upper_median(df.limit(0), "g", "v").count() == 0
    x = spark.createDataFrame([("s", 1, ["a"], "t"), ("s", 2, None, " "), (None, 2, [], None)], "g string, k int, l array<string>, f string")
    assert {tuple(r) for r in summary.field_counts(x, "k", ["l"], ["f"]).collect()} == {(1, 1, 1), (2, 0, 0)}
    got = {r["g"]: r["ok"] for r in summary.closed_set(x, "g", "k", 2, F.col("f") == "bad").collect()}
    assert got == {"s": True, None: False}


def test_page_title(spark):
    pages = ["<html><TITLE lang=x>\n A &amp; B &lt;c&gt; </title>", "<p>none</p>", "<title> </title>", None]
    got = spark.createDataFrame([(p,) for p in pages], "m string").select(html.page_title(F.col("m"))).collect()
    assert [r[0] for r in got] == ["A & B <c>", None, None, None]
