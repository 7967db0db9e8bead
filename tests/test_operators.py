"""Core operators on small fixtures and against brute force."""

import random
import zlib

from pyspark.sql import functions as F

from folioforge.functions import rules
from folioforge.functions.text import estimate, estimate_py
from folioforge.operators import cleaning, dedup, gates, planning, provenance, relational, style
from folioforge.plans.lineage import cut, small_enough
from folioforge.sources import files, html, markdown
from folioforge.streaming import events


def test_estimate_agrees_with_python(spark):
    texts = ["", " ", "a", "abcd efgh", "中文测试", "中 a\u3000b\u00a0c\u2028d\x1ce", "é" * 50, None]
    got = {r["t"]: r["n"] for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", estimate(F.col("t")).alias("n")).collect()}
    assert all(got[t] == estimate_py(t) for t in texts)


def test_scalar_rules(spark):
    df = spark.createDataFrame([("P1_a.txt", "a-b", "a/b.txt"), ("my_first.md", "A-b", "../x"), ("secondary.pdf", "con", "a//b"), ("x", "a\n", "C:/x"), (None, None, None)], "n string, s string, p string")
    got = df.select(rules.source_priority(F.col("n")).alias("n"), rules.slug_valid(F.col("s")).alias("s"), rules.safe_path(F.col("p")).alias("p")).collect()
    assert [r["n"] for r in got] == [1, 2, 4, 5, 5]
    assert [r["s"] for r in got] == [True, False, False, False, None]
    assert [r["p"] for r in got] == [True, False, False, False, None]


def test_first_and_longest_match(spark):
    df = spark.createDataFrame([("/a/b",), ("/a/bc",), ("/x",), ("/a/b.pdf",)], "p string")
    assert [r[0] for r in df.select(relational.first_match(df, F.col("p"), [("*.pdf", "pdf"), ("/a/*", "a")])).collect()] == ["a", "a", None, "pdf"]
    allow = df.select(relational.longest_match(F.col("p"), [("/a", False), ("/a/b", True), ("/a/b$", False), ("/x", False), ("/*", True)])).collect()
    assert [r[0] for r in allow] == [False, True, True, True]  # equally long rules: the allowing one


def prose(n):
    return "\n".join(f"第{i}行正文，讲的是第{i}件事情的经过。" for i in range(n))


def actions(spark, text, **kw):
    return [(r["line_no"], r["action"]) for r in cleaning.marked_lines(spark.createDataFrame([(1, text)], "k int, text string"), "k", **kw).where("action is not null").orderBy("line_no").collect()]


def test_prose_is_left_alone(spark):
    assert actions(spark, prose(60)) == []


def test_index_run_and_contents(spark):
    index = "\n".join(f"term{i}, {i}, {i + 1}–{i + 2}" for i in range(19))
    assert [a for _, a in actions(spark, prose(5) + "\n" + index + "\n" + prose(5))] == ["index_toc_lines"] * 19
    assert len(actions(spark, "\n".join(f"Chapter {i} ..... {i * 7}" for i in range(14)))) == 14
    assert actions(spark, "\n".join(f"term{i}, {i}" for i in range(11))) == []


def test_running_heads_need_page_ends(spark):
    page = "{n}\n长桥日录卷首\n问：\n正文一句话在这里，第{n}页。\n答：\n另一句正文在这里，也在第{n}页。"
    got = actions(spark, "\n".join(page.format(n=i + 1) for i in range(12)))
    assert sum(a == "running_head_lines" for _, a in got) == 12 and sum(a == "page_number_lines" for _, a in got) == 12
    letters = "\n".join(f"To Edwin\nthe body of letter number {i}." for i in range(12))
    assert actions(spark, letters) == []


def test_page_markers_stay_and_ads_go(spark):
    got = actions(spark, "--- Page 3 ---\n≦ 12 ≧\n1\n2\n3\n更多电子书请访问 www.x.com 下载\n神经网络提供了方法")
    assert got == [(2, "page_number_lines"), (3, "page_number_lines"), (4, "page_number_lines"), (5, "site_ad_lines")]


def test_verdicts(spark):
    rows = [(1, ""), (2, "好" * 300), (3, "好" * 100 + "�"), (4, "Ã©" * 200), (5, "short"), (6, None)]
    got = {r["k"]: (r["verdict"], r["reasons"], r["flags"]) for r in cleaning.with_verdict(cleaning.with_metrics(spark.createDataFrame(rows, "k int, text string"))).collect()}
    assert got[1] == got[6] == ("rejected", "empty_after_cleaning", "")
    assert got[2][0] == "accepted" and got[3][1] == "replacement_chars" and got[4][1] == "mojibake_utf8_as_latin" and got[5] == ("flagged", "", "very_short")


def test_book_frame_and_disclaimer(spark):
    book = "licence\n*** START OF THE PROJECT GUTENBERG EBOOK X ***\nbody\n*** END OF THE PROJECT GUTENBERG EBOOK X ***\nmore"
    scan = "Google Book Search helps.\nKeep it legal.\n\nThe text itself.\n\nIt goes on."
    df = spark.createDataFrame([(book, scan), ("plain", "I like Google Book Search.\n\nText")], "a string, b string")
    got = df.select(cleaning.strip_book_frame(F.col("a")), cleaning.strip_scan_disclaimer(F.col("b"))).collect()
    assert got[0][0].strip() == "body" and "Google" not in got[0][1] and "The text itself." in got[0][1] and got[1] == ("plain", "I like Google Book Search.\n\nText")


def brute_prints(text, n=8, k=8):
    s = "".join(c for c in text or "" if c.isalnum())
    return sorted({c for i in range(len(s) - n + 1) if (c := zlib.crc32(s[i : i + n].encode())) % k == 0})


def test_prints_are_sampled_crcs():
    rng = random.Random(3)
    for _ in range(200):
        t = "".join(rng.choice("abcé中文 あ،.\U0001f600q") for _ in range(rng.randrange(0, 60)))
        assert dedup.prints_of(t).tolist() == brute_prints(t)


def brute_edges(sets):
    reps = {}
    for k in sorted(sets):
        if sets[k]:
            reps.setdefault(tuple(sets[k]), k)
    out = set()
    ids = sorted(reps.values())
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = set(sets[a]), set(sets[b])
            s, g = (a, b) if (len(x), a) < (len(y), b) else (b, a)
            n = len(x & y)
            if n and n >= 0.85 * len(x | y) - 1e-9:
                out.add((s, g, "near_duplicate"))
            elif n and n >= 0.9 * min(len(x), len(y)) - 1e-9:
                out.add((s, g, "contained"))
    return out


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(5)
    words = [f"word{i}x" for i in range(200)]
    base = [" ".join(rng.choices(words, k=150)) for _ in range(12)]
    docs = list(base)
    for b in base[:8]:
        w = b.split()
        docs.append(" ".join(w[:120]))
        for i in rng.sample(range(len(w)), 4):
            w[i] = "changed" + str(i)
        docs.append("  ".join(w))
    docs += [base[0], base[0].replace(" ", "-"), "", None, "short"]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, text string")
    p = cut(dedup.prints(df, "id"))
    got = {(r["small"], r["big"], r["relation"]) for r in dedup.edges(p, "id").collect()}
    assert got == brute_edges({i: brute_prints(t) for i, t in enumerate(docs)})
    links = dedup.edges(p, "id")
    gone = {r["dropped"]: r["kept"] for r in dedup.resolved(links).collect()}
    assert gone and not set(gone) & set(gone.values())


def test_edges_store_no_candidates(spark, monkeypatch):
    rng = random.Random(9)
    stock = [" ".join(rng.choices([f"word{i}x" for i in range(40)], k=12)) for _ in range(30)]
    docs = [". ".join(rng.choices(stock, k=rng.choice([1, 2, 3, 9, 40]))) for _ in range(120)]
    df = spark.createDataFrame([(f"k{i}", t) for i, t in enumerate(docs)], "id string, text string")
    want = brute_edges({f"k{i}": brute_prints(t) for i, t in enumerate(docs)})
    assert {"near_duplicate", "contained"} == {x[2] for x in want}
    for block, chunk in ((10**6, 10**6), (1500, 50)):  # one block, and several
        monkeypatch.setattr(dedup, "BLOCK", block)
        monkeypatch.setattr(dedup, "CHUNK", chunk)
        links = dedup.edges(dedup.prints(df, "id"), "id")
        rows = links.collect()
        assert len(rows) == len(want) and {(r["small"], r["big"], r["relation"]) for r in rows} == want
        assert "array_intersect" not in links._jdf.queryExecution().optimizedPlan().toString()  # no pairs with their sets
    assert not dedup.edges(dedup.prints(df.where("false"), "id"), "id").collect()

def test_every_text_has_a_class(spark):
    long = "a text of which some grams are sampled, as it is long enough for that, " * 3
    texts = ["short", "Short?", "sho-rt", None, None, "", " ", "???", "!!!", long, long.replace(",", "")]
    assert len(dedup.prints_of(long)) and not any(len(dedup.prints_of(t)) for t in texts[:9])
    got = {r["k"]: r["class_id"] for r in dedup.classes(dedup.prints(spark.createDataFrame(list(enumerate(texts)), "k int, t string"), "k", "t"), "k").collect()}
    assert got == {0: 0, 1: 1, 2: 0, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 8, 9: 9, 10: 9}


def first_come(links):
    """The reference's rule, pair by pair."""
    gone = {}
    for s, b, relation in sorted(links, key=lambda x: (min(x[:2]), max(x[:2]))):
        worse, better = (max(s, b), min(s, b)) if relation == "near_duplicate" else (s, b)
        if worse not in gone and better not in gone:
            gone[worse] = better
    return gone


def resolved_of(spark, links, kind="int"):
    return {r["dropped"]: r["kept"] for r in dedup.resolved(spark.createDataFrame(links, f"small {kind}, big {kind}, relation string")).collect()}


def test_resolved_cycles_and_long_chains(spark):
    # x < z < y: x in y, z near x, y near z; all three waited for each other
    assert resolved_of(spark, [(1, 3, "contained"), (1, 2, "near_duplicate"), (2, 3, "near_duplicate")]) == {2: 3, 1: 3}
    chain = [(f"v{i:03}", f"v{i + 1:03}", "near_duplicate") for i in range(130)]  # deeper than 50 rounds
    assert resolved_of(spark, chain, "string") == {f"v{i:03}": f"v{i - 1:03}" for i in range(1, 131, 2)}
    assert resolved_of(spark, [(i, i + 1, "contained") for i in range(60)]) == dict.fromkeys(range(60), 60)
    rng = random.Random(8)
    links = {}
    for _ in range(220):
        a, b = rng.sample(range(200), 2)
        links[min(a, b), max(a, b)] = (a, b, rng.choice(["near_duplicate", "contained"]))
    got = resolved_of(spark, list(links.values()))
    want = first_come(links.values())
    assert set(got) == set(want) and not set(got) & set(got.values()) and all(got[k] == want[k] or want[k] in want for k in want)


def test_links_are_thinned_before_groups_are_found(spark, monkeypatch):
    rng = random.Random(11)
    links = [(g * 50 + a, g * 50 + b) for g in range(4) for a, b in (rng.sample(range(50), 2) for _ in range(900))]
    df = spark.createDataFrame(links, "u int, v int").repartition(3)
    assert sum(b.num_rows for b in dedup._forest(iter(df.toArrow().to_batches()))) == 200
    for most in (dedup.LINKS, 0):  # in one task, and in rounds
        monkeypatch.setattr(dedup, "LINKS", most)
        got = dedup.components(df).collect()
        assert sorted((r["id"], r["component"]) for r in got) == [(i, i // 50 * 50) for i in range(200)]

def test_exact_duplicates_and_survivors(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None)], "k int, text string")
    assert {r["k"]: r["duplicate_of"] for r in dedup.exact_duplicates(df, "k", "text").collect()} == {1: None, 2: None, 3: 1, 4: None, 5: None}
    f = spark.createDataFrame([("g", 1, "abc"), ("g", 2, "xabcx"), ("g", 3, "q"), ("g", 4, "q"), ("h", 5, "abc")], "g string, k int, t string")
    assert sorted((r["g"], r["k"]) for r in dedup.surviving(f, "g", "k", "t").collect()) == [("g", 2), ("g", 3), ("h", 5)]


def test_survivors_join_without_broadcast(spark, monkeypatch):
    rng = random.Random(6)
    long = ["".join(rng.choices("abcdefgh", k=rng.choice([3, 9, 30, 90, 200]))) for _ in range(40)]
    texts = sorted({*long, *(t[i : i + k] for t in long for i, k in ((0, 1), (2, 3), (5, 12), (8, 60), (3, 150)))} - {""})
    rows = [(rng.choice("gh"), i, t) for i, t in enumerate(texts)]
    want = sorted(i for g, i, t in rows if not any(h == g and len(u) > len(t) and t in u for h, _, u in rows))
    f = spark.createDataFrame(rows, "g string, k int, t string")
    assert sorted(r["k"] for r in dedup.surviving(f, "g", "k", "t").collect()) == want
    monkeypatch.setattr(dedup, "FEW", 0)
    left = dedup.surviving(f, "g", "k", "t")
    assert "Broadcast" not in left._jdf.queryExecution().sparkPlan().toString()
    assert sorted(r["k"] for r in left.collect()) == want

def test_packing_against_a_loop(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice([None, 0, 5, 40, 70, 200])) for i in range(300)]
    got = {r["i"]: r["shard"] for r in planning.pack_shards(spark.createDataFrame(rows, "g string, i int, n int"), "g", ["i"], "n", 100, 150).collect()}
    for g in ("a", "b", None):
        shard, now, first = 1, 0, True
        for _, i, n in [r for r in rows if r[0] == g]:
            n = n or 0
            if now and (now >= 100 or now + n > 150):
                shard, now = shard + 1, 0
            now += n
            assert got[i] == shard


def test_stratified_sample_counts(spark):
    df = spark.createDataFrame([(f"s{i % 3}", f"u{i}") for i in range(31)] + [(None, "x"), (None, "y")], "s string, u string")
    a = planning.stratified_sample(df, "s", "u", 7, 0.4)
    n = {r["s"]: (r["n"], r["k"]) for r in a.groupBy("s").agg(F.count("*").alias("n"), F.sum(F.col("selected").cast("int")).alias("k")).collect()}
    assert n == {"s0": (11, 5), "s1": (10, 4), "s2": (10, 4), None: (2, 1)} or n["s0"] == (11, 5) and n["s1"] == (10, 4) and n["s2"] == (10, 4)
    assert sorted(a.where("selected").collect()) == sorted(planning.stratified_sample(df, "s", "u", 7, 0.4).where("selected").collect())


def test_paragraph_chunks_stay_under_the_limit():
    text = "\n\n".join(("word " * n).strip() for n in (10, 400, 3000, 20)) + "\n\n" + "中" * 5000
    chunks = planning.split_paragraphs(text, 300)
    assert max(map(estimate_py, chunks)) <= 300 and "word" in chunks[0] and planning.split_paragraphs(None, 5) == [] and planning.split_paragraphs(" \n", 5) == []


def test_located_and_prefix(spark):
    docs = spark.createDataFrame([(1, "He said：『the long way teaches the ground, always』."), (2, "ＡＢＣ中文"), (3, None)], "d int, t string")
    needles = spark.createDataFrame([(1, "the long way teaches the ground"), (2, "abc"), (3, "ABC"), (4, "the long way leads nowhere at all"), (5, "，。"), (6, None)], "n int, q string")
    got = {r["n"]: r["found_in"] for r in provenance.first_located(needles, docs, "n", "q", "d", "t").collect()}
    assert got == {1: 1, 2: None, 3: 2, 4: None, 5: None, 6: None}
    p = spark.createDataFrame([("abcdef", "xxabcdxx"), ("", "x"), ("q", "x"), ("x", "x")], "a string, b string").select(provenance.longest_prefix(F.col("a"), F.col("b")))
    assert [r[0] for r in p.collect()] == [4, 0, 0, 1]


def test_style_and_dialogue(spark):
    md = "intro\n**Q:** Why?\n**A:** First, one. Second, two.\nmore\nQ: lost\nQ：again?\nA：you should rest. you must. You need to go!"
    pairs = markdown.pairs(markdown.dialogue_lines(spark.createDataFrame([(1, md), (2, None), (3, "")], "k int, text string"), "k"), "k")
    got = [(r["prompt"], r["response"].split("\n")[0][:9]) for r in pairs.orderBy("turn").collect()]
    assert got == [("Why?", "First, on"), ("again?", "you shoul")]
    t = {r["turn"]: r for r in style.turn_figures(pairs, "k").collect()}
    assert t[2]["ordinal"] and not t[5]["ordinal"] and t[5]["lecturing"] == 3
    assert style.drift_flags(style.turn_figures(pairs, "k"), "k").collect()[0]["flags"] == "ORDINAL_ENUMERATION|SECOND_PERSON_LECTURING"
    f = style.features(spark.createDataFrame([("too short",), (None,), ("我想。" * 30 + "真的吗？" * 10,)], "text string")).collect()
    assert f[0]["question_rate"] is None and f[1]["sentences_n"] == 0 and f[2]["question_rate"] == 0.25


def test_gates_raise_exactly_their_code(spark):
    ok = [(1, "a", 5), (2, "b", 6)]
    def run(rows):
        df = spark.createDataFrame(rows, "id int, name string, n int")
        return sorted(r["code"] for r in gates.union([gates.required(df, "g", "id", ["name"]), gates.in_range(df, "g", "id", "n", 1, 9), gates.unique(df, "g", "id"), gates.one_of(df, "g", "id", "name", ["a", "b", " "])]).collect())
    assert run(ok) == []
    assert run([*ok, (3, " ", 5)]) == ["MISSING_FIELD"]
    assert run([*ok, (3, "a", 10)]) == ["INVALID_VALUE"]
    assert run([*ok, (2, "a", 1)]) == ["DUPLICATE_ID"]
    assert run([*ok, (3, "c", 1)]) == ["UNKNOWN_VALUE"]


def test_number_rows_and_concentration(spark):
    df = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "x int")
    assert sorted((r["row_no"], r["x"]) for r in relational.number_rows(df, ["x"]).collect()) == [(i + 1, i) for i in range(101)]
    empty = spark.createDataFrame([], "v string")
    assert relational.concentration(empty, "v").collect()[0] == (0, None, 0.0, 0.0)


def test_files_roundtrip(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "sub").mkdir(parents=True)
    (raw / "a.txt").write_bytes("中文文本，足够长。".encode("gb18030"))
    (raw / "sub" / "b.md").write_bytes("plain".encode())
    (raw / "c.txt").write_bytes("plain".encode())
    (raw / "x.bin").write_bytes(b"\x00")
    scan = files.scan(spark, str(raw))
    reg = {r["relative_path"]: r for r in files.register(scan).collect()}
    assert set(reg) == {"a.txt", "sub/b.md", "c.txt"} and reg["sub/b.md"]["duplicate_of"] == reg["c.txt"]["source_id"]
    dec = {r["relative_path"]: (r["text"], r["encoding"]) for r in files.decoded(scan, ["relative_path"]).collect()}
    assert dec["a.txt"] == ("中文文本，足够长。", "gb18030") and dec["c.txt"] == ("plain", "utf-8")
    assert files.decode(b"\xff\xfea\x00")[1] == "utf-16" and files.decode(None) == (None, None, 0) and files.decode(b"\xff\xff\xff")[2] == 3
    out = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    assert files.publish(df, out) == []
    assert files.publish(df.withColumn("v", F.lit(None).cast("string")), out, {"v": lambda d: d.where("v is null")}) == ["v"]
    assert spark.read.parquet(out).collect()[0]["v"] == "a"
    up = files.upsert(df, spark.createDataFrame([(1, None, 1), (1, "z", 2), (2, "n", 1)], "k int, v string, o int"), "k", ["o"])
    assert sorted((r["k"], r["v"]) for r in up.collect()) == [(1, "z"), (2, "n")]
    path = str(tmp_path / "log")
    files.append_json_lines(df, path)
    files.append_json_lines(df, path)
    assert files.read_json_lines(spark, path, "k int, v string").count() == 2


def test_html_and_markdown(spark):
    page = "<html><body><div class='m x'><p>A &amp; B<span style='display: none'>no</span></p>one<br>two<a href='/q'>l</a></div><p>outside</p><script>s</script>"
    assert html.html_to_text(page, "m") == ("A & B\none\ntwol\n", ["/q"])
    assert "outside" in html.html_to_text(page, "missing")[0] and html.html_to_text(None) == (None, [])
    md = "---\nname: x\ndesc: >\n  long\n  text\n---\n> 「top」\n## H\n- 「listed」\n### C1\n> quoted\n> twice\n- a：1\n- b: 2\n- a: 3\n{left}"
    df = spark.createDataFrame([(1, md)], "k int, text string")
    assert {(r["name"], r["value"]) for r in markdown.front_matter(df, "k").collect()} == {("name", "x"), ("desc", "long text")}
    c = markdown.cards(df, "k").collect()[0]
    assert (c["title"], c["verbatim"], c["fields"]) == ("C1", "quoted\ntwice", {"a": "3", "b": "2"})
    assert {(r["place"], r["quote"]) for r in markdown.quotations(df, "k").collect()} == {("epigraph", "top"), ("list", "listed")}
    assert [r["placeholder"] for r in markdown.template_residue(df, "k").collect()] == ["{left}"]
    r = spark.createDataFrame([("1-3,10",), ("2",), ("x",)], "s string").select(markdown.page_ranges(F.col("s"))).collect()
    assert [x[0] for x in r] == [[1, 2, 3, 10], [2], None]


def test_streams_agree_with_batch(spark, root):
    e = spark.read.parquet(f"{root}/events.parquet")
    s = spark.readStream.schema(e.schema).option("pathGlobFilter", "events.parquet").parquet(root)
    for name, f, mode in (("latest", events.latest, "complete"), ("failing", events.failing, "complete"), ("tumbling", events.tumbling, "complete")):
        q = f(events.timed(s)).writeStream.outputMode(mode).format("memory").queryName(f"t_{name}").trigger(availableNow=True).start()
        q.awaitTermination()
        assert sorted(map(tuple, spark.table(f"t_{name}").collect())) == sorted(map(tuple, f(e.withColumn("at", F.col("ts").cast("timestamp"))).collect()))


def test_small_enough(spark):
    assert small_enough(spark.range(5), 5) and not small_enough(spark.range(6), 5)
