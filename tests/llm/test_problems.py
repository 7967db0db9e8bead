"""The ten problems: small fixtures, brute force, round trips, nulls, empty tables, repeated rows, clashing columns."""

import glob
import math
import os
import random
import unicodedata

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.functions.text import estimate_py
from folioforge.llm import encoding, fill, leak, lid, lookalike, ocr, sample, sentences, split, tokens
from folioforge.llm.queries import QUERIES, SQL

LONG = "This is a sentence of a long text. " * 4000


@pytest.fixture(scope="module")
def model():
    return lid.train([])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run_and_agree_with_sql(spark, root, name):
    got = QUERIES[name](spark, root)
    rows = got.collect()
    if name.endswith("_found"):
        assert len(set(rows)) == len(rows)
    if name in SQL:
        c = duckdb.connect()
        for f in glob.glob(f"{root}/*.parquet"):
            c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
        want = c.execute(SQL[name]).df()
        assert sorted(map(tuple, rows)) == sorted(map(tuple, want[got.columns].values.tolist()))


# 1 splitting


def test_split_pieces_cover_overlap_and_limit():
    rng = random.Random(2)
    for k in range(60):
        unit = rng.choice(["word ", "中文字符。", "Satz eins. Satz zwei!\n", "x", "# Head\n\npara one.\n\n", "ก", "é"])
        text = unit * rng.randrange(50, 900)
        limit = rng.randrange(40, 200)
        overlap = rng.randrange(0, limit // 3)
        pieces = split.split_text(text, limit, overlap)
        assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
        for i, (a, b, _) in enumerate(pieces):
            assert estimate_py(text[a:b]) <= limit and b > a
            if i:
                assert pieces[i - 1][0] < a <= pieces[i - 1][1]
                assert estimate_py(text[a : pieces[i - 1][1]]) >= min(overlap, estimate_py(text[pieces[i - 1][0] : pieces[i - 1][1]]) - 1)
    with pytest.raises(ValueError):
        split.split_text("x", 10, 10)


def test_split_prefers_natural_boundaries(spark):
    text = "\n\n".join(("This is one sentence of the text. " * 12).strip() for _ in range(12))
    levels = {x[2] for x in split.split_text(text, 200, 10)[:-1]}
    assert levels <= {"paragraph", "section"}
    df = spark.createDataFrame([(1, text, None, "x"), (1, text, "b, p. 2", "x"), (2, None, "d", "x"), (3, "", "d", "x"), (4, LONG, "d", "x")], "segment_id bigint, text string, source_detail string, piece_no string")
    got = split.split_oversized(df, 1000, 60).collect()
    assert {r["segment_id"] for r in got} == {1, 4} and any(r["source_detail"].startswith("b, p. 2, part 1 of") for r in got) and any(r["source_detail"].startswith("part 1 of") for r in got)
    assert split.split_oversized(df.limit(0), 100, 5).count() == 0


# 2 tokens


def brute_count(pieces, word):
    vocab, n, i = set(pieces), 0, 0
    while i < len(word):
        for j in range(len(word), i, -1):
            if word[i:j] in vocab:
                n, i = n + 1, j
                break
        else:
            n += len(word[i].encode())
            i += 1
    return n


def test_counter_equals_longest_match():
    rng = random.Random(4)
    for _ in range(60):
        pieces = {"".join(rng.choice("abé中") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 25))} | {tokens.START + "a"}
        c = tokens.Counter(sorted(pieces))
        for _ in range(40):
            w = tokens.START + "".join(rng.choice("abé中x") for _ in range(rng.randrange(0, 14)))
            assert c.word(w) == brute_count(pieces, w)
    assert c.text("") == c.text(" \n") == 0


def test_audit_and_file_names(spark):
    df = spark.createDataFrame([(1, None, "some text here"), (2, 4, "some text here"), (3, 0, None), (4, 9, None), (5, 0, ""), (6, 30000, LONG)], "segment_id bigint, token_estimate bigint, text string")
    got = {r["segment_id"]: (r["text_estimate"], r["mistaken"]) for r in tokens.audit(df).collect()}
    assert got[1] == (3, True) and got[2] == (3, True) and got[3] == (0, False) and got[4] == (0, True) and got[5] == (0, False)
    names = spark.createDataFrame([("raw\\A b.TXT",), ("./x/A_b.txt ",), ("  ",), (None,)], "n string").select(tokens.file_name(F.col("n")))
    assert [r[0] for r in names.collect()] == ["a_b.txt", "a_b.txt", None, None]


def test_totals_count_each_unit_once(spark):
    text = "The man who was there said that it is not yet known whether they had been to the house."
    rows = [(1, "u1", "A.txt", "s1", "en", text), (2, "u1", "./a.TXT", "s1", None, text), (3, None, "a.txt", None, "fr", text), (4, "u2", None, "s9", "en", None), (5, "u3", None, "s1", "en", text)]
    registry = [(1, "s1", "old.txt", "http://old.org", 1), (2, "s1", "x/A.txt", "HTTPS://www.Site.org:80/p", 2), (3, None, "n.txt", None, None)]
    segments = spark.createDataFrame(rows, "segment_id bigint, unit_id string, source_file string, source_id string, language string, text string").withColumn("tokens", F.lit("clash"))
    registered = spark.createDataFrame(registry, "registry_id bigint, source_id string, filename string, canonical_url string, version int")
    got = {(r["source_file"], r["domain"], r["language"]): (r["units"], r["token_estimate"]) for r in tokens.totals(segments, registered).collect()}
    n = estimate_py(text)
    assert got == {("a.txt", "site.org", "en"): (2, 2 * n), ("a.txt", None, "en"): (1, n), (None, None, None): (1, 0)}
    assert tokens.totals(segments.limit(0), registered.limit(0)).count() == 0


def test_tokens_are_those_of_longest_match(spark, root):
    """All words of all segments against a greedy search for the longest piece."""
    pieces = set(tokens.vocabulary())
    longest = max(map(len, pieces))
    known = {}

    def brute(word):
        n = i = 0
        while i < len(word):
            j = next((j for j in range(min(len(word), i + longest), i, -1) if word[i:j] in pieces), None)
            n, i = (n + 1, j) if j else (n + len(word[i].encode()), i + 1)
        return n

    rows = spark.read.parquet(f"{root}/segments.parquet").select("segment_id", "text")
    texts = {r["segment_id"]: r["text"] for r in rows.collect()}
    for r in tokens.counted(rows, ["segment_id"]).collect():
        total = 0
        for w in (texts[r["segment_id"]] or "").split():
            if w not in known:
                known[w] = brute(tokens.START + w)
            total += known[w]
        assert r["tokens"] == total


# 3 encodings


SAMPLES = [
    ("Der Müller prüfte die Bücher, und die Frau erklärte schöne Größen für später.", "cp1252"), ("El señor escribió que mañana también vendrá el niño pequeño.", "cp1252"),
    ("若不是小债教人耐性，就别轻信最初的论点！他们带了绳子、灯、盐等等。", "gb18030"), ("なぜ彼女はこの質問のことをその晩書かなかったのか？ノートのページ", "shift_jis"),
    ("По дороге домой он продал старый чертёж и забыл карту канала под крышей совета.", "cp1251"),
]


@pytest.mark.parametrize("text,own", SAMPLES)
def test_encoding_round_trips(text, own):
    for read in ("cp1252", "latin-1", "mac-roman"):
        try:
            garbled = text.encode("utf-8").decode(read)
        except UnicodeDecodeError:
            continue
        assert encoding.repair(garbled)[0] == text, (read, garbled)
    assert encoding.repair(text) == (text, None, None, False)


def test_encoding_legacy_double_and_partial():
    ru, zh, ja, de = SAMPLES[4][0], SAMPLES[2][0], SAMPLES[3][0], SAMPLES[0][0]
    assert encoding.repair(ru.encode("cp1251").decode("latin-1"))[0] == ru
    assert encoding.repair(zh.encode("gb18030").decode("latin-1"))[0] == zh
    assert encoding.repair(ja.encode("shift_jis").decode("gb18030"))[0] == ja
    twice = de.encode("utf-8").decode("latin-1").encode("utf-8").decode("latin-1")
    assert encoding.repair(twice)[0] == de
    part = "A plain line.\n" + de.encode("utf-8").decode("cp1252") + "\n" + ru
    assert encoding.repair(part)[0] == "A plain line.\n" + de + "\n" + ru


def test_encoding_leaves_sound_text(spark):
    sound = ["", None, "plain", "Zoë’s coöperative sold crêpes for £3 or €4. The Ångström column (Å) and the Ærø ferry, ±3°.", "L'ÂGE DU CHÂTEAU, À L'ÉPOQUE DE LA FÊTE.", "one l�st letter", LONG, "ça, c'est « vrai »"]
    df = spark.createDataFrame([(i, t, "utf-16", 5) for i, t in enumerate(sound)], "decoded_id bigint, text string, garbled string, lost bigint")
    got = encoding.repaired(df).collect()
    assert not any(r["garbled"] for r in got) and {r["decoded_id"]: r["repaired"] for r in got} == dict(enumerate(sound))
    lost = encoding.repair("Perch� non tocc� mai la domanda e cos� via, perch� s�?")
    assert lost[3]


# 4 scanned pages


def test_scanned_noise(spark, monkeypatch):
    clean = "The market was closed when the others came home and nobody said a word about the measure of salt. "
    rows = [(i, clean * 2, "a.txt", "s1", "T", "x") for i in range(8)]
    noisy = {
        20: "The rnarket was closed", 21: "The mar-\nket was closed when", 22: "when the others\n- 12 -\ncame home", 23: "when the others\n\n14   NOTES ON SALT\n\ncame home", 24: "when the others\nNotes on Salt\ncame home", 25: "the m�rket was closed",
    }
    fine = {40: "--- Page 3 ---\nThe market was closed", 41: "1. The market\n2. The salt\n- a dash", 42: "when the others came\nhome and nobody said", 43: None, 44: "", 45: "Heading\n\nThe market was closed", 46: "well-\nKnown - no"}
    rows += [(k, t, "b.pdf", "s2", "Notes on Salt, 7", "b.pdf, pages 1-2") for k, t in {**noisy, **fine}.items()]
    df = spark.createDataFrame(rows, "segment_id bigint, text string, source_file string, source_id string, source_title string, source_detail string").withColumn("heads", F.lit("clash"))
    marks = ocr.marked(df)
    got = {r["segment_id"]: r["noisy"] for r in marks.collect()}
    assert {k for k, v in got.items() if v} == set(noisy)
    monkeypatch.setattr(ocr, "BROADCAST_ROWS", 0)  # too many corrections to be broadcast
    assert {r["segment_id"]: r["noisy"] for r in ocr.marked(df).collect()} == got
    text = {r["segment_id"]: r["text"] for r in ocr.reflowed(marks).collect()}
    assert text[20] == "The market was closed" and text[21] == "The market was closed when" and text[22] == text[23] == text[24] == "when the others came home"
    assert text[25] == "the market was closed" and text[40].startswith("--- Page 3 ---\n\nThe") and text[45] == "Heading\n\nThe market was closed"
    assert ocr.marked(df.limit(0)).count() == 0


def scans(spark, rows):
    return spark.createDataFrame([(k, t, "b.pdf", s, title, "b.pdf, pages 1-2") for k, t, s, title in rows], "segment_id bigint, text string, source_file string, source_id string, source_title string, source_detail string").withColumn("source_file", F.concat(F.col("source_id"), F.lit(".pdf")))


@pytest.mark.parametrize("most", [400_000, 0])
def test_heads_are_repeated_lines(spark, monkeypatch, most):
    monkeypatch.setattr(ocr, "BROADCAST_ROWS", most)
    body = "The canal was dug by {} men in the dry season and the salt was\n\nAN ACCOUNT OF SALT\n\ncarried {} miles inland."
    rows = [(i, body.format(i, i + 7), "s1", "Another title") for i in range(12)]  # no number beside it
    rows += [(20 + i, f"{i + 3}   Wages and tolls\n\nThe men of year {i} were paid in salt.", "s2", None) for i in range(3)]
    rows += [(40, "1845  Wheat harvest\n\nThe yield was poor that year.", "s3", "T"), (41, "A text of another page about the yield.", "s3", "T")]
    rows += [(50 + i, f"A line of prose {i}\n\nFirst heading\n\nIt goes on for {i} pages.", "s4", "T") for i in range(3)] + [(60 + i, f"Prose alone, number {i}, and no more.", "s4", "T") for i in range(20)]
    got = {r["segment_id"]: r["heads"] for r in ocr.marked(scans(spark, rows)).collect()}
    assert {k for k, n in got.items() if n} == {*range(12), 20, 21, 22}


def test_a_corpus_of_scans_alone_is_corrected(spark):
    rows = [(i, f"The market of town {i} was open and the others came home with salt.", "s1", "T") for i in range(70)]
    rows += [(100, "The rnarket was closed.", "s1", "T"), (101, "The 0thers carne home.", "s1", "T"), (102, None, "s1", None), (103, "", None, None)]
    out = {r["segment_id"]: r for r in ocr.marked(scans(spark, rows)).collect()}
    assert {k for k, r in out.items() if r["misread"]} == {100, 101}
    assert [x["line"] for x in out[100]["lines"]] == ["The market was closed."] and [x["line"] for x in out[101]["lines"]] == ["The others came home."]


def test_the_text_chooses_between_forms():
    fixes = {"bat": ["hat", "bit"]}
    assert ocr.repair_line("a bat", fixes) == ("a hat", 1) and ocr.repair_line("a bat", fixes, said={"bit"}) == ("a bit", 1)


# 5 sentences


CASES = [
    ("en", '"Is it so?" Ann asked. Ben asked, "Is it true?" Next at 2 p.m. Why did Dr. K. G. Noe (ed. S. Lu), wait... and go? Salt, etc. The file at a.b/v4.1.txt. The answer is no. Then he left.', ['"Is it so?" Ann asked.', 'Ben asked, "Is it true?"', "Next at 2 p.m.", "Why did Dr. K. G. Noe (ed. S. Lu), wait... and go?", "Salt, etc.", "The file at a.b/v4.1.txt.", "The answer is no.", "Then he left."]),
    ("zh", "“真是这样吗？”他问道。他说：“是。不是。”参见第6卷（页2。旧本误作3。），好。他沉默……才说好！", ["“真是这样吗？”他问道。", "他说：“是。不是。”", "参见第6卷（页2。旧本误作3。），好。", "他沉默……才说好！"]),
    ("de", "Am 5. Mai kam M. Sam. Er fragte: „Stimmt das?“ Bd. 7, S. 2, d. h. mehr, usw. Auf Wiedersehen!", ["Am 5. Mai kam M. Sam.", "Er fragte: „Stimmt das?“", "Bd. 7, S. 2, d. h. mehr, usw.", "Auf Wiedersehen!"]),
    ("th", "ฉันไป เขามา“ก ข” แล้ว\nหัวข้อ", ["ฉันไป", "เขามา“ก ข”", "แล้ว", "หัวข้อ"]),
    ("ja", "彼は「A。B。」と言った。「本当か？」と尋ねた。", ["彼は「A。B。」と言った。", "「本当か？」と尋ねた。"]),
    ("hi", '"एक। दो।" उसने कहा। डॉ. करूण ने 16.7 लिखा।', ['"एक। दो।" उसने कहा।', "डॉ. करूण ने 16.7 लिखा।"]),
    ("en", "# Head\n1. First item. It goes on.\n- Second\n\nThe wrapped line goes on and on without\nan end until here. Done.", ["# Head", "1. First item.", "It goes on.", "- Second", "The wrapped line goes on and on without\nan end until here.", "Done."]),
    ("en", "  ", []), ("en", "", []), (None, None, []), ("en", '"unclosed. Then more. (and', ['"unclosed.', "Then more.", "(and"]),
]


@pytest.mark.parametrize("lang,text,want", CASES)
def test_sentences(lang, text, want):
    got = [text[a:b] for a, b in sentences.sentence_ends(text, lang)]
    assert got == want


def test_sentence_table(spark, model):
    df = spark.createDataFrame([(1, "One. Two.", 1), (1, "One. Two.", 1), (2, None, 1), (3, "", 1), (4, LONG, 1)], "segment_id bigint, text string, end_pos int")
    got = sentences.sentences(df, model).groupBy("segment_id").count().collect()
    assert {r[0]: r[1] for r in got} == {1: 4, 4: 4000}


# 6 sampling


def test_sampling_report_and_draw(spark):
    rng = random.Random(9)
    rows = [(i, f"u{i}", "big", "word " * rng.randrange(1, 30)) for i in range(400)] + [(1000 + i, f"s{i}", "small", "word word") for i in range(3)]
    rows += [(2000, "u0", "big", "word " * 5), (2001, None, "big", "x"), (2002, "n", None, "x"), (2003, "b", " ", "x")]
    seg = spark.createDataFrame(rows, "segment_id bigint, unit_id string, stratum_key string, text string").withColumn("tokens", F.lit("clash")).repartition(5)
    targets = spark.createDataFrame([(1, "big", 0.8), (1, "small", 0.1), (1, "gone", 0.1), (2, "small", 0.0)], "config_id bigint, stratum_key string, target_share double")
    config = spark.createDataFrame([(1, 5, 1000, 2), (2, 5, None, 4)], "config_id bigint, seed bigint, representative_max_tokens bigint, minimum_units_per_stratum int")
    wanted = sample.quotas(targets, config)
    units = sample.units_of(seg)
    assert units.count() == 400 + 3 + 1 + 2
    passed = sample.one_pass(units, wanted)
    rep = {(r["config_id"], r["stratum_key"]): (r["units"], r["reason"]) for r in sample.report(passed, wanted).collect()}
    assert rep == {(1, "big"): (401, None), (1, "small"): (3, "too few tokens"), (1, "gone"): (0, "too few tokens and units"), (2, "small"): (3, "too few units")}
    got = sample.draw(passed, wanted).collect()
    big = [r for r in got if r["stratum_key"] == "big"]
    whole = sorted((r["p"], r["unit_id"], r["tokens"]) for r in units.where("stratum_key = 'big'").select(sample.priority(F.lit(5), F.col("unit_id")).alias("p"), "unit_id", "tokens").collect())
    want, t = [], 0
    for _, u, n in whole:
        if t + n > 800:
            break
        want.append(u)
        t += n
    assert sorted(r["unit_id"] for r in big) == sorted(want) and sum(r["stratum_key"] == "small" and r["config_id"] == 1 for r in got) == 3
    inv = {r["config_id"]: r for r in sample.invariants(sample.draw(passed, wanted), sample.report(passed, wanted)).collect()}
    assert inv[1]["exhausted"] == 2 and all(r[c] == 0 for r in inv.values() for c in ("too_few", "over_quota", "not_all_of_exhausted", "twice"))
    # with the shares kept the small category's six tokens set the scale: 48 to 6
    kept = {r["stratum_key"]: r["drawn_tokens"] for r in sample.reached(sample.draw(passed, wanted, keep_shares=True), sample.report(passed, wanted)).where("config_id = 1").collect()}
    small = units.where("stratum_key = 'small'").agg(F.sum("tokens")).first()[0]
    assert kept["small"] == small and kept["big"] <= max(8 * small, 60) and kept["gone"] == 0
    assert sample.report(sample.one_pass(units.limit(0), wanted), wanted).where("reason is null").count() == 0


# 7 look-alikes


def test_canonical_form():
    same = [("ｎｏ. １２", "no. 12"), ("o​f­fice", "office"), ("oﬃce", "office"), ("café", "café"), ("a b c", "a b c"), ("ｶﾞ", "ガ"), ("⼀⼈", "一人"), ("不", "不"), ("Bregar", "Вrеgаr"), ("Осень", "Oceнь"), ("a\r\nb", "a\nb"), ("", ""), ("pаper сар", "paper cap")]
    for a, b in same:
        assert lookalike.canonical(a) == lookalike.canonical(b), (a, b)
    for a, b in [("x²", "x2"), ("resume", "résumé"), ("Box", "box"), ("a.", "a"), ("12", "13"), ("a b", "ab"), ("…", "."), ("！", "。")]:
        assert lookalike.canonical(a) != lookalike.canonical(b), (a, b)
    assert lookalike.canonical(None) is None and lookalike.canonical("Осень соль") == "Осень соль" and lookalike.canonical("Bregar") == "Bregar"
    for t in [x for p in same for x in p]:
        assert lookalike.canonical(lookalike.canonical(t)) == lookalike.canonical(t)


def test_classes_have_the_pairs(spark):
    texts = ["ab", "аb", "ab", "x", None, "a\u200bb", "x", "y"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").withColumn("class_id", F.lit("clash"))
    got = {(r["id"], r["class_id"], r["variants"], r["members"]) for r in lookalike.lookalike_classes({"t": (df, "id")}).collect()}
    assert got == {(i, 0, 3, 4) for i in (0, 1, 2, 5)}


def test_jvm_shortcut_and_pairs_against_brute_force(spark):
    rng = random.Random(8)
    base = ["Bregar kept the price of salt", "Осень и соль на столе", "第２稿は朝凪", "plain text", "café au lait", "नमक का भाव", "ﬁle one", "соль and salt"]
    texts = base + [b.replace("a", "а") for b in base] + [b.replace(" ", " ") for b in base] + [unicodedata.normalize("NFD", b) for b in base] + ["".join(c + rng.choice(["", "​"]) for c in b) for b in base] + base[:3] + ["", None, None]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").withColumn("canonical", F.lit("clash")).withColumn("tbl", F.lit("clash"))
    got = {r["id"]: r["canonical"] for r in lookalike.with_canonical(df, "id").collect()}
    assert got == {i: lookalike.canonical(t) for i, t in enumerate(texts)}
    pairs = {(r["id_a"], r["id_b"]) for r in lookalike.lookalike_pairs({"t": (df, "id")}).collect()}
    want = {(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if texts[a] is not None and texts[b] is not None and texts[a] != texts[b] and lookalike.canonical(texts[a]) == lookalike.canonical(texts[b])}
    assert pairs == want
    assert lookalike.lookalike_pairs({"t": (df.limit(0), "id")}).count() == 0


# 8 containers


def test_packing_is_tight_and_whole():
    rng = random.Random(6)
    sizes = [rng.randrange(0, 900) for _ in range(3000)]
    where = fill.pack(sizes, fill.Capacity(1000))
    load = {}
    for s, w in zip(sizes, where):
        load[w] = load.get(w, 0) + s
    assert max(load.values()) <= 1000 and len(load) <= 1.01 * sum(sizes) / 1000 + 2
    assert len(set(fill.pack([5] * 1000, fill.Capacity(1000)))) == 5 and fill.pack([], fill.Capacity(9)) == []


@pytest.mark.parametrize("bound", [{"documents": 3}, {"attention": 300_000.0}, {"documents": 4, "attention": 400_000.0}])
def test_every_capacity_binds(bound):
    rng = random.Random(7)
    sizes = [rng.randrange(1, 900) for _ in range(1500)]
    capacity = fill.Capacity(1000, **bound)
    load, docs, cost = {}, {}, {}
    for s, w in zip(sizes, fill.pack(sizes, capacity)):
        load[w], docs[w], cost[w] = load.get(w, 0) + s, docs.get(w, 0) + 1, cost.get(w, 0) + s * s
    assert max(load.values()) <= 1000 and max(docs.values()) <= bound.get("documents", 10**9)
    assert all(c <= bound.get("attention", 1e18) for w, c in cost.items() if docs[w] > 1)
    assert len(load) > len(set(fill.pack(sizes, fill.Capacity(1000))))


def test_containers(spark):
    text = "one two three four five six seven. " * 40
    rows = [(1, text), (2, "short"), (3, None), (4, ""), (5, text * 6), (2, "short"), (6, "字" * 3000), (7, "x" * 4000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("container", F.lit("clash")).withColumn("tokens", F.lit("clash"))
    for vocabulary in ("", tokens.VOCABULARY):
        count = tokens.Counter(tokens.vocabulary()).text if vocabulary else estimate_py
        capacity = fill.Capacity(500, 30, 200_000.0)
        got = fill.filled(df, capacity, "doc_id", "text", vocabulary)
        out = got.collect()
        bodies = dict(rows)
        for r in out:
            assert r["tokens"] == count((bodies[r["doc_id"]] or "")[r["start_pos"] : r["end_pos"]]) <= 500
            assert r["oversized"] == (count(bodies[r["doc_id"]] or "") > 500)
        inv = fill.invariants(df, got, capacity, "doc_id", "text", 0.0).first()
        assert (inv["documents"], inv["miscovered"], inv["over_capacity"]) == (8, 0, 0)
        assert fill.filled(df.limit(0), capacity, "doc_id", "text", vocabulary).count() == 0
    with pytest.raises(ValueError):
        fill.Capacity(0)


def test_needs_work_knows_all_of_nfc(spark):
    pairs = [("\u0928\u093c", "\u0929"), ("\u0628\u064e\u0651", "\u0628\u0651\u064e"), ("\u0e01\u0e48\u0e38", "\u0e01\u0e38\u0e48")]
    every = [chr(i) for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF]
    texts = [c for c in every if unicodedata.normalize("NFC", c) != c]
    texts += [unicodedata.normalize("NFD", c) for c in every if unicodedata.normalize("NFD", c) != c]
    marks = [c for c in every if unicodedata.combining(c)]
    texts += [a + b for a in marks[::7] for b in marks[::5] if unicodedata.combining(a) > unicodedata.combining(b)] + [t for p in pairs for t in p]
    texts = [t for t in texts if unicodedata.normalize("NFC", t) != t]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(~lookalike.needs_work(F.col("t"))).count() == 0
    d = spark.createDataFrame([(2 * k + i, t) for k, p in enumerate(pairs) for i, t in enumerate(p)], "doc_id bigint, text string")
    got = {(r["id_a"], r["id_b"]) for r in lookalike.lookalike_pairs({"documents": (d, "doc_id")}).collect()}
    assert got == {(0, 1), (2, 3), (4, 5)}


# 9 leaks


ITEM = "In the year 479 Glanax was offered an unsigned promise of grain by an impatient brother of Zanoll while twice the tax office wants an inventory and credit will be dearer by autumn"
ZH = "设想有个叫蔺騄翀的镇子契纸由两个人的笔迹各抄过一遍而阚騄守着六头骡子却没有车蔺騄翀翻出的纸条上写着两个堂弟为界石争执不休"


@pytest.mark.parametrize(("size", "run"), [(127, leak.RUN_SIGNS), (65, leak.RUN_WORDS)])
@pytest.mark.parametrize("share", [0.5, 0.6, 1.0])
def test_leak_passages_with_alterations_anywhere(size, run, share):
    rng = random.Random(9)
    found = 0
    for _ in range(100):
        item = rng.sample(range(10_000), size)
        n = math.ceil(size * share)
        part = item[:n]
        for i in rng.sample(range(1, n - 1), int(n * 0.1)):
            part[i] = -1 - i
        noise = list(range(20_000, 20_030))
        doc = noise + part + noise
        at = {tuple(item[i : i + run]): i for i in range(size - run + 1)}
        pairs = [(at[t], j) for j in range(len(doc) - run + 1) if (t := tuple(doc[j : j + run])) in at]
        first, got, altered, where = leak.longest_passage(np.array(item), np.array(doc), pairs)
        found += (first, got, altered, where) == (0, n, int(n * 0.1), 30)
        assert got <= n and altered <= leak.ALTERED * got
    assert found >= 90


def test_leak_ends_are_not_stretched():
    item, doc = np.arange(100), np.concatenate([np.arange(40), np.arange(500, 560)])
    doc[42] = 42  # one equal term after others is no passage
    assert leak.longest_passage(item, doc, [(i, i) for i in range(37)]) == (0, 40, 0, 0)


def test_leaks(spark, monkeypatch):
    words = ITEM.split()
    altered = [w if i % 11 else "other" for i, w in enumerate(words)]
    noise = "completely different words stand here and there about salt and the old survey"
    docs = {
        1: f"{noise} {ITEM} {noise}", 2: f"{noise} {' '.join(words[:18])}", 3: f"{noise} {' '.join(words[:10])}", 4: " ".join(altered), 5: noise, 6: None, 7: "",
        8: ITEM.upper().replace(" ", ",\n  "), 9: ITEM.replace("a", "а"), 10: f"{noise}。{ZH[:40]}", 11: "、".join(ZH), 12: f"**{' '.join(words[:8])}** {' '.join(words[8:])}", 13: " ".join(w if i % 3 else "zzz" for i, w in enumerate(words)),
        14: ITEM, 15: ITEM,
    }
    d = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").withColumn("item_id", F.lit("clash")).withColumn("run", F.lit("clash"))
    items = spark.createDataFrame([(1, ITEM), (2, ZH), (3, None), (4, "")], "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leak.leaks(d.select("doc_id", "text"), items).collect()}
    assert got == {(1, 1), (2, 1), (4, 1), (8, 1), (9, 1), (10, 2), (11, 2), (12, 1), (14, 1), (15, 1)}
    monkeypatch.setattr(leak, "BROADCAST_ROWS", 0)  # too many items to be sent to all tasks
    assert {(r["doc_id"], r["item_id"]) for r in leak.leaks(d.select("doc_id", "text"), items).collect()} == got
    assert leak.leaks(d.select("doc_id", "text").limit(0), items).count() == 0 and leak.leaks(d.select("doc_id", "text"), items.limit(0)).count() == 0


def test_short_items_are_met_as_a_whole(spark):
    items = [(1, "hello world"), (2, "你好吗"), (3, "Zanzibar"), (4, "one two three four"), (5, "字")]
    docs = [(1, "Hello, world"), (2, "你好吗"), (3, "world hello"), (4, "to Zanzibar we went"), (5, "one two"), (6, "some 字 here"), (7, "他说你好吗今天"), (8, "say hello world again")]
    got = {(r["d"], r["i"]) for r in leak.leaks(spark.createDataFrame(docs, "d int, t string"), spark.createDataFrame(items, "i string, t string"), "d", "i", "t", "t").collect()}
    assert got == {(1, "1"), (8, "1"), (2, "2"), (7, "2"), (4, "3"), (6, "5")}


def test_leaks_against_brute_force(spark, monkeypatch):
    """Random texts that share stock phrases; a filter so small that it lets nearly all runs through changes nothing."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(120)]
    stock = [" ".join(rng.choices(words, k=9)) for _ in range(3)]
    items = [(i, " ".join([*rng.choices(words, k=14), rng.choice(stock), *rng.choices(words, k=14)])) for i in range(12)]
    docs = []
    for d in range(120):
        body = rng.choices(words, k=40)
        if d % 2:
            part = items[d % 12][1].split()
            n = rng.randrange(10, len(part) + 1)
            body[20:20] = part[:n] if d % 4 == 1 else part[-n:]
        docs.append((d, " ".join(body) + " " + rng.choice(stock)))
    fold = lambda t: leak._fold(leak.terms(t))
    want = set()
    for d, t in docs:
        for i, u in items:
            x, y = fold(u).tolist(), fold(t).tolist()
            pairs = [(a, b) for a in range(len(x) - 2) for b in range(len(y) - 2) if x[a : a + 3] == y[b : b + 3]]
            if pairs and leak.longest_passage(fold(u), fold(t), pairs)[1] >= leak.SHARE * len(x):
                want.add((d, i))
    dd, ii = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert len(want) > 20
    for most in (leak.BLOOM_MOST, 1 << 6):
        monkeypatch.setattr(leak, "BLOOM_MOST", most)
        assert {(r["doc_id"], r["item_id"]) for r in leak.leaks(dd, ii).collect()} == want


# 10 languages


def test_languages_of_passages(spark, model):
    en, de, zh, ja, ru = lid.SEED["en"], lid.SEED["de"], lid.SEED["zh"], lid.SEED["ja"], lid.SEED["ru"]
    rows = [(1, en, "en"), (2, en + "\n\n" + de, "en-US"), (3, zh, None), (4, ja + "\n" + zh, "jpn"), (5, None, "en"), (6, "", None), (7, "123 ...", "fr"), (8, ru, "xx"), (9, en + " (Der Mann, der dort war, sagte es.) " + en, "ENG"), (10, LONG, "en_GB"), (1, en, "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label string").withColumn("confidence", F.lit("clash"))
    found = lid.languages_of(df, model, "doc_id", "text", ["label"])
    by = {}
    for r in found.collect():
        by.setdefault(r["doc_id"], set()).add(r["lang"])
    assert by == {1: {"en"}, 2: {"en", "de"}, 3: {"zh"}, 4: {"ja", "zh"}, 5: {None}, 6: {None}, 7: {None}, 8: {"ru"}, 9: {"en"}, 10: {"en"}}
    bad = {(r[0], r[1]) for r in lid.unnamed_languages(found, "doc_id", F.col("label")).collect()}
    assert bad == {(2, "de"), (3, "zh"), (4, "zh"), (8, "ru")}
    assert lid.fit(df.limit(0), "text", "label", "doc_id").languages == list(lid.LANGUAGES)


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no documents")
    d = spark.read.parquet(path)
    m = lid.fit(d.where("doc_id % 2 = 0"), "text", "lang", "doc_id")
    rest = d.where("doc_id % 2 = 1 and lang in ('en','zh','fr','de','es','pt','it','ru','ja') and length(text) > 60").select("lang", "text").collect()
    top, _, _, _ = m.best([r["text"] for r in rest])
    right = sum(m.languages[k] == r["lang"] for k, r in zip(top, rest))
    assert right > 0.88 * len(rest)  # the labels themselves are wrong for about a tenth


def test_corrections_keep_every_choice(spark):
    near, fits = ["halt", "hait", "hajt", "haIt", "haJt"], [f"wor{c}d" for c in "abcefg"]
    rows = [("form", w, None, 50 - i, 50 - i, None) for i, w in enumerate(near + fits)] + [("form", w, None, 0, 1, None) for w in ("ha1t", "wor�d")]
    passed = spark.createDataFrame(rows, "kind string, a string, b string, clean bigint, total bigint, pages array<bigint>")
    got = {r["bad"]: list(r["good"]) for r in ocr.corrections(passed).collect()}
    assert got == {"ha1t": near, "wor�d": fits}
    assert ocr.repair_line("ha1t wor�d", got, said={"haJt", "worgd"}) == ("haJt worgd", 1)


def test_plain_characters_are_never_special(spark):
    n = F.col("id").cast("int")
    c = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    chars = spark.range(1, 0x11000).where("id < 55296 or id > 57343").select("id", c.alias("c"))
    plain = chars.where(F.col("c").rlike(f"^{lookalike._JAVA_PLAIN}$"))
    assert plain.count() > 20000
    assert not plain.where(F.col("c").rlike(lookalike._JAVA_SPECIAL) | F.col("c").rlike(r"[\p{M}\p{Cn}]")).head(1)
    # between others, and two of a kind side by side
    for text in (F.concat(F.lit("ab"), "c", F.lit("字")), F.concat("c", "c"), F.concat("c", F.lit("a"), "c")):
        assert not chars.where(~F.col("c").rlike(lookalike._JAVA_ALPHABETS) & (lookalike.needs_work(text) != text.rlike(lookalike._JAVA_SPECIAL))).head(1)
