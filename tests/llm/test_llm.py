"""Edge cases, round trips and brute-force comparisons of the operators for training text."""

import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("pagemill.llm")
from pagemill.llm import encoding, languages, leaks, lookalikes, mixing, neardups, pieces, quality, scans, sentences  # noqa: E402
from pagemill.llm.boosting import Boosted  # noqa: E402

SENTENCE = "The pump in building four is sealed and dry. "


def test_pieces_tile_and_fit():
    for text in (SENTENCE * 200, "这是一个句子。" * 400, "x" * 9000, "字" * 2000, "a\n\n" + "b " * 5000):
        out = pieces.cut(text)
        assert all(p["tokens"] <= 800 and p["overlap_tokens"] <= 150 for p in out)
        at, rebuilt = 0, ""
        for p in out:
            assert p["start_pos"] <= at and text[p["start_pos"] : p["end_pos"]] == p["piece"]
            rebuilt += text[at : p["end_pos"]]
            at = p["end_pos"]
        assert rebuilt == text
    assert pieces.cut(None) == pieces.cut("") == [] and len(pieces.cut("short")) == 1


def test_pieces_query(spark):
    df = spark.createDataFrame([(1, SENTENCE * 200, "x"), (2, None, "x"), (3, "", "x")], "id int, t string, tokens string")
    out = pieces.with_pieces(df, "t").collect()
    assert {r["id"] for r in out} == {1} and isinstance(out[0]["tokens"], int)
    with pytest.raises(ValueError):
        pieces.with_pieces(df, "t", 10, 10)


def test_sentences():
    train = [("Der Sensor im Reinraum ist trocken und dicht.\nDas Ventil der Nordlinie ist geschlossen, z. B. in Halle Nr. 3. Die Pumpe läuft bei 3.5 bar weiter.\n" * 3), (SENTENCE * 2 + "\n" + "Dr. Smith asked, \"Is it dry? Is it sealed?\" before the test went on. It ended at 5 p.m. without notice.\n") * 3, "“先关闭阀门！”这句话印在盖板上。操作员问：“关好了吗？”然后等待答复。流量计会触发换热器。\n" * 3]
    m = sentences.MaxEnt(*sentences.labelled(train * 4))
    cut = lambda t: [t[a:b] for a, b in sentences.units(t, m)]
    assert cut("Dr. Smith came. He left at once.") == ["Dr. Smith came.", "He left at once."]
    assert cut("流量计会触发换热器。操作员问：“关好了吗？”然后等待答复。") == ["流量计会触发换热器。", "操作员问：“关好了吗？”然后等待答复。"]
    assert cut("กขค งจฉ") == ["กขค", "งจฉ"] and cut("1. The pump\n2. The valve") == ["1. The pump", "2. The valve"]
    assert cut("") == cut(None) == cut(" \n ") == []
    text = (SENTENCE * 30 + "\n\n") * 50
    got = sentences.units(text, m)
    assert "".join(text[a:b] for a, b in got).replace(" ", "") == "".join(text.split())


def test_repair_and_boosting():
    import numpy as np

    x = np.random.default_rng(0).normal(size=(400, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    assert ((Boosted(x, y).probability(x) > 0.5) == (y > 0.5)).mean() > 0.9
    assert Boosted(np.zeros((0, 2)), np.zeros(0)).probability(np.zeros((1, 2)))[0] < 0.01
    assert scans.repair("HEAD 3\nThe super-\nvision of the pi1ot", [0], [{"line": 1, "left": "super", "right": "vision"}], [{"line": 2, "start": 14, "kind": "w", "old": "pi1ot", "new": "pilot"}]) == "The supervision of the pilot"
    # at its own place and in its own case; a word that a line end breaks is corrected where it is joined
    fix = lambda line, start, old, new, kind="w": {"line": line, "start": start, "kind": kind, "old": old, "new": new}
    assert scans.repair("A1I3 at 1I mm, SAFEIY", [], [], [fix(0, 8, "1I", "11", "n"), fix(0, 15, "SAFEIY", "safety")]) == "A1I3 at 11 mm, SAFETY"
    assert scans.repair("the con-\nve1or", [], [{"line": 0, "left": "con", "right": "ve"}], []) == "the conve1or"
    assert scans.repair("the moun-\ntmg rail", [], [{"line": 0, "left": "moun", "right": "tmg"}], [fix(0, -1, "mountmg", "mounting")]) == "the mounting rail"
    assert scans.explained("rnain", "main") == 1.0 and scans.explained("mnerhalb", "innerhalb") == 1.0 and scans.explained("pump", "valve") == 0.0
    assert scans.repair("上层导\n轨", [], [], []) == "上层导轨"
    assert scans._PAGE.match("Pagc 2 of 29") and scans._PAGE.match("[l]") and not scans._PAGE.match("The pump")


def test_scanned_pages(spark):
    """Against what is planted: broken words, misread words and numbers, running headers with and without boxes."""
    rnd = random.Random(6)
    words = ["maintenance", "relay", *("".join(rnd.choice("bcdfglmnprstvw") + rnd.choice("aeiou") for _ in range(rnd.randrange(2, 5))) + "nt" for _ in range(500))]
    line = lambda n=8: " ".join(rnd.choices(words, k=n))
    meta = lambda ocr: (None, None, None, None, None, None, None, ocr, None)
    rows = [("sound", p, 0, "text", "\n".join(line() for _ in range(6)), None, 1.0, [0.0, 100.0, 9.0, 400.0], f"s{p}", meta(False)) for p in range(400)]
    want = set()
    for p in range(60):
        head = f"Annual report   {p + 1}"
        body = [line() for _ in range(4)]
        block = f"b{p}"
        if p % 3 == 0:
            body[1] += " mainten-"
            body[2] = "ance " + body[2]
            want.add((block, "hyphen"))
        if p % 4 == 0:
            body[3] += " re1ay"
            want.add((block, "chars"))
        if p % 10 == 0:  # glued to the block
            body = [head, *body]
            want.add((block, "furniture"))
        else:
            rows.append(("scan", p, 0, "text", head, None, 1.0, None if p % 7 == 0 else [0.0, 20.0, 9.0, 30.0], f"h{p}", meta(True)))
            want.add((f"h{p}", "furniture"))
        rows.append(("scan", p, 1, "text", "\n".join(body), None, 1.0, [0.0, 100.0, 9.0, 400.0], block, meta(True)))
    rows += [("scan", 99, 0, "text", t, None, 1.0, None, f"z{i}", None) for i, t in enumerate((None, "", " \n "))]
    from pagemill.schemas import PAGE_BLOCKS

    found = scans.issues(spark.createDataFrame(rows, PAGE_BLOCKS))
    got = {(r["block_id"], name) for name, df in found.items() for r in df.select("block_id").distinct().collect()}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.05 * len(want), (got ^ want)
    assert all(df.count() == 0 for df in scans.issues(spark.createDataFrame(rows, PAGE_BLOCKS).filter("false")).values())


def test_lexicon_has_no_pieces_of_codes():
    """Long codes hold any few letters; with many of them, misread words would count as known."""
    import pandas as pd

    text = "data:AbC/tbe+x0+re1ay/Q== l1/O0+1O 10l the relay's high-speed pump.\nplan, 1l units"
    got = {(k, a): n for b in scans.count_lexicon(iter([pd.DataFrame({"content_text": [text, text]})])) for k, a, n in b.itertuples(index=False)}
    assert {a for k, a in got if k == "w" and a.isalpha() or "'" in a} == {"data", "the", "relay's", "pump", "plan", "units"}
    assert {a for k, a in got if k == "n"} == {"10l", "1l"} and got["h", "high-speed"] == 2


def test_one_block_does_not_close_the_margin(spark):
    """In a source of many pages a single block of several lines reaches into the margin; the lines there stay furniture."""
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=7))
    meta = (None, None, None, None, None, None, None, True, None)
    rows = []
    for p in range(1500):
        rows.append(("scan", p, 0, "text", "\n".join(" ".join(word() for _ in range(5)) for _ in range(3)), None, 1.0, [0.0, 60.0, 9.0, 790.0 if p == 7 else 400.0], f"b{p}", meta))
        rows.append(("scan", p, 1, "text", f"{word()} {p + 1}", None, 1.0, [0.0, 770.0, 9.0, 785.0], f"f{p}", meta))
    from pagemill.schemas import PAGE_BLOCKS

    found = scans.issues(spark.createDataFrame(rows, PAGE_BLOCKS))["furniture"]
    got = {r["block_id"] for r in found.select("block_id").distinct().collect()}
    assert sum(b[0] == "f" for b in got) > 1400 and sum(b[0] == "b" for b in got) < 30


def test_prefixes_meet_every_word_within_reach():
    """The rare bigrams of two words within the edits share one, whatever the frequencies."""
    rnd = random.Random(7)
    rank = {a + b: rnd.randrange(9) for a in "abc#" for b in "abc#"}

    def cut(w, more):
        p = f"#{w}#"
        return {g for _, g, _ in sorted((rank[p[i : i + 2]], p[i : i + 2], i) for i in range(len(p) - 1))[: 2 * scans.reach(len(w) + more) + 1]}

    for _ in range(3000):
        a = "".join(rnd.choices("abc", k=rnd.randrange(2, 9)))
        b = list(a)
        for _ in range(rnd.randrange(1, scans.reach(len(a)) + 1)):
            i = rnd.randrange(len(b) + 1)
            rnd.choice([lambda: b.insert(i, "b"), lambda: b and b.pop(min(i, len(b) - 1)), lambda: b.__setitem__(slice(i, i + 1), ["c"])])()
        b = "".join(b)
        if len(b) > 1 and abs(len(a) - len(b)) <= scans.reach(len(a)):
            assert cut(a, False) & cut(b, True), (a, b)


def test_quality():
    kind = lambda t: quality.statistics(t, {"the"})["kind"]
    assert kind(SENTENCE * 5) == "" and kind("") == kind(None) == ""
    assert kind("- the pump\n- the valve\n- the sensor") == "list" and kind("1.1 Pump ....... 12\n1.2 Valve ....... 15") == "list"
    assert kind("a pump\t12\tkg\nvalve\t13\tmm\nsensor\t14\tkg") == "table" and kind("pump: 12 kg\nvalve: 13 mm\nsensor: 15 bar") == "table"
    assert kind("%@0[ $_}x=I_& =+~{X\\l[ ^^^<X>I+{#X_#[ |=I^<o~}") == "junk"
    s = quality.statistics("the pump. the valve", {"the"})
    assert (s["word_count"], s["common_word_share"], s["mean_word_length"]) == (4, 0.5, 3.75)


def test_quality_without_markers_and_delimiters():
    kind = lambda t: quality.statistics(t, {"the", "of", "and", "is", "for", "by", "to", "while"})["kind"]
    assert kind("hex bolts M8\nspring washers\nflat gasket for the inlet\npump shaft\nrelay\ncontrol cabinet door") == "list"
    assert kind("流量计\n控制面板支架\n换热器\n北线阀门组\n密封圈") == "list"
    assert kind("spares\n    shaft seal\n    bearing\n    coupling sleeve\ntools\n    torque wrench\n    gauge\ncleaners\n    brush") == "list"
    assert kind("Pump\n12\nkg\nValve\n13\nmm\nSensor north\n14\nkg\nRelay\n7\nmm") == "table"
    assert kind("pump\n      flow\n   water\nvalve\n      steel\n   oil\nsensor\n      zinc\n   air") == "table"
    for prose in (
        "The pump in building four is sealed and\ndry and the valve of the north line is\nclosed for the night while the sensor is\nread by the operator on duty",
        "The pump is sealed\nand the valve is\nclosed for the night\nwhile nobody is there\nto read the sensor",
        "流量计先于控制面板安装并且需要在维护日志里\n写明安装支架的位置以及上层导轨的编号然后由\n操作员在交接班之前签字确认并把记录送到北线\n的办公室存档",
    ):
        assert kind(prose) == ""


def test_kind_alone_is_that_of_the_statistics():
    common = {"the", "is", "in"}
    texts = ["a\tb\nc\td\ne\tf", "- one\n- two\n- three", SENTENCE * 20, "0f3a9c 77ab01 9e8d7c 00ff12", "├──┤\n│  │", "", None, "x" * 30]
    for t in texts:
        assert quality.kind_of(*quality.lines_of(t), common)[0] == quality.statistics(t, common)["kind"]
    # sums of a line too long for three of them in one number
    long = "a$ 1" * (1 << 20)
    got, short = quality.counted([long, "a$ 1"]), quality.counted(["a$ 1"])[0]
    assert got == [{f: n << 20 for f, n in short.items()}, short] and short["symbol"] == short["digit"] == short["latin"] == 1


def test_encoding_round_trip():
    rnd = random.Random(1)
    words = ["étanchéité", "réducteur", "conduite", "équilibre", "série", "contrôle", "après", "la", "à", "über", "Kühlgüter", "Gehäuse", "für", "die", "prüft", "Träger"]
    zh = ["流量计", "先于", "控制面板", "。", "，", "维护", "日志", "的", "安装", "支架", "上层"]
    sound = [" ".join(rnd.choices(words, k=30)) for _ in range(150)] + ["".join(rnd.choices(zh, k=60)) for _ in range(150)]
    model = encoding.Model(sound)
    for text in (" ".join(words * 2), "".join(zh * 4)):
        for chain in (("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "cp437")):
            r = encoding.examine(model, encoding.garble(text, chain))
            assert r is not None and r[0] == "yes" and r[2] == text
        assert encoding.examine(model, text) is None
    assert encoding.examine(model, "")is None and encoding.examine(model, None) is None and encoding.examine(model, "plain") is None
    assert encoding.examine(model, "r�ducteur")[0] == "no"
    assert encoding.examine(model, 'If it shows "Ã©" then change the page.') is None


def test_several_encodings_in_one_text():
    rnd = random.Random(3)
    zh = list("流量计先于控制面板维护日志的安装支架上层导轨北线审批表")
    line = lambda n=25: "".join(rnd.choices(zh, k=n)) + "。"
    model = encoding.Model([line() + line() for _ in range(300)])
    parts = [line(), line(), line()]
    text = encoding.garble(parts[0], ("utf-8", "latin-1")) + parts[1] + encoding.garble(parts[2], ("gbk", "latin-1"))
    r = encoding.examine(model, text)
    assert r is not None and parts[1] in r[2] and parts[2][:-1] in r[2] and parts[0][:-1] in r[2]


def test_hot_bands_are_cut_without_loss(spark, monkeypatch):
    """Shards of a few codes, cut by size and then by number, find the pairs that whole bands find."""
    rnd = random.Random(9)
    base = "".join(rnd.choices("abcdefgh", k=300))
    texts = []
    for i in range(120):
        t = list(base)
        for _ in range(rnd.randrange(1, 12)):
            t[rnd.randrange(len(t))] = rnd.choice("ijkl")
        texts.append("".join(t) + "".join(rnd.choices("mnop", k=rnd.randrange(0, 90))))
    df = spark.createDataFrame([(f"k{i:03d}", t) for i, t in enumerate(texts)], "chunk_id string, content string")
    pairs = lambda: {(bytes(r["a"]), bytes(r["b"])) for r in neardups.class_links(df, "chunk_id", "content")[1].collect()}
    whole = pairs()
    monkeypatch.setattr(neardups, "SHARD", 10)
    cut = pairs()
    assert len(whole) > 100 and len(whole ^ cut) <= 0.01 * len(whole)
    tree = neardups.BKTree()
    for i in range(400):
        tree.add(neardups.code(rnd.getrandbits(64), rnd.getrandbits(64)), i * 20, i)
    list(tree.near(neardups.code(1, 2), 4000))
    assert tree.visited < 0.5 * tree.size


def test_a_full_shard_is_searched_in_little_time():
    """All queries of a shard go through its tree together and find what each finds alone, over the ends of batches too."""
    import time

    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(5)
    codes = rng.integers(-(1 << 63), 1 << 63, (3, 4000))
    codes[:, 2000:] = codes[:, :2000] ^ (1 << rng.integers(0, 62, 2000)) ^ (1 << rng.integers(0, 62, 2000))
    level = np.concatenate([rng.integers(3000, 3100, 2000)] * 2)
    rows = pd.DataFrame({"shard": 7, "rid": np.arange(4000, 0, -1), "fp": codes[0], "fp2": codes[1], "fp3": codes[2], "level": level})
    rows.loc[3900:, "rid"] = -np.arange(5001, 5101)[::-1]  # these only ask
    rows = pd.concat([rows, pd.DataFrame([(8, 9002, *codes[:, 0], 2000), (8, 9001, *codes[:, 0], 2000), (9, 9003, *codes[:, 0], 2000)], columns=rows.columns)])
    began = time.process_time()
    found = pd.concat(list(neardups.tree_hits(rows.iloc[a : a + 1500] for a in range(0, len(rows), 1500))))
    assert time.process_time() - began < 1.5
    tree, want = neardups.BKTree(), {(9001, 9002)}
    own = rows[rows["shard"] == 7]
    for rid, fp, fp2, at in zip(*(own[c].tolist() for c in ("rid", "fp", "fp2", "level"))):
        if abs(rid) % 10 == 1:
            want |= {(min(abs(rid), x), max(abs(rid), x)) for x in tree.near(neardups.code(fp, fp2), at)}
        if rid > 0:
            tree.add(neardups.code(fp, fp2), at, rid)
    got = set(zip(found["a"].tolist(), found["b"].tolist()))
    assert len(got) > 1900 and want <= got


def test_near_duplicates_match_brute_force(spark):
    rnd = random.Random(2)
    words = ["pump", "valve", "sensor", "relay", "drive", "shaft", "inlet", "duct", "plant", "order", "label", "panel"]
    base = [" ".join(rnd.choices(words, k=40)) + f" {i}" for i in range(40)]
    near = [b.replace("pump", "pumps", 1) + " x" for b in base[:15]]
    texts = base + near + [base[0], base[0].replace(" ", "\n"), None, "", "abc", "abc"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select(F.format_string("k%03d", "k").alias("chunk_id"), F.col("t").alias("content"))
    members, links = neardups.class_links(df, "chunk_id", "content")
    s = {}
    for t in texts:
        c = "".join((t or "").split())
        if len(c) >= 5:
            s[c] = {c[i : i + 5] for i in range(len(c) - 4)}
    keys = list(s)
    want = sum(len(s[a] & s[b]) / len(s[a] | s[b]) >= 0.7 for i, a in enumerate(keys) for b in keys[:i])
    assert links.count() >= 0.9 * want > 0 and members.count() == 57
    roots = neardups.components(links)
    assert roots.select("root").distinct().count() == 15
    assert neardups.class_links(df.filter("false"), "chunk_id", "content")[1].count() == 0


def test_near_duplicates_that_share_mostly_common_shingles(spark):
    rnd = random.Random(4)
    own = lambda n: "".join(chr(rnd.randrange(0x4E00, 0x9FA0)) for _ in range(n))
    forms = [own(280) for _ in range(3)]
    apart = [forms[i % 3] + own(700) for i in range(60)]
    near = ["".join(forms) + own(130) for _ in range(6)]
    df = spark.createDataFrame([(f"k{i:03d}", t) for i, t in enumerate(apart + near)], "chunk_id string, content string")
    assert neardups.class_links(df, "chunk_id", "content")[1].count() == 15


def test_every_chunk_has_a_group(spark):
    texts = [("a", SENTENCE), ("b", SENTENCE + " "), ("c", None), ("d", ""), ("e", "ab c\n"), ("f", "ab c\n"), ("e", "ab c\n")]
    rows = {r["chunk_id"]: r for r in neardups.groups(spark.createDataFrame(texts, "chunk_id string, content string"), "chunk_id", "content").collect()}
    assert set(rows) == set("abcdef") and rows["a"]["group_id"] == rows["b"]["group_id"]
    assert len({r["class_id"] for r in rows.values()}) == 5 and all(r["n_links"] == 0 for r in rows.values())


def test_lookalikes():
    trie = lookalikes.Trie([("the", 9), ("office", 3), ("pump", 5), ("насос", 4), ("конвейер", 2)])

    def spelled(token, around):
        word = lookalikes.choose(trie.find(token), around)
        return None if word is None or len(word) != len(lookalikes.bare(token)) else lookalikes.in_case(word, token)

    form = lambda t: (lookalikes.canonical(t, spelled) or (t, 0))[0]
    # in both directions and in the case of the token
    assert form("нacoc") == "насос" and form("Нacoc") == "Насос" and form("конвейеp") == "конвейер" and form("РUMP") == "PUMP"
    assert trie.find("pumb") == [] and trie.find("pumb", 1) == [(1, "pump", 5)] and trie.find("pmp", 1) == [(1, "pump", 5)]
    assert form("a\u3000b") == "a b" and form("\u3000上层。\u3000导轨") == "\u3000上层。\u3000导轨"
    assert form("оffісе") == "office" and form("ＡＢ１") == "AB1" and form("ﾗｲﾝ") == "ライン" and form("café") == "café"
    assert form("pu​mp") == "pump" and form("a b") == "a b" and form("ﬁt") == "fit" and form("⼯") == "工" and form("HK‑9366") == "HK-9366"
    for kept in ("👩‍🔧", "क्‍ष", "（x）“y”", "① m² α = 1 ΔT 5 Ω", "über", "Конвейер", "", None):
        assert form(kept) == kept


def test_vocabulary_looks_at_distinct_words(spark):
    """Only whole words of one script, and costly patterns behind the aggregate, not on every occurrence."""
    texts = ["The pump p\u0443mp насос насос αντλία", "水泵 펌프 ปั๊ม पंप مضخة ＰＵＭＰ ﬁlter the", "é\u0301 Ⅳ ꙗко ԓа"]
    words = lookalikes.vocabulary(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert {r["word"]: r["n"] for r in words.collect()} == {"the": 2, "pump": 1, "насос": 2, "αντλία": 1, "ꙗко": 1, "ԓа": 1}
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("IsCyrillic") < plan.find("Aggregate")
    assert lookalikes.script("насос pump pumps") == "L" and [t[2:] for t in lookalikes.suspect_tokens("насос p\u0443mp")] == [("p\u0443mp", "C")]


def test_leaks_match_brute_force(spark):
    words = [f"w{i}" for i in range(60)]
    items = spark.createDataFrame([(1, "en", " ".join(words[:30])), (2, "zh", "".join(chr(0x4E00 + i) for i in range(40))), (3, "en", "too short"), (4, "en", None)], "item_id bigint, lang string, text string")
    rows = [(1, "x " + " ".join(words[5:19]).upper() + " y"), (2, " ".join(words[5:18])), (3, "！".join(chr(0x4E00 + i) for i in range(20))), (4, "".join(chr(0x4E00 + i) for i in range(19))), (5, None), (6, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted((r["doc_id"], r["item_id"]) for r in leaks.leaks(docs, items).collect()) == [(1, 1), (3, 2)]
    assert sorted(r["doc_id"] for r in leaks.without_leaks(docs, items).collect()) == [2, 4, 5, 6]
    assert leaks.leaks(docs, items.filter("false")).count() == 0
    # the way for large item sets gives the same
    spans = lambda most: sorted(tuple(r) for r in leaks.leaks(docs, items, most=most).collect())
    assert spans(1 << 30) == spans(0)
    cleaned = {r["doc_id"]: r["text"] for r in leaks.without_spans(docs, items).collect()}
    assert cleaned[1] == "x  y" and cleaned[3] == "" and cleaned[2] == rows[1][1] and cleaned[5] is None


def test_leaks_have_their_places_in_the_text_as_it_is(spark):
    words = [f"w{i}" for i in range(20)]
    items = spark.createDataFrame([(1, "en", " ".join(words))], "item_id bigint, lang string, text string")
    text = "ﬁﬁ ㌔ é　" + " ".join(words).replace("w3", "ｗ３") + " é"
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    for most in (0, 1 << 30):
        r = leaks.leaks(docs, items, most=most).first()
        assert text[r["start_pos"] : r["end_pos"]] == " ".join(words).replace("w3", "ｗ３")


def test_mixing(spark):
    docs = spark.createDataFrame([(i, "a" if i < 60 else "b" if i < 90 else None, 10) for i in range(100)], "doc_id bigint, source string, tokens bigint")
    targets = spark.createDataFrame([("A", 0.5, 2), ("b", 0.4, 3), ("none", 0.1, 1)], "source string, target_share double, max_repeats int")
    used, plan = mixing.mix(docs, targets)
    rows = used.collect()
    got = {s: sum(r["tokens"] * r["uses"] for r in rows if r["source"] == s) for s in "ab"}
    assert got["a"] / got["b"] == pytest.approx(1.25, rel=0.1) and max(r["uses"] for r in rows) <= 3 and plan.count() == 3
    e = mixing.exponent_for_entropy({"a": 0.9, "b": 0.1}, 0.6)
    assert mixing.entropy(mixing.tempered({"a": 0.9, "b": 0.1}, e)) == pytest.approx(0.6, abs=1e-6)
    assert mixing.mix(docs.filter("false"), targets)[0].count() == 0


def test_every_source_with_documents_meets_its_target(spark):
    docs = spark.createDataFrame([(i, "a" if i < 200 else "b" if i < 300 else "c", 10) for i in range(310)], "doc_id bigint, source string, tokens bigint")
    want = {"a": 0.5, "b": 0.4, "c": 0.08}
    targets = spark.createDataFrame([*((s, t, 2) for s, t in want.items()), ("none", 0.02, 1)], "source string, target_share double, max_repeats int")
    rows = mixing.mix(docs, targets)[0].collect()
    total = sum(r["tokens"] * r["uses"] for r in rows)
    for s, t in want.items():
        assert sum(r["tokens"] * r["uses"] for r in rows if r["source"] == s) / total >= 0.99 * t
    assert max(r["uses"] for r in rows) == 2


def test_exponents_and_limits(spark):
    shares, goal = {"a": 0.8, "b": 0.2}, {"a": 0.2, "b": 0.8}
    assert mixing.tempered(shares, 1.0, goal) == pytest.approx(shares) and mixing.tempered(shares, 0.0, goal) == pytest.approx(goal)
    caps = {"a": 800.0, "b": 400.0}
    e = mixing.exponent_for_limits(shares, caps, 1000.0, goal)
    w = mixing.tempered(shares, e, goal)
    assert 0 < e < 1 and w["b"] * 1000 == pytest.approx(400.0, rel=1e-6)
    docs = spark.createDataFrame([(i, "a" if i < 80 else "b", 10) for i in range(100)], "doc_id bigint, source string, tokens bigint")
    targets = spark.createDataFrame([("a", 0.2, 1), ("b", 0.8, 2), ("c", None, 1), ("d", 0.5, 0)], "source string, target_share double, max_repeats int")
    used, steps = mixing.mix(docs, targets, size=1000.0)
    rows = used.collect()
    assert sum(r["uses"] * 10 for r in rows if r["source"] == "b") == 400 and max(r["uses"] for r in rows) == 2
    order = mixing.ordered(used).collect()
    assert len(order) == sum(r["uses"] for r in rows) and {r["pass"] for r in order if r["source"] == "b"} == {1, 2}
    assert {r["source"]: r["falls_short"] for r in mixing.report(used, steps).collect()}["d"]
    # a limit of 0 allows no use
    none = spark.createDataFrame([("a", 1.0, 0)], "source string, target_share double, max_repeats int")
    assert mixing.mix(docs, none)[0].count() == 0
    assert mixing.mix(docs, targets, by_entropy=True)[0].count() > 0


def test_languages():
    en, de = "The pump of the north line is sealed and the valve is open for the night. ", "Die Pumpe der Nordlinie ist dicht und das Ventil ist für die Nacht offen. "
    model = languages.Model({"en": [en * 8] * 4, "de": [de * 8] * 4}, {"en": {"the", "of", "is"}, "de": {"die", "der", "ist", "das"}})
    main = lambda t: {p[2]: p[4] for p in languages.passages(t, model)}
    assert list(main(en * 3)) == ["en"] and list(main(de * 3)) == ["de"] and set(main(en * 3 + de * 3)) == {"en", "de"}
    assert list(main("流量计先于控制面板。")) == ["zh"] and list(main("ポンプは弁を開ける。")) == ["ja"] and list(main("насос и клапан")) == ["ru"] and main("123 !") == {}
    model = languages.Model({"ru": ["Насос и клапан на северной линии закрыт на ночь, датчик чистый. " * 9]}, {"ru": {"и", "на"}})
    sure = lambda t: languages.passages(t, model)[0][3]
    assert sure("клапан закрыт на ночь") > 0.9 > 0.7 > sure("Їжак і ґанок є, її мрії")
    assert languages.code("zh-CN") == "zh" and languages.code("English") == "en" and languages.code("und") is None and languages.code(None) is None


def test_found_queries_run_on_the_smallest_tables(spark):
    import os

    from pagemill.llm.queries import QUERIES

    d = "/root/testdata/sf0.001"
    if not os.path.isdir(d):
        pytest.skip("no test tables")
    for name in ("p3_found", "p7_found", "p8_found"):
        df = QUERIES[name](spark, d)
        assert df.count() == df.distinct().count()
