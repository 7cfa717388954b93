"""Golden rows, edge cases and properties of the core operators."""

import math

import pytest
from pyspark.sql import functions as F

from pagemill import config
from pagemill.functions import text as T
from pagemill.operators import aggregates, chunking, graph, normalize, parsing, validation, windows
from pagemill.plans.pipeline import to_chunks
from pagemill.schemas import PAGE_BLOCKS
from pagemill.sinks import exports

SCALARS = [
    ("", 0, 0, 0, 0, 0), ("abc", 0, 1.0, 0, 0, 0), ("中文测试。abc!!!", 7, 0.636364, 0.272727, 0, 0), ("a     b", 1, 0.285714, 0.571429, 0, 0),
    ("a" * 20, 5, 1.0, 0, 0, 0.9375), ("ab\x01�cd", 1, 0.666667, 0, 0.333333, 0), ("x\ty", 0, 0.666667, 0, 0, 0), ("²½①_é", 1, 0.8, 0, 0, 0),
    ("3.14 is pi. Ok", 3, 0.642857, 0, 0, 0), ("abcdefghij", 2, 1.0, 0, 0, 0),
]


def test_scalars(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(SCALARS)] + [(99, None)], "i int, t string").repartition(3)
    cols = [T.count_tokens("t"), T.info_density("t"), T.noise_ratio("t"), T.garble_ratio("t"), T.repetition_ratio("t")]
    got = {r[0]: r[1:] for r in df.select("i", *[F.round(c, 6) for c in cols]).collect()}
    for i, r in enumerate(SCALARS):
        assert got[i] == pytest.approx(r[1:]), r[0]
    assert set(got[99]) == {None}


def test_sentences(spark):
    df = spark.createDataFrame([("3.14 is pi. Ok",), ("a。b!!c. ",), ("  ",)], "t string")
    assert [r[0] for r in df.select(T.split_sentences("t")).collect()] == [["3.", "14 is pi.", "Ok"], ["a。", "b!!", "c."], []]


def test_line_merge_and_headers(spark):
    pairs = {"hello\nworld": "helloworld", "inter-\nnational": "international", "end.\nNext": "end.\nNext", "abcd\nefgh": "abcd\nefgh", "hello\n1. item": "hello\n1. item", "hello\n\nworld": "hello\nworld"}
    df = spark.createDataFrame(list(pairs.items()), "t string, want string")
    assert all(r[0] == r[1] for r in df.select(normalize.merge_lines("t"), "want").collect())
    heads = [("- 12 -", None, True), ("第 3 页", None, True), ("page 7", None, True), ("Section 4", None, True), ("Introduction", None, False), ("Introduction", [0.0, 20.0, 9.0, 30.0], True), ("x" * 120, [0.0, 20.0, 9.0, 30.0], False)]
    df = spark.createDataFrame(heads, "t string, b array<double>, want boolean")
    assert all(r[0] == r[1] for r in df.select(normalize.is_header_footer("t", "b"), "want").collect())


@pytest.mark.parametrize(("n", "size", "want"), [(5, 3, [[0, 1, 2], [2, 3, 4], [4]]), (4, 3, [[0, 1, 2], [2, 3]]), (2, 3, [[0, 1]]), (3, 1, [[0], [0, 1], [1, 2], [2]])])
def test_windows(spark, n, size, want):
    df = spark.createDataFrame([("s", p) for p in range(n)], "source string, page int")
    got: dict[int, list[int]] = {}
    for r in windows.page_windows(df, size).orderBy("page").collect():
        got.setdefault(r["win"], []).append(r["page"])
    assert [got[k] for k in sorted(got)] == want


def test_chunk_golden_and_force_split():
    c = config.Chunking(size=10, overlap=6, min_chunk_size=1)
    rows = chunking.pieces([(7, "甲乙丙丁。戊己庚辛。壬癸子丑。")], c)
    assert [(r["content"], r["token_count"], r["char_count"], r["page_start"], r["page_end"]) for r in rows] == [("甲乙丙丁。", 6, 5, 7, 7), ("甲乙丙丁。戊己庚辛。", 12, 10, 0, 7), ("戊己庚辛。壬癸子丑。", 12, 10, 7, 7)]
    assert [len(x) for x in chunking.force_split("甲" * 10, 4, 2)] == [4, 3, 4, 3, 2]
    assert [len(x) for x in chunking.force_split("甲" * 10, 4, 0)] == [4, 4, 2]
    assert chunking.force_split("a" * 500, 4, 2) == ["a" * 500]
    cuts = chunking.by_chars("ab。" * 300, config.Chunking(size=20, overlap=15, split_by="char"))
    assert cuts[-1].endswith("ab。") and len(cuts) < 900


def test_chunk_id(spark):
    r = spark.range(1).select(T.chunk_id(F.lit("f.pdf"), F.lit(7), F.lit(7), F.lit(1))).first()[0]
    assert r == "chunk_0007_0007_0001_49603d4b"


def test_validation(spark):
    distinct = "".join(chr(0x4E00 + i) for i in range(250))
    rows = [(distinct, "good", 1.0), (distinct[:100], "low", 0.925), ("!?#" * 100, "reject", 0.35), ("a" * 300, "low", 0.85), (distinct + "\x01" * 50, "low", 0.615503), (None, "reject", 0.6)]
    df = spark.createDataFrame(rows, "content string, want string, score double")
    for r in validation.validated(df).collect():
        assert (r["quality"], round(r["rule_score"], 6)) == (r["want"], pytest.approx(r["score"])), r["reason"]


def test_replies_gate_and_review(spark):
    df = spark.createDataFrame([('x {"quality":"GOOD","confidence":0.9,"reason":"r"} y',), ('{"quality":"odd"}',), ("no json",), (None,)], "t string")
    got = [r[0] for r in df.select(validation.parsed_reply("t")).collect()]
    assert [tuple(g) if g else None for g in got] == [("good", 0.9, "r"), ("low", 0.5, "LLM 评估"), None, None]
    gate = spark.createDataFrame([("good", 0.7), ("good", 0.6), ("low", 0.7), ("reject", 0.1)], "quality string, rule_score double")
    assert [r[0] for r in gate.select(validation.needs_review()).collect()] == [False, True, True, False]
    chunks = spark.createDataFrame([(f"c{i}", "x", "low", 0.5, "why") for i in range(4)], "chunk_id string, content string, quality string, rule_score double, reason string")
    c = config.Config(llm=config.Llm(max_calls=2))
    out = {r["chunk_id"]: r["quality"] for r in validation.reviewed(chunks, lambda t: '{"quality":"good"}', c).collect()}
    assert out == {"c0": "good", "c1": "good", "c2": "low", "c3": "low"}


def test_graph(spark):
    reply = 'Sure {"entities":[{"name":"A","type":"T"},{"name":"A ","type":"U"},{"name":"B"},{"name":""}],"relations":[{"source":"A","relation":"includes","target":"B"},{"source":"A","relation":"includes","target":"B"},{"source":"A","relation":"x"}]} ok'
    df = spark.createDataFrame([(1, reply), (2, "none"), (3, None)], "ord int, t string").select("ord", graph.parsed("t").alias("graph"))
    assert sorted((r["name"], r["type"]) for r in graph.entities(df).collect()) == [("A", "T"), ("B", None)]
    assert [tuple(r)[:3] for r in graph.relations(df).collect()] == [("A", "includes", "B")]
    assert sorted(tuple(r) for r in graph.counts(graph.entities(df), graph.relations(df)).collect()) == [("entity", "T", 1), ("entity", "unknown", 1), ("relation", "includes", 1)]


def test_exports_and_report(spark):
    df = spark.createDataFrame([("a", "s", 0, 1, 800, 3, 0.0, None, 0.0, "x" * 201), ("b", "s", 0, 1, 800, 3, 0.5, "good", 0.25, "x" * 200)], "chunk_id string, source string, page_start int, page_end int, token_count int, char_count int, rule_score double, llm_quality string, llm_confidence double, content string")
    a, b = exports.csv_rows(df).orderBy("chunk_id").collect()
    assert (a["content"], a["rule_score"], b["content"], b["rule_score"]) == ("x" * 200 + "...", "", "x" * 200, "0.500")
    s = aggregates.report_summary(df).first()
    assert (s["top_k"], s["chunk_size"]) == (3, 640)
    assert aggregates.report_summary(df.filter("false")).first()["top_k"] is None
    assert sum(r["n"] for r in aggregates.token_histogram(df.filter("false")).collect()) == 0


def test_tables(spark):
    df = spark.createDataFrame([([["a", " b ", None], ["", None]],), (None,)], "rows array<array<string>>")
    assert [tuple(r) for r in df.select(parsing.table_text("rows"), parsing.table_text_compact("rows")).collect()] == [("a |  b  | \n | ", "a | b"), (None, None)]


def test_pipeline_edges_and_partitions(spark):
    text = "The pump is sealed and the valve is open. " * 12
    rows = [("s", p, 0, "text", text + str(p), None, 1.0, None, f"b{p}", None) for p in range(4)] + [("s", 4, 0, "text", None, None, 1.0, None, "b4", None), ("e", 0, 0, "text", "", None, None, None, "b0", None)]
    df = spark.createDataFrame(rows, PAGE_BLOCKS)
    key = lambda d: sorted((r["chunk_id"], r["quality"]) for r in d.collect())
    assert key(to_chunks(df)) == key(to_chunks(df.repartition(7))) != []
    assert to_chunks(df.filter("false")).count() == 0


def test_config():
    assert config.final_config("fast", {"chunk": {"size": 5}})["chunk"]["size"] == 5
    assert "chunk.overlap" in config.validate_dict({"pdf": {}, "quality": {}, "output": {}, "chunk": {"size": 10, "overlap": 10}})[0]
    assert config.Builder().with_preset("high_quality").with_chunk_size(300, 30).build().chunk == config.Chunking(300, 30, 150, "token", True)
    with pytest.raises(ValueError):
        config.final_config("none")
    assert "llm.provider" in config.settings_by_impact("cost") and math.isclose(config.Config().quality.max_noise_ratio, 0.3)


def test_streaming(spark, tmp_path):
    from pagemill.streaming.ingest import ingest

    rows = [("s", 0, 0, "text", "The pump is sealed and the valve is open. " * 12, None, 1.0, None, "b0", None)]
    spark.createDataFrame(rows, PAGE_BLOCKS).write.json(str(tmp_path / "in"))
    for _ in range(2):
        ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def by_hand(blocks, c):
    """The pipeline without Spark: one page after the other through the buffer, as a plain loop."""
    out, sources = [], {}
    for b in blocks:
        sources.setdefault(b["source"], {}).setdefault(b["page"], []).append(b)
    for source, pages in sources.items():
        buffer, n = {}, 0

        def flush():
            nonlocal n
            items = [(p, b["text"]) for p in sorted(buffer) for b in sorted(buffer[p], key=lambda b: b["ord"]) if b["kept"]]
            for r in chunking.pieces(items, c.chunk) if items else []:
                n += 1
                out.append((source, n, r["page_start"], r["page_end"], r["content"]))

        for p in sorted(pages):
            buffer[p] = pages[p]
            if len(buffer) >= c.runtime.batch_size:
                flush()
                buffer = {p: pages[p]}
        if buffer:
            flush()
    return sorted(out)


def test_pipeline_against_a_plain_loop(spark):
    """Windows over pages that vanish in normalization, several windows, two sources."""
    c = config.Config(chunk=config.Chunking(size=30, overlap=8, min_chunk_size=1), runtime=config.Runtime(batch_size=3))
    made = []
    for source in ("a", "b"):
        for p in range(11):
            for k in range(2):
                gone = p in (3, 4, 8) or source == "b" and p == 0
                text = f"page {p}" if gone else f"The {source} pump number {p} of part {k} is sealed and the valve is open. It was tested. Then it was shipped."
                made.append({"source": source, "page": p, "ord": k, "text": text, "kept": not gone})
    rows = [(b["source"], b["page"], b["ord"], "text", b["text"], None, 1.0, None, f"b{b['page']}{b['ord']}", None) for b in made]
    got = to_chunks(spark.createDataFrame(rows, PAGE_BLOCKS).repartition(5), c)
    i = F.split("chunk_id", "_")[3].cast("int")
    assert sorted(tuple(r) for r in got.select("source", i, "page_start", "page_end", "content").collect()) == by_hand(made, c) != []


def test_ranked_splits_groups(spark):
    from pagemill.session import ranked

    rows = [("hot" if i % 3 else None, i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, i int").repartition(7)
    got = {(r["g"], r["i"]): r["rank"] for r in ranked(df, ["g"], ["i"]).collect()}
    for g in ("hot", None):
        assert [got[g, i] for h, i in rows if h == g] == list(range(sum(h == g for h, _ in rows)))
    sums = ranked(df, ["g"], ["i"], "before", "i").filter("i = 6").first()["before"]
    assert sums == 0 + 3
    assert ranked(df.filter("false"), ["g"], ["i"]).count() == 0


def test_first_deliveries(spark, tmp_path):
    rows = [("a", "2024-01-02", 1), ("a", "2024-01-01", 2), ("a", None, 3), ("b", "2024-01-01", 4), ("b", "2024-01-01", 4), (None, None, 5), (None, None, 5), ("c", None, 6)]
    df = spark.createDataFrame(rows, "k string, t string, v int").withColumn("ingested_at", F.col("t").cast("timestamp")).drop("t")
    df.repartition(3).write.parquet(str(tmp_path / "x"))
    got = normalize.first_deliveries(spark.read.parquet(str(tmp_path / "x")), ["k"])
    assert sorted(r["v"] for r in got.collect()) == [2, 4, 5, 6] and got.columns == ["k", "v", "ingested_at"]


def test_sentence_and_character_chunks():
    c = config.Chunking(size=4, overlap=0, split_by="sentence")
    assert chunking.split("One. Two. Three. Four. Five.", c) == ["One. Two. Three.", "Four. Five."]
    # the boundary may stand just behind the window
    assert chunking.split("a" * 8 + "b" * 8 + "。" + "c" * 5, config.Chunking(size=4, overlap=0, split_by="char")) == ["a" * 8 + "b" * 8 + "。", "ccccc"]
    assert chunking.split(" " * 40, config.Chunking(size=4, overlap=1, split_by="char")) == []


def test_run_writes_everything(spark, tmp_path):
    from pagemill.plans.pipeline import run
    from pagemill.sources import jsonl

    text = "The pump is sealed and the valve is open. Every part was tested twice before it was shipped. " * 4
    blocks = [("s", p, 0, "text", f"{text}{p}", None, 1.0, None, f"b{p}", None) for p in range(3)] + [("s", 3, 0, "text", "!?#" * 150, None, 1.0, None, "b3", None)]
    df = spark.createDataFrame(blocks, PAGE_BLOCKS)
    c = config.Config(chunk=config.Chunking(size=100, overlap=0, min_chunk_size=1))
    asked = []

    def ask(prompt):
        asked.append(prompt)
        return '{"quality": "reject", "confidence": 0.9, "reason": "no"}' if "#" in prompt else None

    out = str(tmp_path)
    got = run(df, out, c, ask)
    assert got["total_chunks"] > got["accepted_chunks"] > 0
    kept = jsonl.read_chunks(spark, f"{out}/chunks")
    assert kept.count() == got["accepted_chunks"] and kept.filter("source = 's'").count() == kept.count()
    assert {r["reason"] for r in jsonl.read_rejected(spark, f"{out}/rejected").collect()} != {"unknown"}
    assert jsonl.read_blocks(spark, f"{out}/pages").count() == 4
    assert spark.read.csv(f"{out}/csv", header=True).count() == spark.read.parquet(f"{out}/vectors").count() == got["accepted_chunks"]
    stats = spark.read.json(f"{out}/stats").first()
    assert (stats["total_chunks"], stats["processed_pages"], stats["failed_pages"]) == (got["total_chunks"], 4, 0) and stats["duration_seconds"] >= 0
    assert "Tokens per chunk" in "".join(r[0] for r in spark.read.text(f"{out}/report").collect())
    assert "chunk_id" in "".join(r[0] for r in spark.read.text(f"{out}/schema").collect())
    assert spark.read.text(f"{out}/markdown").filter("value like '## chunk_%'").count() == got["accepted_chunks"]
    assert exports.file_summary(spark, f"{out}/chunks/*.json").agg(F.sum("lines")).first()[0] == got["accepted_chunks"]
    exports.milvus_document(kept, f"{out}/one")
    assert "rag_chunks" in "".join(r[0] for r in spark.read.text(f"{out}/one").collect())


def test_reviews_are_spread(spark):
    chunks = spark.createDataFrame([(f"c{i}", "x", "low", 0.5, "why") for i in range(40)], "chunk_id string, content string, quality string, rule_score double, reason string")

    def ask(text):
        import os

        return f'{{"quality":"good","reason":"{os.getpid()}"}}'

    out = validation.reviewed(chunks, ask, config.Config()).collect()
    assert len(out) == 40 and len({r["reason"] for r in out}) > 1


def test_graph_run(spark, tmp_path):
    from pagemill.plans.pipeline import extract_graph

    df = spark.createDataFrame([(f"c{i}", f"{i} " + "x" * 120) for i in range(6)] + [("c9", "short"), ("d", None)], "chunk_id string, content string")

    def ask(prompt):
        if "Entity types" not in prompt or "4 xx" in prompt:
            return None
        return 'Well {"entities":[{"name":"A","type":"Model"}],"relations":[{"source":"A","relation":"includes","target":"B"}]}'

    got = {(r["what"], r["type"]): r["n"] for r in extract_graph(df, ask, str(tmp_path)).collect()}
    assert got == {("entity", "Model"): 1, ("relation", "includes"): 1}
    assert spark.read.json(str(tmp_path / "entities")).first()["name"] == "A" and spark.read.json(str(tmp_path / "relations")).count() == 1


def test_command_line(capsys, tmp_path):
    from pagemill.__main__ import main, parsed, settings

    assert main(["strategies"]) == 0 and "balanced (default)" in capsys.readouterr().out
    d = settings(parsed(["run", "--input", "x", "--output", "y", "--strategy", "fast", "--chunk-overlap", "0", "--no-llm"]))
    assert (d["chunk"]["overlap"], d["chunk"]["size"], d["llm"]["enabled"], d["output"]["dir"]) == (0, 1200, False, "y")
    assert main(["run", "--input", "x", "--dry-run"]) == 0 and main(["run", "--input", "x", "--chunk-size", "0"]) == 1
    assert config.strategy_info("fast")["available"] and not config.strategy_info("none")["available"]


def test_parsing_of_pages(spark):
    span = "struct<text:string,font:string,size:double>"
    df = spark.createDataFrame([([([("a", "F", 10.0), ("b", "G", 12.0)],), ([("c", "F", 8.0)],)],), ([],)], f"lines array<struct<spans:array<{span}>>>")
    a, b = df.select(parsing.block_text("lines").alias("t"), parsing.font_info("lines").alias("f")).collect()
    assert (a["t"], a["f"]["fonts"], a["f"]["avg_size"], a["f"]["max_size"]) == ("ab\nc", ["F", "G"], 10.0, 12.0)
    assert (b["t"], b["f"]["fonts"], b["f"]["avg_size"], b["f"]["max_size"]) == ("", [], 0.0, 0.0)
