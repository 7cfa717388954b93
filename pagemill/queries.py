"""Registered queries of the reference's operators and their SQL. All read whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagemill import config as C
from pagemill.functions import text as T
from pagemill.operators import aggregates, chunking, graph, normalize, parsing, validation, windows
from pagemill.plans.pipeline import to_chunks
from pagemill.session import checkpointed, ranked, spread, table
from pagemill.sinks import exports
from pagemill.sources import blocks as block_sources

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None = None, name: str | None = None):
    def add(f):
        QUERIES[name or f.__name__] = f
        if sql:
            ORACLE[name or f.__name__] = sql
        return f

    return add


def docs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents")


def blocks(s: SparkSession, d: str) -> DataFrame:
    """page_blocks with repeated deliveries dropped; only keys, times and places are shuffled."""
    return normalize.first_deliveries(table(s, d, "page_blocks"), ["source", "block_id"])


def text_blocks(s: SparkSession, d: str) -> DataFrame:
    return blocks(s, d).filter("type = 'text' and content_text is not null")


def chunks(s: SparkSession, d: str) -> DataFrame:
    return normalize.first_deliveries(table(s, d, "chunks"), ["chunk_id"])


def spread_chunks(s: SparkSession, d: str) -> DataFrame:
    """The chunks on all cores, before measures that cost much."""
    return spread(chunks(s, d))


# SQL fragments: white space as Python sees it, and tables without repeated deliveries
W = r"\t-\r\x1c-\x20\x{85}\p{Z}"
STRIP = lambda x: f"regexp_replace({x}, '^[{W}]+|[{W}]+$', '', 'g')"
ZH_COUNT = lambda x: f"length(regexp_replace({x}, '[^一-鿿]', '', 'g'))"
TOKENS = lambda x: f"trunc({ZH_COUNT(x)} * 1.5 + (length({x}) - {ZH_COUNT(x)}) / 4.0)::INT"
RATIO = lambda part, x: f"CASE WHEN length({x}) = 0 THEN 0.0 ELSE ({part})::DOUBLE / length({x}) END"
DENSITY = lambda x: RATIO(f"length(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}]', '', 'g'))", x)
NOISE = lambda x: "least(1.0, " + RATIO(
    f"(length({x}) - length(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_{W}]{{3,}}', '', 'g'))) + (length({x}) - length(regexp_replace({x}, '[{W}]{{4,}}', ' ', 'g')))", x
) + ")"
GARBLE = lambda x: RATIO(f"length(regexp_replace({x}, '[\\p{{L}}\\p{{M}}\\p{{N}}\\p{{P}}\\p{{S}}\\p{{Z}}\\n\\r\\t]', '', 'g')) + length(regexp_replace({x}, '[^\\x{{fffd}}]', '', 'g'))", x)
REPEAT = lambda x: (
    f"CASE WHEN length({x}) < 10 THEN 0.0 ELSE (length({x}) - 4 - len(list_distinct(list_transform(range(1, length({x}) - 3), "
    f"lambda i: substr({x}, i, 5)))))::DOUBLE / (length({x}) - 4) END"
)
SENTENCES = lambda x: f"list_filter(list_transform(regexp_extract_all({x}, '[^。！？.!?]*[。！？.!?]+|[^。！？.!?]+'), lambda s: {STRIP('s')}), lambda s: s <> '')"
BLOCKS = "(SELECT * FROM page_blocks QUALIFY row_number() OVER (PARTITION BY source, block_id ORDER BY ingested_at) = 1)"
CHUNKS = "(SELECT * FROM chunks QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY ingested_at) = 1)"
TEXTS = f"(SELECT * FROM {BLOCKS} WHERE type = 'text' AND content_text IS NOT NULL)"
FROM_DOCS = "FROM documents WHERE text IS NOT NULL"

# ---- scalar functions


@query(f"SELECT doc_id, {TOKENS('text')} AS tokens, (length(text) // 3)::INT AS tokens_other {FROM_DOCS}")
def count_tokens(s, d):
    return docs(s, d).filter("text is not null").select("doc_id", T.count_tokens("text").alias("tokens"), T.count_tokens("text", "other").alias("tokens_other"))


@query(f"SELECT doc_id, round({GARBLE('text')}, 6) AS garble_ratio, ({GARBLE('text')}) > 0.1 AS is_garbled {FROM_DOCS}")
def garble_ratio(s, d):
    g = T.garble_ratio("text")
    return docs(s, d).filter("text is not null").select("doc_id", F.round(g, 6).alias("garble_ratio"), (g > 0.1).alias("is_garbled"))


@query(f"SELECT doc_id, round({DENSITY('text')}, 6) AS info_density {FROM_DOCS}")
def info_density(s, d):
    return docs(s, d).filter("text is not null").select("doc_id", F.round(T.info_density("text"), 6).alias("info_density"))


@query(f"SELECT doc_id, round({NOISE('text')}, 6) AS noise_ratio {FROM_DOCS}")
def noise_ratio(s, d):
    return docs(s, d).filter("text is not null").select("doc_id", F.round(T.noise_ratio("text"), 6).alias("noise_ratio"))


@query(f"SELECT chunk_id, round({REPEAT('content')}, 6) AS repetition_ratio FROM {CHUNKS} WHERE content IS NOT NULL")
def repetition_ratio(s, d):
    return spread_chunks(s, d).filter("content is not null").select("chunk_id", F.round(T.repetition_ratio("content"), 6).alias("repetition_ratio"))


@query(f"SELECT doc_id, i - 1 AS pos, l[i] AS sentence FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, {SENTENCES('text')} AS l {FROM_DOCS}))")
def split_sentences(s, d):
    return docs(s, d).select("doc_id", F.posexplode(T.split_sentences("text")).alias("pos", "sentence"))


@query(
    f"""SELECT chunk_id, printf('chunk_%04d_%04d_%04d_', page_start, page_end, token_count) ||
    left(md5(source || '_' || page_start || '_' || page_end || '_' || token_count), 8) AS made FROM {CHUNKS}"""
)
def chunk_ids(s, d):
    return chunks(s, d).select("chunk_id", T.chunk_id("source", "page_start", "page_end", "token_count").alias("made"))


@query()
def clean_text(s, d):
    return chunks(s, d).select("chunk_id", T.clean_text("content").alias("cleaned"))


# ---- sources and parsing


@query(f"SELECT source, block_id, page FROM {BLOCKS} WHERE page >= 2 AND page < 10")
def page_range(s, d):
    return block_sources.page_range(blocks(s, d), 2, 10).select("source", "block_id", "page")


@query(
    "SELECT coalesce(source, '') AS source, doc_id, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY doc_id) - 1 AS page, length(text) AS n FROM documents"
)
def documents_as_pages(s, d):
    b = block_sources.from_documents(docs(s, d)).select("source", "page", F.length("content_text").alias("n"))
    ids = ranked(docs(s, d).select("doc_id", F.coalesce("source", F.lit("")).alias("source")), ["source"], ["doc_id"], "page")
    return ids.join(b, ["source", "page"]).select("source", "doc_id", "page", "n")


@query("SELECT source, title, author, creator, producer, creation_date, total_pages, round(file_size_mb, 6) AS file_size_mb FROM pdf_sources WHERE total_pages > 0")
def pdf_metadata(s, d):
    return table(s, d, "pdf_sources").filter("total_pages > 0").select("source", "title", "author", "creator", "producer", "creation_date", "total_pages", F.round("file_size_mb", 6).alias("file_size_mb"))


@query(
    f"""SELECT source, page, ord, type, (CASE WHEN type = 'text' THEN 'block' ELSE type END) ||
    printf('_%04d_%04d', page, row_number() OVER (PARTITION BY source ORDER BY page, ord)) AS made_id FROM {BLOCKS}"""
)
def block_ids(s, d):
    return parsing.with_block_ids(blocks(s, d).drop("block_id")).select("source", "page", "ord", "type", F.col("block_id").alias("made_id"))


@query(
    f"""SELECT source, count(*) AS total_blocks, count(*) FILTER (type = 'text') AS text_blocks, count(*) FILTER (type = 'table') AS table_blocks,
    count(*) FILTER (type = 'image') AS image_blocks FROM {BLOCKS} GROUP BY source"""
)
def block_stats(s, d):
    return parsing.block_counts(blocks(s, d))


TABLES = f"(SELECT source, block_id, content_table.rows AS r FROM {BLOCKS} WHERE type = 'table' AND content_table IS NOT NULL)"


def table_blocks(s, d):
    return blocks(s, d).filter("type = 'table' and content_table is not null")


@query(f"SELECT source, block_id, array_to_string(list_transform(r, lambda x: array_to_string(list_transform(x, lambda c: coalesce(c, '')), ' | ')), chr(10)) AS text FROM {TABLES}")
def table_to_text(s, d):
    return table_blocks(s, d).select("source", "block_id", parsing.table_text("content_table.rows").alias("text"))


@query(
    f"""SELECT source, block_id, array_to_string(list_filter(list_transform(r, lambda x:
    array_to_string(list_transform(list_filter(x, lambda c: coalesce(c, '') <> ''), lambda c: {STRIP('c')}), ' | ')), lambda t: t <> ''), chr(10)) AS text FROM {TABLES}"""
)
def table_to_text_compact(s, d):
    return table_blocks(s, d).select("source", "block_id", parsing.table_text_compact("content_table.rows").alias("text"))


@query(
    f"""SELECT source, block_id, list_sort(list_distinct(fonts)) AS fonts, len(fonts)::BIGINT AS n_fonts, round((a + (len(fonts) - 1) * (a + 2)) / len(fonts), 6) AS avg_size,
    CASE WHEN len(fonts) > 1 THEN a + 2 ELSE a END AS max_size FROM (SELECT source, block_id, metadata.font_info.fonts AS fonts, metadata.font_info.avg_size AS a FROM {TEXTS}
    WHERE len(metadata.font_info.fonts) > 0 AND metadata.font_info.avg_size IS NOT NULL)""",
    name="font_info",
)
def font_info_query(s, d):
    """Text blocks as page dictionaries of a line per font, the first of the mean size and the others two points larger."""
    size = F.col("metadata.font_info.avg_size")
    span = lambda f, i: F.struct(F.array(F.struct(F.lit("x").alias("text"), f.alias("font"), F.when(i == 0, size).otherwise(size + 2).alias("size"))).alias("spans"))
    fonts = F.col("metadata.font_info.fonts")
    rows = text_blocks(s, d).filter((F.size(fonts) > 0) & size.isNotNull()).select("source", "block_id", F.size(fonts).cast("bigint").alias("n_fonts"), parsing.font_info(F.transform(fonts, span)).alias("i"))
    return rows.select("source", "block_id", "i.fonts", "n_fonts", F.round("i.avg_size", 6).alias("avg_size"), "i.max_size")


@query(f"SELECT source, block_id, '[IMAGE: xref=' || metadata.xref || ', index=' || metadata.image_index || ']' AS text FROM {BLOCKS} WHERE type = 'image' AND metadata.xref IS NOT NULL AND metadata.image_index IS NOT NULL")
def image_placeholders(s, d):
    images = blocks(s, d).filter("type = 'image' and metadata.xref is not null and metadata.image_index is not null")
    return images.select("source", "block_id", parsing.image_placeholder("metadata.xref", "metadata.image_index").alias("text"))


@query(f"SELECT source, block_id, replace(content_text, chr(10), '') AS joined FROM {TEXTS}")
def page_text(s, d):
    """Each line of a block as spans of one character: joined within the line; here the lines are one."""
    spans = lambda t: F.transform(F.split(t, ""), lambda x: F.struct(x.alias("text")))
    lines = F.transform(F.split("content_text", "\n"), lambda l: F.struct(spans(l).alias("spans")))
    return text_blocks(s, d).select("source", "block_id", F.replace(parsing.block_text(lines), F.lit("\n"), F.lit("")).alias("joined"))


# ---- normalization

SQUEEZE = lambda x: STRIP(f"array_to_string(list_transform(string_split(regexp_replace(regexp_replace({x}, '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g'), chr(10)), lambda l: {STRIP('l')}), chr(10))")
NO_NOISE = lambda x: f"regexp_replace({x}, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]|[\\x{{feff}}\\x{{200b}}-\\x{{200f}}]|[■□▪▫●○◆◇★☆]+', '', 'g')"
IS_HEADER = f"""(regexp_matches(t, '^[{W}]*[-—]?[{W}]*\\p{{Nd}}+[{W}]*[-—]?[{W}]*$') OR regexp_matches(t, '^[{W}]*第[{W}]*\\p{{Nd}}+[{W}]*页[{W}]*$')
    OR regexp_matches(t, '(?i)^[{W}]*page[{W}]*\\p{{Nd}}+[{W}]*$')
    OR (len(string_split(t, chr(10))) <= 3 AND regexp_matches(t, '\\p{{Nd}}') AND length(t) < 50)
    OR coalesce((bbox[2] < 50 OR bbox[4] > 750) AND length(t) < 100, false))"""


@query(f"SELECT source, block_id, {IS_HEADER} AS is_header FROM (SELECT *, {STRIP('content_text')} AS t FROM {TEXTS})")
def header_footer_filter(s, d):
    return text_blocks(s, d).select("source", "block_id", normalize.is_header_footer("content_text", "bbox").alias("is_header"))


@query(f"SELECT source, block_id, {NO_NOISE('content_text')} AS text FROM {TEXTS}")
def noise_strip(s, d):
    return text_blocks(s, d).select("source", "block_id", normalize.strip_noise("content_text").alias("text"))


_FOLD = f"""list_reduce(list_prepend({{'done': '', 'buf': ''}}, list_transform(l, lambda x: {{'done': x, 'buf': ''}})), lambda s, n:
    CASE WHEN n.done = '' THEN {{'done': s.done || CASE WHEN s.buf = '' THEN '' ELSE chr(10) || s.buf END, 'buf': ''}}
    WHEN s.buf = '' THEN {{'done': s.done, 'buf': n.done}}
    WHEN regexp_matches(right(s.buf, 1), '[。！？.!?：:]') OR regexp_matches(n.done, '^[\\p{{Nd}}一二三四五六七八九十①②③④⑤•·\\-]') OR length(s.buf) < 5
    THEN {{'done': s.done || chr(10) || s.buf, 'buf': n.done}}
    ELSE {{'done': s.done, 'buf': s.buf || n.done}} END)"""


@query(
    f"""SELECT source, block_id, ltrim(f.done || CASE WHEN f.buf = '' THEN '' ELSE chr(10) || f.buf END, chr(10)) AS text FROM (SELECT source, block_id, {_FOLD} AS f FROM (
    SELECT source, block_id, list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(content_text, '([一-鿿])\\n([一-鿿])', '\\1\\2', 'g'), '([一-鿿])\\n([一-鿿])', '\\1\\2', 'g'),
    '([\\p{{L}}\\p{{N}}_])-\\n([\\p{{L}}\\p{{N}}_])', '\\1\\2', 'g'), chr(10)), lambda x: {STRIP('x')}) AS l FROM {TEXTS}))"""
)
def merge_broken_lines(s, d):
    return text_blocks(s, d).select("source", "block_id", normalize.merge_lines("content_text").alias("text"))


@query(f"SELECT source, block_id, {SQUEEZE('content_text')} AS text FROM {TEXTS}")
def normalize_whitespace(s, d):
    return text_blocks(s, d).select("source", "block_id", normalize.squeeze_whitespace("content_text").alias("text"))


@query(f"SELECT source, block_id, replace(translate(content_text, '{''.join(normalize.PUNCTUATION)}', '{''.join(normalize.PUNCTUATION.values())}'), '…', '...') AS text FROM {TEXTS}")
def normalize_punctuation(s, d):
    return text_blocks(s, d).select("source", "block_id", normalize.plain_punctuation("content_text").alias("text"))


@query(f"SELECT source, block_id FROM {BLOCKS} WHERE type = 'text' AND length({STRIP('content_text')}) >= 5")
def valid_content(s, d):
    return blocks(s, d).filter("type = 'text'").filter(normalize.is_valid("content_text")).select("source", "block_id")


@query(f"SELECT source, block_id, CASE WHEN metadata.is_ocr THEN least(confidence, 0.7) ELSE confidence END AS confidence FROM {BLOCKS}")
def ocr_confidence_cap(s, d):
    return blocks(s, d).select("source", "block_id", normalize.ocr_confidence("confidence", "metadata.is_ocr").alias("confidence"))


@query(f"SELECT source, block_id, array_to_string(list_transform(r, lambda x: array_to_string(list_transform(x, lambda c: coalesce({SQUEEZE(NO_NOISE('c'))}, '')), ' | ')), chr(10)) AS text FROM {TABLES}")
def table_clean(s, d):
    return table_blocks(s, d).select("source", "block_id", parsing.table_text(normalize.clean_rows("content_table.rows")).alias("text"))


@query(
    f"""WITH b AS (SELECT *, {STRIP('content_text')} AS t FROM {BLOCKS}), p AS (SELECT source, count(DISTINCT page) AS pages FROM b GROUP BY source),
    f AS (SELECT source, regexp_replace(t, '\\p{{Nd}}+', 'N', 'g') AS pattern, count(*) AS n FROM b WHERE type = 'text' AND length(t) BETWEEN 1 AND 99 GROUP BY ALL)
    SELECT source, pattern, n FROM f JOIN p USING (source) WHERE n >= 0.5 * pages"""
)
def learn_header_patterns(s, d):
    return normalize.header_patterns(blocks(s, d))


@query(
    f"""WITH b AS (SELECT *, {STRIP('content_text')} AS t FROM {BLOCKS}), p AS (SELECT source, count(DISTINCT page) AS pages FROM b GROUP BY source),
    f AS (SELECT source, regexp_replace(t, '\\p{{Nd}}+', 'N', 'g') AS pattern, count(*) AS n FROM b WHERE type = 'text' AND length(t) BETWEEN 1 AND 99 GROUP BY ALL)
    SELECT source, pattern, n FROM f JOIN p USING (source) WHERE n >= 0.02 * pages"""
)
def frequent_short_texts(s, d):
    """The same with a share that these pages reach."""
    return normalize.header_patterns(blocks(s, d), 0.02)


# the line fold over text without noise; string_split of empty text gives one empty line
_LINES = f"""list_transform(string_split(regexp_replace(regexp_replace(regexp_replace({NO_NOISE('content_text')}, '([一-鿿])\\n([一-鿿])', '\\1\\2', 'g'), '([一-鿿])\\n([一-鿿])', '\\1\\2', 'g'),
    '([\\p{{L}}\\p{{N}}_])-\\n([\\p{{L}}\\p{{N}}_])', '\\1\\2', 'g'), chr(10)), lambda x: {STRIP('x')})"""


@query(
    f"""WITH t AS (SELECT *, {STRIP('content_text')} AS t FROM {BLOCKS}),
    x AS (SELECT source, block_id, confidence, metadata, {_FOLD} AS f FROM (SELECT *, {_LINES} AS l FROM t WHERE type = 'text' AND content_text IS NOT NULL AND NOT {IS_HEADER})),
    y AS (SELECT source, block_id, confidence, metadata, {SQUEEZE("ltrim(f.done || CASE WHEN f.buf = '' THEN '' ELSE chr(10) || f.buf END, chr(10))")} AS c FROM x)
    SELECT source, block_id, c AS content_text, CASE WHEN metadata.is_ocr THEN least(confidence, 0.7) ELSE confidence END AS confidence,
    CASE WHEN metadata.is_ocr THEN 'OCR extracted' ELSE metadata.low_confidence_reason END AS why FROM y WHERE length(c) >= 5
    UNION ALL SELECT source, block_id, content_text, confidence, metadata.low_confidence_reason FROM t WHERE type <> 'text'"""
)
def normalize_blocks(s, d):
    n = normalize.normalize_blocks(blocks(s, d))
    return n.select("source", "block_id", "content_text", "confidence", F.col("metadata.low_confidence_reason").alias("why"))


# ---- windows and chunking

_RANKED = f"(SELECT source, page, row_number() OVER (PARTITION BY source ORDER BY page) - 1 AS r FROM (SELECT DISTINCT source, page FROM {BLOCKS}))"


@query(f"SELECT source, page, (r // 9)::INT AS win FROM {_RANKED} UNION ALL SELECT source, page, (r // 9 - 1)::INT FROM {_RANKED} WHERE r % 9 = 0 AND r > 0")
def page_windows(s, d):
    return windows.page_windows(blocks(s, d), 10)


_MERGED_BLOCKS = f"""SELECT source, page, ord, CASE WHEN type = 'text' THEN {STRIP('content_text')}
    WHEN type = 'table' THEN array_to_string(list_filter(list_transform(content_table.rows, lambda x:
    array_to_string(list_transform(list_filter(x, lambda c: coalesce(c, '') <> ''), lambda c: {STRIP('c')}), ' | ')), lambda t: t <> ''), chr(10)) END AS t FROM {BLOCKS}"""
_MERGED = f"(SELECT source, page, string_agg(t, chr(10) || chr(10) ORDER BY ord) AS text FROM ({_MERGED_BLOCKS}) WHERE t <> '' GROUP BY source, page)"


@query(f"SELECT source, page, text FROM {_MERGED}")
def merge_pages(s, d):
    return chunking.page_texts(blocks(s, d))


@query(f"SELECT source, win, count(*) AS n_texts, sum(length(t))::BIGINT AS chars FROM ({_MERGED_BLOCKS}) JOIN (SELECT source, page, (r // 9)::INT AS win FROM {_RANKED} UNION ALL SELECT source, page, (r // 9 - 1)::INT FROM {_RANKED} WHERE r % 9 = 0 AND r > 0) USING (source, page) WHERE t <> '' GROUP BY ALL")
def window_texts(s, d):
    """The texts of each window, counted."""
    w = chunking.window_texts(blocks(s, d))
    return w.select("source", "win", F.size("items").cast("bigint").alias("n_texts"), F.aggregate("items", F.lit(0).cast("bigint"), lambda n, i: n + F.length(i["text"])).alias("chars"))


@query(
    f"""WITH w AS (SELECT chunk_id, source, page_start // 10 AS win, row_number() OVER (PARTITION BY source, page_start // 10 ORDER BY page_start, chunk_id DESC) AS pos FROM {CHUNKS} WHERE source IS NOT NULL)
    SELECT chunk_id FROM w QUALIFY pos < max(pos) OVER (PARTITION BY source, win) OR win = max(win) OVER (PARTITION BY source)"""
)
def held_back_chunks(s, d):
    """Stored chunks in windows of ten pages: all but the last of each window that another follows."""
    w = chunks(s, d).filter("source is not null").select("chunk_id", "source", F.floor(F.col("page_start") / 10).alias("win"), "page_start")
    pos = F.row_number().over(Window.partitionBy("source", "win").orderBy("page_start", F.desc("chunk_id")))
    return windows.held_back(w.withColumn("pos", pos)).select("chunk_id")


def _split_query(c: C.Chunking):
    return lambda s, d: chunking.split_texts(spread(docs(s, d).select("doc_id", "text")), "doc_id", "text", c)


QUERIES["chunk_tokens"] = _split_query(C.Chunking(size=120, overlap=30, min_chunk_size=20))
QUERIES["chunk_sentences"] = _split_query(C.Chunking(size=60, split_by="sentence"))
QUERIES["chunk_chars_overlap"] = _split_query(C.Chunking(size=100, overlap=20, split_by="char"))
QUERIES["chunk_chars"] = _split_query(C.Chunking(size=100, overlap=0, split_by="char", respect_sentence_boundary=False))
ORACLE["chunk_chars"] = "SELECT doc_id, (unnest(range(0, length(text), 400)) // 400)::INT AS pos, substr(text, unnest(range(0, length(text), 400))::INT + 1, 400) AS piece FROM documents WHERE length(text) > 0"
QUERIES["chunk_force_split"] = _split_query(C.Chunking(size=50, overlap=10, respect_sentence_boundary=False))
# the fold as a recursion: sentences joined by a space, which the limit does not count
ORACLE["chunk_sentences"] = f"""
WITH RECURSIVE t AS (SELECT doc_id, {SENTENCES('text')} AS l FROM documents WHERE text IS NOT NULL),
r(doc_id, l, i, cur, pos, emit) AS (
  SELECT doc_id, l, 1, l[1], 0, NULL::VARCHAR FROM t WHERE len(l) > 0
  UNION ALL SELECT doc_id, l, i + 1,
    CASE WHEN i = len(l) THEN NULL WHEN length(cur) + length(l[i + 1]) > 240 THEN l[i + 1] ELSE cur || ' ' || l[i + 1] END,
    pos + CASE WHEN i = len(l) OR length(cur) + length(l[i + 1]) > 240 THEN 1 ELSE 0 END,
    CASE WHEN i = len(l) OR length(cur) + length(l[i + 1]) > 240 THEN cur END
  FROM r WHERE i <= len(l))
SELECT doc_id, (pos - 1)::INT AS pos, emit AS piece FROM r WHERE emit IS NOT NULL"""

# the overlap is the longest tail of the piece's sentences within 30 tokens; a sentence over the limit is cut by ideographs
# first (c), and each of its pieces ends what came before
_TAIL = f"""(list_reduce(list_prepend({{'s': '', 'n': 0, 'open': true}}, list_transform(list_reverse({SENTENCES('cur')}), lambda x: {{'s': x, 'n': {TOKENS('x')}, 'open': true}})), lambda a, b:
    CASE WHEN a.open AND a.n + b.n <= 30 THEN {{'s': CASE WHEN a.s = '' THEN b.s ELSE b.s || ' ' || a.s END, 'n': a.n + b.n, 'open': true}} ELSE {{'s': a.s, 'n': a.n, 'open': false}} END)).s"""
ORACLE["chunk_tokens"] = f"""
WITH RECURSIVE u AS (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, {SENTENCES('text')} AS l FROM documents WHERE text IS NOT NULL)),
v AS (SELECT doc_id, i, l[i] AS x, {TOKENS('l[i]')} > 120 AS long FROM u),
c(doc_id, i, j, rest, piece) AS (
  SELECT doc_id, i, 0, x, '' FROM v WHERE long
  UNION ALL SELECT doc_id, i, j + 1, substr(rest, length(h) + 1), kept || h FROM (SELECT *, CASE WHEN {TOKENS('kept')} >= 120 THEN left(rest, 1) ELSE regexp_extract(rest, '^(?:[^一-鿿]*[一-鿿]){{0,' || (120 - {TOKENS('kept')}) || '}}[^一-鿿]*') END AS h
    FROM (SELECT *, right(piece, (length(piece) * 30 // 120)::INT) AS kept FROM c WHERE rest <> ''))),
w AS (SELECT doc_id, i, 0 AS j, x, false AS long FROM v WHERE NOT long UNION ALL SELECT doc_id, i, j, piece, true FROM c WHERE j > 0),
t AS (SELECT doc_id, list(x ORDER BY i, j) AS l, list({TOKENS('x')} ORDER BY i, j) AS k, list(long ORDER BY i, j) AS f FROM w GROUP BY doc_id),
r(doc_id, l, k, f, i, cur, n, pos, emit) AS (
  SELECT doc_id, l, k, f, 1, l[1], k[1], 0, NULL::VARCHAR FROM t WHERE len(l) > 0
  UNION ALL SELECT doc_id, l, k, f, i + 1,
    CASE WHEN i = len(l) THEN NULL WHEN f[i + 1] THEN l[i + 1] WHEN n + k[i + 1] > 120 THEN {_TAIL} || l[i + 1] ELSE cur || ' ' || l[i + 1] END,
    CASE WHEN i = len(l) THEN 0 WHEN f[i + 1] THEN k[i + 1] WHEN n + k[i + 1] > 120 THEN {TOKENS(f"({_TAIL} || l[i + 1])")} ELSE n + k[i + 1] END,
    pos + CASE WHEN f[i + 1] OR n + k[i + 1] > 120 OR i = len(l) AND {TOKENS('cur')} >= 20 THEN 1 ELSE 0 END,
    CASE WHEN f[i + 1] OR n + k[i + 1] > 120 OR i = len(l) AND {TOKENS('cur')} >= 20 THEN cur END
  FROM r WHERE i <= len(l))
SELECT doc_id, (pos - 1)::INT AS pos, emit AS piece FROM r WHERE emit IS NOT NULL"""

ORACLE["chunk_force_split"] = f"""
WITH RECURSIVE c(doc_id, j, rest, piece) AS (
  SELECT doc_id, 0, text, '' FROM documents WHERE length(text) > 0
  UNION ALL SELECT doc_id, j + 1, substr(rest, length(h) + 1), kept || h FROM (SELECT *, CASE WHEN {TOKENS('kept')} >= 50 THEN left(rest, 1) ELSE regexp_extract(rest, '^(?:[^一-鿿]*[一-鿿]){{0,' || (50 - {TOKENS('kept')}) || '}}[^一-鿿]*') END AS h
    FROM (SELECT *, right(piece, (length(piece) * 10 // 50)::INT) AS kept FROM c WHERE rest <> '')))
SELECT doc_id, j - 1 AS pos, piece FROM c WHERE j > 0"""

# windows of 400 characters: the last mark in the second half ends one, the next starts 80 characters before its end
_CUT = "(CASE WHEN b + 400 >= length(text) THEN length(text) ELSE b + coalesce(nullif(201 + length(regexp_extract(substr(text, b + 202, 200), '^(?s:(.*))[。！？.!?\n]', 0)), 201), 400) END)::BIGINT"
ORACLE["chunk_chars_overlap"] = f"""
WITH RECURSIVE r(doc_id, text, b, pos, fin, piece) AS (
  SELECT doc_id, text, 0::BIGINT, -1, length(text) = 0, NULL::VARCHAR FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, text, greatest(e - 80, b + 1), pos + 1, e = length(text), substr(text, b + 1, e - b) FROM (SELECT *, {_CUT} AS e FROM r WHERE NOT fin))
SELECT doc_id, pos, piece FROM r WHERE pos >= 0"""


# ---- validation

VALID = f"""WITH t AS MATERIALIZED (SELECT *, coalesce(content, '') AS x FROM {CHUNKS}),
m AS MATERIALIZED (SELECT *, length(x) AS n, {DENSITY('x')} AS de, {NOISE('x')} AS no, {GARBLE('x')} AS ga, {REPEAT('x')} AS re FROM t),
w AS MATERIALIZED (SELECT *, 0.15 * least(n / 200.0, 1) + 0.25 * least(de / 0.3, 1) + 0.25 * greatest(0, 1 - no / 0.3) + 0.2 * greatest(0, 1 - ga / 0.1) + 0.15 * greatest(0, 1 - re / 0.5) AS score,
    concat_ws('; ', CASE WHEN n < 200 THEN '长度不足: ' || n || ' < 200' END, CASE WHEN de < 0.3 THEN '信息密度低: ' || printf('%.2f', de) || ' < 0.3' END,
    CASE WHEN no > 0.3 THEN '噪声过多: ' || printf('%.2f', no) || ' > 0.3' END, CASE WHEN ga > 0.1 THEN '检测到乱码: ' || printf('%.2f', ga) END,
    CASE WHEN re > 0.5 THEN '重复过多: ' || printf('%.2f', re) || ' > 0.5' END) AS why,
    (n < 200)::INT + (de < 0.3)::INT + (no > 0.3)::INT + (ga > 0.1)::INT + (re > 0.5)::INT AS k FROM m),
v AS MATERIALIZED (SELECT *, CASE WHEN k >= 2 OR (k = 1 AND score < 0.3) THEN 'reject' WHEN k = 1 THEN 'low' ELSE 'good' END AS q, CASE WHEN k > 0 THEN why ELSE '规则校验通过' END AS reason_text FROM w)
"""


def valid_chunks(s, d):
    return validation.validated(spread_chunks(s, d).select("chunk_id", "source", "content", "page_start", "page_end", "token_count", "char_count"))


@query(VALID + "SELECT chunk_id, n AS length, round(de, 6) AS info_density, round(no, 6) AS noise_ratio, round(ga, 6) AS garble_ratio, round(re, 6) AS repetition_ratio, round(score, 5) AS rule_score, q AS quality FROM v")
def rule_validation(s, d):
    r = lambda c, k=6: F.round(c, k).alias(c)
    return valid_chunks(s, d).select("chunk_id", "length", r("info_density"), r("noise_ratio"), r("garble_ratio"), r("repetition_ratio"), r("rule_score", 5), "quality")


@query(VALID + "SELECT chunk_id, reason_text AS reason FROM v")
def validation_reasons(s, d):
    return valid_chunks(s, d).select("chunk_id", "reason")


@query(VALID + "SELECT q <> 'reject' AS accepted, q AS quality, count(*) AS n, sum(n)::BIGINT AS chars FROM v GROUP BY q")
def quality_routing(s, d):
    v = valid_chunks(s, d).withColumn("metadata", F.create_map().cast("map<string,string>"))
    ok, bad = validation.routed(v)
    both = ok.withColumn("accepted", F.lit(True)).unionByName(bad.withColumn("accepted", F.lit(False)))
    return both.groupBy("accepted", "quality").agg(F.count("*").alias("n"), F.sum("length").cast("bigint").alias("chars"))


@query(VALID + "SELECT chunk_id FROM v WHERE NOT ((score > 0.6 AND q = 'good') OR score < 0.2)")
def llm_gate(s, d):
    return valid_chunks(s, d).filter(validation.needs_review()).select("chunk_id")


@query(VALID + "SELECT chunk_id FROM v WHERE NOT ((score > 0.6 AND q = 'good') OR score < 0.2) ORDER BY chunk_id LIMIT 500")
def llm_budget(s, d):
    """The call budget is the feature: the first 500 gated chunks."""
    return validation.within_budget(valid_chunks(s, d).filter(validation.needs_review()).select("chunk_id"), 500, ["chunk_id"])




def _replies(s, d):
    q = F.expr("CASE token_count % 4 WHEN 0 THEN 'GOOD' WHEN 1 THEN 'low' WHEN 2 THEN 'odd' ELSE 'Reject' END")
    body = F.concat(F.lit('x {"quality":"'), q, F.lit('","confidence":0.'), (F.col("token_count") % 10).cast("string"), F.lit(',"reason":"r'), F.col("page_start").cast("string"), F.lit('"} y'))
    return chunks(s, d).withColumn("reply", F.when(F.col("token_count") % 7 == 0, F.lit("no json")).otherwise(body))


_SAID = f"""(SELECT *, CASE WHEN token_count % 7 = 0 THEN NULL WHEN token_count % 4 = 0 THEN 'good' WHEN token_count % 4 = 3 THEN 'reject' ELSE 'low' END AS said FROM {CHUNKS})"""


@query(f"SELECT chunk_id, said AS quality, CASE WHEN said IS NOT NULL THEN (token_count % 10) / 10.0::DOUBLE END AS confidence, CASE WHEN said IS NOT NULL THEN 'r' || page_start END AS reason FROM {_SAID}")
def llm_parse(s, d):
    """Replies made from the rows, parsed."""
    return _replies(s, d).select("chunk_id", validation.parsed_reply("reply").alias("p")).select("chunk_id", "p.quality", "p.confidence", "p.reason")


def _judge(prompt: str) -> str | None:
    """Stands for the model: its reply depends on the length of what it is asked about."""
    n = len(prompt)
    return None if n % 5 == 0 else f'{{"quality": "{("good", "low", "reject")[n % 3]}", "confidence": 0.{n % 10}, "reason": "n{n}"}}'


@query(
    VALID + """, g AS (SELECT chunk_id, CASE WHEN n > 2000 THEN 2003 ELSE n END AS k FROM v WHERE NOT ((score > 0.6 AND q = 'good') OR score < 0.2) ORDER BY chunk_id LIMIT 400),
    a AS (SELECT chunk_id, k, CASE k % 3 WHEN 0 THEN 'good' WHEN 1 THEN 'low' ELSE 'reject' END AS said FROM g WHERE k % 5 <> 0)
    SELECT v.chunk_id, coalesce(said, q) AS quality, said AS llm_quality, coalesce((a.k % 10) / 10.0, 0.0)::DOUBLE AS llm_confidence, coalesce('n' || a.k, reason_text) AS reason,
    CASE WHEN coalesce(said, q) = 'reject' THEN coalesce('n' || a.k, reason_text) END AS reject_reason FROM v LEFT JOIN a ON v.chunk_id = a.chunk_id"""
)
def llm_merge(s, d):
    """Reviews of the first 400 gated chunks merged into the rule results, and the reason each rejected one carries."""
    rows = checkpointed(valid_chunks(s, d).withColumns({"content": F.coalesce("content", F.lit("")), "metadata": F.create_map().cast("map<string,string>")}))
    ok, bad = validation.routed(validation.reviewed(rows, _judge, C.Config(llm=C.Llm(max_calls=400))))
    return ok.unionByName(bad).select("chunk_id", "quality", "llm_quality", "llm_confidence", "reason", F.col("metadata")["reject_reason"].alias("reject_reason"))


# ---- aggregates


@query(f"""SELECT bucket, (SELECT count(*) FROM {CHUNKS} WHERE token_count >= lo AND token_count < hi) AS n
    FROM (VALUES ('<200', 0, 200), ('200-499', 200, 500), ('500-799', 500, 800), ('800-1199', 800, 1200), ('>=1200', 1200, 2000000000)) v(bucket, lo, hi)""")
def token_histogram(s, d):
    return aggregates.token_histogram(chunks(s, d))


@query(f"SELECT coalesce(llm_quality, 'not_evaluated') AS llm_quality, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS percent FROM {CHUNKS} GROUP BY 1")
def quality_distribution(s, d):
    return aggregates.quality_distribution(chunks(s, d))


@query(f"SELECT coalesce(metadata['reject_reason'], 'unknown') AS reason, count(*) AS n FROM {CHUNKS} WHERE llm_quality = 'reject' OR metadata['reject_reason'] IS NOT NULL GROUP BY 1")
def rejection_reasons(s, d):
    reason = F.col("metadata")["reject_reason"]
    return aggregates.rejection_reasons(chunks(s, d).withColumn("reason", reason).filter("llm_quality = 'reject' or reason is not null"))


@query(
    f"""SELECT n_chunks, total_tokens, round(a, 6) AS avg_tokens, round(b, 6) AS avg_rule_score, round(c, 6) AS avg_llm_confidence,
    CASE WHEN a > 0 THEN greatest(3, least(10, floor(1000 / round(a, 6))))::INT END AS top_k, CASE WHEN a > 0 THEN floor(round(a, 6) * 0.8)::INT END AS chunk_size FROM
    (SELECT count(*) AS n_chunks, sum(token_count)::BIGINT AS total_tokens, avg(token_count) AS a, avg(rule_score) AS b, avg(llm_confidence) AS c FROM {CHUNKS})"""
)
def report_summary(s, d):
    return aggregates.report_summary(chunks(s, d))


@query(
    VALID + f""", b AS (SELECT source, count(DISTINCT page) AS processed_pages, count(*) AS total_blocks, count(*) FILTER (type = 'text') AS text_blocks,
    count(*) FILTER (type = 'table') AS table_blocks, count(*) FILTER (type = 'image') AS image_blocks FROM {BLOCKS} GROUP BY source),
    c AS (SELECT source, count(*) AS total_chunks, count(*) FILTER (q <> 'reject') AS accepted_chunks, count(*) FILTER (q = 'reject') AS rejected_chunks,
    avg(char_count) AS avg_chunk_length, avg(score) AS avg_rule_score FROM v GROUP BY source)
    SELECT b.*, coalesce(total_chunks, 0) AS total_chunks, coalesce(accepted_chunks, 0) AS accepted_chunks, coalesce(rejected_chunks, 0) AS rejected_chunks,
    round(coalesce(avg_chunk_length, 0), 6) AS avg_chunk_length, round(coalesce(avg_rule_score, 0), 4) AS avg_rule_score,
    round(coalesce(accepted_chunks, 0) * 100.0 / greatest(coalesce(total_chunks, 0), 1), 6) AS acceptance_rate FROM b LEFT JOIN c ON b.source IS NOT DISTINCT FROM c.source"""
)
def run_stats(s, d):
    """Of the blocks and the stored chunks of each source."""
    return aggregates.run_stats(blocks(s, d), valid_chunks(s, d)).withColumn("avg_rule_score", F.round("avg_rule_score", 4))


@query("SELECT source_file, total_pages, total_chunks, round(accepted_chunks * 100.0 / greatest(total_chunks, 1), 6) AS acceptance_rate, round(llm_calls * 0.001::DOUBLE, 6) AS llm_cost FROM processing_stats")
def stored_run_rates(s, d):
    return aggregates.stored_rates(table(s, d, "processing_stats"))


# ---- exports

_THREE = lambda c: f"CASE WHEN coalesce({c}, 0) = 0 THEN '' ELSE printf('%.3f', {c}) END"


@query(
    f"""SELECT chunk_id, source, page_start, page_end, token_count, {_THREE('rule_score')} AS rule_score, coalesce(llm_quality, '') AS llm_quality, {_THREE('llm_confidence')} AS llm_confidence,
    char_count, CASE WHEN length(content) > 200 THEN left(content, 200) || '...' ELSE content END AS content FROM {CHUNKS}"""
)
def export_csv(s, d):
    return exports.csv_rows(chunks(s, d))


@query(
    f"""SELECT chunk_id, '## ' || chunk_id || chr(10) || chr(10) || '**Source:** ' || coalesce(source, '') || ' (Pages ' || page_start || '-' || page_end || ')' || chr(10) || chr(10) || '**Stats:** ' || token_count
    || ' tokens, ' || char_count || ' chars' || chr(10) || chr(10) || CASE WHEN coalesce(rule_score, 0) <> 0 THEN '**Rule Score:** ' || printf('%.3f', rule_score) || chr(10) || chr(10) ELSE '' END
    || CASE WHEN length(llm_quality) > 0 THEN '**LLM Quality:** ' || llm_quality || chr(10) || chr(10) ELSE '' END || coalesce(content, '') || chr(10) || chr(10) || '---' || chr(10) AS section FROM {CHUNKS}"""
)
def export_markdown(s, d):
    return exports.markdown_sections(chunks(s, d))


@query(f"SELECT content, source, page_start, page_end, chunk_id, token_count FROM {CHUNKS}")
def export_dify(s, d):
    return exports.dify_rows(chunks(s, d)).select("content", "meta.*")


@query(f"SELECT chunk_id AS id, content AS text, source, page_start, page_end, token_count, rule_score FROM {CHUNKS}")
def export_milvus(s, d):
    return exports.milvus_rows(chunks(s, d))


@query(f"""SELECT content AS text, '{{"chunk_id":"' || chunk_id || '","source":"' || source || '","page_start":' || page_start || ',"page_end":' || page_end || ',"token_count":' || token_count || '}}' AS metadata FROM {CHUNKS}""")
def export_vectors(s, d):
    return exports.vector_rows(chunks(s, d))


@query(f"SELECT chunk_id, content FROM {CHUNKS} WHERE length(content) > 0")
def export_texts(s, d):
    return exports.text_rows(chunks(s, d))


# ---- knowledge graph

_KG = f"(SELECT chunk_id, source, page_start, token_count, row_number() OVER (ORDER BY chunk_id) AS ord FROM {CHUNKS} WHERE source IS NOT NULL)"


def _graph_replies(s, d):
    """A reply made from each chunk: its source and its page as entities, one in the other."""
    c = chunks(s, d).filter("source is not null")
    e = lambda name, kind: F.struct(name.alias("name"), F.lit(kind).alias("type"), F.col("chunk_id").alias("description"))
    page = F.concat(F.lit(" page "), F.col("page_start").cast("string"), F.lit(" "))
    ents = F.array(e(F.col("source"), "Document"), e(page, "Page"), e(F.lit(" "), "Blank"))
    rels = F.array(F.struct(F.col("source").alias("source"), F.lit("includes").alias("relation"), page.alias("target"), F.lit(0.9).alias("confidence")),
                   F.struct(F.col("source").alias("source"), F.lit("includes").alias("relation"), F.lit(None).cast("string").alias("target"), F.lit(0.1).alias("confidence")))
    reply = F.concat(F.lit("Sure: "), F.to_json(F.struct(ents.alias("entities"), rels.alias("relations"))), F.lit(" done"))
    return c.select(F.col("chunk_id").alias("ord"), graph.parsed(reply).alias("graph"))


@query(f"SELECT name, type, min(chunk_id) AS description FROM (SELECT source AS name, 'Document' AS type, chunk_id FROM {_KG} UNION ALL SELECT ' page ' || page_start || ' ', 'Page', chunk_id FROM {_KG}) GROUP BY ALL")
def kg_entities(s, d):
    return graph.entities(_graph_replies(s, d))


@query(f"SELECT DISTINCT source, 'includes' AS relation, ' page ' || page_start || ' ' AS target, 0.9::DOUBLE AS confidence FROM {_KG}")
def kg_relations(s, d):
    return graph.relations(_graph_replies(s, d))


@query(f"""SELECT 'entity' AS what, 'Document' AS type, count(DISTINCT source) AS n FROM {_KG} UNION ALL SELECT 'entity', 'Page', count(DISTINCT page_start) FROM {_KG}
    UNION ALL SELECT 'relation', 'includes', count(*) FROM (SELECT DISTINCT source, page_start FROM {_KG})""")
def kg_stats(s, d):
    r = _graph_replies(s, d)
    return graph.counts(graph.entities(r), graph.relations(r))


@query(f"SELECT chunk_id FROM (SELECT chunk_id, content FROM {CHUNKS} ORDER BY chunk_id LIMIT 300 OFFSET 50) WHERE length(content) >= 100")
def skip_limit(s, d):
    """Skip and limit are the feature: the 300 chunks after the first 50."""
    return graph.selected(chunks(s, d).select("chunk_id", "content"), 50, 300).select("chunk_id")


# ---- the whole way


@query()
def e2e_pipeline(s, d):
    """Page blocks to accepted chunks."""
    return to_chunks(blocks(s, d)).filter("quality <> 'reject'").select("chunk_id", "source", "win", "page_start", "page_end", "token_count", "char_count", "content", F.round("rule_score", 6).alias("rule_score"), "quality", "reason")


@query()
def e2e_documents(s, d):
    """Documents through the adapter to accepted chunks."""
    return to_chunks(block_sources.from_documents(docs(s, d))).filter("quality <> 'reject'").select("chunk_id", "source", "page_start", "page_end", "token_count", "quality")
