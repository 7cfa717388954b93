"""Rule validation, the gate and budget of reviews by a language model, merging and routing; native expressions."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.config import Config, Llm, Quality
from pagemill.functions import text as T
from pagemill.session import small_side

METRICS = ("length", "info_density", "noise_ratio", "garble_ratio", "repetition_ratio")


# The weight of each metric in the rule score.
WEIGHTS = {"length": 0.15, "info_density": 0.25, "noise_ratio": 0.25, "garble_ratio": 0.2, "repetition_ratio": 0.15}
# The wording of the reasons, which is part of the data.
TOO_SHORT, THIN, NOISY, GARBLED, REPETITIVE, PASSED = "长度不足: ", "信息密度低: ", "噪声过多: ", "检测到乱码: ", "重复过多: ", "规则校验通过"
REVIEW_TEMPLATE = (
    "Judge whether this text is fit for retrieval: is it complete, coherent, informative and free of garbled characters?\n"
    "---\n{{CHUNK_TEXT}}\n---\n"
    'Answer in JSON alone: {"quality": "good/low/reject", "confidence": 0.0-1.0, "reason": "in a few words"}'
)


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are computed once per row: later filters and projections don't repeat their expressions.

    A generator of one row stands between them and what follows; a column of the same name is replaced.
    """
    keep = [c for c in df.columns if c not in columns]
    return df.select(*keep, F.inline(F.array(F.struct(*[v.alias(k) for k, v in columns.items()]))))


def with_metrics(chunks: DataFrame, q: Quality = Quality(), content: str = "content") -> DataFrame:
    """The five metrics, of null text as of empty text."""
    x = F.coalesce(F.col(content), F.lit(""))
    return computed(
        chunks,
        {
            "length": F.length(x),
            "info_density": T.info_density(x),
            "noise_ratio": T.noise_ratio(x),
            "garble_ratio": T.garble_ratio(x) if q.garble_enabled else F.lit(0.0),
            "repetition_ratio": T.repetition_ratio(x),
        },
    )


def _excess(value: Column, limit: float) -> Column:
    """1 at no excess, 0 at the limit and beyond; a limit of 0 allows nothing."""
    if limit == 0:
        return F.when(value == 0, F.lit(1.0)).otherwise(0.0)
    return F.greatest(F.lit(0.0), 1 - value / F.lit(float(limit)))


def _reach(value: Column, least: float) -> Column:
    return F.lit(1.0) if least == 0 else F.least(value / F.lit(float(least)), F.lit(1.0))


def rule_score(q: Quality = Quality()) -> Column:
    return (
        _reach(F.col("length"), q.min_length) * WEIGHTS["length"]
        + _reach(F.col("info_density"), q.min_info_density) * WEIGHTS["info_density"]
        + _excess(F.col("noise_ratio"), q.max_noise_ratio) * WEIGHTS["noise_ratio"]
        + _excess(F.col("garble_ratio"), q.max_garble_ratio) * WEIGHTS["garble_ratio"]
        + _excess(F.col("repetition_ratio"), q.max_repetition_ratio) * WEIGHTS["repetition_ratio"]
    )


def reasons(q: Quality = Quality()) -> Column:
    """The failed rules in words, as an array."""
    two = lambda c: F.format_number(F.col(c), 2)
    n = lambda v: F.lit(str(v))
    return F.array_compact(
        F.array(
            F.when(F.col("length") < q.min_length, F.concat(F.lit(TOO_SHORT), F.col("length").cast("string"), F.lit(" < "), n(q.min_length))),
            F.when(F.col("info_density") < q.min_info_density, F.concat(F.lit(THIN), two("info_density"), F.lit(" < "), n(q.min_info_density))),
            F.when(F.col("noise_ratio") > q.max_noise_ratio, F.concat(F.lit(NOISY), two("noise_ratio"), F.lit(" > "), n(q.max_noise_ratio))),
            F.when(F.col("garble_ratio") > q.max_garble_ratio, F.concat(F.lit(GARBLED), two("garble_ratio"))) if q.garble_enabled else F.lit(None).cast("string"),
            F.when(F.col("repetition_ratio") > q.max_repetition_ratio, F.concat(F.lit(REPETITIVE), two("repetition_ratio"), F.lit(" > "), n(q.max_repetition_ratio))),
        )
    )


def validated(chunks: DataFrame, q: Quality = Quality(), content: str = "content") -> DataFrame:
    """Metrics, rule_score, quality and reason of every chunk."""
    out = computed(with_metrics(chunks, q, content), {"rule_score": rule_score(q), "_r": reasons(q)})
    failed = F.size("_r")
    quality = F.when((failed >= 2) | (failed > 0) & (F.col("rule_score") < 0.3), "reject").when(failed == 1, "low").otherwise("good")
    said = F.when(failed > 0, F.array_join("_r", "; ")).otherwise(PASSED)
    return computed(out, {"quality": quality, "reason": said}).drop("_r")


def needs_review(c: Config = Config()) -> Column:
    """Whether a chunk is to be reviewed by the language model."""
    if not (c.llm.enabled and c.quality.llm_enabled):
        return F.lit(False)
    if not c.quality.only_edge_chunks:
        return F.lit(True)
    clear = (F.col("rule_score") > c.quality.edge_threshold) & (F.col("quality") == "good") | (F.col("rule_score") < 0.2)
    return ~clear


def within_budget(gated: DataFrame, max_calls: int, order: list[str]) -> DataFrame:
    """The first max_calls rows in order; a top-k, so each task passes on no more than that many rows."""
    return gated.orderBy(*order).limit(max_calls)


def parsed_reply(reply: Column | str) -> Column:
    """struct(quality, confidence, reason) of a model's reply, null where it holds no JSON object."""
    found = F.regexp_extract(T.col(reply), r"(\{[^}]+\})", 1)
    j = F.from_json(found, "quality string, confidence double, reason string")
    quality = F.lower(F.coalesce(j["quality"], F.lit("low")))
    return F.when(
        F.get_json_object(found, "$").isNotNull(),
        F.struct(
            F.when(quality.isin("good", "low", "reject"), quality).otherwise("low").alias("quality"),
            F.coalesce(j["confidence"], F.lit(0.5)).alias("confidence"),
            F.coalesce(j["reason"], F.lit("LLM 评估")).alias("reason"),
        ),
    )


def prompt_text(content: Column | str, limit: int = 2000) -> Column:
    c = T.col(content)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit("..."))).otherwise(c)


def reviewed(chunks: DataFrame, ask: Callable[[str], str | None], c: Config = Config(), order: tuple[str, ...] = ("chunk_id",)) -> DataFrame:
    """Merge reviews of the gated chunks within the budget into the rule results; `ask` is the injected client.

    Only gated rows reach Python. The budgeted rows are spread over all cores and their replies written before the join,
    so calls run side by side and none is repeated. A reply replaces the rule's quality; the rule's score stays.
    Give it chunks that are written or checkpointed: they are read for the gate and for the join.
    """

    @F.pandas_udf("string")
    def replies(prompts: pd.Series) -> pd.Series:
        return prompts.map(ask)

    gated = within_budget(chunks.filter(needs_review(c)).select("chunk_id", *[o for o in order if o != "chunk_id"], "content"), c.llm.max_calls, list(order))
    gated = gated.repartition(chunks.sparkSession.sparkContext.defaultParallelism)
    said = gated.select("chunk_id", parsed_reply(replies.asNondeterministic()(prompt_text("content"))).alias("llm"))
    said = small_side(said)
    out = chunks.join(said, "chunk_id", "left")
    return out.withColumns(
        {
            "llm_quality": F.col("llm.quality"),
            "llm_confidence": F.coalesce("llm.confidence", F.lit(0.0)),
            "llm_reason": F.coalesce("llm.reason", F.lit("")),
            "quality": F.coalesce("llm.quality", "quality"),
            "reason": F.coalesce("llm.reason", "reason"),
        }
    ).drop("llm")


def http_client(llm: Llm, template: str = REVIEW_TEMPLATE, predict: int | None = None) -> Callable[[str], str | None]:
    """A client for an Ollama-style endpoint; tries llm.retry_times times and gives None on failure."""

    def ask(text: str) -> str | None:
        import json
        import time
        import urllib.request

        body = {"model": llm.model, "prompt": template.replace("{{CHUNK_TEXT}}", text or ""), "stream": False, "options": {"temperature": llm.temperature} | ({"num_predict": predict} if predict else {})}
        for _ in range(max(llm.retry_times, 1)):
            try:
                req = urllib.request.Request(f"{llm.endpoint}/api/generate", json.dumps(body).encode(), {"Content-Type": "application/json"})
                with urllib.request.urlopen(req, timeout=llm.timeout) as r:
                    return json.load(r).get("response")
            except OSError:
                time.sleep(1)
        return None

    return ask


def routed(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); rejected ones carry their reason in metadata."""
    accepted = chunks.filter(F.col("quality") != "reject")
    noted = F.map_concat(F.coalesce("metadata", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))), F.create_map(F.lit("reject_reason"), F.col("reason")))
    rejected = chunks.filter(F.col("quality") == "reject")
    return accepted, rejected.withColumn("metadata", noted) if "metadata" in chunks.columns else rejected


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", n).filter("_n = 1").drop("_n")
