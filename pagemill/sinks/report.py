"""The HTML report of a run: a template over a few aggregates, which alone are collected."""

from __future__ import annotations

from html import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.operators.aggregates import COST_PER_CALL, quality_distribution, rejection_reasons, report_summary, token_histogram

#: Most reasons listed; they hold numbers, so nearly every one is its own.
TOP_REASONS = 50


def _table(title: str, head: list[str], rows: list) -> str:
    cells = "".join("<tr>" + "".join(f"<td>{escape(str(v))}</td>" for v in r) + "</tr>" for r in rows)
    return f"<h2>{escape(title)}</h2><table><tr>{''.join(f'<th>{escape(h)}</th>' for h in head)}</tr>{cells}</table>"


def html(accepted: DataFrame, rejected: DataFrame, llm_calls: int = 0, strategy: str = "balanced") -> str:
    s = report_summary(accepted).first()
    n_rejected = rejected.count()
    rate = s["n_chunks"] * 100.0 / max(s["n_chunks"] + n_rejected, 1)
    parts = [
        _table("Summary", ["accepted", "rejected", "acceptance %", "tokens"], [(s["n_chunks"], n_rejected, f"{rate:.2f}", s["total_tokens"])]),
        _table("Strategy", ["name"], [(strategy,)]),
        _table("Tokens per chunk", ["bucket", "chunks"], token_histogram(accepted).collect()),
        _table("Quality", ["quality", "chunks", "%"], quality_distribution(accepted).orderBy(F.desc("n"), "llm_quality").collect()),
        _table("Rejections", ["reason", "chunks"], rejection_reasons(rejected).orderBy(F.desc("n"), "reason").limit(TOP_REASONS).collect()),
        _table("Reviews", ["calls", "cost", "mean confidence"], [(llm_calls, f"{llm_calls * COST_PER_CALL:.3f}", s["avg_llm_confidence"])]),
        _table("Recommendations", ["top_k", "chunk_size"], [(s["top_k"], s["chunk_size"])]),
    ]
    return "<!doctype html><meta charset='utf-8'><title>Report</title><style>td,th{border:1px solid #999;padding:4px}</style>" + "".join(parts)
