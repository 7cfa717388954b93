"""Command line: run the pipeline, extract a graph, list strategies.

    python -m pagemill run --input blocks/ --output out/ --strategy fast
    python -m pagemill graph --input out/chunks --output out/graph
    python -m pagemill strategies

Settings come from the preset, then the YAML file, then the options. Input is Parquet or JSON lines of page blocks.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pagemill import config


def parsed(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="pagemill")
    todo = p.add_subparsers(dest="command", required=True)
    todo.add_parser("strategies", help="list the presets")
    r = todo.add_parser("run", help="page blocks to chunks and exports")
    r.add_argument("--input", required=True)
    r.add_argument("--output")
    r.add_argument("--config", help="a YAML file of settings")
    r.add_argument("--strategy", choices=list(config.PRESETS))
    r.add_argument("--chunk-size", type=int)
    r.add_argument("--chunk-overlap", type=int)
    r.add_argument("--no-llm", action="store_true", help="rules alone, no reviews")
    r.add_argument("--log-level", choices=["DEBUG", "INFO", "WARN", "ERROR"])
    r.add_argument("--dry-run", action="store_true", help="check and print the settings, then stop")
    g = todo.add_parser("graph", help="chunks to a knowledge graph")
    g.add_argument("--input", required=True)
    g.add_argument("--output", required=True)
    g.add_argument("--endpoint", default=config.Llm().endpoint)
    g.add_argument("--model", default=config.Llm().model)
    g.add_argument("--skip", type=int, default=0)
    g.add_argument("--limit", type=int, default=0)
    return p.parse_args(argv)


def settings(a: argparse.Namespace) -> dict:
    """The final settings of a run; an option that is not given changes nothing, 0 does."""
    given = {
        ("pdf", "path"): a.input, ("output", "dir"): a.output, ("chunk", "size"): a.chunk_size, ("chunk", "overlap"): a.chunk_overlap,
        ("llm", "enabled"): False if a.no_llm else None, ("runtime", "log_level"): a.log_level,
    }
    over: dict = {}
    for (section, key), value in given.items():
        if value is not None:
            over.setdefault(section, {})[key] = value
    return config.final_config(a.strategy, config.load_yaml(a.config) if a.config else None, over)


def read(spark, path: str, kind: str):
    """Page blocks or chunks, from Parquet if the path says so and from JSON lines otherwise."""
    from pagemill.sources import jsonl

    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return jsonl.read_blocks(spark, path) if kind == "blocks" else jsonl.read_chunks(spark, path)


def main(argv: Sequence[str] | None = None) -> int:
    a = parsed(argv)
    if a.command == "strategies":
        for s in config.strategies():
            print(f"{s['name']}{' (default)' if s['is_default'] else ''}: {s['description']}")
        return 0
    from pyspark.sql import SparkSession

    from pagemill.operators import graph, validation
    from pagemill.plans import pipeline

    if a.command == "graph":
        llm = config.Llm(endpoint=a.endpoint, model=a.model, timeout=120, retry_times=1)
        spark = SparkSession.builder.getOrCreate()
        ask = validation.http_client(llm, "{{CHUNK_TEXT}}", predict=2000)
        counts = pipeline.extract_graph(read(spark, a.input, "chunks"), ask, a.output, a.skip, a.limit, graph.TEMPLATE)
        print(json.dumps([r.asDict() for r in counts.collect()]))
        return 0
    d = settings(a)
    c = config.Config.from_dict(d)
    if bad := c.validate():
        print("\n".join(bad))
        return 1
    if a.dry_run:
        print(json.dumps(d, ensure_ascii=False, indent=2))
        return 0
    spark = SparkSession.builder.getOrCreate()
    spark.sparkContext.setLogLevel(c.runtime.log_level)
    ask = validation.http_client(c.llm) if c.llm.enabled and c.quality.llm_enabled else None
    print(json.dumps(pipeline.run(read(spark, a.input, "blocks"), c.output.dir, c, ask, a.strategy or config.DEFAULT_STRATEGY)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
