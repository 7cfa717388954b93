"""Knowledge graphs from replies of a language model: prompts, parsing, first-wins merging, counts by type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions.text import col, strip
from pagemill.operators.validation import first_rows

REPLY = (
    "entities array<struct<name:string,type:string,description:string>>, "
    "relations array<struct<source:string,relation:string,target:string,confidence:double>>"
)
MIN_CONTENT = 100

# The types that a graph of software architecture is asked for.
ENTITY_TYPES = ["Method", "Model", "ArchitectureView", "DesignStage", "QualityAttribute", "Concept"]
RELATION_TYPES = ["includes", "consists_of", "applies_to", "affects", "defines", "compares_with", "belongs_to", "supports"]
TEMPLATE = (
    "Extract the entities and relations of software architecture that this text states.\n"
    f"Entity types: {', '.join(ENTITY_TYPES)}\nRelation types: {', '.join(RELATION_TYPES)}\n"
    "Leave out what is uncertain; give empty arrays if there is nothing. Answer in JSON alone:\n"
    '{"entities":[{"name":"","type":"","description":""}],"relations":[{"source":"","relation":"","target":"","confidence":0.9}]}\n\n'
    "Text:\n{{CHUNK_TEXT}}\n\nJSON:"
)


def prompt(template: str, content: Column | str) -> Column:
    return F.replace(F.lit(template), F.lit("{{CHUNK_TEXT}}"), col(content))


def selected(chunks: DataFrame, skip: int = 0, limit: int = 0, order: str = "chunk_id") -> DataFrame:
    """Skip and limit in order, then drop short contents; 0 is no limit."""
    out = chunks.orderBy(order)
    out = out.offset(skip) if skip > 0 else out
    out = out.limit(limit) if limit > 0 else out
    return out.filter(F.length("content") >= MIN_CONTENT)


def parsed(reply: Column | str) -> Column:
    """The reply as JSON, else what stands between its first and last brace; null if neither is."""
    r = col(reply)
    whole = F.when(F.get_json_object(r, "$").isNotNull(), F.from_json(r, REPLY))
    return F.coalesce(whole, F.from_json(F.nullif(F.regexp_extract(r, r"(?s)(\{.*\})", 1), F.lit("")), REPLY))


def entities(replies: DataFrame) -> DataFrame:
    """Entities by stripped name, the first in (ord, pos) wins and keeps its spelling; blank names are dropped."""
    each = replies.select("ord", F.posexplode(F.col("graph.entities")).alias("pos", "e"))
    named = each.withColumn("key", strip("e.name")).filter(F.length("key") > 0)
    return first_rows(named, ["key"], ["ord", "pos"]).select("e.*")


def relations(replies: DataFrame) -> DataFrame:
    """Relations by (source, relation, target), the first wins; those without source or target are dropped."""
    each = replies.select("ord", F.posexplode(F.col("graph.relations")).alias("pos", "r")).select("ord", "pos", "r.*")
    full = each.filter((F.length("source") > 0) & (F.length("target") > 0))
    return first_rows(full, ["source", "relation", "target"], ["ord", "pos"]).select("source", "relation", "target", "confidence")


def counts(ents: DataFrame, rels: DataFrame) -> DataFrame:
    a = ents.groupBy(F.lit("entity").alias("what"), F.coalesce("type", F.lit("unknown")).alias("type")).agg(F.count("*").alias("n"))
    b = rels.groupBy(F.lit("relation").alias("what"), F.coalesce("relation", F.lit("unknown")).alias("type")).agg(F.count("*").alias("n"))
    return a.unionByName(b)
