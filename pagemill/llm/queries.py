"""The queries of the operators for training text and their SQL where SQL can express them."""

from __future__ import annotations

from pagemill.llm import encoding, languages, leaks, lookalikes, mixing, neardups, pieces, quality, scans, sentences

QUERIES = {
    "p1_found": sentences.p1_found,
    "p1_units": sentences.p1_units,
    "p2_found": scans.p2_found,
    "p2_repaired": scans.p2_repaired,
    "p3_found": quality.p3_found,
    "p3_stats": quality.p3_stats,
    "p4_found": encoding.p4_found,
    "p4_restored": encoding.p4_restored,
    "p5_found": neardups.p5_found,
    "p5_groups": neardups.p5_groups,
    "p6_found": lookalikes.p6_found,
    "p6_canonical": lookalikes.p6_canonical,
    "p7_found": pieces.p7_found,
    "p7_pieces": pieces.p7_pieces,
    "p8_found": leaks.p8_found,
    "p8_spans": leaks.p8_spans,
    "p8_cleaned": leaks.p8_cleaned,
    "p8_items": leaks.p8_items,
    "p9_mix": mixing.p9_mix,
    "p9_order": mixing.p9_order,
    "p9_full_size": mixing.p9_full_size,
    "p9_report": mixing.p9_report,
    "p9_temperature": mixing.p9_temperature,
    "p10_found": languages.p10_found,
    "p10_documents": languages.p10_documents,
    "p10_passages": languages.p10_passages,
}
ORACLE = {
    "p7_found": pieces.P7_FOUND_SQL,
    "p8_found": leaks.P8_FOUND_SQL,
}
