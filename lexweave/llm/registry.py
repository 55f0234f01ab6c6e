"""Queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from . import fmindex, gif, html, langid, linedup, mixing, paragraphs, quality, simhash, warc

QUERIES = {
    "op1_language_id": langid.op1_language_id,
    "op2_line_dedup": linedup.op2_line_dedup,
    "op3_simhash": simhash.op3_simhash,
    "op4_warc": warc.op4_warc,
    "op5_paragraph_dedup": paragraphs.op5_paragraph_dedup,
    "op6_media_columns": gif.op6_media_columns,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_decontamination": fmindex.op8_decontamination,
    "op9_html_text": html.op9_html_text,
    "op10_quality": quality.op10_quality,
}

ORACLES = {
    "op2_line_dedup": linedup.SQL_OP2,
    "op4_warc": warc.SQL_OP4,
    "op7_mix_sources": mixing.SQL_OP7,
    "op8_decontamination": fmindex.SQL_OP8,
}
