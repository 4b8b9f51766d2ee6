"""The training-data queries by name, and their SQL where SQL can express them."""

from __future__ import annotations

from cohortline.llm import (
    decontaminate, exact_dedup, language_model, page_text, pieces, quality, repeats, runs, simhash, token_counts,
    token_files, tool_calls, whitening,
)

QUERIES = {
    "op1_page_text": page_text.op1_page_text,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_sentencepiece": pieces.op4_sentencepiece,
    "op5_quality": quality.op5_quality,
    "op6_repeats": repeats.op6_repeats,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_simhash": simhash.op8_simhash,
    "op9_language_model": language_model.op9_language_model,
    "op10_tool_calls": tool_calls.op10_tool_calls,
    "op11_token_files": token_files.op11_token_files,
    "op12_whitening": whitening.op12_whitening,
    "op13_runs": runs.op13_runs,
}
ORACLES = {
    "op2_decontaminate": decontaminate.SQL,
    "op7_exact_dedup": exact_dedup.SQL,
    "op10_tool_calls": tool_calls.SQL,
}
