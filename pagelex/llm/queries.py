"""The registered queries of the numbered operators and their DuckDB SQL."""

from __future__ import annotations

from pagelex.llm import bpe, decontaminate, fingerprint, language, lattice, line_dedup, lm_score, ngram_join, periodic, quality, toxicity, warc, whitening

QUERIES = {
    "op1_byte_bpe": bpe.query,
    "op2_fingerprint": fingerprint.query,
    "op3_ngram_join": ngram_join.query,
    "op4_line_dedup": line_dedup.query,
    "op5_decontaminate": decontaminate.query,
    "op6_lm_score": lm_score.query,
    "op7_quality": quality.query,
    "op8_warc": warc.query,
    "op9_language": language.query,
    "op10_toxicity": toxicity.query,
    "op11_whitening": whitening.query,
    "op12_periodic_runs": periodic.query,
    "op13_lattice_dedup": lattice.query,
}

ORACLE = {
    "op2_fingerprint": fingerprint.ORACLE,
    "op3_ngram_join": ngram_join.ORACLE,
    "op4_line_dedup": line_dedup.ORACLE,
    "op5_decontaminate": decontaminate.ORACLE,
    "op8_warc": warc.ORACLE,
    "op13_lattice_dedup": lattice.ORACLE,
}
