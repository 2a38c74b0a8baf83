"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from . import divergence, fingerprints, html_text, language, licenses, lines, mixing, packing, resampling, simhash, substrings, token_files, topk

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _module in (fingerprints, language, lines, token_files, licenses, packing, html_text, simhash, mixing, topk, substrings, divergence, resampling):
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
