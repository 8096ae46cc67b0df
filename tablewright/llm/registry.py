"""All queries of the text operators, with their SQL where it can be written."""

from tablewright.llm import chat, decontaminate, exact_dedup, fingerprint, language, license_scan, ngram_join, periodic_runs, pieces, prefix_trie, secret_scan, token_files, url_filter  # noqa: F401
from tablewright.llm.base import ORACLES, QUERIES  # noqa: F401
