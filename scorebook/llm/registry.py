"""The queries of this subpackage by name, and DuckDB SQL for those that SQL can express."""

from scorebook.llm import (
    chat,
    decontamination,
    embedding_links,
    language_model,
    main_text,
    near_duplicates,
    pieces,
    quality,
    spelling,
    substrings,
    suffixes,
    token_counts,
    whitening,
)

MODULES = (quality, substrings, main_text, decontamination, near_duplicates, pieces, language_model, chat, suffixes,
           token_counts, spelling, whitening, embedding_links)
QUERIES = {k: f for m in MODULES for k, f in m.QUERIES.items()}
ORACLE = {k: s for m in MODULES for k, s in m.ORACLE.items()}
