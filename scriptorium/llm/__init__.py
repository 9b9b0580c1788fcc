"""Operators of a training-data pipeline over a `documents` table (doc_id, text, lang, source, n_chars).

Every operator reads only the columns it names, so further columns never clash; a missing text counts
as empty unless its docstring says otherwise. Nothing outside this subpackage imports it.
"""
