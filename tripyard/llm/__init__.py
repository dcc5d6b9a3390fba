"""Training-data operators: filters, joins, packing and scoring for large text tables.

Nothing outside this subpackage imports it; its queries are listed in
:mod:`tripyard.llm.queries`.
"""
