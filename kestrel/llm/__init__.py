"""Training-data operators: packing, token counts, de-duplication, sanitisation, scoring, encoding.

Nothing else in the library imports this package. Each module holds one operator with a
general interface; ``kestrel.llm.queries`` applies the operators to the whole test tables.
"""
