"""Operators for training-data pipelines: language identification, pseudonyms,
near duplicates, decontamination, licence scans, token counts, web archives, page
text and source mixing. Every operator takes and returns DataFrames; the
registered queries are in ``framewell.llm.queries``."""
