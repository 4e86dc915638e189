"""Training-data operators: media columns, toxicity, packing, HTML extraction,
quality, WARC, decontamination, pseudonyms, token counts and near-duplicates.

Nothing outside this subpackage imports it.
"""
