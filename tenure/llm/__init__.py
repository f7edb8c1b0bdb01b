"""Training-data operators (quality, toxicity, language, dedup, PII, tokens, packing).

Nothing else in the library imports this subpackage.
"""
