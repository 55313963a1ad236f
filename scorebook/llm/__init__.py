"""Training-data operators (quality, dedup, decontamination, tokens, language model).

Nothing else in the library imports this subpackage.
"""
