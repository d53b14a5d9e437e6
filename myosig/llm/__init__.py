"""Training-data operators: fingerprints, license scan, packing, language id, LM scoring, chat
formatting, source mixing, near-duplicate join, quality voting, quality rules, ranked search,
embedding near-duplicates and fill-in-middle texts.

Nothing else in the library imports this subpackage.
"""
