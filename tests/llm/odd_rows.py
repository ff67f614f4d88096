"""Texts and columns of the odd rows that every training-data operator is tested on."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, row long, spans string, n_words long"
EN = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the river bank"
