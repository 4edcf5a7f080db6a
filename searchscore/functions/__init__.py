"""Column-level functions."""
from .text import (binary_label, common_words, common_words_with_text, java_split, len_of_attributes, len_of_query,
                   levenshtein_distance, levenshtein_to_text, name_value, num_of_attributes,
                   occurrences, ratio_of_common_words, regex_tokenize, snap_to_levels, spaced_words, text_length,
                   tokenize_ws, words)

__all__ = ["binary_label", "common_words", "common_words_with_text", "java_split", "len_of_attributes", "len_of_query",
           "levenshtein_distance", "levenshtein_to_text", "name_value", "num_of_attributes",
           "occurrences", "ratio_of_common_words", "regex_tokenize", "snap_to_levels", "spaced_words", "text_length",
           "tokenize_ws", "words"]
