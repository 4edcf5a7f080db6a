"""Training-data operators: mixing, decontamination, chat formatting, HTML
extraction, line dedup, quality rules, SimHash near-dedup, toxicity, personal
data and URL filters. Nothing else in the library imports this package."""
