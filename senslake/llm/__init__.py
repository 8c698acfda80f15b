"""Training-data operators: packing, decontamination, PII, chat formatting, quality, language, toxicity,
token files, substring and near-duplicate removal. Nothing else in the library imports this subpackage."""
