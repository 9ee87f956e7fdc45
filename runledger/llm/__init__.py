"""Operators for preparing training data: mixing, search, classifiers, filters, duplicates,
decontamination and token counts. Nothing else in the library imports this package."""
