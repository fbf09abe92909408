"""Training-data operators on text and near-equal records."""
