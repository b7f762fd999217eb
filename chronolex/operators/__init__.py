"""Steps of the corpus pipeline as DataFrame transformations."""
