"""A PySpark engine for image-and-caption datasets and training corpora."""
