"""atomframe: Spark operators for atomic-structure datasets and calculation campaigns."""
