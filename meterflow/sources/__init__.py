"""Record sources: DataFrames ready for ``to_metrics``."""
