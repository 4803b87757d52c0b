"""A PySpark engine for tag-driven, incremental selection over object-metadata change journals."""
