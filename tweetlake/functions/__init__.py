"""Column-level functions: every one returns a ``pyspark.sql.Column`` built from
``pyspark.sql.functions`` so that it stays inside whole-stage codegen."""
