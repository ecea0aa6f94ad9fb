"""Revenue-operations analytics as Spark DataFrame operators and ready-made plans."""
