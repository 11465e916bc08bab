"""Prepare large document catalogues on Spark and prove that they are complete."""
