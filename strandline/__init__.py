"""strandline: sequence-alignment analytics expressed as Spark DataFrames."""
