"""Evidence engine on PySpark: DataFrame in, DataFrame out."""
