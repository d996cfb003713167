"""Social-text warehouse and analytics on PySpark DataFrames."""
