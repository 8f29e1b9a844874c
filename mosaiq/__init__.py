"""mosaiq: record linkage and corpus preparation as PySpark DataFrame plans."""
