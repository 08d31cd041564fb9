"""Press-monitoring analytics on PySpark: sources, operators, plans and streaming, all as DataFrame expressions."""
