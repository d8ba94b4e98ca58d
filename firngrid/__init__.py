"""firngrid: gridded hazard analytics as PySpark DataFrame operators."""
